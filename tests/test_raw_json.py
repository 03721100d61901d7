"""Raw JSON rows: arrays cut in parallel splits, JSON lines, unreadable texts."""

import json
import os
import random

import pytest

from ratebook.sources import json_arrays as JA
from ratebook.sources.readers import read_raw, split_corrupt

TEXTS = ["plain", "a { b", "} ] , [", 'say "hi" {', "back\\slash\\", "\\\"{", "é 中 😀\n\t", "", "{{{{", "[1, {2}]", "﻿[{"]


@pytest.fixture()
def split_bytes(spark):
    """Sets the size of an input split; restored afterwards."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
    yield set_to
    for n, v in old.items():
        spark.conf.set(n, v)


def rows(n, seed, nested=False):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        row = {f"k{j}": rng.choice(TEXTS) for j in range(rng.randint(0, 4))}
        row["i"] = str(i)
        if nested and i % 3 == 0:
            row["n"] = {"x": [{"y": rng.choice(TEXTS)}, 1], "z": {}}
        out.append(row)
    return out


def plain(got):
    """Nested values, which are read as JSON text, as values again."""
    return [{k: json.loads(v) if k == "n" else v for k, v in r.items()} for r in got]


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def read(spark, path, form="auto"):
    good, bad = split_corrupt(read_raw(spark, path, form))
    return [dict(r.cells) for r in good.orderBy("ord").collect()], [r[0] for r in bad.orderBy("ord").collect()]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("nested", [False, True])
@pytest.mark.parametrize("size", [97, 1500, 10_000_000])
def test_arrays_in_splits(spark, tmp_out, split_bytes, indent, nested, size):
    n = 20 if size < 1000 else 400
    want = rows(n, size, nested)
    path = os.path.join(tmp_out, "a b[1].json")
    write(path, json.dumps(want, indent=indent, ensure_ascii=False))
    split_bytes(size)
    got, bad = read(spark, tmp_out)
    assert plain(got) == want and bad == []
    if size < 10_000:
        assert JA._pieces(spark, [tmp_out]).rdd.getNumPartitions() > 5
        assert JA.split_table(spark, [tmp_out]).count() > 5


def test_splits_in_a_shuffle_join(spark, tmp_out, split_bytes, monkeypatch):
    want = rows(80, 5, nested=True)
    write(os.path.join(tmp_out, "x.json"), json.dumps(want, ensure_ascii=False))
    split_bytes(700)
    monkeypatch.setattr(JA, "SPLITS", 0)
    got, bad = read(spark, tmp_out, "array")
    assert plain(got) == want and bad == []


def test_many_files_of_both_forms(spark, tmp_out, split_bytes):
    want = []
    for k in range(6):
        part = rows(40, k)
        text = "﻿  \n" * (k == 2) + json.dumps(part, indent=k) if k % 2 == 0 else "\n".join(map(json.dumps, part)) + "\n\n"
        write(os.path.join(tmp_out, f"f{k}.json"), text)
        want += part
    write(os.path.join(tmp_out, "f6.json"), "")
    write(os.path.join(tmp_out, "f7.json"), " [ ] ")
    split_bytes(900)
    got, bad = read(spark, tmp_out)
    assert got == want and bad == []


def test_what_is_no_object(spark, tmp_out):
    write(os.path.join(tmp_out, "a.json"), '[5, {"a": "1"}, "x", 6, {"b": }, null, {"c": "3"} ,7]\n[{"d": "4"}]\n')
    write(os.path.join(tmp_out, "b.json"), '{"e": "5"}\nnot json\n[1]\n{"f": "6"\n')
    got, bad = read(spark, tmp_out)
    assert got == [{"a": "1"}, {"c": "3"}, {"d": "4"}, {"e": "5"}]
    assert bad == ["5", '"x", 6', '{"b": }', "null", "7", "not json", "[1]", '{"f": "6"']


def test_cut_off_array_keeps_what_is_whole(spark, tmp_out):
    text = json.dumps(rows(5, 1))
    write(os.path.join(tmp_out, "a.json"), text[:-4])
    got, bad = read(spark, tmp_out)
    assert got == rows(5, 1)[:4] and len(bad) == 1


def test_unmatched_quote_is_not_gathered(spark, tmp_out, split_bytes, monkeypatch):
    monkeypatch.setattr(JA, "RECORD_BYTES", 200)
    text = '[{"a": "1"}, {"b": "2}' + ', {"c": "3"}' * 100 + "]"
    write(os.path.join(tmp_out, "a.json"), text)
    split_bytes(300)
    got, bad = read(spark, tmp_out)
    assert got == [{"a": "1"}]
    assert sum(t.count('"c"') for t in bad) == 100 and max(map(len, bad)) < 200


def test_empty_folder_and_fields(spark, tmp_out):
    write(os.path.join(tmp_out, "a.json"), "")
    got = read_raw(spark, tmp_out)
    assert got.columns == ["cells", "_corrupt", "ord"] and got.count() == 0
