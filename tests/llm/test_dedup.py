"""SimHash near-duplicates, substring dedup and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from ratebook.llm import line_dedup as LD
from ratebook.llm import simhash as SH
from ratebook.llm import substring_dedup as SD
from ratebook.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_simhash(text, n=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, bits):
    code = np.array(codes, dtype=np.uint64)
    near = np.bitwise_count(code[:, None] ^ code[None, :]) <= bits
    label = np.arange(len(code))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(code))])
        if (new == label).all():
            return label
        label = new


def test_fingerprints():
    rnd = random.Random(3)
    for n in (0, 1, 3, 4, 5, 40, 400):
        text = " ".join(rnd.choice(["A", "b", "É", "中", "the\vx", "of"]) for _ in range(n))
        assert SH.simhash(text, 4) == brute_simhash(text)


@pytest.mark.parametrize("spread", [64, 9])
def test_index_links_equal_brute_force(spread):
    rnd = np.random.default_rng(5)
    centre = rnd.integers(0, 1 << 63, 12, dtype=np.uint64)
    codes = {int(c) for c in centre}
    for c in centre:
        for _ in range(40):
            flips = rnd.choice(spread, rnd.integers(1, 8), replace=False)
            codes.add(int(c) ^ sum(1 << int(f) for f in flips))
    codes = sorted(codes)
    code = np.array(codes, dtype=np.uint64)
    order = np.argsort(SH.gray_rank(code), kind="stable")
    got = SH.link_units(np.zeros(len(code), np.int64), code[order], 4)
    want = brute_components([codes[i] for i in order], 4)
    assert (got == want).all()


def test_near_duplicates_hot_node_is_split(spark, monkeypatch):
    monkeypatch.setattr(SH, "NODE_LIMIT", 7)
    rnd = np.random.default_rng(6)
    codes = sorted({int(rnd.integers(0, 1 << 30)) ^ int(1 << int(rnd.integers(0, 30))) for _ in range(60)} |
                   {1 << b for b in range(40)} | {0})
    frame = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "fp long, rep long")
    found = {r.id: r.component for r in components(SH.links(frame, 4)).collect()}
    want = brute_components(codes, 4)
    assert [found.get(i, i) for i in range(len(codes))] == want.tolist()


def test_near_duplicates_messy(messy, docs):
    got = sorted(SH.near_duplicates(messy).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.fp))
    assert len(got) == messy.count()
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[4] == 4 and by_id[8] == 6
    assert SH.near_duplicates(docs([])).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(70, 71), (71, 70), (90, 90)], "u long, v long")
    found = {r.id: r.component for r in components(chain).collect()}
    assert found == {i: 0 for i in range(51)} | {70: 70, 71: 70}


def brute_substring(rows, width):
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d, w in words.items():
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in words.items():
        gone = {p for i in range(len(w) - width + 1) if first[tuple(w[i:i + width])] < d for p in range(i, i + width)}
        kept = [x for p, x in enumerate(w) if p not in gone]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2_000, 1])
def test_substring_dedup(docs, monkeypatch, hot):
    monkeypatch.setattr(SD, "HOT_FRAGMENTS", hot)
    rnd = random.Random(8)
    vocab = ["the", "of", "é", "a"] + [f"w{i}" for i in range(60)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    rows = []
    for d in range(60):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        if d % 3 == 0:
            a = rnd.randint(0, 40)
            w[len(w) // 2:len(w) // 2] = passage[a:a + rnd.randint(5, 50)]
        if d % 7 == 0:
            w += ["a", "b"] * 20
        rows.append((d, " ".join(w)))
    rows += [(60, rows[3][1]), (61, None), (62, "x " * 12), (63, "x " * 13), (64, "\u00a0".join("y" * 20))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in SD.without_repeats(docs(rows)).collect()}
    assert got == brute_substring(rows, 13)


def test_substring_dedup_messy(messy, docs):
    got = SD.without_repeats(messy).collect()
    assert len(got) == messy.count()
    assert [r.n_removed for r in got if r.doc_id == 4] == [0, 0]
    assert [r.n_removed for r in got if r.doc_id == 5] == [28]
    assert [r.n_removed for r in got if r.doc_id == 8] == [30_001]
    assert [r.n_removed for r in got if r.doc_id is None] == [0, 0]
    assert SD.without_repeats(docs([])).count() == 0


def edits(a, b):
    if abs(len(a) - len(b)) > 1:
        return 2
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b))
    a, b = sorted((a, b), key=len)
    return 1 if any(b[:i] + b[i + 1:] == a for i in range(len(b))) else 2


def test_line_dedup(docs):
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abé中 ") for _ in range(rnd.randint(8, 40))) for _ in range(25)] + ["a" * 12, "ab" * 9]
    rows = []
    for d in range(40):
        text = []
        for _ in range(rnd.randint(0, 5)):
            s = rnd.choice(base)
            for _ in range(rnd.randint(0, 2)):
                i = rnd.randrange(len(s))
                s = rnd.choice([s[:i] + s[i + 1:], s[:i] + "Z" + s[i:], s[:i] + "Q" + s[i + 1:], s])
            text.append(s)
        rows.append((d, "\n".join(text)))
    rows += [(50, "Les.\n\nAnd"), (51, "Less.\n \nLes.\n\t\nAnd\n123456789"), (52, "123456789\n12345678\nLes.\n0123456789")]
    occurs = [((d, i), s) for d, t in rows for i, s in enumerate(t.split("\n")) if s.strip(" \t\r")]
    want = {}
    for place, s in occurs:
        bound = 1 if len(s) >= 10 else 0
        least = min((q, edits(s, t)) for q, t in occurs if edits(s, t) <= (bound if len(t) >= 10 else 0))
        if least[0] < place:
            want[place] = least
    got = {(r.doc_id, r.line_no): ((r.keep_doc_id, r.keep_line_no), r.distance)
           for r in LD.dropped_lines(docs(rows)).collect()}
    # The kept place is a line's first occurrence; its distance is that line's.
    assert got.keys() == want.keys()
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert any(v[1] for v in got.values()) and {(51, 2), (51, 4), (52, 0), (52, 2)} <= got.keys()


def test_line_dedup_messy_and_apply(messy, docs):
    dropped = LD.dropped_lines(messy)
    got = {(r.doc_id, r.line_no): r.keep_doc_id for r in dropped.collect()}
    assert got == {(5, 0): 4, (5, 1): 4, (8, 0): 6}
    left = LD.without_lines(messy, dropped).collect()
    assert len(left) == messy.count()
    assert {r.doc_id for r in left if r["__emptied"]} == {5, 8}
    assert all(r.emptied == "clash" for r in left)
    assert LD.dropped_lines(docs([])).count() == 0
