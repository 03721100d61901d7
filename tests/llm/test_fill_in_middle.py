"""Fill-in-the-middle against plain slicing of Python strings."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratebook.llm import fill_in_middle as FM


def plain(doc_id, text):
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(frame):
    out = FM.fill_in_middle(frame).withColumn("back", FM.restored(F.col("output"), F.col("form")))
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out.collect()), key=key)
    want = sorted(((r.doc_id, *plain(r.doc_id, r.text), r.text or "") for r in frame.collect()), key=key)
    assert got == want
    return got


def test_unit_index_against_decoding():
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = "".join(rng.choice(list("aé中😀 \x00\x7f߿"), rng.integers(0, 40)))
        data = text.encode()
        index = FM.UnitIndex(data)
        ends = np.cumsum([0] + [len(c.encode()) for c in text])
        assert index.select(np.arange(len(text) + 1)).tolist() == ends.tolist()
        assert index.rank(ends).tolist() == list(range(len(text) + 1))


def test_messy_rows(messy):
    check(messy)


def test_many_texts_of_all_widths(docs):
    alphabet = "ab é中😀\x00"
    rows = [(i, "".join(alphabet[(i * 7 + j * j) % 7] for j in range(i % 41))) for i in range(600)]
    forms = {r[2] for r in check(docs(rows))}
    assert forms == {"plain", "psm", "spm"}


def test_sentinels_in_text_stay_plain(docs):
    rows = [(i, f"text {'é' * i} <S> here") for i in range(20)] + [(i, "< P> <<S <M" + "x" * i) for i in range(20, 60)]
    got = check(docs(rows))
    assert {r[2] for r in got if r[0] < 20} == {"plain"}
    assert {r[2] for r in got if r[0] >= 20} == {"plain", "psm", "spm"}


def test_own_sentinels_and_shares(docs):
    marks = ("\u0001p", "\u0001s", "\u0001m")
    out = FM.fill_in_middle(docs([(1, "some text")]), seed=5, fim_percent=100, spm_percent=100, sentinels=marks)
    row = out.withColumn("back", FM.restored(F.col("output"), F.col("form"), marks)).first()
    assert row.form == "spm" and row.output.startswith("\u0001s") and row.back == "some text"
    with pytest.raises(ValueError):
        FM.fill_in_middle(docs([]), sentinels=("<P>", "<S>", "x<"))


def test_empty_table(docs):
    assert FM.fill_in_middle(docs([])).collect() == []


def test_given_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
