"""The pipeline's stages against plain rules, and its registration."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, size = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        docs = P.staged(out, name)
        assert 0 < docs.count() <= size
        size = docs.count()
    last = P.STAGES[-1][1](spark, docs, SF)
    assert last.count() == size
    assert P.run(spark, SF).count() == size


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES], ids=[n for n, _ in P.STAGES])
def test_messy_documents(messy, docs, spark, stage):
    frame = messy.drop("ids")
    out = stage(spark, frame, SF)
    ids = [r.doc_id for r in out.collect()]
    if stage is P.lines:
        assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 4, 6, 7]
    elif stage is P.near_copies:
        assert sorted(i for i in ids if i != 5) == [1, 4, 6, 7]  # the rows without an id are copies of 1 and 4
    elif stage is not P.toxic:
        assert len(ids) == frame.count()
    if stage not in (P.toxic, P.near_copies):  # the first depends on the few labels of these ids
        assert ids.count(None) == 2
    assert stage(spark, docs([]).drop("ids"), SF).count() == 0


def test_benchmark_free_drops_copies_with_one_changed_name(docs, spark, tmp_path):
    question = ("a train leaves with Anna Smith aboard and travels 120 km in 3 hours, so how fast does Anna ride "
                "the train today")
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, question.replace("does Anna", "does Berta")), (2, "nothing of it stands here " * 4)]
    assert [r.doc_id for r in P.benchmark_free(spark, docs(rows), str(tmp_path)).collect()] == [2]


def test_lines_drops_equal_short_lines(docs, spark):
    rows = [(1, "Les.\n\nthis line is long enough\n \nAnd"), (2, "a line of its own here\nLes.\n\nLess.\n \nAnd")]
    got = {r.doc_id: r.text for r in P.lines(spark, docs(rows), SF).collect()}
    assert got == {1: rows[0][1], 2: "a line of its own here\n\nLess.\n "}


def test_near_copies_judges_rows(docs, spark):
    """Rows that share an id are judged by their own texts, and rows without
    an id too."""
    a, b = "a b c d e f", "z y x w v u t s r q"
    rows = [(1, a), (1, b), (2, a), (None, b), (None, "only here " * 9), (None, "only here " * 9), (0, "k l m n o p q " * 3)]
    got = sorted(((r.doc_id is None, r.doc_id, r.text) for r in P.near_copies(spark, docs(rows), SF).collect()), key=repr)
    assert got == sorted([(False, 1, a), (False, 1, b), (False, 0, rows[-1][1]), (True, None, rows[4][1])], key=repr)


def plain_pipeline(rows, toxic_word, items, encode):
    """The stages' rules over {doc_id: text}, one after the other."""
    from test_dedup import brute_simhash, edits
    kept = {d: t for d, t in rows if toxic_word not in t}
    # equal lines, and lines of ten or more within one edit, behind an earlier one
    occurs = [((d, i), x) for d, t in sorted(kept.items()) for i, x in enumerate(t.split("\n")) if x.strip(" \t\r")]
    gone = {p for p, x in occurs if any(q < p and edits(x, y) <= (1 if min(len(x), len(y)) >= 10 else 0) for q, y in occurs)}
    cut = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in kept.items()}
    kept = {d: t for d, t in cut.items() if not (any(g[0] == d for g in gone) and not t.strip())}
    # one of each group of fingerprints that four bits link
    code, group = {d: brute_simhash(t) for d, t in kept.items()}, {d: d for d in kept}
    while True:
        new = {d: min(group[e] for e in kept if (code[d] ^ code[e]).bit_count() <= 4) for d in kept}
        if new == group:
            break
        group = new
    kept = {d: t for d, t in kept.items() if group[d] == d}
    # no three windows of eight words of an item, whatever its numbers
    def windows(t):
        w = ["#" if x.isdigit() else x for x in t.lower().split()]
        return {tuple(w[i:i + 8]) for i in range(len(w) - 7)}
    kept = {d: t for d, t in kept.items() if all(len(windows(t) & windows(x)) < 3 for x in items)}
    return {d: encode(t) for d, t in kept.items()}


def test_run_against_plain_rules(spark, tmp_path):
    import hashlib
    import random
    import struct

    from tokenizers import Tokenizer

    from ratebook.llm.queries import default_tokenizer
    rnd = random.Random(4)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    line = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    item = "how many apples has the farmer left when 12 of the 40 apples go to the market with 3 boys"
    shared, long = line(6), "\n".join(line(9) for _ in range(6))
    rows = []
    for d in range(160):
        text = [line(rnd.randint(3, 14)) for _ in range(rnd.randint(1, 7))]
        if d % 4 == 0:
            text.insert(1, f"{line(4)} zorgblat {line(3)} zorgblat")
        if d % 9 == 1:
            text.append(shared if d % 2 else shared[:-1] + "Q")
        if d % 16 == 3:
            text = [x + " " for x in long.split("\n")] + ([] if d < 40 else [f"end {d}"])
        if d % 23 == 5:
            text += [f"the farmer asks {item.replace('12', str(d)).replace('40', str(d + 60))} he says"]
        rows.append((d, "\n".join(text)))
    rows += [(200, rows[2][1]), (201, "Les.\n" + line(5)), (202, "Les."), (203, "")]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", P.F.length("text").cast("long")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, int("zorgblat" in t)) for d, t in rows if d < 150], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    library = Tokenizer.from_file(default_tokenizer())

    def encode(text):
        ids = library.encode(text, add_special_tokens=False).ids
        return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()

    want = plain_pipeline(rows, "zorgblat", [item], encode)
    got = {r.doc_id: r.ids_sha256 for r in P.run(spark, str(tmp_path)).collect()}
    assert got == want
    assert 90 < len(want) < 120 and not {d for d, _ in rows if d % 23 == 5} & want.keys()


def test_encoding_and_decoding_do_not_share_a_task(spark):
    """The last stage holds one Python worker a task, not two."""
    docs = spark.createDataFrame([(1, "one two"), (2, None), (None, "")], "doc_id long, text string")
    out = P.encoded(spark, docs, "")
    assert "MapInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 3
