"""Language identification: sizes against one-shot zstandard, held-out accuracy."""

import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ratebook.llm import language_id as LI
from ratebook.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def by_hand(model, text):
    """(language, margin) of a text, each block encoded alone."""
    words = re.sub(r"[\W\d_]+", " ", text.lower()).strip(" ").split(" ")
    kept = [w for i, w in enumerate(words) if i == 0 or w != words[i - 1]]
    data = "".join(w + " " for w in kept).encode()
    sizes = []
    for content in model.dictionaries:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LI.LEVEL)
        c = zstandard.ZstdCompressor(level=LI.LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
        sizes.append(sum(len(c.compress(data[i:i + LI.BLOCK])) for i in range(0, len(data), LI.BLOCK)))
    best = min(range(len(sizes)), key=lambda j: (sizes[j], -model.shares[j], j))
    second = sorted(sizes)[1]
    return model.languages[best], (second - sizes[best]) / second


@pytest.fixture(scope="module")
def model(spark):
    return LI.fit(spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 3 <> 0"))


def test_sizes_by_hand(spark, model):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 3 = 0 and text rlike '[a-z]'").limit(120)
    for r in LI.identify(rows, model).collect():
        lang, margin = by_hand(model, r.text)
        assert (r.language.lang, r.language.margin) == (lang, pytest.approx(margin))
        assert r.language.rejected == (margin < LI.MARGIN) and 0 <= r.language.score <= 1


def test_held_out_accuracy(spark):
    got = REGISTRY["op13_language_id"](spark, SF).where("held_out")
    want = spark.read.parquet(f"{SF}/documents.parquet").where("text rlike '\\\\p{L}'").select("doc_id", "lang")
    n, right = got.join(want, "doc_id").agg(F.count(F.lit(1)), F.sum((F.col("lang_pred") == F.col("lang")).cast("int"))).first()
    assert right / n >= 0.98


def test_sure_predictions_are_not_rejected(spark, model):
    rows = LI.identify(spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 1000"), model)
    assert rows.where("language.rejected").count() < 0.1 * rows.count()


def test_messy_rows(spark, model, messy):
    got = {r.doc_id: r.language for r in LI.identify(messy, model).collect()}
    for i in (1, 2, 3, None):
        if i is not None:
            assert (got[i].lang, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[7].lang in model.languages and got[6] == got[8]
    assert LI.identify(messy, model).count() == messy.count()
    assert LI.identify(messy, model).columns == [*messy.columns, "language"]


def test_whole_text_counts(docs, model, spark):
    de, fr = (spark.read.parquet(f"{SF}/documents.parquet").where(f"lang = '{x}' and n_chars > 3000").first().text
              for x in ("de", "fr"))
    text = fr[:2000] + "\n" + "\n".join([de[:3000]] * 20)
    assert LI.identify(docs([(1, text)]), model).first().language.lang == "de"


def test_no_labels_and_one_label(docs, spark):
    rows = docs([(1, "one text"), (2, None)])
    none = LI.fit(rows.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r.language) for r in LI.identify(rows, none).collect()} == {("und", 0.0, 0.0, True)}
    one = LI.fit(rows.withColumn("lang", F.lit("xx")))
    assert [r.language.lang for r in LI.identify(rows, one).orderBy("doc_id").collect()] == ["xx", "und"]
    tiny = LI.fit(docs([(1, "ab"), (2, "?"), (3, "ab")]).withColumn("lang", F.when(F.col("doc_id") == 2, "b").otherwise("a")))
    assert tiny.languages == ["a", "b"] and LI.identify(rows, tiny).first().language.lang == "a"
    assert LI.identify(docs([]), one).collect() == []


def test_repeats_count_once(docs, spark):
    rows = docs([(1, "Ab  ab AB, ab cd cd ab"), (2, "x" * 50_000 + " " + "y " * 50_000), (3, "12 -- 3")])
    got = [r.t for r in rows.select(LI.letters(F.col("text")).alias("t")).collect()]
    assert got == ["ab cd ab ", "x" * 50_000 + " y ", ""]


def test_choice_of_equal_sizes():
    m = LI.Model(["a", "b", "c"], [b"", b"", b""], np.array([0.2, 0.4, 0.4]))
    best, score, lead = LI.choose(np.array([[5, 5, 5], [4, 5, 5]]), m)
    assert best.tolist() == [1, 0] and lead.tolist() == [0, 0.2] and score[0] == pytest.approx(0.4)
