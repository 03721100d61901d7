"""Corpus cleaning pipeline: toxicity, line dedup, SimHash near-dedup,
benchmark decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; between stages the documents are written as Parquet to the shared
checkpoint folder and read again. All stages but the last return the columns
of their input. An empty input passes through; columns other than doc_id,
text and n_chars are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from ratebook.llm.common import crc_class, prepare, staged
from ratebook.llm.queries import TOXIC, default_tokenizer, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold. The classifier learns
    from labelled documents outside the held-out class."""
    prepare(spark)
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels").where(crc_class("doc_id", 4) != 2))
    scored = toxicity.score(docs, weights, out_col="__score")
    return scored.where(F.col("__score") < TOXIC).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one, however short
    if it is equal; a document of which nothing is left goes."""
    prepare(spark)
    out = line_dedup.without_lines(docs, staged(line_dedup.dropped_lines(docs), "dropped")).where("not __emptied")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written with a number of its own for every row, so that rows
    with one id, or none, are judged each by its own text."""
    return staged(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest id, of
    several the first; a row without an id stays only if the group has none
    with an id."""
    prepare(spark)
    rows = numbered(docs)
    groups = simhash.near_duplicates(rows, "__row", shingle=4, max_bits=4).select(F.col("doc_id").alias("__row"), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__row")
    stay = (rows.select("doc_id", "__row").join(groups, "__row").groupBy("component_id")
            .agg(F.min(rank).alias("first")).select(F.col("first.__row").alias("__row")))
    return rows.join(stay, "__row", "left_semi").select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no template passage with a benchmark item, not even
    beside a slot that conflicts elsewhere."""
    prepare(spark)
    rows = numbered(docs)
    hit = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"), "__row").select(F.col("doc_id").alias("__row"))
    return rows.join(hit.distinct(), "__row", "left_anti").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids (little-endian unsigned 32-bit) and their digest, and
    the digest of the decoded text."""
    prepare(spark)
    path = default_tokenizer()
    # Written in between: encoding and decoding in one task would hold two
    # Python workers, each with its tokenizer, beside every core.
    out = bpe.decode(staged(bpe.encode(docs, path), "ids"), path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("simhash_near_dedup", near_copies),
          ("benchmark_decontamination", benchmark_free), ("bpe_encoding", encoded)]

# The classifier, SimHash and BPE have no SQL form; tests/llm/test_pipeline.py
# holds the rows against the stages' rules in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
