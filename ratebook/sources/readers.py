"""Scans (S1-S9): every reader takes an explicit schema or reads strings,
so codes keep their leading zeros and no type inference runs on the data."""

from __future__ import annotations

import functools
import os
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebook.fixed import SEED_SOURCE_NAME, SEED_SOURCE_URL
from ratebook.functions.rates import RATE_TYPE
from ratebook.session import is_local
from ratebook.sources import json_arrays


def ensure_parallel(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over the cluster's cores when it came out as fewer
    partitions (e.g. one unsplittable row group), on a local master only: a
    cluster's scans are never shuffled for it."""
    if not is_local(df.sparkSession):
        return df
    try:
        sc = df.sparkSession.sparkContext
        want = min_partitions or sc.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - Spark Connect exposes no partition count
        return df
    return df.repartition(want) if have < want else df


def read_parquet(spark: SparkSession, path: str, spread: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return ensure_parallel(df) if spread else df


SEED_SCHEMA = T.StructType([
    T.StructField("hsn_code", T.StringType()),
    T.StructField("gst_description", T.StringType()),
    T.StructField("igst_rate", RATE_TYPE),
    T.StructField("cess_rate", RATE_TYPE),
    T.StructField("schedule", T.StringType()),
])

def read_seed(spark: SparkSession, path: str, source_name: str = SEED_SOURCE_NAME,
              source_url: str = SEED_SOURCE_URL) -> DataFrame:
    """Seed CSV (hsn_code, gst_description, igst_rate, cess_rate,
    schedule) -> records. cgst = sgst = igst / 2 when igst > 0 else 0;
    confidence high; file order kept in ``ord``."""
    raw = spark.read.schema(SEED_SCHEMA).option("header", True).option("escape", '"').csv(path).withColumn("ord", file_order())
    return seed_records(raw, source_name, source_url)


def seed_records(raw: DataFrame, source_name: str = SEED_SOURCE_NAME,
                 source_url: str = SEED_SOURCE_URL) -> DataFrame:
    from ratebook.functions.text import dec_text, stable_id
    igst = F.col("igst_rate").cast(RATE_TYPE)
    half = F.when(igst > 0, (igst / 2).cast(RATE_TYPE)).otherwise(F.lit(0).cast(RATE_TYPE))
    return raw.select(
        stable_id("hsn_code", "gst_description", dec_text(igst)).alias("product_id"),
        F.lit("").alias("product_name"), F.lit("other").alias("top_category"),
        F.lit("uncategorized").alias("sub_category"),
        F.coalesce("hsn_code", F.lit("")).alias("hsn_code"),
        F.coalesce("gst_description", F.lit("")).alias("gst_description"),
        F.coalesce("schedule", F.lit("")).alias("schedule"), F.lit("").alias("serial_no"),
        half.alias("cgst_rate"), half.alias("sgst_rate"), igst.alias("igst_rate"),
        F.coalesce(F.col("cess_rate").cast(RATE_TYPE), F.lit(0).cast(RATE_TYPE)).alias("cess_rate"),
        F.lit(None).cast("date").alias("effective_from"),
        F.lit(source_name).alias("source_name"), F.lit(source_url).alias("source_url"),
        F.lit("").alias("raw_text"), F.lit("high").alias("confidence_flag"), "ord")


RAW_JSON_SCHEMA = T.MapType(T.StringType(), T.StringType())


def file_order() -> "F.Column":
    """Order of rows as stored: (file path, split start, position). The id
    increases with row order inside a split; splits of one file are ordered
    by their start offset, so large files keep their order too."""
    return F.struct(F.col("_metadata.file_path").alias("f"),
                    F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("i"))


def read_raw(spark: SparkSession, path: str, form: str = "auto") -> DataFrame:
    """Parsed-row JSON files -> RAW rows; ``ord`` is their stored order.

    A file holds one array of objects, over any number of lines, or one object
    per line (``form`` names it where all files have one form; "auto" looks at
    the first character of each). Both are read in parallel splits; values are
    read as text. What is not an object comes back with null ``cells`` and its
    text in ``_corrupt`` (see :func:`split_corrupt`). No file, or only empty
    ones, give no rows."""
    files, splits = {form: [path]}, None
    if form == "auto":
        splits = json_arrays.split_table(spark, [path])
        # One row per file, and the driver has listed the files anyway.
        kinds = splits.where("b = 0").select("f", F.coalesce(F.col("head") == "[", F.lit(False)).alias("array")).collect()
        files = {"array": [_literal(r.f) for r in kinds if r.array], "lines": [_literal(r.f) for r in kinds if not r.array]}
    parts = []
    if files.get("lines"):
        lines = spark.read.text(files["lines"]).where(F.trim("value") != "")
        parts.append(lines.select(F.struct(*[F.col("_metadata." + c).alias(n) for c, n in
                                             (("file_path", "f"), ("file_block_start", "b"))],
                                           F.monotonically_increasing_id().alias("i"), F.lit(0).alias("place")).alias("ord"),
                                  F.col("value").alias("text"), F.lit(False).alias("broken")))
    if files.get("array"):
        parts.append(json_arrays.array_records(spark, files["array"], splits))
    empty = spark.createDataFrame([], "ord struct<f:string,b:bigint,i:bigint,place:int>, text string, broken boolean")
    rows = functools.reduce(DataFrame.unionByName, parts) if parts else empty
    cells = F.when(~F.col("broken"), F.from_json("text", RAW_JSON_SCHEMA))
    return rows.select(cells.alias("cells"), F.when(cells.isNull(), F.col("text")).alias("_corrupt"), "ord")


def _literal(path: str) -> str:
    """A listed path (an encoded URI) as one that no character makes a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(path))


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with cells, texts that could not be read) of :func:`read_raw`."""
    return raw.where("cells is not null").drop("_corrupt"), raw.where("cells is null").select("_corrupt", "ord")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3: page content by url (Parquet page_id, url, html)."""
    return read_parquet(spark, path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """SKU catalog CSV, every column as text; a missing hsn_code or
    product_name column reads as ''."""
    df = spark.read.option("header", True).option("escape", '"').option("inferSchema", False).csv(path)
    for c in ("hsn_code", "product_name"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    return df.withColumn("ord", file_order())


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product table (Parquet written by the export sinks)."""
    return spark.read.parquet(path)


def read_stage(spark: SparkSession, root: str, stage: str) -> DataFrame | None:
    """A stage table if it was written, else None."""
    p = os.path.join(root, stage)
    try:
        return spark.read.parquet(p)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # absent; anything else is an error
            return None
        raise


def with_seed_fallback(df: DataFrame, seed: DataFrame) -> DataFrame:
    """The seed table when ``df`` has no rows (one short-circuit action)."""
    return seed if df.isEmpty() else df
