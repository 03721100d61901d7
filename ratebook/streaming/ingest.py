"""Incremental ingestion of parsed raw rows.

The reference has no stream processing; its normalisation and
classification are row-local, so they run unchanged on a streaming
DataFrame. This module wires them to Structured Streaming: new JSON files
of raw rows in a folder -> normalised, classified records appended to a
Parquet table, with the progress checkpoint in the shared checkpoint folder
(exactly-once file sink; restart resumes from the last committed batch).
No stateful operator is involved, so no watermark is needed.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebook.operators import classify as C
from ratebook.operators import normalize as N
from ratebook.session import ensure_checkpoint_dir

RAW_LINE = T.StructType([T.StructField("value", T.StringType())])


def raw_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming RAW rows from JSON-lines files (one object of text values per
    line); a line that is no object has null cells and its text in ``_corrupt``."""
    lines = (spark.readStream.schema(RAW_LINE).option("maxFilesPerTrigger", max_files_per_trigger)
                  .text(folder).where(F.trim("value") != ""))
    cells = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return lines.select(cells.alias("cells"), F.when(cells.isNull(), F.col("value")).alias("_corrupt"),
                        F.input_file_name().alias("source_file"))


def records_stream(raw: DataFrame, source_name: str = "", keyword_rules=None, range_rules=None) -> DataFrame:
    """Normalise + classify a (streaming or batch) RAW frame; what can't become
    a record is in :func:`quarantine_stream`."""
    good, _ = N.split_errors(N.normalize(raw, source_name=source_name, keep=("source_file",)))
    return C.classify(good, keyword_rules=keyword_rules, range_rules=range_rules)


def quarantine_stream(raw: DataFrame, source_name: str = "") -> DataFrame:
    """(source_file, error, raw): lines that are no object, and rows of which a
    rate fits no rate, as JSON text with the reason."""
    unread = raw.where("_corrupt is not null").select(
        "source_file", F.lit("not_an_object").alias("error"), F.col("_corrupt").alias("raw"))
    kept = N.normalize(raw.where("cells is not null").withColumn("text", F.to_json("cells")),
                       source_name=source_name, keep=("source_file", "text"))
    _, bad = N.split_errors(kept)
    return unread.unionByName(bad.select("source_file", F.col("_error").alias("error"), F.col("text").alias("raw")))


def start_ingest(spark: SparkSession, folder: str, out_path: str, name: str = "ratebook_ingest",
                 source_name: str = "", trigger_seconds: int | None = None, quarantine_path: str | None = None,
                 once: bool = False):
    """Start the ingestion: records appended to Parquet at ``out_path``, rows
    that can't become records to ``quarantine_path`` (default: beside it, with
    ``_quarantine`` behind its name). Returns the two queries; each has its own
    checkpoint and an exactly-once file sink. ``once``: take what is there and
    stop."""
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams")
    raw = raw_stream(spark, folder)
    side = quarantine_path or out_path.rstrip("/") + "_quarantine"

    def start(df: DataFrame, path: str, query: str):
        w = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", os.path.join(ckpt, query))
               .outputMode("append").queryName(query))
        if once:
            w = w.trigger(availableNow=True)
        elif trigger_seconds:
            w = w.trigger(processingTime=f"{trigger_seconds} seconds")
        return w.start()

    return start(records_stream(raw, source_name), out_path, name), start(
        quarantine_stream(raw, source_name), side, f"{name}_quarantine")
