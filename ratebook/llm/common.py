"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.session import apply_scale_conf, stage_path

# Rows and bytes of an Arrow batch: whole documents travel in these batches,
# so a batch of long texts has to stay small beside an executor's memory.
ARROW_ROWS = "1000"
ARROW_BYTES = "4m"


def prepare(spark: SparkSession) -> None:
    """Runtime settings the operators rely on, and worker code by value (the
    executors need no installed copy of this package)."""
    apply_scale_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    # A written stage needs its shuffles no longer: free their files at once.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    for name in [m for m in list(sys.modules) if m.startswith("ratebook.llm")]:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def staged(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder (in folders per value
    of the columns ``by``) and read it back: lineage ends here, and a lost
    executor costs a re-read."""
    spark = df.sparkSession
    path = stage_path(spark, "llm-stages", f"{name}-{uuid.uuid4().hex}")
    df.write.partitionBy(*by or []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) only, a null text as the empty one; other columns of any
    name stay behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def crc_class(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``: the learning split."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")) if isinstance(id_col, str)
                  else F.crc32(id_col.cast("string").cast("binary")), F.lit(modulus))


def computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with computed columns that later expressions read and never
    recompute: the optimiser doesn't move expressions through a generator."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return rows.select("*", F.inline(F.array(made)))
