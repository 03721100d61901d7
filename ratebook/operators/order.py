"""Dense rank of rows within a group by an order column, without a window
partitioned by the group (a hot group would land in one task).

Rows are range-partitioned and sorted by (group, order) — the range
partitioner splits a hot group over many partitions — and numbered inside
each partition; a small table of per-(partition, group) counts gives each
partition's offset within its group. The numbered rows are checkpointed to
the shared checkpoint folder first so both branches read one materialised,
deterministic numbering (and survive executor loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratebook.session import cut_lineage


def rank_within(df: DataFrame, group_cols: list[str], order_cols: list[str],
                out_col: str = "rank", num_partitions: int | None = None,
                checkpoint: bool = True) -> DataFrame:
    """Adds ``out_col`` = 0-based position of the row within its group when
    ordered by ``order_cols`` (which must make the order total)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group_cols + order_cols]
    numbered = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("__pid", F.spark_partition_id())
                  .withColumn("__mid", F.monotonically_increasing_id()))
    if checkpoint:
        numbered = cut_lineage(numbered)
    # (partition, group) -> rows and first id; at most partitions + groups rows.
    counts = (numbered.groupBy("__pid", *group_cols)
                      .agg(F.count(F.lit(1)).alias("__cnt"), F.min("__mid").alias("__first_mid")))
    w = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    out = numbered.join(offsets.select("__pid", *group_cols, "__off", "__first_mid"),
                        ["__pid", *group_cols])
    return (out.withColumn(out_col, F.col("__off") + F.col("__mid") - F.col("__first_mid"))
               .drop("__pid", "__mid", "__off", "__first_mid"))


def first_by_hash(df: DataFrame, hash_col: str, tie_cols: list[str], n: int, digits: int = 4) -> DataFrame:
    """The ``n`` rows that come first by (``hash_col``, ``tie_cols``), all if
    there are fewer. ``hash_col`` holds evenly spread hexadecimal text of a
    fixed length (a digest); equal hashes are told apart by ``tie_cols``.

    No sort of all rows: a histogram of the first ``digits`` digits (at most
    16 ** digits rows) tells the prefix in which the cut lies; rows below it
    stay, and only the rows that share it, one in 16 ** digits, are ranked."""
    prefix = F.substring(hash_col, 1, digits)
    counts = df.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("c"))
    up_to = F.sum("c").over(Window.orderBy("p"))
    cut = (counts.select("p", "c", up_to.alias("up_to")).where(F.col("up_to") >= n).orderBy("p")
                 .select("p", (F.lit(n) - F.col("up_to") + F.col("c")).alias("left")).first())
    if cut is None:
        return df
    edge = rank_within(df.where(prefix == cut.p), [], [hash_col, *tie_cols], out_col="__at")
    return df.where(prefix < cut.p).unionByName(edge.where(F.col("__at") < cut.left).select(*df.columns))
