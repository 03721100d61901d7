"""Hot keys: one key holding a third of all rows must not change results,
and the plans must combine such keys before the shuffle."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratebook.operators import quality as V
from ratebook.operators.order import rank_within


def skewed(spark, n=3000):
    # key 0 holds a third of the rows; the rest spread over 500 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).cast("string").alias("hsn_code"),
        F.lit("goods").alias("gst_description"),
        F.col("id").alias("ord"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("product_id"),
        (F.col("id") % 2 * 5).cast("decimal(12,6)").alias("igst_rate"),
        F.lit(0).cast("decimal(12,6)").alias("cgst_rate"), F.lit(0).cast("decimal(12,6)").alias("sgst_rate"),
        F.lit(0).cast("decimal(12,6)").alias("cess_rate"),
        F.when(F.col("id") % 7 == 0, F.lit(V.DEFAULT_PRIMARY)).otherwise(F.lit("other")).alias("source_name"),
        F.lit("high").alias("confidence_flag"), F.lit("other").alias("top_category"),
        F.lit("uncategorized").alias("sub_category"))


def test_rank_within_hot_group(spark):
    df = skewed(spark).select("hsn_code", "ord")
    got = rank_within(df, ["hsn_code"], ["ord"], out_col="r", num_partitions=9)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("hsn_code").orderBy("ord")) - 1)
    assert sorted(got.collect()) == sorted(want.collect())
    # the hot group is spread over several range partitions
    parts = (df.repartitionByRange(9, "hsn_code", "ord").withColumn("p", F.spark_partition_id())
               .filter("hsn_code = '0'").select("p").distinct().count())
    assert parts > 1


def test_hot_key_results_and_partial_aggregation(spark):
    df = skewed(spark)
    res = {r.hsn_code: r for r in V.resolve_conflicts(df).collect()}
    # key 0: first primary row is id 0 (0 % 7 == 0), 1000 rows collapse to one
    assert res["0"].product_id == "r0" and len(res) == 501
    dups = V.check_duplicates(df).count()
    # brute force: rows - distinct (code, rate) keys
    keys = {r for r in df.select("hsn_code", "igst_rate").distinct().collect()}
    assert dups == df.count() - len(keys)
    plan = V.resolve_conflicts(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan or "partial_min" in plan


def test_first_by_hash_equals_a_sort(spark):
    from ratebook.operators.order import first_by_hash
    df = spark.range(3000).select((F.col("id") % 1500).alias("k"), F.col("id"), F.md5((F.col("id") % 1500).cast("string")).alias("h"))
    for n, digits in ((0, 4), (1, 4), (777, 1), (778, 2), (2999, 4), (3000, 4), (5000, 4)):
        want = sorted(df.orderBy("h", "k", "id").limit(n).collect())
        assert sorted(first_by_hash(df, "h", ["k", "id"], n, digits).collect()) == want
    assert first_by_hash(df.limit(0), "h", ["k", "id"], 5).count() == 0


def test_one_code_holds_a_third_and_conflicts(spark):
    df = skewed(spark, 900)
    rows = {r.ord: r for r in df.collect()}
    firsts = {}
    for o in sorted(rows):
        firsts.setdefault((rows[o].hsn_code, rows[o].source_name), rows[o].igst_rate)
    primary = {h: rate for (h, s), rate in firsts.items() if s == V.DEFAULT_PRIMARY}
    bad = {h for h in primary if len({r for (c, _), r in firsts.items() if c == h}) > 1}
    want = sorted(o for o, r in rows.items() if r.hsn_code in bad and r.source_name != V.DEFAULT_PRIMARY
                  and r.igst_rate != primary[r.hsn_code])
    assert "0" in bad and want
    assert sorted(r.row_ord for r in V.check_conflicts(df).collect()) == want
    table = V.conflict_table(df)
    assert {r.hsn_code for r in table.collect()} == bad
    # The list of sources is made for the codes that may conflict, and a small
    # conflict table is broadcast when the join is planned: no row is shuffled.
    plan = V.apply_primary_rate(df, conflicts=table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert {r.ord for r in V.apply_primary_rate(df).collect() if r.confidence_flag == "review_required"} == set(want)
