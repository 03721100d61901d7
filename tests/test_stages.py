"""Fingerprints and committed stages."""

import os

import pytest
from pyspark.sql import functions as F

from ratebook.sources import stages as ST


def feed(spark, rows):
    return spark.createDataFrame(rows, "id int, cells map<string,string>, tags array<string>")


ROWS = [(1, {"a": "1", "b": "2"}, ["x"]), (2, None, []), (2, None, []), (3, {}, None)]


def test_fingerprint_ignores_order_only(spark):
    one = ST.fingerprint(feed(spark, ROWS), "rules", 1)
    assert ST.fingerprint(feed(spark, ROWS[::-1]).repartition(5), "rules", 1) == one
    swapped = [(1, {"b": "2", "a": "1"}, ["x"]), *ROWS[1:]]
    assert ST.fingerprint(feed(spark, swapped), "rules", 1) == one
    other = [ST.fingerprint(feed(spark, ROWS[:-1]), "rules", 1), ST.fingerprint(feed(spark, ROWS + ROWS[1:3]), "rules", 1),
             ST.fingerprint(feed(spark, [(1, {"a": "1", "b": "3"}, ["x"]), *ROWS[1:]]), "rules", 1),
             ST.fingerprint(feed(spark, ROWS), "rules", 2), ST.fingerprint(feed(spark, ROWS).withColumnRenamed("id", "k"), "rules", 1),
             ST.fingerprint(feed(spark, []), "rules", 1)]
    assert len({one, *other}) == 7


def test_a_stage_is_known_by_its_commit(spark, tmp_out):
    made = []

    def make(path):
        made.append(path)
        spark.range(7).write.parquet(path)
        return {"rows": 7}

    assert ST.commits(spark, tmp_out).count() == 0
    first, counts, found = ST.stage_for(spark, tmp_out, "s", "aa", make)
    assert (first.count(), counts, found) == (7, {"rows": 7}, False)
    again, counts, found = ST.stage_for(spark, tmp_out, "s", "aa", make)
    assert (again.count(), counts, found, len(made)) == (7, {"rows": 7}, True, 1)
    ST.stage_for(spark, tmp_out, "s", "bb", make)
    ST.stage_for(spark, tmp_out, "t", "aa", make)
    assert len(set(made)) == 3 and ST.commits(spark, tmp_out).count() == 3

    def breaks(path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ST.stage_for(spark, tmp_out, "u", "cc", breaks)
    assert ST.find_stage(spark, tmp_out, "u", "cc") is None
    rows = ST.commits(spark, tmp_out).where(F.col("stage") == "s").orderBy("seq").collect()
    assert [r.fingerprint for r in rows] == ["aa", "bb"] and all(os.path.isdir(os.path.join(tmp_out, r.data_path)) for r in rows)


def test_a_one_file_table_is_dealt_over_all_partitions(spark, tmp_path):
    """costly work per row of a small file is not left to one task."""
    from ratebook.plans import bindings as B
    spark.range(1000).selectExpr("id as k", "cast(null as string) as v", "id as w").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    rows = B.spread_table(spark, str(tmp_path), "t", "k", "v")
    sizes = rows.rdd.glom().map(len).collect()
    assert rows.columns == ["k", "v"] and sum(sizes) == 1000
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and min(sizes) > 0
