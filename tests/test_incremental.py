"""State that merges: ledger and checkpoint folds, counts, sketches; point
lookups by row group; what a stream can't read."""

import itertools
import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ratebook.operators import extract as E
from ratebook.operators import ledger as J
from ratebook.operators import lookup as L
from ratebook.operators import summary as S
from ratebook.sources import sinks
from ratebook.sources import stages as ST

JOBS = "job_id int, source_name string, url string, source_type string, priority string, is_primary boolean, created_at int"
EVENTS = "job_id int, ts int, seq int, transition string, detail string"


def log(n, seed):
    rng = random.Random(seed)
    kinds = ["in_progress", "completed", "failed"]
    return [(rng.choice([0, 0, 0, 1, 2, 9]), rng.randint(0, n // 2), i, rng.choice(kinds), rng.choice([None, f"d{i}"]))
            for i in range(n)]


def plain(events):
    out = {}
    for j in (0, 1, 2, 3):
        mine = sorted((e for e in events if e[0] == j), key=lambda e: (e[1], e[2]))
        failed = [e for e in mine if e[3] == "failed"]
        done = [e for e in mine if e[3] == "completed"]
        error = failed[-1][4] if failed and (not done or failed[-1][1:3] > done[-1][1:3]) else None
        out[j] = (mine[-1][3] if mine else "pending", len(failed), done[-1][4] if done else None, error,
                  mine[-1][1] if mine else -1)
    return out


def test_a_log_folds_in_parts(spark, tmp_out):
    events = log(300, 1)
    jobs = spark.createDataFrame([(j, f"s{j}", f"u{j}", "html", "high", False, -1) for j in range(4)], JOBS)
    frame = spark.createDataFrame(events, EVENTS)
    want = plain(events)

    def got(state):
        return {r.job_id: (r.status, r.retries, r.content_path, r.error, r.updated_at) for r in J.ledger_of(jobs, state).collect()}

    assert got(J.fold_state(frame)) == want
    parts = [J.fold_state(frame.where(F.col("seq") % 3 == k)) for k in range(3)]
    for order in itertools.permutations(parts):
        assert got(J.merge_states(order[0], J.merge_states(*order[1:]))) == want
    taken = [ST.take_batch(spark, tmp_out, "led", frame.where(F.col("seq") % 2 == k), J.fold_state, J.merge_states)
             for k in (0, 1, 0)]
    assert [new for _, new in taken] == [True, True, False] and got(taken[-1][0]) == want
    assert got(J.fold_state(frame.limit(0))) == plain([])


def test_checkpoints_merge(spark):
    saves = [(f"s{i % 3}", f"p{i}", i, (i * 7) % 11, i) for i in range(40)]
    frame = spark.createDataFrame(saves, "stage string, data_path string, row_count int, created_at int, seq int")
    whole = sorted(J.latest_checkpoint(frame).collect())
    parts = [J.checkpoint_state(frame.where(F.col("seq") % 4 == k)) for k in range(4)]
    assert sorted(J.latest_of(J.merge_checkpoints(*parts)).collect()) == whole
    best = {s: max((x for x in saves if x[0] == s), key=lambda x: (x[3], x[4])) for s in ("s0", "s1", "s2")}
    assert {r.stage: r.data_path for r in whole} == {s: x[1] for s, x in best.items()}


def test_counts_and_sketches_merge(spark):
    df = spark.range(6000).select((F.col("id") % 1777).cast("string").alias("hsn_code"), (F.col("id") % 4).alias("k"),
                                  F.when(F.col("id") % 5 > 0, F.col("id") % 5).cast("string").alias("c"))
    parts = [df.where(F.col("k") == k) for k in range(4)] + [df.limit(0)]
    merged = S.merge_counts(*[S.count_table(p, ["c", "hsn_code"]) for p in parts])
    assert merged.collect() == S.value_counts(df, ["c", "hsn_code"]).collect()
    row = S.merge_sketches(*[S.load_sketch(p) for p in parts]).first()
    assert row.total_records == 6000 and abs(row.unique_hsn_codes - 1777) < 5 * S.SKETCH_ERROR * 1777


def scan_rows(df):
    """Rows that the Parquet scan of an executed frame returned."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_point_lookup_reads_one_row_group(spark, tmp_out):
    n = 60_000
    df = spark.range(n).select(F.lpad((F.col("id") * 2).cast("string"), 7, "0").alias("hsn_code"),
                               F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
                               F.md5(F.col("id").cast("string")).alias("text"))
    # Small row groups, several in the one file.
    key = "parquet.block.size"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(key, str(256 * 1024))
    try:
        sinks.load_products(df, tmp_out, mode="overwrite", partitions=1, distinct_per_group=5_000)
    finally:
        conf.unset(key)
    table = spark.read.parquet(tmp_out)
    group = scan_rows(table.where("hsn_code = '0050000'"))
    assert 0 < group < n / 4
    assert scan_rows(table.where("hsn_code = '0050001'")) == 0          # inside a range, not there
    one = table.where(F.col("product_id") == F.sha2(F.lit("777"), 256))  # ids lie anywhere
    assert one.count() == 1 and 0 < scan_rows(one) < n / 4
    assert scan_rows(table.where(F.col("product_id") == F.sha2(F.lit("none"), 256))) < n / 4


def test_spark_judges_the_pattern(spark):
    df = spark.createDataFrame([(0, "été", "Fromage 5", "0406"), (1, "x", "b", "8517")],
                               "ord int, product_name string, gst_description string, hsn_code string")
    for c in ("igst_rate", "cgst_rate", "sgst_rate", "cess_rate", "top_category", "sub_category", "schedule"):
        df = df.withColumn(c, F.lit(0))
    assert [r.hsn_code for r in L.rate_by_product(df, r"^\p{L}{3}$").collect()] == ["0406"]
    assert [r.gst_description for r in L.search_description(df, r"\p{Lu}\w+ \d").collect()] == ["Fromage 5"]
    assert [r.hsn_code for r in L.rate_by_code(df, r"8\p{N}+").collect()] == ["8517"]
    for bad in ("(", "[a", "*"):
        with pytest.raises(ValueError, match="invalid search pattern"):
            L.rate_by_product(df, bad)
        with pytest.raises(ValueError, match="invalid search pattern"):
            L.rate_by_code(df, bad)


def test_a_stream_keeps_what_it_can_not_read(spark, tmp_out):
    from ratebook.streaming.ingest import start_ingest
    src, out = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "out")
    os.makedirs(src)
    rows = [{"HSN": "8517", "Description": "Phones", "Rate": "18%"}, {"HSN": "1", "Description": "x", "Rate": "9" * 30}]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(map(json.dumps, rows)) + "\nno json\n\n")
    name = f"t{uuid.uuid4().hex}"
    for q in start_ingest(spark, src, out, name=name, once=True):
        q.awaitTermination(120)
    assert [r.hsn_code for r in spark.read.parquet(out).collect()] == ["8517"]
    bad = {r.error: r.raw for r in spark.read.parquet(out + "_quarantine").collect()}
    assert bad["not_an_object"] == "no json" and json.loads(bad["rate_out_of_range"]) == rows[1] and len(bad) == 2


def test_document_rows_carry_their_page(spark):
    grid = [(1, 1, 0, 0, ["HSN", "Rate"], "doc"), (1, 1, 0, 1, ["1", "5", "cut"], "doc"), (1, 1, 1, 0, ["only a header"], "doc"),
            (1, 3, 0, 0, ["HSN", "Rate"], "doc"), (1, 3, 0, 1, ["2"], "doc"), (1, 3, 0, 2, ["", None], "doc"),
            (2, 1, 0, 0, ["HSN"], None), (2, 1, 0, 1, ["3"], None)]
    df = spark.createDataFrame(grid, "doc_id int, page int, table_idx int, row_idx int, cells array<string>, source_name string")
    rows = [(r.doc_id, r.page, dict(r.cells), r.raw_text) for r in E.document_rows(df).orderBy("ord").collect()]
    assert rows == [
        (1, 1, {"hsn": "1", "rate": "5", "_raw_text": "1 | 5", "_source_name": "doc", "_page": "1"}, "1 | 5"),
        (1, 3, {"hsn": "2", "rate": "", "_raw_text": "2", "_source_name": "doc", "_page": "3"}, "2"),
        (2, 1, {"hsn": "3", "_raw_text": "3", "_source_name": "", "_page": "1"}, "3")]
