"""Extraction from HTML, sinks and stages, streaming ingestion, driver entry."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from ratebook.operators import extract as E
from ratebook.operators import normalize as N
from ratebook.sources import sinks
from ratebook.sources.readers import read_raw, read_stage, read_catalog, split_corrupt

PAGE = """<html><body><h2>Tariff list</h2>
<table class="menu"><tr><td>Start</td></tr></table>
<table class="list"><thead><tr><th>No</th><th>Particulars</th><th>HSN</th>
<th>CGST</th><th>SGST</th></tr></thead><tbody>
<tr><td>11</td><td>Walnut kernels</td><td>0802</td><td>3.5%</td><td>3.5%</td></tr>
<tr><td>12</td><td>Pocket lamps</td><td>85.13</td><td>6%</td><td>6%</td></tr>
<tr><td>13</td><td>Buttons of horn</td><td>9606</td><td>5.5%</td><td>5.5%</td></tr>
</tbody></table></body></html>"""

DIV_PAGE = """<html><body><div class="ad"><tr><td>no</td></tr></div>
<div class="Rate-Schedule"><tr><td>HSN</td><td>Rate</td></tr><tr><td>0802</td><td>7%</td></tr>
<tr><td>8513</td><td>12</td><td>extra</td></tr><tr><td>9606</td></tr><tr></tr></div></body></html>"""


def pages(spark, *htmls):
    return spark.createDataFrame([(i, f"src{i}", h) for i, h in enumerate(htmls)],
                                 "page_id long, source string, html string")


@pytest.mark.parametrize("has_selector", [True, False])
def test_extract_reference_page(spark, has_selector):
    raw = E.extract(pages(spark, PAGE), has_selector=has_selector, source_col="source")
    rec = N.normalize(raw).orderBy("ord").collect()
    assert [r.hsn_code for r in rec] == ["0802", "8513", "9606"]
    assert [float(r.igst_rate) for r in rec] == [7.0, 12.0, 11.0]
    assert rec[0].source_name == "src0" and rec[0].serial_no == "11"
    assert rec[0].raw_text == "11 | Walnut kernels | 0802 | 3.5% | 3.5%"


def test_extract_div_fallback(spark):
    raw = E.extract(pages(spark, DIV_PAGE), has_selector=True).orderBy("row_idx").collect()
    cells = [dict(r.cells) for r in raw]
    assert cells == [{"hsn": "0802", "rate": "7%"}, {"hsn": "8513", "rate": "12"}, {"hsn": "9606", "rate": ""}]


def test_extract_errors_and_no_tables(spark):
    df = pages(spark, "", "<html><p>no tables</p></html>")
    assert [r.page_id for r in E.extract_errors(df).collect()] == [0]
    assert E.extract(df, has_selector=False).count() == 0


def test_colspan_and_header_detection(spark):
    html = ("<table><tr><th>HSN</th><th colspan=2>Rate</th></tr><tr><td>1</td><td>2</td><td>3</td></tr>"
            "<tr><td>4</td><td>5</td><td>6</td></tr></table>")
    raw = E.extract(pages(spark, html), has_selector=False).orderBy("row_idx").collect()
    assert [dict(r.cells) for r in raw] == [{"hsn": "1", "rate": "2", "rate_1": "3"},
                                             {"hsn": "4", "rate": "5", "rate_1": "6"}]


def test_deep_pages_and_spans(spark):
    deep = "<p>" * 1500 + "<div>" * 1500 + "<table><tr><th>HSN</th><th>Rate</th></tr>" \
        "<tr><td rowspan=3>7</td><td>1</td></tr><tr><td>2</td></tr></table>"
    raw = E.extract(pages(spark, deep), has_selector=False).orderBy("row_idx").collect()
    assert [dict(r.cells) for r in raw] == [{"hsn": "7", "rate": "1"}, {"hsn": "7", "rate": "2"}, {"hsn": "7", "rate": None}]


def test_read_raw_arrays_and_lines(spark, tmp_out):
    os.makedirs(tmp_out, exist_ok=True)
    with open(os.path.join(tmp_out, "a.json"), "w") as f:
        json.dump([{"hsn": "1", "rate": "5%"}, {"hsn": "2", "n": 3}], f, indent=2)
    with open(os.path.join(tmp_out, "b.json"), "w") as f:
        f.write('{"hsn": "3"}\n\n{"hsn": "4"}\nnot json\n')
    good, bad = split_corrupt(read_raw(spark, tmp_out))
    assert [dict(r.cells) for r in good.orderBy("ord").collect()] == [
        {"hsn": "1", "rate": "5%"}, {"hsn": "2", "n": "3"}, {"hsn": "3"}, {"hsn": "4"}]
    assert [r[0] for r in bad.collect()] == ["not json"]


def test_grid_to_rows(spark):
    g = spark.createDataFrame([(1, 0, ["S No", "", "Rate", "Rate"]), (1, 1, ["1", "x", "5", "6"]),
                               (1, 2, ["", "", "", ""]), (1, 3, ["2"]), (2, 0, ["only header"])],
                              "page_id long, row_idx int, cells array<string>")
    rows = {r.row_idx: dict(r.cells) for r in E.grid_to_rows(g).collect()}
    assert rows[1] == {"s_no": "1", "col_1": "x", "rate": "6"}
    assert rows[3] == {"s_no": "2", "col_1": "", "rate": ""} and 2 not in rows


def test_stage_roundtrip_and_chunks(spark, tmp_out):
    df = spark.range(25).select(F.col("id").alias("ord"), (F.col("id") % 3).cast("string").alias("hsn_code"))
    assert read_stage(spark, tmp_out, "nothing") is None
    sinks.write_stage(df, tmp_out, "s1")
    assert read_stage(spark, tmp_out, "s1").count() == 25
    chunks = sinks.with_chunk_ids(df, "ord", 10).groupBy("chunk").count().orderBy("chunk").collect()
    assert [(r.chunk, r["count"]) for r in chunks] == [(1, 10), (2, 10), (3, 5)]
    sinks.load_products(df, os.path.join(tmp_out, "products"), mode="overwrite", partitions=3)
    assert spark.read.parquet(os.path.join(tmp_out, "products")).count() == 25


def test_read_raw_and_catalog(spark, tmp_out):
    p = os.path.join(tmp_out, "raw.json")
    with open(p, "w") as f:
        f.write(json.dumps({"HSN": "0401", "Rate": "Nil"}) + "\n" + json.dumps({"hsn": "1006"}) + "\n")
    raw = read_raw(spark, p)
    assert sorted(r.cells.get("HSN") or r.cells.get("hsn") for r in raw.collect()) == ["0401", "1006"]
    c = os.path.join(tmp_out, "cat.csv")
    with open(c, "w") as f:
        f.write("product_name,sku\nA,1\n")
    cat = read_catalog(spark, c).first()
    assert cat.hsn_code == "" and cat.product_name == "A"


def test_streaming_ingest(spark, tmp_out):
    from ratebook.streaming.ingest import raw_stream, records_stream
    src = os.path.join(tmp_out, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"HSN Code": "8517", "Description": "Mobile phones", "Rate": "18%"}) + "\n")
    q = (records_stream(raw_stream(spark, src)).writeStream.format("memory").queryName("ingest_t")
         .option("checkpointLocation", os.path.join(tmp_out, "ck")).start())
    q.processAllAvailable()
    q.stop()
    r = spark.sql("select * from ingest_t").first()
    assert r.hsn_code == "8517" and r.top_category == "electronics" and float(r.igst_rate) == 18.0


def test_entry_and_registry(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    from ratebook.plans.bindings import REGISTRY
    rows_only = set(REGISTRY) - set(o)
    assert rows_only == set()


def test_oracles_small(spark):
    """Every registered query against its DuckDB twin on the sf0.001 tables."""
    import __spark_entry__ as entry
    from scripts.check_oracle import TABLES, rows_of
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = []
    for name, sql in entry.oracle_sql().items():
        df = entry.queries()[name](spark, sf)
        sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
        res = con.execute(sql)
        dc, dr = rows_of([d[0] for d in res.description], res.fetchall())
        if (sc, sr) != (dc, dr):
            bad.append(name)
    assert bad == []


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_pushdown_on_product_table(spark, tmp_out):
    from ratebook.operators import lookup as L
    from ratebook.operators import summary as S
    rows = [(f"p{i}", f"item {i}", str(8500 + i % 40), f"desc {i % 5}", 1.0 * (i % 4), i) for i in range(400)]
    df = spark.createDataFrame(rows, "product_id string, product_name string, hsn_code string, "
                                     "gst_description string, igst_rate double, ord long")
    path = os.path.join(tmp_out, "products")
    sinks.load_products(df, path, mode="overwrite", partitions=4)
    prod = spark.read.parquet(path)
    plan = _plan(L.rate_by_code(prod, "851"))
    assert "StringStartsWith(hsn_code,851)" in plan
    plan = _plan(S.find_one(prod, "8512"))
    assert "EqualTo(hsn_code,8512)" in plan
    # Column pruning: a count of a filtered code reads only that column.
    plan = _plan(prod.filter(F.col("hsn_code") == "8512").groupBy().count())
    assert "ReadSchema: struct<hsn_code:string>" in plan
    assert [r.product_id for r in L.rate_by_code(prod, "8512", limit=20).collect()] == ["p12"]


def test_csv_issue_and_raw_sinks(spark, tmp_out):
    from ratebook.operators import quality as V
    rec = spark.createDataFrame([("a", "", "Rice", 5.0, "S1", 0)],
                                "product_id string, hsn_code string, gst_description string, "
                                "igst_rate double, source_name string, ord int")
    for c in ("cgst_rate", "sgst_rate", "cess_rate"):
        rec = rec.withColumn(c, F.lit(0.0))
    rec = rec.withColumn("top_category", F.lit("other")).withColumn("sub_category", F.lit("uncategorized"))
    sinks.write_csv(rec, os.path.join(tmp_out, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_out, "csv")).first()
    assert back.product_id == "a" and back.igst_rate == "5.0"
    sinks.write_issues(V.validate_issues(rec), os.path.join(tmp_out, "issues"))
    iss = spark.read.option("header", True).csv(os.path.join(tmp_out, "issues")).collect()
    assert {r.issue_type for r in iss} == {"missing_hsn"}
    raw = spark.createDataFrame([("Src A!", {"hsn": "1"})], "source_name string, cells map<string,string>")
    sinks.write_raw(raw, os.path.join(tmp_out, "raw"))
    assert os.path.isdir(os.path.join(tmp_out, "raw", "source_slug=src_a_"))
    sinks.write_chunks(rec, os.path.join(tmp_out, "chunks"), chunk_rows=1, exact=True)
    assert spark.read.parquet(os.path.join(tmp_out, "chunks")).count() == 1


def test_read_seed_and_fallback(spark, tmp_out):
    import hashlib
    from ratebook.sources.readers import read_seed, with_seed_fallback
    p = os.path.join(tmp_out, "seed.csv")
    with open(p, "w") as f:
        f.write("hsn_code,gst_description,igst_rate,cess_rate,schedule\n0401,Fresh milk,0,0,I\n"
                "1006,Rice,5,0,I\n8703,Cars,28,15,IV\n")
    seed = read_seed(spark, p)
    rows = seed.orderBy("ord").collect()
    assert [r.hsn_code for r in rows] == ["0401", "1006", "8703"]   # leading zero kept
    assert [float(r.cgst_rate) for r in rows] == [0.0, 2.5, 14.0]
    assert rows[1].product_id == hashlib.sha256(b"1006|Rice|5").hexdigest()[:16]
    empty = seed.filter(F.lit(False))
    assert with_seed_fallback(empty, seed).count() == 3
    assert with_seed_fallback(seed.limit(1), empty).count() == 1
