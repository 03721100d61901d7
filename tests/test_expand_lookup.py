"""Expansion invariants, catalog enrichment, lookups and ledger folds."""

import datetime as dt
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratebook.operators import expand as X
from ratebook.operators import ledger as J
from ratebook.operators import lookup as L
from ratebook.operators.order import rank_within


def base_frame(spark, n_a=5, n_b=2, n_c=1):
    rows = []
    k = 0
    for cat, n in (("a", n_a), ("b", n_b), ("uncategorized", n_c)):
        for _ in range(n):
            rows.append((k, cat, f"{1000 + k}", f"desc {k}", 5.0))
            k += 1
    return spark.createDataFrame(rows, "ord int, sub_category string, hsn_code string, gst_description string, "
                                       "igst_rate double")


def templates(spark):
    return spark.createDataFrame([
        ("a", ["B1", "B2"], ["N1", "N2", "N3"], ["V1", "V2"]),
        ("furniture_misc", ["F1"], ["Chair", "Table"], ["Oak"]),
    ], "sub_category string, brands array<string>, names array<string>, variants array<string>")


def test_rank_within_matches_row_number(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 2000).alias("o"))
    got = rank_within(df, ["g"], ["o"], out_col="r", num_partitions=7)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert sorted(got.collect()) == sorted(want.collect())


def test_expand_exact_target_and_use_once(spark):
    for target in (8, 100, 1003):
        out = X.expand_synthetic(base_frame(spark), templates(spark), target, seed=7)
        rows = out.collect()
        assert len(rows) == target
        assert len({r.product_id for r in rows}) == target
    # Category 'a' (12 combinations): every block of 12 consecutive indices
    # of the proportional pass uses each combination once.
    out = X.expand_synthetic(base_frame(spark), templates(spark), 1003, seed=7)
    a = sorted((r.gen_index, r.product_name) for r in out.filter("sub_category = 'a' AND gen_chunk = -1").collect())
    for start in range(0, len(a) - 11, 12):
        block = [n for _, n in a[start:start + 12]]
        if len(block) == 12:
            assert len(set(block)) == 12
    # Fallback template for categories without one.
    names = {r.product_name for r in out.filter("sub_category = 'b'").collect()}
    assert names <= {"F1 Chair - Oak", "F1 Table - Oak"}


def test_expand_round_robin_base(spark):
    out = X.expand_synthetic(base_frame(spark), templates(spark), 70, seed=1)
    per = Counter(r.hsn_code for r in out.filter("sub_category = 'a' AND gen_chunk = -1").collect())
    assert max(per.values()) - min(per.values()) <= 1


def test_expand_trim_below_base(spark):
    out = X.expand_synthetic(base_frame(spark, 50, 30, 20), templates(spark), 40, seed=3)
    assert out.count() == 40


def test_catalog_exact_prefix_last_wins(spark):
    recs = spark.createDataFrame([
        (0, "8517", "phones old", 12.0), (1, "1006", "rice", 5.0), (2, "8517", "phones", 18.0),
        (3, "", "blank", 0.0), (4, "85", "short", 28.0),
    ], "ord int, hsn_code string, gst_description string, igst_rate double")
    for c in ("cgst_rate", "sgst_rate", "cess_rate"):
        recs = recs.withColumn(c, F.lit(0.0))
    for c in ("top_category", "sub_category", "source_name", "source_url", "raw_text", "confidence_flag"):
        recs = recs.withColumn(c, F.lit("x"))
    cat = spark.createDataFrame([(10, "Phone X", "8517"), (11, "Phone Y", "85171290"), (12, "Rice Z", "10063010"),
                                 (13, "None", "9999"), (14, "Empty", ""), (15, "Short", "8599")],
                                "ord int, product_name string, hsn_code string")
    out = {r.product_name: r for r in X.enrich_catalog(cat, recs).collect()}
    assert out["Phone X"].gst_description == "phones" and out["Phone X"].match_kind == "exact"
    assert out["Phone Y"].gst_description == "phones" and out["Phone Y"].hsn_code == "85171290"
    assert out["Rice Z"].gst_description == "rice"
    assert out["Short"].gst_description == "short"
    assert "None" not in out and "Empty" not in out
    st = X.catalog_match_stats(cat, recs).first()
    assert (st.matched, st.total) == (4, 6)


def products(spark):
    rows = [(i, f"p{i}", name, code, desc) for i, (name, code, desc) in enumerate([
        ("Red Ring", "8517", "Phones"), ("ring binder", "85171", "Phones"), ("RING light", "8518", "Audio"),
        ("bolt", "1006", "Rice"), ("Ring 5", "85172", "Phones"), ("ring 6", "85173", "Other"),
        ("ring 7", "9", "Phones"), ("ring 8", "10", "Rice")])]
    df = spark.createDataFrame(rows, "ord int, product_id string, product_name string, hsn_code string, "
                                     "gst_description string")
    for c in ("cgst_rate", "sgst_rate", "igst_rate", "cess_rate"):
        df = df.withColumn(c, F.lit(1.0))
    for c in ("top_category", "sub_category", "schedule", "confidence_flag"):
        df = df.withColumn(c, F.lit("t"))
    return df


def test_lookups(spark):
    df = products(spark)
    assert [r.product_id for r in L.rate_by_product(df, "ring").collect()] == ["p0", "p1", "p2", "p4", "p5"]
    assert L.rate_by_product(df, "ring", limit=0).count() == 1
    # Limit before dedupe: first 3 rows under '85' hold two 'Phones'.
    got = L.rate_by_code(df, "85", limit=3).collect()
    assert sorted(r.product_id for r in got) == ["p0", "p2"]
    top = L.search_description(df, "PHONES").collect()
    assert top[0].gst_description == "Phones" and top[0].product_count == 4 and top[0].hsn_code == "8517"
    cats = {(r.level, r.top_category): r.product_count for r in L.categories(df).collect()}
    assert cats[("all", None)] == 8


def test_ledger_fold_and_queue(spark):
    t0 = dt.datetime(2024, 1, 1)
    jobs = spark.createDataFrame([
        (1, "a", "u1", "html", "high", False, t0), (2, "b", "u2", "html", "weird", False, t0),
        (3, "c", "u3", "pdf", "low", True, t0), (4, "d", "u4", "html", "low", False, t0)],
        "job_id long, source_name string, url string, source_type string, priority string, "
        "is_primary boolean, created_at timestamp")
    m = lambda x: t0 + dt.timedelta(minutes=x)
    ev = spark.createDataFrame([
        (1, m(1), 1, "in_progress", None), (1, m(2), 2, "failed", "boom"), (1, m(3), 3, "completed", "p1"),
        (2, m(1), 4, "failed", "e1"), (2, m(2), 5, "failed", "e2"), (2, m(3), 6, "failed", "e3"),
        (3, m(10), 7, "in_progress", None)],
        "job_id long, ts timestamp, seq long, transition string, detail string")
    led = {r.job_id: r for r in J.fold_transitions(jobs, ev).collect()}
    assert led[1].status == "completed" and led[1].error is None and led[1].content_path == "p1"
    assert led[2].retries == 3 and led[2].error == "e3" and led[4].status == "pending"
    pend = [r.job_id for r in J.pending(J.fold_transitions(jobs, ev)).collect()]
    assert pend == [4]  # job 2 is out of retries
    now = F.lit(m(40)).cast("timestamp")
    st = {r.job_id: r.status for r in J.reset_stale(J.fold_transitions(jobs, ev), now).collect()}
    assert st[3] == "in_progress"   # exactly 30 minutes: strict '<' keeps it
    st = {r.job_id: r.status for r in J.reset_stale(J.fold_transitions(jobs, ev), F.lit(m(41))).collect()}
    assert st[3] == "pending"
    srcs = spark.createDataFrame([(9, "z", "u1", "html", "medium", False, 0), (8, "y", "u8", "html", None, False, 1),
                                  (7, "x", "u8", "html", "high", True, 2)],
                                 "job_id long, source_name string, url string, source_type string, "
                                 "priority string, is_primary boolean, ord int")
    enq = J.enqueue(J.fold_transitions(jobs, ev), srcs, F.lit(t0))
    new = {r.url: r for r in enq.collect()}
    assert len(new) == 5 and new["u8"].job_id == 8 and new["u1"].status == "completed"
    order = [r.job_id for r in J.pending(enq).collect()]
    assert order == [8, 4]  # unknown (null) priority sorts first


def test_envelope_and_nested_categories(spark):
    import json
    df = products(spark)
    env = json.loads(L.envelope(L.rate_by_product(df, "ring"), "ring").first().json)
    assert env["query"] == "ring" and env["total_results"] == 5
    assert [p["product_id"] for p in env["products"]] == ["p0", "p1", "p2", "p4", "p5"]
    flat = {(r.top_category, r.sub_category): r.product_count
            for r in L.categories(df).filter("level = 'sub'").collect()}
    nested = L.categories_nested(df).collect()
    assert sum(r.total_products for r in nested) == sum(flat.values()) == 8
    for r in nested:
        counts = [s.product_count for s in r.sub_categories]
        assert counts == sorted(counts, reverse=True)
        assert {(r.top_category, s.name): s.product_count for s in r.sub_categories}.items() <= flat.items()


def test_full_run_against_brute_force(spark, tmp_path):
    """Issues and report are made on the rates as they are, the export after
    the override; counts and summary against plain loops over the rows."""
    import json
    from ratebook.operators import normalize as N
    from ratebook.operators import quality as V
    from ratebook.plans import runs
    feeds = ["official", "shop", "blog"]
    raw_rows = [(i, [("HSN", str(1000 + i % 7)), ("Description", f"item {i % 5}" if i % 11 else ""),
                     ("Rate", "9" * 30 if i == 13 else f"{(i % 3) * 6}%"), ("_source_name", feeds[i % 4 % 3])])
                for i in range(60)] + [(60, [("HSN", ""), ("Description", "")])]
    raw = (spark.createDataFrame(raw_rows, "ord int, kv array<struct<k:string,v:string>>")
                .select("ord", F.map_from_entries("kv").alias("cells")))
    tpl = spark.createDataFrame([("furniture_misc", ["B"], ["N1", "N2"], ["V"])],
                                "sub_category string, brands array<string>, names array<string>, variants array<string>")
    good = N.split_errors(N.normalize(raw))[0]
    sources = [{"name": n, "url": f"https://{n}.example/", "status": "completed", "error": ""} for n in feeds]
    sources.append({"name": "gone", "url": "https://gone.example/", "status": "failed", "error": "timeout"})
    res = runs.full_run(spark, raw, good.filter(F.lit(False)), tpl, 200, primary="official", out_dir=str(tmp_path),
                        sources=sources)
    rows = spark.read.parquet(str(tmp_path / "expanded")).collect()
    rows.sort(key=lambda r: r.ord)
    seen, firsts, dups, codes = {}, {}, 0, {}
    for r in rows:
        k = (r.hsn_code, r.gst_description.strip().lower(), r.igst_rate)
        dups += k in seen
        seen.setdefault(k, r.product_id)
        firsts.setdefault((r.hsn_code, r.source_name), r.igst_rate)
    for (h, s), rate in firsts.items():
        codes.setdefault(h, {})[s] = rate
    clash = {h: v["official"] for h, v in codes.items() if "official" in v and len(set(v.values())) > 1}
    hit = {r.product_id for r in rows if r.hsn_code in clash and r.source_name != "official" and r.igst_rate != clash[r.hsn_code]}
    rep = res.report.first()
    assert hit and dups
    assert (rep.total_records, rep.duplicates_found, rep.conflicts_found, rep.passed) == (200, dups, len(hit), True)
    assert V.validation_report(spark.read.parquet(str(tmp_path / "expanded")), "official").first() == rep
    assert {r.record_id for r in res.issues.where("issue_type = 'conflict'").collect()} == hit
    changed = {r.product_id for r in res.products.where("confidence_flag = 'review_required'").collect()}
    assert hit <= changed
    for r in res.products.collect():
        if r.product_id in hit:
            assert r.igst_rate == clash[r.hsn_code] and r.confidence_flag == "review_required"
    # resolved base = distinct (code, description) pairs of the kept rows
    keys = {(str(1000 + i % 7), f"item {i % 5}" if i % 11 else "") for i in range(60) if i != 13}
    assert {(r.hsn_code, r.gst_description) for r in rows} == keys
    run = res.run.first()
    assert (run.sources_attempted, run.sources_succeeded, run.sources_failed, run.errors) == (4, 3, 1, ["timeout"])
    assert run.parse_counts == {n: sum(feeds[i % 4 % 3] == n for i in range(60)) for n in feeds}
    assert (run.normalization_count, run.skipped_count, run.quarantined_count) == (59, 1, 1)
    assert (run.expansion_count, run.final_row_count, run.validation_passed) == (200, 200, True)
    assert sum(run.classification_distribution.values()) == len(keys)
    assert [(s.name, s.rows_extracted) for s in run.sources][-1] == ("gone", 0)
    with open(next((tmp_path / "run_summary").glob("*.json"))) as f:
        assert json.load(f)["normalization_count"] == 59
    assert res.quarantine.count() == 1


def test_full_run_falls_back_to_the_seed(spark):
    from ratebook.plans import runs
    from ratebook.sources.readers import seed_records
    seed = seed_records(spark.createDataFrame([("0401", "Milk", 0, 0, "I", 0), ("8703", "Cars", 28, 15, "IV", 1)],
                                              "hsn_code string, gst_description string, igst_rate int, cess_rate int, "
                                              "schedule string, ord int"))
    raw = spark.createDataFrame([], "ord int, cells map<string,string>")
    tpl = spark.createDataFrame([("furniture_misc", ["B"], ["N"], ["V"])],
                                "sub_category string, brands array<string>, names array<string>, variants array<string>")
    res = runs.full_run(spark, raw, seed, tpl, 9)
    assert res.products.count() == 9 and {r.hsn_code for r in res.products.collect()} == {"0401", "8703"}
    assert res.run.first().normalization_count == 2


def test_build_products_runs_and_export_view(spark, tmp_path):
    from ratebook.operators import normalize as N
    from ratebook.operators import summary as S
    from ratebook.plans import runs
    raw_rows = [(i, [("HSN Code", str(8500 + i % 6)), ("Description", f"goods {i % 4}"),
                     ("IGST", f"{(i % 3) * 9}"), ("_source_name", "CBIC GST Goods Rates" if i % 2 else "other")])
                for i in range(30)]
    raw = (spark.createDataFrame(raw_rows, "ord int, kv array<struct<k:string,v:string>>")
                .select("ord", F.map_from_entries("kv").alias("cells")))
    tpl = spark.createDataFrame([("furniture_misc", ["B"], ["N"], ["V1", "V2"])],
                                "sub_category string, brands array<string>, names array<string>, variants array<string>")
    res = runs.build_products(spark, raw, tpl, 50, out_dir=str(tmp_path / "synthetic"))
    assert res.products.count() == 50
    # A resumed run takes the normalised stage of the same feed, in any order;
    # a changed feed is read anew.
    out, none = str(tmp_path / "synthetic"), raw.filter(F.lit(False))
    assert not runs.build_products(spark, raw, tpl, 50, out_dir=out, resume=True).resumed
    again = runs.build_products(spark, raw.repartition(7), tpl, 50, out_dir=out, resume=True)
    assert again.resumed and again.products.count() == 50
    assert again.run.first().normalization_count == 30
    changed = runs.build_products(spark, raw.filter("ord > 0"), tpl, 50, out_dir=out, resume=True)
    assert not changed.resumed and changed.run.first().normalization_count == 29
    assert runs.build_products(spark, none, tpl, 50, out_dir=out).products.count() == 0
    lost = runs.build_products(spark, raw, tpl, 50, catalog=str(tmp_path / "no such file.csv"))
    assert lost.products.count() == 50 and lost.run.first().sources[0].error == "PATH_NOT_FOUND"
    cat = spark.createDataFrame([(0, "SKU A", "85010000"), (1, "SKU B", "9999")],
                                "ord int, product_name string, hsn_code string")
    res = runs.build_products(spark, raw, tpl, 50, catalog=cat, out_dir=str(tmp_path / "catalog"))
    rows = res.products.collect()
    assert [r.product_name for r in rows] == ["SKU A"] and rows[0].hsn_code == "85010000"
    ev = S.export_view(res.products)
    assert len(ev.columns) == 17 and dict(ev.dtypes)["igst_rate"] == "double"
    assert ev.filter(F.col("hsn_code").isNull()).count() == 0
    good = N.split_errors(N.normalize(raw))[0]
    assert good.count() == 30
