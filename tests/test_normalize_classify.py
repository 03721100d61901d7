"""Normalisation of raw rows with differing headers; rule classification."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratebook.fixed import HSN_RANGE_RULES
from ratebook.operators import classify as C
from ratebook.operators import normalize as N

RAW = [
    {"sr_no": "41", "description": "Walnut kernels", "hsn_code": "0802", "rate": "7%",
     "_source_name": "src-a", "_raw_text": "41 | Walnut"},
    {"s_no": "42", "description_of_goods": "Pocket lamps", "hsn": "8513", "cgst": "6", "sgst": "6"},
    {"serial_no": "43", "particulars": "Buttons of horn", "tariff": "96.06", "gst_rate": "11%"},
    {"no": "44", "description": "Untaxed seed potatoes", "hsn_code": "0701", "rate": "Nil"},
    {"left": "", "right": ""},
]


def _raw(spark, rows):
    data = [(i, list(r.items())) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "ord int, kv array<struct<k:string,v:string>>")
    return df.select("ord", F.map_from_entries("kv").alias("cells"))


def test_normalize_rows(spark):
    rec = N.normalize(_raw(spark, RAW), source_name="run-src").orderBy("ord").collect()
    assert len(rec) == 4  # the all-empty row is dropped
    r0, r1, r2, r3 = rec
    assert (r0.igst_rate, r0.cgst_rate, r0.sgst_rate) == (Decimal("7"), Decimal("3.5"), Decimal("3.5"))
    assert r0.source_name == "src-a" and r0.raw_text == "41 | Walnut" and r0.serial_no == "41"
    assert (r1.igst_rate, r1.cgst_rate) == (Decimal("12"), Decimal("6"))
    assert r1.source_name == "run-src"
    assert r2.hsn_code == "9606" and r2.igst_rate == Decimal("11")
    assert r3.hsn_code == "0701" and (r3.cgst_rate, r3.sgst_rate, r3.igst_rate) == (0, 0, 0)
    assert r3.confidence_flag == "medium"
    assert r0.confidence_flag == "high"


def test_first_alias_wins_and_presence_decides(spark):
    rows = [{"HSN Code": "1111", "hsn": "2222", "Desc": "x"},  # alias 'hsn' ranks before 'hsn_code'
            {"hsn": None, "tariff": "3333", "Desc": "y"}]      # present but null still wins
    rec = N.normalize(_raw(spark, rows)).orderBy("ord").collect()
    assert [r.hsn_code for r in rec] == ["2222", ""]


def test_confidence_points(spark):
    df = spark.createDataFrame([("1006", "Rice", 2.5, 2.5, 5.0), ("", "", 0.0, 0.0, 0.0),
                                ("1", "x", -1.0, 0.0, 0.0)], "h string, d string, c double, s double, i double")
    got = [r[0] for r in df.select(N.confidence(F.col("h"), F.col("d"), F.col("c"), F.col("s"), F.col("i"))).collect()]
    assert got == ["high", "review_required", "review_required"]


def _chapter_cases():
    cases = []
    for lo, hi, top, sub in HSN_RANGE_RULES:
        for ch in {lo, hi}:
            cases.append((f"{ch:02d}10", top, sub))
    cases += [("9900", "other", "uncategorized"), ("", "other", "uncategorized"), ("1", "other", "uncategorized"),
              ("ab12", "other", "uncategorized"), ("7701", "industrial", "metals")]
    return cases


def test_category_for_code(spark):
    cases = _chapter_cases()
    df = spark.createDataFrame([(c,) for c, _, _ in cases], "hsn_code string")
    got = [(r.top_category, r.sub_category) for r in C.category_for_code(df).collect()]
    assert got == [(t, s) for _, t, s in cases]


def test_range_join_agrees_with_case(spark):
    codes = [f"{i:02d}55" for i in range(0, 100)] + ["", "7", "x9", "-1", "+5"]
    df = spark.createDataFrame([(c,) for c in codes], "hsn_code string")
    a = {(r.hsn_code, r.top_category, r.sub_category) for r in C.category_for_code(df).collect()}
    b = {(r.hsn_code, r.top_category, r.sub_category)
         for r in C.classify_ranges_join(df, C.range_rules_frame(spark)).collect()}
    assert a == b


@pytest.mark.parametrize("code,desc,top", [
    ("3926", "Mobile phone protective cover", "electronics"),
    ("4202", "Laptop bag made of leather", "electronics"),
    ("4011", "Car tyres, new pneumatic", "automotive"),
    ("5701", "Carpets of wool", "automotive"),   # substring semantics: 'car' in 'carpets'
    ("1006", "Rice", "consumer_goods"),
])
def test_keyword_priority(spark, code, desc, top):
    df = spark.createDataFrame([(code, desc)], "hsn_code string, gst_description string")
    assert C.classify(df).first().top_category == top


def test_rules_from_config():
    kw, rr = C.rules_from_config({"classification": {
        "hsn_rules": [{"hsn_prefix_start": 1, "hsn_prefix_end": 2, "top_category": "other",
                       "sub_category": "jewelry"}],
        "keyword_overrides": {"fan": "electronics"}}})
    assert rr == [(1, 2, "other", "jewelry")] and kw == [("fan", "electronics")]
    kw, rr = C.rules_from_config({"classification": {"hsn_rules": []}})
    assert rr == HSN_RANGE_RULES and len(kw) == 48


def test_many_rules_equal_a_plain_loop(spark):
    rules = [(f"w{i:03d}", "industrial" if i % 2 else "electronics") for i in range(500)] + [("car", "automotive")]
    texts = ["x w150 y w007", "carpet", "nothing", None, "W499 upper", "w3000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] and r[0].top_category for r in df.select(C.keyword_category("t", rules, {})).collect()]
    want = [next((top for kw, top in rules if kw in (t or "").lower()), None) for t in texts]
    assert got == want


def test_quarantine_keeps_good_rates(spark):
    cells = [{"hsn": "1", "description": "a", "rate": "tobacco 24029900"}, {"hsn": "2", "description": "b", "rate": "1500000"},
             {"hsn": "3", "description": "c", "cgst": "999999", "sgst": "999999"},
             {"hsn": "4", "description": "d", "rate": "9" * 30}, {"hsn": "5", "description": "e", "rate": "1.2.3"}]
    good, bad = N.split_errors(N.normalize(_raw(spark, cells)))
    got = {r.hsn_code: r.igst_rate for r in good.collect()}
    assert got == {"1": 0, "2": Decimal("1500000"), "3": Decimal("1999998"), "5": 0}
    assert [(r.hsn_code, r._error) for r in bad.collect()] == [("4", "rate_out_of_range")]


def test_run_summary(spark):
    import datetime as dt
    from ratebook.operators import summary as S
    srcs = spark.createDataFrame([("a", "completed", 3), ("b", "failed", 0)], "source_name string, status string, rows int")
    cats = spark.createDataFrame([("electronics",), ("electronics",), ("other",)], "top_category string")
    rep = spark.createDataFrame([(True,)], "passed boolean")
    t0 = dt.datetime(2024, 1, 1)
    r = S.run_summary(t0, t0 + dt.timedelta(seconds=90), srcs, {"normalized_rows": cats}, cats, rep).first()
    assert (r.sources_attempted, r.sources_succeeded, r.sources_failed) == (2, 1, 1)
    assert r.normalized_rows == 3 and r.category_distribution == {"electronics": 2, "other": 1}
    assert r.duration_sec == 90.0 and r.validation_passed
    kv = {x.key: x.value for x in S.summary_kv(S.summary(cats.withColumn("hsn_code", cats.top_category))).collect()}
    assert kv == {"total_records": "3", "unique_hsn_codes": "2"}


def test_keyword_rules_from_frame(spark):
    kw_df = C.keyword_rules_frame(spark)
    kws, sub = C.keyword_rules_from_frame(kw_df)
    df = spark.createDataFrame([("Mobile phone cover",), ("Carpets",), ("Plain rice",)], "d string")
    a = [r[0] for r in df.select(C.keyword_category("d")).collect()]
    b = [r[0] for r in df.select(C.keyword_category("d", kws, sub)).collect()]
    assert a == b
