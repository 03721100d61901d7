"""Column functions: rate, code, date parsing; ids and cache keys."""

import datetime as dt
import hashlib
from decimal import Decimal
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from ratebook.functions import (cache_key, clean_hsn, coerce_rate, dec_text, parse_date, parse_rate,
                                snake, stable_id, strip_hsn)


def _one(spark, col_expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col_expr(F.col("x"))).collect()]


RATE_CASES = [
    ("18", Decimal("18")), ("18%", Decimal("18")), ("Nil", Decimal("0")), ("Exempt", Decimal("0")),
    ("Free", Decimal("0")), (None, Decimal("0")), ("", Decimal("0")), ("-", Decimal("0")),
    ("2.5", Decimal("2.5")), ("5% to 12%", Decimal("5")), ("12 or 18", Decimal("12")),
    ("n/a", Decimal("0")), ("tobacco 28", Decimal("0")), ("1.2.3", Decimal("0")), (".", Decimal("0")),
    ("-5", Decimal("5")), ("GST @ 28 %", Decimal("28")), ("  0  ", Decimal("0")),
]


def test_parse_rate(spark):
    got = _one(spark, parse_rate, [c for c, _ in RATE_CASES])
    assert got == [e for _, e in RATE_CASES]


def test_parse_rate_numeric_keeps_sign(spark):
    df = spark.createDataFrame([(18.0,), (2.5,), (-5.0,)], "x double")
    got = [r[0] for r in df.select(parse_rate(F.col("x"), df.schema["x"].dataType)).collect()]
    assert got == [Decimal("18"), Decimal("2.5"), Decimal("-5")]


def test_coerce_rate(spark):
    cases = [("18%", Decimal("18")), ("Nil", Decimal("0")), ("free", Decimal("0")), ("-5", Decimal("-5")),
             ("5 to 12", Decimal("0")), (None, Decimal("0")), (" 2.5 % ", Decimal("2.5"))]
    assert _one(spark, coerce_rate, [c for c, _ in cases]) == [e for _, e in cases]


def test_clean_hsn(spark):
    cases = [("1006", "1006"), ("71.13", "7113"), ("85 17", "8517"), ("Chapter 01", "01"), (None, ""),
             ("", ""), ("84-51", "8451"), ("HSN 12a34 ex", "12a34"), ("\t9901\n", "9901")]
    assert _one(spark, clean_hsn, [c for c, _ in cases]) == [e for _, e in cases]


def test_strip_hsn(spark):
    cases = [(" 71.13 ", "7113"), ("85 17", "8517"), ("84-51", "84-51"), (None, "")]
    assert _one(spark, strip_hsn, [c for c, _ in cases]) == [e for _, e in cases]


def test_parse_date_all_layouts(spark):
    d = dt.date(2024, 9, 5)
    texts = ["05-09-2024", "5/9/2024", "2024-09-05", "05.09.2024", "5 Sep 2024", "05 September 2024",
             "September 5, 2024", "SEP 05, 2024", "5-sep-2024", "05-SEPTEMBER-2024", "5  Sep   2024"]
    assert _one(spark, parse_date, texts) == [d] * len(texts)
    assert _one(spark, parse_date, ["1-4-2025"]) == [dt.date(2025, 4, 1)]
    assert _one(spark, parse_date, [None, "", "-", "N/A", "soon", "31-02-2024"]) == [None] * 6


def test_dec_text(spark):
    df = spark.createDataFrame([(Decimal("10"),), (Decimal("0"),), (Decimal("0.25"),), (Decimal("5.0"),),
                                (Decimal("100"),), (Decimal("-2.50"),)], "x decimal(12,6)")
    assert [r[0] for r in df.select(dec_text("x")).collect()] == ["10", "0", "0.25", "5", "100", "-2.5"]


def test_stable_id_matches_hashlib(spark):
    df = spark.createDataFrame([("1006", "Rice", "5")], "a string, b string, c string")
    got = df.select(stable_id("a", "b", "c")).first()[0]
    assert got == hashlib.sha256(b"1006|Rice|5").hexdigest()[:16]


def test_cache_key(spark):
    urls = ["https://cbic-gst.gov.in/gst-goods-services-rates.html", "http://u:p@a.b.com:8080/x?y=1"]
    got = _one(spark, cache_key, urls)
    want = [urlparse(u).netloc.replace(".", "_") + "_" + hashlib.md5(u.encode()).hexdigest()[:12] + ".html"
            for u in urls]
    assert got == want


@pytest.mark.parametrize("raw,want", [("  S. No. ", "s_no"), ("HSN/SAC Code", "hsn_sac_code"),
                                      ("__Rate (%)__", "rate"), ("", "")])
def test_snake(spark, raw, want):
    assert _one(spark, snake, [raw]) == [want]


def test_cell_number_is_the_parsed_rate_and_null_only_beyond_a_rate(spark):
    """one number per cell serves the rate and its check."""
    from ratebook.functions.rates import cell_number
    texts = [None, "", ".", "..", "1.2.3", "5.", ".5", "5%", " or 5", "x or 5", "5 or 6", "12 to 18", "Nil", "0", "a.5", "9" * 30, "9" * 400]
    want = [0, 0, 0, 0, 0, 5, 0.5, 5, 5, 0, 5, 12, 0, 0, 0.5, None, None]
    assert [x if x is None else float(x) for x in _one(spark, cell_number, texts)] == want


def test_no_layout_is_passed_over_that_would_parse(spark):
    """the layouts left untried are those that cannot parse the text."""
    from pyspark.sql import functions as F

    from ratebook.fixed import DATE_FORMATS
    from ratebook.functions.dates import _may_be
    texts = ["1-4-2025", "00005/1/2020", "-2020-1-2", "+12020-1-2", "1-2--2020", "1/2/-2020", "2020-01-02", "3.4.2020", "1 Feb 2020",
             "1 FEBRUARY 2020", "may 5, 2020", "March 05, 2020", "5-may-2020", "5-March-2020", "5-May--2020", "12-2020-1", "x", "1/2/20"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for _, p in DATE_FORMATS:
        assert df.where(F.try_to_date("s", p).isNotNull() & ~_may_be(F.col("s"), p)).collect() == []
    assert [r[0] for r in df.select(F.size(F.filter(F.array(*[_may_be(F.col("s"), p) for _, p in DATE_FORMATS]), lambda x: x)))
            .collect()][6] == 1
