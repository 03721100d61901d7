"""Keyword rules held as a table, against a plain loop over the rules."""

import random

from pyspark.sql import functions as F

from ratebook.operators import classify as C

TOPS = ["consumer_goods", "electronics", "industrial", "automotive", "other"]


def frames(spark, texts, rules):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, gst_description string").withColumn("hsn_code", F.lit("99"))
    table = spark.createDataFrame([(i, k, TOPS[i % 5], None if i % 3 else f"s{i}") for i, k in enumerate(rules)],
                                  "rule_ord int, keyword string, top_category string, sub_category string")
    return df, table


def plain(texts, rules):
    out = []
    for t in texts:
        i = next((i for i, k in enumerate(rules) if k and k.lower() in (t or "").lower()), None)
        out.append(("other", "uncategorized") if i is None else (TOPS[i % 5], "uncategorized" if i % 3 else f"s{i}"))
    return out


def check(spark, texts, rules):
    df, table = frames(spark, texts, rules)
    out = C.classify_rule_table(df, table, range_rules=[(1, 2, "x", "y")])
    assert out.columns == ["id", "gst_description", "hsn_code", "top_category", "sub_category"]
    got = [(r.top_category, r.sub_category) for r in out.orderBy("id").collect()]
    assert got == plain(texts, rules)
    return out


def test_ten_thousand_rules(spark):
    rng = random.Random(1)
    word = lambda lo, hi: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(lo, hi)))
    rules = [word(5, 14) for _ in range(10_000)]
    texts = ["zz " + word(0, 900) for _ in range(150)] + [rules[-1], "x" + rules[7000] + "y", "", None, "Z" * 3000 + rules[9000]]
    out = check(spark, texts, rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_long_repeated_and_empty_keywords(spark):
    long = "k" * 700
    rules = ["", None, long, "cC", "q", "cc", "car", "carpet", "😀b", "  "]
    texts = ["CARPET", "a CAR", "xCcx", "q", "😀B", "a  b", "y" * 250 + long, "k" * 699, "y" * 254 + "car", "y" * 255 + "cc",
             None, "", " ", "y" * 256 + "q", "carpet", "carpet"]
    check(spark, texts, rules)


def test_no_rules_no_rows(spark):
    check(spark, ["a", None], [])
    df, table = frames(spark, [], ["abc"])
    assert C.classify_rule_table(df, table).count() == 0


def test_builtin_rules_equal_the_case_chain(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("text").alias("gst_description"), F.lit("8517").alias("hsn_code"), "doc_id")
    got = C.classify_rule_table(d, C.keyword_rules_frame(spark)).select("doc_id", "top_category", "sub_category")
    want = C.classify(d).select("doc_id", "top_category", "sub_category")
    assert sorted(got.collect()) == sorted(want.collect())


def test_places_become_rows_one_by_one_and_meet_broadcast_rules(spark):
    """no array of q-grams with their piece is built for a text, and the rules travel."""
    df, table = frames(spark, ["a car b", "x" * 700 + "car", "ca", None], ["zz", "car", "c"])
    plan = C.keyword_matches(df, table, "gst_description")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "explode(sequence(1" in plan and "SortMergeJoin" not in plan
    check(spark, ["a car b", "x" * 700 + "car", "ca", None], ["zz", "car", "c"])
