"""Lookup queries over a product table (Q1-Q7).

Store order is an explicit order column (``ord_col``); "first" always means
smallest by that column. Limits are the feature of these lookups (they are
top-k reports), clamped to the documented ranges.
"""

from __future__ import annotations

import re

from pyspark.errors import SparkRuntimeException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.fixed import (CATEGORY_GROUP_CAP, LIMIT_CODE, LIMIT_DESCRIPTION,
                            LIMIT_PRODUCT)

RATE_COLS = ["cgst_rate", "sgst_rate", "igst_rate", "cess_rate"]
PICK_COLS = ["product_id", "product_name", "hsn_code", "gst_description", "cgst_rate",
             "sgst_rate", "igst_rate", "cess_rate", "top_category", "sub_category",
             "schedule", "confidence_flag"]


def clamp(limit: int | None, default_max: tuple[int, int]) -> int:
    default, hi = default_max
    return min(max(1, default if limit is None else int(limit)), hi)


def _check_pattern(p: str, df: DataFrame) -> str:
    """A pattern that Spark can't compile fails here, with a clear message,
    before any job over the table."""
    try:
        df.sparkSession.range(1).select(F.lit("").rlike(p)).collect()
    except SparkRuntimeException as e:
        if e.getCondition() != "INVALID_PARAMETER_VALUE.PATTERN":
            raise
        raise ValueError(f"invalid search pattern {p!r}") from e
    return p


def pick_product(df: DataFrame) -> DataFrame:
    """Q5: the 12 reported fields; absent text -> '', absent rates -> 0."""
    cols = []
    for c in PICK_COLS:
        default = F.lit(0.0) if c in RATE_COLS else F.lit("")
        cols.append((F.coalesce(F.col(c), default) if c in df.columns else default).alias(c))
    return df.select(*cols)


def rate_by_product(df: DataFrame, pattern: str, limit: int | None = None,
                    ord_col: str = "ord", name_col: str = "product_name") -> DataFrame:
    """Q1: case-insensitive regex on the product name, first ``limit`` rows in
    store order (limit clamped to 1..20, default 5)."""
    n = clamp(limit, LIMIT_PRODUCT)
    hit = df.filter(F.col(name_col).rlike("(?i)" + _check_pattern(pattern, df)))
    top = hit.orderBy(F.col(ord_col)).limit(n)
    return pick_product(top)


def search_description(df: DataFrame, term: str, limit: int | None = None,
                       ord_col: str = "ord", desc_col: str = "gst_description") -> DataFrame:
    """Q2: regex on the description, grouped by exact description: the first
    row's code, rates, categories and schedule, and the row count; largest
    groups first (ties by description), limit clamped to 1..30 (default 10).

    The grouping is a hash aggregate with map-side partial ``min_by``, so a
    description held by a third of all rows is combined before the shuffle.
    """
    n = clamp(limit, LIMIT_DESCRIPTION)
    fields = ["hsn_code", "igst_rate", "cgst_rate", "sgst_rate", "cess_rate",
              "top_category", "sub_category", "schedule"]
    g = (df.filter(F.col(desc_col).rlike("(?i)" + _check_pattern(term, df)))
           .groupBy(F.col(desc_col).alias("gst_description"))
           .agg(F.min_by(F.struct(*fields), F.col(ord_col)).alias("f"),
                F.count(F.lit(1)).alias("product_count")))
    return (g.orderBy(F.col("product_count").desc(), F.col("gst_description"))
             .limit(n)
             .select("gst_description", *[F.col("f." + c).alias(c) for c in fields],
                     "product_count"))


def _prefix_filter(df: DataFrame, code_col: str, code: str) -> Column:
    # A plain code becomes startswith (pushed to the Parquet scan as
    # StringStartsWith); a code with regex syntax keeps regex semantics.
    if re.fullmatch(r"[0-9A-Za-z]*", code):
        return F.col(code_col).startswith(code)
    return F.col(code_col).rlike("^" + _check_pattern(code, df))


def rate_by_code(df: DataFrame, code: str, limit: int | None = None,
                 ord_col: str = "ord", code_col: str = "hsn_code") -> DataFrame:
    """Q3: code prefix match; take the first ``limit`` rows in store order
    **then** keep the first row per description, so fewer than ``limit`` rows
    may come back (limit clamped to 1..20, default 10)."""
    n = clamp(limit, LIMIT_CODE)
    top = df.filter(_prefix_filter(df, code_col, code)).orderBy(F.col(ord_col)).limit(n)
    w = Window.partitionBy(F.coalesce(F.col("gst_description"), F.lit(""))).orderBy(ord_col)
    first = top.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").orderBy(ord_col)
    return pick_product(first)


def categories(df: DataFrame, ord_col: str = "ord", top_col: str = "top_category",
               sub_col: str = "sub_category", code_col: str = "hsn_code",
               cap: int = CATEGORY_GROUP_CAP) -> DataFrame:
    """Q4 (flat form): count and first code per (top, sub), ordered by top
    then count desc, capped at ``cap`` groups; then the per-top totals and
    the grand total over those groups.

    Output: level ('sub'|'top'|'all'), top_category, sub_category,
    product_count, sample_hsn. The first pass is one hash aggregate with
    partial combine; everything after it works on at most ``cap`` rows.
    """
    subs = (df.groupBy(F.col(top_col).alias("top_category"), F.col(sub_col).alias("sub_category"))
              .agg(F.count(F.lit(1)).alias("product_count"),
                   F.min_by(F.col(code_col), F.col(ord_col)).alias("sample_hsn"))
              .orderBy("top_category", F.col("product_count").desc(), "sub_category")
              .limit(cap))
    # Roll the capped groups up: (top, sub), (top), ().
    rolled = (subs.rollup("top_category", "sub_category")
                  .agg(F.sum("product_count").alias("product_count"),
                       F.max("sample_hsn").alias("__s"),
                       F.grouping_id().alias("__g")))
    return rolled.select(
        F.when(F.col("__g") == 0, "sub").when(F.col("__g") == 1, "top").otherwise("all").alias("level"),
        "top_category", "sub_category",
        F.col("product_count").cast("long").alias("product_count"),
        F.when(F.col("__g") == 0, F.col("__s")).alias("sample_hsn"))


def categories_nested(df: DataFrame, **kw) -> DataFrame:
    """Q4 (nested form): one row per top category with its total and a
    sorted array of (name, product_count, sample_hsn); at most ``cap``
    groups in all, so the collected arrays are bounded."""
    flat = categories(df, **kw).filter("level = 'sub'")
    return (flat.groupBy("top_category")
                .agg(F.sum("product_count").alias("total_products"),
                     F.sort_array(F.collect_list(F.struct(
                         (-F.col("product_count")).alias("neg_count"),
                         F.col("sub_category").alias("name"),
                         "product_count", "sample_hsn"))).alias("subs"))
                .select("top_category", "total_products",
                        F.transform("subs", lambda s: s.dropFields("neg_count")).alias("sub_categories")))


def envelope(items: DataFrame, query: str, items_name: str = "products") -> DataFrame:
    """Q6: JSON envelope {query, total_results, <items_name>} as one string
    row, items in the order of ``items``, null fields written as null. Only
    used on the bounded (<= 30 row) outputs of Q1-Q3."""
    # The id follows the order of a sorted frame, over its partitions too.
    placed = items.withColumn("__at", F.monotonically_increasing_id())
    agg = placed.agg(F.count(F.lit(1)).alias("total_results"),
                     F.sort_array(F.collect_list(F.struct("__at", *items.columns))).alias("__all"))
    plain = F.transform("__all", lambda x: x.dropFields("__at")).alias(items_name)
    return agg.select(F.to_json(F.struct(F.lit(query).alias("query"), "total_results", plain),
                                {"ignoreNullFields": "false"}).alias("json"))


def collection_size(df: DataFrame) -> DataFrame:
    """Q7: row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("total_products"))
