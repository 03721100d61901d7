"""Bindings of the operators to the driver's tables.

Each registered query reads whole tables (or data Spark derives from them)
and returns a DataFrame; each has an ANSI SQL twin in ``ratebook.plans.oracles``
that DuckDB runs on the same Parquet files. Shared derived views (a product
table built from ``part``, rate records built from ``lineitem``...) live here
so queries and tests use one definition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.operators import classify as C
from ratebook.operators import lookup as L
from ratebook.session import apply_scale_conf
from ratebook.sources.readers import read_parquet
from ratebook.functions.dates import parse_date
from ratebook.functions.rates import coerce_rate, parse_rate
from ratebook.functions.text import clean_hsn, strip_hsn
from ratebook.operators import normalize as N
from ratebook.functions.rates import RATE_TYPE
from ratebook.operators import quality as V
from ratebook.operators import summary as S
from ratebook.operators import expand as X
from ratebook.functions.text import cache_key
from ratebook.operators import ledger as J
from ratebook.operators import extract as E
from ratebook.plans import runs as P

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


SMALL_TABLES = {"region", "nation", "supplier"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_scale_conf(spark)
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet",
                        spread=name not in SMALL_TABLES)


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table dealt evenly over the shuffle partitions, whatever
    its files: for costly work on each of many narrow rows, which one small
    file with one row group would leave to one task."""
    apply_scale_conf(spark)
    rows = read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", spread=False).select(*columns)
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


# ------------------------------------------------------------ derived views

def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product table derived from ``part``: code = part key text,
    description = type + brand, name = part name, rates from size, store
    order = part key; classified by keyword then chapter rules."""
    p = table(spark, sf_dir, "part")
    igst = ((F.col("p_size") % 4) * 6).cast("double")
    prod = p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_partkey").cast("string").alias("hsn_code"),
        F.concat_ws(" ", "p_type", "p_brand").alias("gst_description"),
        F.concat(F.lit("S"), (F.col("p_size") % 6).cast("string")).alias("schedule"),
        (igst / 2).alias("cgst_rate"), (igst / 2).alias("sgst_rate"), igst.alias("igst_rate"),
        F.lit(0.0).alias("cess_rate"),
        F.lit("high").alias("confidence_flag"),
        F.col("p_partkey").alias("ord"))
    return C.classify(prod)


# ------------------------------------------------------------------ queries

@register("categories")
def q_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3+C4+C5+Q4: classify the part-derived products, then the category
    rollup (per (top, sub) count and first code; per top; grand total)."""
    return L.categories(part_products(spark, sf_dir))


# ------------------------------------------------------- normalisation



def _pct(c):
    return F.round(c * 100).cast("long").cast("string")


def dirty_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate texts in eight spellings built from lineitem tax and discount."""
    li = table(spark, sf_dir, "lineitem")
    t, d = _pct(F.col("l_tax")), _pct(F.col("l_discount"))
    u = F.round((F.col("l_tax") + F.col("l_discount")) * 100).cast("long").cast("string")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    text = (F.when(k == 0, F.concat(t, F.lit("%")))
             .when(k == 1, F.when(F.col("l_tax") == 0, F.lit("Nil")).otherwise(F.concat(t, F.lit(" %"))))
             .when(k == 2, F.concat(t, F.lit("% to "), u, F.lit("%")))
             .when(k == 3, F.concat(t, F.lit(" or "), u))
             .when(k == 4, F.concat(F.lit("GST @ "), t, F.lit(".5%")))
             .when(k == 5, F.when(F.col("l_discount") == 0, F.lit("Exempt")).otherwise(F.concat(F.lit("-"), t)))
             .when(k == 6, F.concat(t, F.lit("."), d, F.lit(".1")))
             .otherwise(F.concat(F.lit("Tobacco "), t)))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("rate_text"))


@register("parse_rate")
def q_parse_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N5 + N6 on rate texts of eight spellings."""
    r = dirty_rates(spark, sf_dir)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rate_text",
                    parse_rate(F.col("rate_text")).cast("double").alias("rate"),
                    coerce_rate(F.col("rate_text")).cast("double").alias("coerced"))


@register("clean_hsn")
def q_clean_hsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 + N3 on code texts of six spellings built from part keys."""
    p = table(spark, sf_dir, "part")
    ks = F.col("p_partkey").cast("string")
    k = F.col("p_partkey") % 6
    dirty = (F.when(k == 0, F.concat(F.lit("Chapter "), ks))
              .when(k == 1, F.concat(F.substring(ks, 1, 2), F.lit("."), F.substring(ks, 3, 100)))
              .when(k == 2, F.concat(F.substring(ks, 1, 2), F.lit(" - "), F.substring(ks, 3, 100)))
              .when(k == 3, F.concat(F.lit(" "), ks, F.lit(" ex")))
              .when(k == 4, F.concat(ks, F.lit("a"), ks))
              .otherwise(F.when(F.col("p_partkey") % 12 == 5, F.lit(None).cast("string")).otherwise(F.lit(""))))
    return p.select("p_partkey", dirty.alias("code_text"),
                    clean_hsn(dirty).alias("hsn_code"), strip_hsn(dirty).alias("model_code"))


DATE_SPELLINGS = ["dd-MM-yyyy", "d/M/yyyy", "yyyy-MM-dd", "dd.MM.yyyy", "d  MMM yyyy",
                  "dd MMMM yyyy", "MMMM d, yyyy", "MMM dd, yyyy", "d-MMM-yyyy", "dd-MMMM-yyyy"]


@register("parse_date")
def q_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N11 on order dates written in the ten layouts (one upper-cased, one
    lower-cased, one with a doubled blank), plus 'n/a' and junk."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 12
    txt = F.when(k == 10, F.lit("n/a")).when(k == 11, F.lit("soon"))
    for i, pat in enumerate(DATE_SPELLINGS):
        v = F.date_format("o_orderdate", pat)
        if i == 7:
            v = F.upper(v)
        if i == 9:
            v = F.lower(v)
        txt = txt.when(k == i, v)
    return o.select("o_orderkey", txt.alias("date_text"),
                    F.date_format(parse_date(txt), "yyyy-MM-dd").alias("parsed"))


def raw_lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows (cells MAP) from lineitem with four header spellings."""
    li = table(spark, sf_dir, "lineitem")
    t, d = _pct(F.col("l_tax")), _pct(F.col("l_discount"))
    td = F.round((F.col("l_tax") + F.col("l_discount")) * 100).cast("long").cast("string")
    code = F.col("l_partkey").cast("string")
    ln = F.col("l_linenumber").cast("string")
    k = F.col("l_linenumber") % 4
    arr = lambda *xs: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    keys = (F.when(k == 0, arr("S. No.", "HSN Code", "Description of Goods", "Rate", "_source_name"))
             .when(k == 1, arr("Sr. No.", "Tariff Item", "Particulars", "CGST Rate", "SGST Rate", "Cess"))
             .when(k == 2, arr("hsn_sac", "Goods Description", "IGST", "w.e.f", "HSN"))
             .when(F.col("l_quantity") > 25, arr("col1", "col2"))
             .otherwise(arr("Description", "HSN", "Rate")))
    vals = (F.when(k == 0, arr(ln, code, F.concat(F.lit("part "), code), F.concat(t, F.lit("%")),
                             F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string"))))
             .when(k == 1, arr(ln, F.concat(F.substring(code, 1, 2), F.lit("."), F.substring(code, 3, 100)),
                               F.concat(F.lit("Item "), F.col("l_returnflag"), F.col("l_linestatus")),
                               F.concat(t, F.lit("%")), F.concat(t, F.lit("%")), F.concat(d, F.lit("%"))))
             .when(k == 2, arr("WRONG", F.when(F.col("l_returnflag") == "N", F.lit(""))
                               .otherwise(F.concat(F.lit("goods "), F.col("l_returnflag"))),
                               td, F.date_format("l_shipdate", "dd/MM/yyyy"), code))
             .when(F.col("l_quantity") > 25, arr("", ""))
             .otherwise(arr(F.concat(F.lit("Exempt - part "), code), "", "Nil")))
    return li.select(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("ord"),
                     F.map_from_arrays(keys, vals).alias("cells"))


@register("normalize")
def q_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw maps with differing headers ->
    canonical records."""
    rec = N.normalize(raw_lineitem_rows(spark, sf_dir), source_name="lineitem-feed")
    good, _bad = N.split_errors(rec)
    return good.select(
        "ord.l_orderkey", "ord.l_linenumber", "ord.l_partkey", "ord.l_suppkey",
        "product_id", "hsn_code", "gst_description", "serial_no",
        *[F.col(r).cast("double").alias(r) for r in N.RATES],
        F.date_format("effective_from", "yyyy-MM-dd").alias("effective_from"),
        "source_name", "confidence_flag")


# ------------------------------------------------------------- quality


DOC_PRIMARY = "src0"
LI_PRIMARY = "S7"
CUST_PRIMARY = "N3"


def _dec(c):
    return c.cast(RATE_TYPE)


def doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate records from documents: code = language, description = whole
    text, source = source, rate by doc id parity, order = doc id."""
    d = table(spark, sf_dir, "documents")
    igst = _dec((F.col("doc_id") % 2) * 5)
    return d.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("product_id"),
        F.col("lang").alias("hsn_code"), F.col("text").alias("gst_description"),
        F.col("source").alias("source_name"),
        _dec(igst / 2).alias("cgst_rate"), _dec(igst / 2).alias("sgst_rate"), igst.alias("igst_rate"),
        _dec(F.lit(0)).alias("cess_rate"), F.lit("other").alias("top_category"),
        F.lit("uncategorized").alias("sub_category"), F.lit("high").alias("confidence_flag"),
        F.col("doc_id").alias("ord"))


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate records from lineitem: code = part key, source = supplier,
    rate = tax percent; order = the whole row (the natural key repeats)."""
    li = table(spark, sf_dir, "lineitem")
    igst = _dec(F.round(F.col("l_tax") * 100))
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("product_id"),
        F.col("l_partkey").cast("string").alias("hsn_code"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("gst_description"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("source_name"),
        _dec(igst / 2).alias("cgst_rate"), _dec(igst / 2).alias("sgst_rate"), igst.alias("igst_rate"),
        _dec(F.lit(0)).alias("cess_rate"), F.lit("high").alias("confidence_flag"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_tax", "l_quantity",
                 "l_extendedprice").alias("ord"))


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate records from customer with blank codes, negative rates (balance),
    zero rates (BUILDING), out-of-domain categories and repeated keys."""
    c = table(spark, sf_dir, "customer")
    k9 = F.col("c_custkey") % 9
    hsn = (F.when(k9 == 0, F.lit("")).when(k9 == 1, F.lit(" "))
            .otherwise(((F.col("c_custkey") % 40) + 10).cast("string")))
    v = F.when(F.col("c_mktsegment") == "BUILDING", _dec(F.lit(0))).otherwise(_dec(F.col("c_acctbal")))
    top = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", "automotive")
            .when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), "industrial")
            .when(F.col("c_mktsegment") == "FURNITURE", "consumer_goods").otherwise("household"))
    return c.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("product_id"),
        hsn.alias("hsn_code"),
        F.concat(F.lower("c_mktsegment"), F.lit(" goods")).alias("gst_description"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("source_name"),
        v.alias("cgst_rate"), v.alias("sgst_rate"), _dec(v * 2).alias("igst_rate"),
        F.when(F.col("c_custkey") % 50 == 0, _dec(F.lit(-2.5))).otherwise(_dec(F.lit(0))).alias("cess_rate"),
        top.alias("top_category"), F.lower("c_mktsegment").alias("sub_category"),
        F.lit("high").alias("confidence_flag"), F.col("c_custkey").alias("ord"))


def _dbl(df: DataFrame, cols) -> list:
    return [F.col(c).cast("double").alias(c) for c in cols]


@register("resolve_conflicts")
def q_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 on documents: one row per (language, lower(trim(text))), primary source first."""
    r = V.resolve_conflicts(doc_records(spark, sf_dir), DOC_PRIMARY)
    return r.select("product_id", "hsn_code", "source_name", *_dbl(r, ["igst_rate"]), "ord")


@register("duplicates")
def q_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 on documents: every repeat of (language, text, rate) after the first."""
    return V.check_duplicates(doc_records(spark, sf_dir)).select(*V.ISSUE_COLS)


@register("conflicts")
def q_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 on lineitem: suppliers disagreeing on a part's tax rate, primary supplier S7."""
    return V.check_conflicts(lineitem_records(spark, sf_dir), LI_PRIMARY).select(*V.ISSUE_COLS)


@register("apply_primary_rate")
def q_apply_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 on lineitem: conflicting rows take the primary supplier's rate."""
    r = V.apply_primary_rate(lineitem_records(spark, sf_dir), LI_PRIMARY)
    return r.select("product_id", "hsn_code", "source_name",
                    *_dbl(r, ["cgst_rate", "sgst_rate", "igst_rate"]), "confidence_flag")


@register("validate_issues")
def q_validate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1-V6, V9 on customer records: the whole issue table."""
    return V.validate_issues(customer_records(spark, sf_dir), CUST_PRIMARY).select(*V.ISSUE_COLS)


@register("validation_report")
def q_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V10 on customer records."""
    return V.validation_report(customer_records(spark, sf_dir), CUST_PRIMARY)


@register("issues_top")
def q_issues_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10,000 issues in check / row order."""
    return V.issues_top(V.validate_issues(customer_records(spark, sf_dir), CUST_PRIMARY))


# ------------------------------------------------------- classification

PART_KEYWORDS = [("hot ring", "electronics"), ("ring", "consumer_goods"), ("hot", "industrial"),
                 ("widget", "electronics"), ("rod", "automotive"), ("bolt", "industrial")]
PART_KEYWORD_SUB = {"hot ring": "consumer_appliances", "widget": "computers_electronics",
                    "rod": "vehicles_transport"}
SIZE_RULES = [(1, 10, "consumer_goods", "jewelry"), (5, 20, "industrial", "metals"),
              (26, 40, "electronics", "instruments"), (35, 45, "automotive", "vehicles_transport")]


@register("classify_documents")
def q_classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 + C4: built-in keyword rules on whole document texts."""
    d = table(spark, sf_dir, "documents")
    cat = F.coalesce(C.keyword_category("text"), C.default_category())
    return d.select("doc_id", cat.top_category.alias("top_category"),
                    cat.sub_category.alias("sub_category"))


@register("classify_parts")
def q_classify_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 with caller rules: overlapping keywords on part names, then the
    built-in chapter ranges on the part-key code."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("gst_description"),
        F.col("p_partkey").cast("string").alias("hsn_code"))
    out = C.classify(p, keyword_rules=PART_KEYWORDS, sub_map=PART_KEYWORD_SUB)
    return out.select("p_partkey", "hsn_code", "top_category", "sub_category")


@register("classify_ranges_join")
def q_classify_ranges_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 + C4 + C6 with a rule DataFrame (overlap 5-10, gaps 21-25 and
    46-50): chapters expanded, broadcast hash join on the chapter."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lpad(F.col("p_size").cast("string"), 2, "0"),
                              (F.col("p_partkey") % 100).cast("string")).alias("hsn_code"))
    out = C.classify_ranges_join(p, C.range_rules_frame(spark, SIZE_RULES))
    return out.select("p_partkey", "hsn_code", "top_category", "sub_category")


@register("category_counts")
def q_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per top category after keyword classification."""
    return C.category_counts(q_classify_documents(spark, sf_dir))


# -------------------------------------------------------------- lookups

@register("rate_by_product")
def q_rate_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 + Q5: 'RING' in product names, first 5 in store order."""
    return L.rate_by_product(part_products(spark, sf_dir), "RING")


@register("rate_by_product_clamped")
def q_rate_by_product_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 with a regex and a limit above the maximum (clamped to 20)."""
    return L.rate_by_product(part_products(spark, sf_dir), "h.t (rod|gear)", limit=50)


@register("search_description")
def q_search_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: 'promo' in descriptions, grouped, largest 10 groups."""
    return L.search_description(part_products(spark, sf_dir), "promo")


@register("rate_by_code")
def q_rate_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: codes starting with '1': first 10 rows, then first per description."""
    return L.rate_by_code(part_products(spark, sf_dir), "1")


@register("envelope")
def q_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: JSON envelope of the Q1 answer, read back: one row per item."""
    items = q_rate_by_product(spark, sf_dir)
    schema = f"query string, total_results long, products array<{items.schema.simpleString()}>"
    back = L.envelope(items, "RING").select(F.from_json("json", schema).alias("e"))
    return back.select("e.query", "e.total_results", F.posexplode("e.products").alias("place", "p")).select(
        "query", "total_results", "place", "p.*")


@register("categories_nested")
def q_categories_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 nested form: per top category, total and sorted sub-category list,
    one row per list entry with its place."""
    nested = L.categories_nested(part_products(spark, sf_dir))
    return nested.select("top_category", "total_products", F.posexplode("sub_categories").alias("place", "s")).select(
        "top_category", "total_products", "place", "s.*")


@register("collection_size")
def q_collection_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: product count."""
    return L.collection_size(part_products(spark, sf_dir))


# ------------------------------------------------------------ summaries



@register("summary")
def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 on lineitem records: rows and distinct codes."""
    return S.summary(lineitem_records(spark, sf_dir))


@register("value_counts")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three value counts over orders in one GROUPING SETS pass."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("string").alias("o_year"))
    return S.value_counts(o, ["o_orderstatus", "o_orderpriority", "o_year"])


@register("summary_kv")
def q_summary_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation report of customer records as key/value rows."""
    return S.summary_kv(V.validation_report(customer_records(spark, sf_dir), CUST_PRIMARY))


@register("top_categories")
def q_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 largest sub-categories of the part-derived products."""
    return S.top_values(part_products(spark, sf_dir), "sub_category", 10)


@register("find_one")
def q_find_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookup of code '1234'."""
    return S.find_one(part_products(spark, sf_dir), "1234")


@register("to_product")
def q_to_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L3: customer rows with gaps -> product documents with defaults."""
    import datetime as dt
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    rows = c.select(
        F.col("c_custkey").cast("string").alias("product_id"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("product_name"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.lower("c_mktsegment")).alias("top_category"),
        F.lit(None).cast("string").alias("sub_category"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string")).alias("hsn_code"),
        F.lit("goods").alias("gst_description"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("I")).alias("schedule"),
        F.when(k % 4 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("igst_rate"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("c_acctbal") / 2).alias("cgst_rate"),
        F.lit("http://x").alias("source_url"), F.lit("raw").alias("raw_text"))
    out = S.to_product(rows, dt.datetime(2024, 1, 1))
    return out.withColumn("migrated_at", F.date_format("migrated_at", "yyyy-MM-dd HH:mm:ss"))


# ------------------------------------------------------------ expansion


EXPAND_DEFAULT_TEMPLATE = "standard"


def part_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base records from part: category = lower(type), code = part key."""
    p = table(spark, sf_dir, "part")
    return p.select(F.lower("p_type").alias("sub_category"), F.lit("industrial").alias("top_category"),
                    F.col("p_partkey").cast("string").alias("hsn_code"),
                    F.col("p_name").alias("gst_description"),
                    ((F.col("p_size") % 4) * 6).cast("double").alias("igst_rate"),
                    F.col("p_partkey").alias("ord"))


def part_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates derived from the data: per part type (all but PROMO, which
    falls back to the default template) the sorted distinct brands and part
    names; variants = the sorted nation names."""
    p = table(spark, sf_dir, "part")
    variants = table(spark, sf_dir, "nation").agg(F.array_sort(F.collect_set("n_name")).alias("variants"))
    per = (p.filter(F.lower("p_type") != "promo").groupBy(F.lower("p_type").alias("sub_category"))
            .agg(F.array_sort(F.collect_set("p_brand")).alias("brands"),
                 F.array_sort(F.collect_set("p_name")).alias("names")))
    from ratebook.operators.joins import one_row_join
    return one_row_join(per, variants)


def _expansion_out(df: DataFrame) -> DataFrame:
    return df.select("product_id", "product_name", "sub_category", "hsn_code", "gst_description",
                     "igst_rate", F.col("gen_index").cast("long").alias("gen_index"),
                     F.col("gen_chunk").cast("int").alias("gen_chunk"))


@register("allocate")
def q_allocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-category targets for a target of |lineitem| + |nation| rows."""
    target = table(spark, sf_dir, "lineitem").count() + table(spark, sf_dir, "nation").count()
    return X.allocate(part_base(spark, sf_dir), target)


@register("expand_synthetic")
def q_expand_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """|lineitem| + |nation| product rows from the part base
    (proportional pass, then padding chunks)."""
    target = table(spark, sf_dir, "lineitem").count() + table(spark, sf_dir, "nation").count()
    out = X.expand_synthetic(part_base(spark, sf_dir), part_templates(spark, sf_dir), target,
                             seed=42, default_key=EXPAND_DEFAULT_TEMPLATE)
    return _expansion_out(out)


@register("expand_trim")
def q_expand_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target below the base size (|orders| / 10): every base row once,
    then the seeded md5 order cut to the target."""
    target = table(spark, sf_dir, "orders").count() // 10
    out = X.expand_synthetic(part_base(spark, sf_dir), part_templates(spark, sf_dir), target,
                             seed=42, default_key=EXPAND_DEFAULT_TEMPLATE)
    return _expansion_out(out)


@register("expand_simple")
def q_expand_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round-robin variants without templates, |orders| rows."""
    target = table(spark, sf_dir, "orders").count()
    out = X.expand_simple(part_base(spark, sf_dir), target)
    return out.select("product_id", "product_name", "sub_category", "hsn_code",
                      F.col("gen_index").cast("long").alias("gen_index"))


def part_lookup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup records for catalog enrichment: codes (part key mod 1500) * 3,
    so later parts repeat earlier codes; every 97th code blank."""
    p = table(spark, sf_dir, "part")
    code = F.when(F.col("p_partkey") % 97 == 0, F.lit("")).otherwise(
        ((F.col("p_partkey") % 1500) * 3).cast("string"))
    return p.select(code.alias("hsn_code"), F.col("p_name").alias("gst_description"),
                    ((F.col("p_size") % 4) * 6).cast("double").alias("igst_rate"),
                    (((F.col("p_size") % 4) * 6) / 2).cast("double").alias("cgst_rate"),
                    (((F.col("p_size") % 4) * 6) / 2).cast("double").alias("sgst_rate"),
                    F.lit(0.0).alias("cess_rate"), F.lit("industrial").alias("top_category"),
                    F.lower("p_type").alias("sub_category"), F.col("p_brand").alias("source_name"),
                    F.lit("").alias("source_url"), F.lit("").alias("raw_text"),
                    F.lit("high").alias("confidence_flag"), F.col("p_partkey").alias("ord"))


def customer_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU catalog from customer: code = key * 7 plus '', '01' or '9'; every
    11th code blank."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    suffix = F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit("01")).otherwise(F.lit("9"))
    code = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat((k * 7).cast("string"), suffix))
    return c.select(F.col("c_name").alias("product_name"), code.alias("hsn_code"), k.alias("ord"))


@register("enrich_catalog")
def q_enrich_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKUs matched by exact code, else by 4-character code prefix."""
    e = X.enrich_catalog(customer_catalog(spark, sf_dir), part_lookup_records(spark, sf_dir))
    return e.select("product_id", "product_name", "hsn_code", "gst_description",
                    F.col("igst_rate").cast("double").alias("igst_rate"), "source_name", "match_kind", "ord")


@register("catalog_match_stats")
def q_catalog_match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched and total SKUs."""
    return X.catalog_match_stats(customer_catalog(spark, sf_dir), part_lookup_records(spark, sf_dir))


@register("catalog_unmatched")
def q_catalog_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKUs without a match (anti join)."""
    return X.catalog_unmatched(customer_catalog(spark, sf_dir), part_lookup_records(spark, sf_dir))


# --------------------------------------------------------------- ledger


TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def event_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs: one per user with a signup event (its first signup = enqueue)."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    u = F.col("user_id")
    pr = F.when(u % 4 == 0, "high").when(u % 4 == 1, "medium").when(u % 4 == 2, "low").otherwise("urgent")
    return (e.groupBy("user_id").agg(F.min("ts").alias("created_at"))
             .select(u.alias("job_id"), F.concat(F.lit("user "), u.cast("string")).alias("source_name"),
                     F.concat(F.lit("https://src.example/u"), u.cast("string")).alias("url"),
                     F.when(u % 5 == 0, "pdf").otherwise("html").alias("source_type"),
                     pr.alias("priority"), (u % 10 == 0).alias("is_primary"), "created_at"))


def event_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitions: view/click -> in_progress, purchase -> completed
    (detail = cache path), error -> failed (detail = props)."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") != "signup")
    t = (F.when(F.col("event_type").isin("view", "click"), "in_progress")
          .when(F.col("event_type") == "purchase", "completed").otherwise("failed"))
    detail = (F.when(t == "completed", F.concat(F.lit("cache/u"), F.col("user_id").cast("string"), F.lit("_"),
                                                  F.col("event_id").cast("string"), F.lit(".html")))
               .when(t == "failed", F.col("props")))
    return e.select(F.col("user_id").alias("job_id"), "ts", F.col("event_id").alias("seq"),
                    t.alias("transition"), detail.alias("detail"))


def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.fold_transitions(event_jobs(spark, sf_dir), event_transitions(spark, sf_dir))


def _ts(c: str):
    return F.date_format(c, TS_FMT).alias(c)


def _now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.max("ts").alias("__now"))


@register("ledger_fold")
def q_ledger_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger state folded from the event log."""
    led = event_ledger(spark, sf_dir)
    return led.select("job_id", "status", "retries", "content_path", "error", _ts("created_at"), _ts("updated_at"))


def enqueued_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    pr = (F.when(p.isin("1-URGENT", "2-HIGH"), "high").when(p == "3-MEDIUM", "medium")
           .when(p == "5-LOW", "low").otherwise("unspecified"))
    src = o.select(F.col("o_custkey").alias("job_id"),
                   F.concat(F.lit("cust "), F.col("o_custkey").cast("string")).alias("source_name"),
                   F.concat(F.lit("https://src.example/u"), F.col("o_custkey").cast("string")).alias("url"),
                   F.lit("html").alias("source_type"), pr.alias("priority"),
                   (F.col("o_orderstatus") == "F").alias("is_primary"), F.col("o_orderkey").alias("ord"))
    led = J.with_now(event_ledger(spark, sf_dir), _now(spark, sf_dir))
    out = J.enqueue(led.drop("__now"), src, F.lit(None).cast("timestamp"))
    return out


@register("ledger_enqueue")
def q_ledger_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order customers enqueued as sources; known urls ignored."""
    return enqueued_ledger(spark, sf_dir).select("job_id", "url", "status", "priority", "is_primary", "retries")


@register("ledger_pending")
def q_ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retryable jobs in queue order."""
    return J.pending(enqueued_ledger(spark, sf_dir)).select(
        "job_id", "priority", "is_primary", "status", "retries")


@register("ledger_completed")
def q_ledger_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3."""
    return J.completed(event_ledger(spark, sf_dir)).select("job_id", "content_path")


@register("ledger_reset_stale")
def q_ledger_reset_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """in_progress jobs idle for 30+ minutes at the log's last event -> pending."""
    led = J.with_now(event_ledger(spark, sf_dir), _now(spark, sf_dir))
    out = J.reset_stale(led, F.col("__now"))
    return out.select("job_id", "status", _ts("updated_at"))


@register("parse_results")
def q_parse_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as parse results, counted per job; errors and every
    tenth event failed."""
    e = table(spark, sf_dir, "events")
    failed = (F.col("event_type") == "error") | (F.col("event_id") % 10 == 0)
    res = e.select(F.col("user_id").alias("job_id"),
                   F.round(F.col("value")).cast("long").alias("record_count"),
                   F.when(failed, "failed").otherwise("completed").alias("status"))
    return J.record_parse(res)


def event_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as checkpoint saves: the stage is the event type and the
    last digit of the user."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat_ws("-", "event_type", (F.col("user_id") % 10).cast("string")).alias("stage"),
                    F.concat(F.lit("ckpt/"), F.col("event_id").cast("string")).alias("data_path"),
                    F.col("user_id").alias("row_count"), F.col("ts").alias("created_at"),
                    F.col("event_id").alias("seq"))


@register("latest_checkpoint")
def q_latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last save per stage."""
    out = J.latest_checkpoint(event_saves(spark, sf_dir))
    return out.select("stage", "data_path", "row_count", _ts("created_at"))


@register("job_stats")
def q_job_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs per status."""
    return J.job_stats(event_ledger(spark, sf_dir))


@register("cache_key")
def q_cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page cache names from page urls."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", cache_key("url").alias("cache_key"))


# ----------------------------------------------------------- extraction


PAGE_ROWS = 40


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML pages built from part, PAGE_ROWS parts per page (bounded groups):
    a one-row decoy table, then the rate table with <thead>/<tbody>. Every
    7th-ish row has an extra cell (cut), every 11th-ish misses its last cell
    (padded), every 13th description carries an '&amp;' entity."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cg = ((F.col("p_size") % 4) * 3).cast("string")
    desc = F.concat(F.col("p_name"), F.when(k % 13 == 0, F.lit(" &amp; co")).otherwise(F.lit("")))
    td = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), td(((k % PAGE_ROWS) + 1).cast("string")), td(k.cast("string")), td(desc),
                   td(F.concat(cg, F.lit("%"))),
                   F.when(k % 11 == 5, F.lit("")).otherwise(td(F.concat(cg, F.lit(" %")))),
                   F.when(k % 7 == 3, td(F.lit("x"))).otherwise(F.lit("")), F.lit("</tr>"))
    pages = (p.select(F.floor(k / PAGE_ROWS).cast("long").alias("page_id"), k.alias("__k"), row.alias("__row"))
              .groupBy("page_id")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__k", "__row"))),
                                            lambda s: s["__row"]), "").alias("__rows")))
    head = ("<html><head><title>Rates</title><script>var t='<table>';</script></head><body>"
            "<table class='nav'><tr><td>Home</td><td>About</td></tr></table>"
            "<table class='rates'><thead><tr><th>S. No.</th><th>HSN Code</th><th>Description</th>"
            "<th>CGST Rate</th><th>SGST Rate</th></tr></thead><tbody>")
    return pages.select("page_id", F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("source"),
                        F.concat(F.lit(head), F.col("__rows"), F.lit("</tbody></table></body></html>")).alias("html"))


def _extracted_records(raw: DataFrame) -> DataFrame:
    rec = N.normalize(raw.withColumnRenamed("source_name", "source_name"), source_name="html")
    good, _ = N.split_errors(rec)
    return good.select("ord.page_id", "ord.row_idx", "hsn_code", "gst_description", "serial_no",
                       *[F.col(r).cast("double").alias(r) for r in N.RATES], "source_name",
                       "confidence_flag", "product_id")


@register("extract_tables")
def q_extract_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E8, E10 (first strategy: table scoring, thead header) then N15."""
    raw = E.extract(part_pages(spark, sf_dir), has_selector=False, source_col="source")
    return _extracted_records(raw)


@register("extract_fallback")
def q_extract_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9, E10 (fallback strategy, the configured behaviour) then N15."""
    raw = E.extract(part_pages(spark, sf_dir), has_selector=True, source_col="source")
    return _extracted_records(raw)


@register("extract_pages")
def q_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E10 over the raw web pages, which hold no table: every page is
    parsed without an error and yields no row."""
    pages = table(spark, sf_dir, "pages")
    parsed = E.parse_pages(pages, has_selector=False)
    n = E.raw_rows(parsed).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return parsed.select("page_id", "error").join(n, "page_id", "left").select(
        "page_id", "error", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@register("extract_layouts")
def q_extract_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E9 on part-derived pages with unclosed paragraphs, a menu table
    before the rates, a leading <th> row with a repeated header, and spans."""
    p = spread_table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    html = F.format_string(
        "<p><p><div><table><tr><td>menu</td></tr></table><table><tr><th>HSN</th><th>Rate</th><th>Rate</th></tr>"
        "<tr><td rowspan=2>%s</td><td>%s</td><td>9</td></tr><tr><td>%s</td><td>8</td></tr>"
        "<tr><td colspan=2>%s</td><td></td></tr></table>",
        *[F.col(c).cast("string") for c in ("p_partkey", "p_size", "p_retailprice", "p_partkey")])
    raw = E.extract(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")), has_selector=False)
    return raw.select("page_id", "table_idx", "row_idx", "strategy", "raw_text",
                      *[F.col("cells").getItem(h).alias(h) for h in ("hsn", "rate", "rate_1")])


# ------------------------------------------------------------ pipelines



def default_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One default template from the data: brands = part brands, names =
    part types, variants = nation names (every category falls back to it)."""
    p = table(spark, sf_dir, "part")
    n = table(spark, sf_dir, "nation")
    from ratebook.operators.joins import one_row_join
    t = p.agg(F.array_sort(F.collect_set("p_brand")).alias("brands"),
              F.array_sort(F.collect_set("p_type")).alias("names"))
    v = n.agg(F.array_sort(F.collect_set("n_name")).alias("variants"))
    return one_row_join(t, v).select(F.lit("furniture_misc").alias("sub_category"), "brands", "names", "variants")


@register("full_run_report")
def q_full_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full run on lineitem raw rows: normalise, resolve (primary = supplier
    7's feed), classify, expand to |orders| rows, override, report."""
    raw = raw_lineitem_rows(spark, sf_dir)
    target = table(spark, sf_dir, "orders").count()
    good_schema = N.split_errors(N.normalize(raw))[0].schema
    seed = spark.createDataFrame([], good_schema)  # no seed needed: the raw rows are not empty
    res = P.full_run(spark, raw, seed, default_templates(spark, sf_dir), target,
                     primary="supplier 7", source_name="lineitem-feed")
    return res.report


@register("export_view")
def q_export_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: canonical 17-column view of the customer records."""
    return S.export_view(customer_records(spark, sf_dir))


@register("load_stats")
def q_load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, rows that fail conversion, rows loaded, over order-derived
    source rows with text rates (some blank, some not numbers, some ids empty)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = o.select(F.when(k % 17 == 0, F.lit("")).otherwise(k.cast("string")).alias("product_id"),
                    F.when(k % 13 == 0, F.lit("n/a")).when(k % 7 == 0, F.lit(" "))
                    .otherwise((k % 28).cast("string")).alias("igst_rate"))
    return S.load_stats(rows)


# ---------------------------------------------------------------- sinks

from ratebook.session import stage_path  # noqa: E402
from ratebook.sources import sinks as K  # noqa: E402
from ratebook.sources.readers import read_products  # noqa: E402


@register("stored_lookup")
def q_stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + S8 + Q3: the product table written clustered by code to the
    shared checkpoint folder, read back, and queried by code prefix (the
    prefix filter is pushed into the Parquet scan)."""
    import uuid
    path = stage_path(spark, "ratebook-products", uuid.uuid4().hex)
    K.load_products(part_products(spark, sf_dir), path, mode="overwrite")
    return L.rate_by_code(read_products(spark, path), "1")


@register("export_chunks")
def q_export_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: exact chunk numbers in record order (10,000 rows per chunk) over
    the lineitem records: rows and first record id per chunk."""
    ch = K.with_chunk_ids(lineitem_records(spark, sf_dir), "ord", 10_000)
    return ch.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"),
                                   F.min_by("product_id", "ord").alias("first_id"))


@register("normalize_quarantine")
def q_normalize_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part-derived raw rows whose rate text holds a code number behind a
    cut, a large rate, a number no rate can hold, or a plain rate: the rows
    kept and the rows quarantined with the reason."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    rate = (F.when(k == 0, "tobacco 24029900").when(k == 1, "1500000")
            .when(k == 2, F.repeat(F.lit("9"), 30)).otherwise("5%"))
    raw = p.select(F.col("p_partkey").alias("ord"), F.create_map(
        F.lit("hsn"), F.col("p_partkey").cast("string"), F.lit("description"), F.col("p_name"),
        F.lit("rate"), rate).alias("cells"))
    good, bad = N.split_errors(N.normalize(raw))
    cols = ["hsn_code", F.col("igst_rate").cast("double").alias("igst_rate")]
    return good.select(*cols, F.lit(None).cast("string").alias("error")).unionByName(
        bad.select(*cols, F.col("_error").alias("error")))
