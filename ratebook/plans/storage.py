"""Sources, sinks, stages and run summaries as queries: what is written to the
shared checkpoint folder is read back, and each query has its SQL twin beside
it, over the same tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.operators import classify as C
from ratebook.operators import normalize as N
from ratebook.operators import quality as V
from ratebook.operators import summary as S
from ratebook.plans import bindings as B
from ratebook.plans import oracles as O
from ratebook.plans import runs as P
from ratebook.plans.bindings import register, table
from ratebook.plans.metrics import flat_summary
from ratebook.plans.oracles import ORACLES
from ratebook.plans.sqlgen import classify_sql, range_case
from ratebook.session import stage_path
from ratebook.sources import readers as R
from ratebook.sources import sinks as K
from ratebook.sources import stages as ST


def folder(spark: SparkSession, name: str) -> str:
    return stage_path(spark, f"ratebook-{name}", uuid.uuid4().hex)


# ------------------------------------------------------------ raw rows

def part_cells() -> Column:
    """Cells of a raw row from ``part``, with the characters that JSON escapes
    and the brackets that a split has to tell from text."""
    k = F.col("p_partkey")
    text = F.concat(F.col("p_name"), F.when(k % 3 == 0, ' {"x": [').when(k % 3 == 1, "]} \\").otherwise("\n\té"), F.col("p_brand"))
    return F.create_map(F.lit("hsn"), k.cast("string"), F.lit("description"), text, F.lit("rate"),
                        F.concat((F.col("p_size") % 28).cast("string"), F.lit("%")))


PARTS_PER_ARRAY = 5_000


@register("read_raw_rows")
def q_read_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows written as JSON lines (odd keys) and as indented JSON
    arrays of up to 5,000 keys a file (even keys), read back from both."""
    p = table(spark, sf_dir, "part")
    rows = p.select("p_partkey", part_cells().alias("cells"))
    lines, arrays = folder(spark, "raw-lines"), folder(spark, "raw-arrays")
    K.write_raw(rows.where("p_partkey % 2 = 1").withColumn("source_name", F.lit("odd parts")), lines)
    item = F.concat(F.lit("  {\n    "), F.regexp_replace(F.to_json("cells"), r"^\{|\}$", ""), F.lit("\n  }"))
    # One row per file: bounded groups of keys, and a text file for each.
    (rows.where("p_partkey % 2 = 0")
         .groupBy((F.col("p_partkey") / PARTS_PER_ARRAY).cast("long").alias("file"))
         .agg(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("t")))).alias("t"))
         .select("file", F.concat(F.lit("[\n"), F.array_join(F.transform("t", lambda x: x["t"]), ",\n"), F.lit("\n]")).alias("value"))
         .write.partitionBy("file").text(arrays))
    read = R.read_raw(spark, lines).unionByName(R.read_raw(spark, arrays))
    good, bad = R.split_corrupt(read)
    cells = good.select(*[F.col("cells")[c].alias(c) for c in ("hsn", "description", "rate")],
                        F.lit(None).cast("string").alias("corrupt"))
    return cells.unionByName(bad.select(*[F.lit(None).cast("string").alias(c) for c in ("hsn", "description", "rate")],
                                        F.col("_corrupt").alias("corrupt")))


_PART_TEXT = """p_name || CASE p_partkey % 3 WHEN 0 THEN ' {"x": [' WHEN 1 THEN ']} \\' ELSE chr(10) || chr(9) || 'é' END || p_brand"""
ORACLES["read_raw_rows"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS hsn, {_PART_TEXT} AS description, CAST(p_size % 28 AS VARCHAR) || '%' AS rate,
       CAST(NULL AS VARCHAR) AS corrupt FROM part
"""


@register("rewrite_raw_source")
def q_rewrite_raw_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows written per brand, one brand written again with new
    rates: the other brands' folders keep their rows."""
    p = table(spark, sf_dir, "part")
    path = folder(spark, "raw-sources")
    rows = p.select(F.col("p_brand").alias("source_name"), part_cells().alias("cells"))
    K.write_raw(rows, path)
    again = p.where("p_brand = 'Brand#11' and p_partkey % 2 = 0").select(
        F.col("p_brand").alias("source_name"), F.create_map(F.lit("hsn"), F.col("p_partkey").cast("string"),
                                                            F.lit("rate"), F.lit("new")).alias("cells"))
    K.write_raw(again, path)
    back = R.read_raw(spark, path, form="lines")
    slug = F.regexp_extract("ord.f", "source_slug=([^/]*)", 1)
    return back.select(slug.alias("source_slug"), F.col("cells")["hsn"].alias("hsn"), F.col("cells")["rate"].alias("rate"))


ORACLES["rewrite_raw_source"] = """
SELECT regexp_replace(lower(p_brand), '[^a-z0-9]', '_', 'g') AS source_slug, CAST(p_partkey AS VARCHAR) AS hsn,
       CASE WHEN p_brand = 'Brand#11' THEN 'new' ELSE CAST(p_size % 28 AS VARCHAR) || '%' END AS rate
FROM part WHERE p_brand <> 'Brand#11' OR p_partkey % 2 = 0
"""


# ------------------------------------------------------- other readers

@register("read_seed_table")
def q_read_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part-derived seed rows written as CSV and read as seed records."""
    p = table(spark, sf_dir, "part")
    path = folder(spark, "seed")
    p.select(F.lpad((F.col("p_partkey") % 9000).cast("string"), 4, "0").alias("hsn_code"),
             F.concat(F.col("p_name"), F.lit(', "'), F.col("p_type"), F.lit('"')).alias("gst_description"),
             (F.col("p_size") % 4 * 6).alias("igst_rate"), (F.col("p_size") % 3).alias("cess_rate"),
             F.lit("IV").alias("schedule")).write.option("header", True).option("escape", '"').csv(path)
    seed = R.read_seed(spark, path)
    return seed.select("product_id", "hsn_code", "gst_description", "schedule", "source_name", "confidence_flag",
                       *[F.col(c).cast("double").alias(c) for c in N.RATES])


ORACLES["read_seed_table"] = f"""
WITH s AS (SELECT lpad(CAST(p_partkey % 9000 AS VARCHAR), 4, '0') AS hsn_code, p_name || ', "' || p_type || '"' AS gst_description,
                  p_size % 4 * 6 AS igst, CAST(p_size % 3 AS DOUBLE) AS cess_rate FROM part)
SELECT substr(sha256(hsn_code || '|' || gst_description || '|' || CAST(igst AS VARCHAR)), 1, 16) AS product_id,
       hsn_code, gst_description, 'IV' AS schedule, '{R.SEED_SOURCE_NAME}' AS source_name, 'high' AS confidence_flag,
       CAST(igst AS DOUBLE) / 2 AS cgst_rate, CAST(igst AS DOUBLE) / 2 AS sgst_rate, CAST(igst AS DOUBLE) AS igst_rate, cess_rate
FROM s
"""


@register("seed_fallback")
def q_seed_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed without a usable row is replaced by the seed table, a feed
    with rows is not."""
    p = table(spark, sf_dir, "part")
    seed = R.seed_records(p.select(F.col("p_partkey").cast("string").alias("hsn_code"), F.col("p_name").alias("gst_description"),
                                   (F.col("p_size") % 4 * 6).alias("igst_rate"), F.lit(0).alias("cess_rate"),
                                   F.lit("I").alias("schedule"), F.col("p_partkey").alias("ord")))
    blank = p.select(F.col("p_partkey").alias("ord"), F.create_map(F.lit("hsn"), F.lit(""), F.lit("description"), F.lit(" ")).alias("cells"))
    full = p.select(F.col("p_partkey").alias("ord"), part_cells().alias("cells"))
    def rows(feed: DataFrame, name: str) -> DataFrame:
        good, _ = N.split_errors(N.normalize(feed, source_name=name))
        return R.with_seed_fallback(good, seed).select(F.lit(name).alias("feed"), "hsn_code", "source_name")
    return rows(blank, "blank").unionByName(rows(full, "full"))


ORACLES["seed_fallback"] = f"""
SELECT 'blank' AS feed, CAST(p_partkey AS VARCHAR) AS hsn_code, '{R.SEED_SOURCE_NAME}' AS source_name FROM part
UNION ALL SELECT 'full', CAST(p_partkey AS VARCHAR), 'full' FROM part
"""


@register("read_page_content")
def q_read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: page content by url."""
    return R.read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("long").alias("n_chars"))


ORACLES["read_page_content"] = "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages"


@register("read_sku_catalog")
def q_read_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer-derived catalog CSV without a name column; codes keep
    their zeros, the missing column reads as ''."""
    c = table(spark, sf_dir, "customer")
    path = folder(spark, "catalog")
    c.select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("hsn_code"),
             F.round("c_acctbal", 2).alias("price")).write.option("header", True).csv(path)
    return R.read_catalog(spark, path).select("hsn_code", "product_name", F.col("price").cast("double").alias("price"))


ORACLES["read_sku_catalog"] = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS hsn_code, '' AS product_name, round(c_acctbal, 2) AS price FROM customer
"""

RULES_CONFIG = {"classification": {
    "hsn_rules": [{"hsn_prefix_start": 10, "hsn_prefix_end": 49, "top_category": "industrial", "sub_category": "metals"},
                  {"hsn_prefix_start": 30, "hsn_prefix_end": 60, "top_category": "electronics", "sub_category": "instruments"}],
    "keyword_overrides": {"rod": "automotive", "hot": "consumer_goods"}}}


@register("classify_by_config")
def q_classify_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from a parsed configuration applied to the part products."""
    kw, ranges = C.rules_from_config(RULES_CONFIG)
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("gst_description"),
                                            F.col("p_partkey").cast("string").alias("hsn_code"))
    return C.classify(p, keyword_rules=kw, range_rules=ranges).select("p_partkey", "top_category", "sub_category")


_KW, _RANGES = C.rules_from_config(RULES_CONFIG)
ORACLES["classify_by_config"] = "SELECT p_partkey, " + ", ".join(
    f"{classify_sql('p_name', 'CAST(p_partkey AS VARCHAR)', part, _KW, range_rules=_RANGES)} AS {part}_category"
    for part in ("top", "sub")) + " FROM part"


@register("category_for_code")
def q_category_for_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category from the code alone, over part keys, order keys and blanks."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    code = F.when(k % 10 == 0, "").when(k % 10 == 1, (k % 10).cast("string")).when(k % 10 == 2, F.concat(F.lit("x"), k.cast("string"))
                                                                               ).otherwise(k.cast("string"))
    return C.category_for_code(p.select("p_partkey", code.alias("hsn_code"))).select(
        "p_partkey", "hsn_code", "top_category", "sub_category")


ORACLES["category_for_code"] = f"""
WITH c AS (SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN CAST(p_partkey % 10 AS VARCHAR)
                  WHEN 2 THEN 'x' || CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END AS hsn_code FROM part)
SELECT p_partkey, hsn_code, coalesce({range_case('hsn_code', 'top')}, 'other') AS top_category,
       coalesce({range_case('hsn_code', 'sub')}, 'uncategorized') AS sub_category FROM c
"""


# --------------------------------------------------------- large rules

RULES = 1_000


def word_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword rules from the data: the first 1,000 distinct words of five or
    more letters of ``benchmark`` by md5, every second joined to another."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0)))
    words = table(spark, sf_dir, "benchmark").select(word.alias("w")).distinct().orderBy(F.md5("w")).limit(RULES)
    # A bounded number of rows, so one window task numbers them.
    from pyspark.sql import Window
    n = words.withColumn("rule_ord", F.row_number().over(Window.orderBy(F.md5("w"))).cast("int") - 1)
    k = F.col("rule_ord")
    tops = F.array(*[F.lit(t) for t in ("consumer_goods", "electronics", "industrial", "automotive", "other")])
    return n.select("rule_ord", F.when(k % 2 == 0, F.col("w")).otherwise(F.concat(F.col("w"), F.lit(" "))).alias("keyword"),
                    F.get(tops, k % 5).alias("top_category"), F.when(k % 3 != 0, F.concat(F.lit("s"), k.cast("string"))).alias("sub_category"))


@register("classify_rule_table")
def q_classify_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 with a rule table: 1,000 keywords from the benchmark over all texts."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.classify_rule_table(d, word_rules(spark, sf_dir), "text").select("doc_id", "top_category", "sub_category")


ORACLES["classify_rule_table"] = f"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{5,}}')) AS w FROM benchmark),
r AS (SELECT w, row_number() OVER (ORDER BY md5(w)) - 1 AS o FROM w ORDER BY md5(w) LIMIT {RULES}),
rule AS (SELECT o, CASE WHEN o % 2 = 0 THEN w ELSE w || ' ' END AS kw FROM r),
hit AS (SELECT doc_id, min(o) AS o FROM documents JOIN rule ON contains(lower(text), kw) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN o IS NULL THEN 'other'
         ELSE ['consumer_goods', 'electronics', 'industrial', 'automotive', 'other'][o % 5 + 1] END AS top_category,
       CASE WHEN o IS NULL OR o % 3 = 0 THEN 'uncategorized' ELSE 's' || CAST(o AS VARCHAR) END AS sub_category
FROM documents d LEFT JOIN hit ON hit.doc_id = d.doc_id
"""


@register("classify_builtin_rule_table")
def q_classify_builtin_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 + C4 with the built-in rules held as a table; must equal the
    result of the built-in rules."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.classify_rule_table(d, C.keyword_rules_frame(spark), "text").select("doc_id", "top_category", "sub_category")


ORACLES["classify_builtin_rule_table"] = ORACLES["classify_documents"]


# ---------------------------------------------------------- sinks back

@register("csv_export")
def q_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the customer records written as CSV and read back as text; nulls
    are empty fields, which read as null."""
    path = folder(spark, "csv")
    K.write_csv(B.customer_records(spark, sf_dir), path)
    back = spark.read.option("header", True).option("escape", '"').option("inferSchema", False).csv(path)
    return back.select(*[F.col(c).cast("double").alias(c) if c in N.RATES else c for c in S.EXPORT_COLS])


ORACLES["csv_export"] = "SELECT * REPLACE (nullif(hsn_code, '') AS hsn_code) FROM (" + ORACLES["export_view"] + ")"


@register("issues_export")
def q_issues_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issue table of the customer records written as CSV and read
    back; what was null reads as ''."""
    path = folder(spark, "issues")
    K.write_issues(V.validate_issues(B.customer_records(spark, sf_dir), B.CUST_PRIMARY), path)
    return spark.read.option("header", True).option("escape", '"').option("emptyValue", "").csv(path).na.fill("")


ORACLES["issues_export"] = O.CUST_ISSUES + """
SELECT issue_type, severity, record_id, coalesce(hsn_code, '') AS hsn_code, description, coalesce(source_name, '') AS source_name
FROM issues
"""


# ---------------------------------------------------------------- runs

FEEDS = [{"name": "lineitem-feed", "url": "https://feed.example/li", "status": "completed", "error": ""},
         *[{"name": f"supplier {n}", "url": f"https://feed.example/s{n}", "status": "completed", "error": ""} for n in (1, 2, 7)],
         {"name": "archive", "url": "https://feed.example/old", "status": "failed", "error": "HTTP 503"}]


@register("run_summary")
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O11 + N14: the summary of a full run on the lineitem feed, counted by
    the writes of its stages, as (section, name, value) rows."""
    raw = B.raw_lineitem_rows(spark, sf_dir)
    seed = spark.createDataFrame([], N.split_errors(N.normalize(raw))[0].schema)
    target = table(spark, sf_dir, "supplier").count()
    res = P.full_run(spark, raw, seed, B.default_templates(spark, sf_dir), target, primary="supplier 7",
                     source_name="lineitem-feed", sources=FEEDS)
    return flat_summary(res.run)


# Resolved and classified base of the lineitem feed (twin of V8 and C5).
_RESOLVED = f"""
n AS ({ORACLES["normalize"]}),
o AS (SELECT *, {{'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_suppkey}} AS ord FROM n),
res AS (SELECT arg_min(hsn_code, rk) AS hsn_code, arg_min(gst_description, rk) AS gst_description,
               arg_min(igst_rate, rk) AS igst_rate, arg_min(source_name, rk) AS source_name, min(ord) AS ord
        FROM (SELECT *, {{'np': CASE WHEN source_name = 'supplier 7' THEN 0 ELSE 1 END, 'o': ord}} AS rk FROM o)
        GROUP BY hsn_code, lower(trim(gst_description))),
cls AS (SELECT *, {classify_sql('gst_description', 'hsn_code', 'top')} AS top_category,
               {classify_sql('gst_description', 'hsn_code', 'sub')} AS sub_category FROM res)
"""
_SOURCES = " UNION ALL ".join(
    f"SELECT 'source_{f}', '{s['name']}', '{s[f]}'" for s in FEEDS for f in ("url", "status", "error"))
ORACLES["run_summary"] = f"""
WITH {_RESOLVED},
total AS (SELECT greatest((SELECT count(*) FROM supplier), 0) AS n),
names AS (SELECT unnest([{', '.join(repr(s['name']) for s in FEEDS)}]) AS name),
raw AS (SELECT CASE WHEN l_linenumber % 4 = 0 THEN 'supplier ' || CAST(l_suppkey AS VARCHAR) ELSE 'lineitem-feed' END AS name FROM lineitem),
parsed AS (SELECT names.name, count(raw.name) AS n FROM names LEFT JOIN raw ON raw.name = names.name GROUP BY names.name)
SELECT 'run' AS section, 'sources_attempted' AS name, '{len(FEEDS)}' AS value
UNION ALL SELECT 'run', 'sources_succeeded', '{len(FEEDS) - 1}' UNION ALL SELECT 'run', 'sources_failed', '1'
UNION ALL SELECT 'run', 'normalization_count', CAST((SELECT count(*) FROM n) AS VARCHAR)
UNION ALL SELECT 'run', 'skipped_count', CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM n) AS VARCHAR)
UNION ALL SELECT 'run', 'quarantined_count', '0'
UNION ALL SELECT 'run', 'expansion_count', CAST(n AS VARCHAR) FROM total
UNION ALL SELECT 'run', 'final_row_count', CAST(n AS VARCHAR) FROM total
UNION ALL SELECT 'run', 'validation_passed', 'true'
UNION ALL {_SOURCES}
UNION ALL SELECT 'source_rows_extracted', name, CAST(n AS VARCHAR) FROM parsed
UNION ALL SELECT 'parse_count', name, CAST(n AS VARCHAR) FROM parsed WHERE n > 0
UNION ALL SELECT 'category', top_category, CAST(count(*) AS VARCHAR) FROM cls GROUP BY top_category
"""

# Twin of the full run's report: X1-X9 on the resolved base, checks on the
# rates as expanded. The record id plays no part in the counts.
_T = "(SELECT count(*) FROM orders)"
ORACLES["full_run_report"] = f"""
WITH {_RESOLVED},
alloc AS (SELECT sub_category, count(*) AS n, min(ord) AS fp FROM cls GROUP BY 1),
al AS (SELECT *, greatest(CAST(floor(CAST({_T} AS DOUBLE) * (CAST(n AS DOUBLE) / CAST((SELECT count(*) FROM cls) AS DOUBLE))) AS BIGINT), n) AS tc FROM alloc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sub_category ORDER BY ord) - 1 AS r FROM cls),
main AS (SELECT ranked.*, unnest(range(r, tc, n)) AS i, -1 AS chunk FROM ranked JOIN al USING (sub_category)),
kept AS (SELECT * FROM main ORDER BY md5('42|' || sub_category || '|' || CAST(i AS VARCHAR)), sub_category, i LIMIT {_T}),
cats AS (SELECT sub_category, n, row_number() OVER (ORDER BY n DESC, fp) - 1 AS ci, count(*) OVER () AS k FROM al),
padidx AS (SELECT g.range AS rr FROM range(CAST(greatest({_T} - (SELECT sum(tc) FROM al), 0) AS BIGINT)) g),
pad AS (SELECT ranked.*, p.rr % 1000 AS i, CAST(p.rr // 1000 AS INTEGER) AS chunk
        FROM padidx p JOIN cats c ON (p.rr // 1000) % c.k = c.ci
        JOIN ranked ON ranked.sub_category = c.sub_category AND ranked.r = (p.rr % 1000) % c.n),
rows AS (SELECT *, {{'s': sub_category, 'c': chunk, 'i': i}} AS pos FROM (SELECT * FROM kept UNION ALL SELECT * FROM pad)),
first AS (SELECT hsn_code, source_name, arg_min(igst_rate, pos) AS rate FROM rows WHERE hsn_code <> '' GROUP BY 1, 2),
clash AS (SELECT hsn_code, max(CASE WHEN source_name = 'supplier 7' THEN rate END) AS pr FROM first
          GROUP BY 1 HAVING count(DISTINCT rate) > 1 AND max(CASE WHEN source_name = 'supplier 7' THEN rate END) IS NOT NULL)
SELECT count(*) AS total_records, count(*) - count(*) FILTER (igst_rate < 0) AS valid_records,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT hsn_code, lower(trim(gst_description)), igst_rate FROM rows)) AS duplicates_found,
       count(*) FILTER (source_name <> 'supplier 7' AND igst_rate <> pr) AS conflicts_found,
       count(*) FILTER (trim(rows.hsn_code) = '') AS missing_hsn_count,
       count(*) FILTER (igst_rate < 0) AS negative_rate_count, count(*) FILTER (igst_rate < 0) = 0 AS passed
FROM rows LEFT JOIN clash ON clash.hsn_code = rows.hsn_code
"""


@register("resumed_stage")
def q_resumed_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O10 + S7: a normalised stage made from the part feed, asked for again
    with the same rows in another order, with one row changed, and with
    another source name; whether it was found, and its rows."""
    p = B.spread_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    root = folder(spark, "stages")
    feed = p.select(F.col("p_partkey").alias("ord"), part_cells().alias("cells"))
    first = p.agg(F.min("p_partkey")).first()[0]
    changed = feed.withColumn("cells", F.when(F.col("ord") == first, F.create_map(F.lit("hsn"), F.lit("0")))
                              .otherwise(F.col("cells")))
    out = []
    for n, (rows, name) in enumerate([(feed, "a"), (feed.repartition(F.xxhash64("ord")), "a"), (changed, "a"), (changed, "b"), (feed, "a")]):
        def make(path: str, rows=rows, name=name) -> dict:
            N.normalize(rows, source_name=name).write.parquet(path)
            return {"rows": spark.read.parquet(path).count()}
        stage, counts, found = ST.stage_for(spark, root, "normalized", ST.fingerprint(rows, name), make)
        out.append(stage.agg(F.lit(n).alias("asked"), F.lit(found).alias("found"), F.count(F.lit(1)).alias("n_rows"),
                             F.min(F.col("hsn_code").cast("long")).alias("least_code"), F.max("source_name").alias("source_name")))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


ORACLES["resumed_stage"] = """
WITH t AS (SELECT count(*) AS n, min(p_partkey) AS k FROM part)
SELECT asked, found, n AS n_rows, CASE WHEN changed THEN 0 ELSE k END AS least_code, source_name
FROM t, (VALUES (0, false, false, 'a'), (1, true, false, 'a'), (2, false, true, 'a'), (3, false, true, 'b'),
                (4, true, false, 'a')) v(asked, found, changed, source_name)
"""
