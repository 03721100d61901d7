"""DuckDB-runnable SQL twins of the registered queries (same column names)."""

from __future__ import annotations

from ratebook.plans.sqlgen import classify_sql

ORACLES: dict[str, str] = {}

# The part-derived product table (twin of bindings.part_products).
PART_PRODUCTS = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
       CAST(p_partkey AS VARCHAR) AS hsn_code, concat_ws(' ', p_type, p_brand) AS gst_description,
       'S' || CAST(p_size % 6 AS VARCHAR) AS schedule,
       CAST((p_size % 4) * 6 AS DOUBLE) / 2 AS cgst_rate,
       CAST((p_size % 4) * 6 AS DOUBLE) / 2 AS sgst_rate,
       CAST((p_size % 4) * 6 AS DOUBLE) AS igst_rate, 0.0::DOUBLE AS cess_rate,
       'high' AS confidence_flag, p_partkey AS ord,
       {classify_sql("concat_ws(' ', p_type, p_brand)", "CAST(p_partkey AS VARCHAR)", "top")} AS top_category,
       {classify_sql("concat_ws(' ', p_type, p_brand)", "CAST(p_partkey AS VARCHAR)", "sub")} AS sub_category
FROM part
"""

ORACLES["categories"] = f"""
WITH p AS ({PART_PRODUCTS}),
subs AS (
  SELECT top_category, sub_category, count(*) AS product_count,
         arg_min(hsn_code, ord) AS sample_hsn
  FROM p GROUP BY top_category, sub_category
  ORDER BY top_category, product_count DESC, sub_category LIMIT 100)
SELECT 'sub' AS level, top_category, sub_category, product_count, sample_hsn FROM subs
UNION ALL
SELECT 'top', top_category, NULL, CAST(sum(product_count) AS BIGINT), NULL FROM subs GROUP BY top_category
UNION ALL
SELECT 'all', NULL, NULL, CAST(sum(product_count) AS BIGINT), NULL FROM subs
"""

# ------------------------------------------------------- normalisation

_T = "CAST(round(l_tax * 100) AS BIGINT)"
_D = "CAST(round(l_discount * 100) AS BIGINT)"
_U = "CAST(round((l_tax + l_discount) * 100) AS BIGINT)"
_K8 = "((l_orderkey + l_linenumber) % 8)"

ORACLES["parse_rate"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE {_K8}
    WHEN 0 THEN CAST({_T} AS VARCHAR) || '%'
    WHEN 1 THEN CASE WHEN l_tax = 0 THEN 'Nil' ELSE CAST({_T} AS VARCHAR) || ' %' END
    WHEN 2 THEN CAST({_T} AS VARCHAR) || '% to ' || CAST({_U} AS VARCHAR) || '%'
    WHEN 3 THEN CAST({_T} AS VARCHAR) || ' or ' || CAST({_U} AS VARCHAR)
    WHEN 4 THEN 'GST @ ' || CAST({_T} AS VARCHAR) || '.5%'
    WHEN 5 THEN CASE WHEN l_discount = 0 THEN 'Exempt' ELSE '-' || CAST({_T} AS VARCHAR) END
    WHEN 6 THEN CAST({_T} AS VARCHAR) || '.' || CAST({_D} AS VARCHAR) || '.1'
    ELSE 'Tobacco ' || CAST({_T} AS VARCHAR) END AS rate_text,
  CAST(CASE {_K8}
    WHEN 4 THEN {_T} + 0.5
    WHEN 5 THEN CASE WHEN l_discount = 0 THEN 0 ELSE {_T} END
    WHEN 6 THEN 0 WHEN 7 THEN 0
    ELSE {_T} END AS DOUBLE) AS rate,
  CAST(CASE {_K8}
    WHEN 0 THEN {_T}
    WHEN 1 THEN {_T}
    WHEN 5 THEN CASE WHEN l_discount = 0 THEN 0 ELSE -{_T} END
    ELSE 0 END AS DOUBLE) AS coerced
FROM lineitem
"""

_KS = "CAST(p_partkey AS VARCHAR)"
ORACLES["clean_hsn"] = f"""
SELECT p_partkey,
  CASE p_partkey % 6
    WHEN 0 THEN 'Chapter ' || {_KS}
    WHEN 1 THEN substr({_KS}, 1, 2) || '.' || substr({_KS}, 3, 100)
    WHEN 2 THEN substr({_KS}, 1, 2) || ' - ' || substr({_KS}, 3, 100)
    WHEN 3 THEN ' ' || {_KS} || ' ex'
    WHEN 4 THEN {_KS} || 'a' || {_KS}
    ELSE CASE WHEN p_partkey % 12 = 5 THEN NULL ELSE '' END END AS code_text,
  CASE p_partkey % 6 WHEN 4 THEN {_KS} || 'a' || {_KS} WHEN 5 THEN '' ELSE {_KS} END AS hsn_code,
  CASE p_partkey % 6
    WHEN 0 THEN 'Chapter' || {_KS}
    WHEN 2 THEN substr({_KS}, 1, 2) || '-' || substr({_KS}, 3, 100)
    WHEN 3 THEN {_KS} || 'ex'
    WHEN 4 THEN {_KS} || 'a' || {_KS}
    WHEN 5 THEN ''
    ELSE {_KS} END AS model_code
FROM part
"""

_OD = "CAST(o_orderdate AS DATE)"
ORACLES["parse_date"] = f"""
SELECT o_orderkey,
  CASE o_orderkey % 12
    WHEN 0 THEN strftime({_OD}, '%d-%m-%Y')
    WHEN 1 THEN strftime({_OD}, '%-d/%-m/%Y')
    WHEN 2 THEN strftime({_OD}, '%Y-%m-%d')
    WHEN 3 THEN strftime({_OD}, '%d.%m.%Y')
    WHEN 4 THEN strftime({_OD}, '%-d  %b %Y')
    WHEN 5 THEN strftime({_OD}, '%d %B %Y')
    WHEN 6 THEN strftime({_OD}, '%B %-d, %Y')
    WHEN 7 THEN upper(strftime({_OD}, '%b %d, %Y'))
    WHEN 8 THEN strftime({_OD}, '%-d-%b-%Y')
    WHEN 9 THEN lower(strftime({_OD}, '%d-%B-%Y'))
    WHEN 10 THEN 'n/a' ELSE 'soon' END AS date_text,
  CASE WHEN o_orderkey % 12 < 10 THEN strftime({_OD}, '%Y-%m-%d') END AS parsed
FROM orders
"""

_CODE = "CAST(l_partkey AS VARCHAR)"
_TD = "CAST(round((l_tax + l_discount) * 100) AS BIGINT)"
ORACLES["normalize"] = f"""
WITH b AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 4 AS k,
         {_T} AS t, {_D} AS d, {_TD} AS td, {_CODE} AS code, l_quantity, l_returnflag,
         l_linestatus, l_shipdate
  FROM lineitem),
r AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN k = 3 THEN '' ELSE code END AS hsn_code,
    CASE k WHEN 0 THEN 'part ' || code
           WHEN 1 THEN 'Item ' || l_returnflag || l_linestatus
           WHEN 2 THEN CASE WHEN l_returnflag = 'N' THEN '' ELSE 'goods ' || l_returnflag END
           ELSE 'Exempt - part ' || code END AS gst_description,
    CASE WHEN k IN (0, 1) THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS serial_no,
    CAST(CASE k WHEN 0 THEN t / 2 WHEN 1 THEN t WHEN 2 THEN td / 2 ELSE 0 END AS DOUBLE) AS cgst_rate,
    CAST(CASE k WHEN 0 THEN t / 2 WHEN 1 THEN t WHEN 2 THEN td / 2 ELSE 0 END AS DOUBLE) AS sgst_rate,
    CAST(CASE k WHEN 0 THEN t WHEN 1 THEN 2 * t WHEN 2 THEN td ELSE 0 END AS BIGINT) AS igst,
    CAST(CASE k WHEN 1 THEN d ELSE 0 END AS DOUBLE) AS cess_rate,
    CASE WHEN k = 2 THEN strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') END AS effective_from,
    CASE WHEN k = 0 THEN 'supplier ' || CAST(l_suppkey AS VARCHAR) ELSE 'lineitem-feed' END AS source_name
  FROM b WHERE NOT (k = 3 AND l_quantity > 25))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  substr(sha256(hsn_code || '|' || gst_description || '|' || CAST(igst AS VARCHAR)), 1, 16) AS product_id,
  hsn_code, gst_description, serial_no, cgst_rate, sgst_rate, CAST(igst AS DOUBLE) AS igst_rate,
  cess_rate, effective_from, source_name,
  CASE (CASE WHEN hsn_code = '' THEN 2 WHEN length(hsn_code) < 2 THEN 1 ELSE 0 END
        + CASE WHEN gst_description = '' THEN 1 ELSE 0 END
        + CASE WHEN igst = 0 THEN 1 ELSE 0 END)
    WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'review_required' END AS confidence_flag
FROM r
"""

# ------------------------------------------------------------- quality

from ratebook.plans.sqlgen import dec_text_sql as _dt  # noqa: E402

DOC_RECORDS = """
SELECT 'D' || CAST(doc_id AS VARCHAR) AS product_id, lang AS hsn_code, text AS gst_description,
       source AS source_name, CAST((doc_id % 2) * 5 AS DECIMAL(12,6)) AS igst, doc_id AS ord
FROM documents
"""

ORACLES["resolve_conflicts"] = f"""
WITH r AS ({DOC_RECORDS}),
k AS (
  SELECT *, row_number() OVER (PARTITION BY hsn_code, lower(trim(gst_description))
                               ORDER BY CASE WHEN source_name = 'src0' THEN 0 ELSE 1 END, ord) AS rn,
         min(ord) OVER (PARTITION BY hsn_code, lower(trim(gst_description))) AS first_ord
  FROM r)
SELECT product_id, hsn_code, source_name, CAST(igst AS DOUBLE) AS igst_rate, first_ord AS ord
FROM k WHERE rn = 1
"""

ORACLES["duplicates"] = f"""
WITH r AS ({DOC_RECORDS}),
k AS (
  SELECT *, row_number() OVER w AS rn, first_value(product_id) OVER w AS first_id
  FROM r WINDOW w AS (PARTITION BY hsn_code, lower(trim(gst_description)), igst ORDER BY ord
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT 5 AS check_ord, 'duplicate' AS issue_type, 'warning' AS severity, product_id AS record_id,
       hsn_code, 'Duplicate of record ' || first_id || '. HSN=' || hsn_code || ', Rate=' || {_dt('igst')} || '%'
         AS description, source_name
FROM k WHERE rn > 1
"""

LI_RECORDS = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS product_id,
       CAST(l_partkey AS VARCHAR) AS hsn_code, 'S' || CAST(l_suppkey AS VARCHAR) AS source_name,
       CAST(round(l_tax * 100) AS DECIMAL(12,6)) AS igst,
       {'a': l_orderkey, 'b': l_linenumber, 'c': l_suppkey, 'd': l_tax, 'e': l_quantity,
        'f': l_extendedprice} AS ord
FROM lineitem
"""

LI_CONFLICTS = f"""
ps AS (SELECT hsn_code, source_name, arg_min(igst, ord) AS rate, min(ord) AS pos
       FROM r WHERE hsn_code <> '' GROUP BY hsn_code, source_name),
pc AS (SELECT hsn_code, count(DISTINCT rate) AS n,
              max(CASE WHEN source_name = 'S7' THEN rate END) AS pr,
              string_agg(source_name || '=' || {_dt('rate')} || '%', ', ' ORDER BY pos) AS txt
       FROM ps GROUP BY hsn_code HAVING count(DISTINCT rate) > 1
          AND max(CASE WHEN source_name = 'S7' THEN rate END) IS NOT NULL)
"""

ORACLES["conflicts"] = f"""
WITH r AS ({LI_RECORDS}), {LI_CONFLICTS}
SELECT 6 AS check_ord, 'conflict' AS issue_type, 'warning' AS severity, r.product_id AS record_id,
       r.hsn_code, 'Rate conflict for HSN ' || r.hsn_code || ': ' || txt || '. Primary rate ('
         || {_dt('pr')} || '%) takes precedence.' AS description, r.source_name
FROM r JOIN pc ON r.hsn_code = pc.hsn_code
WHERE r.source_name <> 'S7' AND r.igst <> pc.pr
"""

ORACLES["apply_primary_rate"] = f"""
WITH r AS ({LI_RECORDS}), {LI_CONFLICTS},
j AS (SELECT r.*, pc.pr, (pc.pr IS NOT NULL AND r.source_name <> 'S7' AND r.igst <> pc.pr) AS hit
      FROM r LEFT JOIN pc ON r.hsn_code = pc.hsn_code)
SELECT product_id, hsn_code, source_name,
       CAST(CASE WHEN hit THEN pr / 2 ELSE igst / 2 END AS DOUBLE) AS cgst_rate,
       CAST(CASE WHEN hit THEN pr / 2 ELSE igst / 2 END AS DOUBLE) AS sgst_rate,
       CAST(CASE WHEN hit THEN pr ELSE igst END AS DOUBLE) AS igst_rate,
       CASE WHEN hit THEN 'review_required' ELSE 'high' END AS confidence_flag
FROM j
"""

CUST_RECORDS = """
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS product_id,
  CASE c_custkey % 9 WHEN 0 THEN '' WHEN 1 THEN ' ' ELSE CAST(c_custkey % 40 + 10 AS VARCHAR) END AS hsn_code,
  lower(c_mktsegment) || ' goods' AS gst_description,
  'N' || CAST(c_nationkey AS VARCHAR) AS source_name,
  CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(0 AS DECIMAL(12,6)) ELSE CAST(c_acctbal AS DECIMAL(12,6)) END AS cgst_rate,
  CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(0 AS DECIMAL(12,6)) ELSE CAST(c_acctbal AS DECIMAL(12,6)) END AS sgst_rate,
  CAST(2 * CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(0 AS DECIMAL(12,6)) ELSE CAST(c_acctbal AS DECIMAL(12,6)) END
       AS DECIMAL(12,6)) AS igst_rate,
  CASE WHEN c_custkey % 50 = 0 THEN CAST(-2.5 AS DECIMAL(12,6)) ELSE CAST(0 AS DECIMAL(12,6)) END AS cess_rate,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'automotive'
       WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'industrial'
       WHEN c_mktsegment = 'FURNITURE' THEN 'consumer_goods' ELSE 'household' END AS top_category,
  lower(c_mktsegment) AS sub_category, c_custkey AS ord
FROM customer
"""

_TOPS = "('consumer_goods', 'electronics', 'industrial', 'automotive', 'other')"
_SUBS = ("('animal_products', 'vegetable_products', 'food_beverages', 'minerals_fuels', "
         "'chemicals_pharma', 'plastics_rubber', 'leather_goods', 'wood_paper', 'textiles_apparel', "
         "'footwear_accessories', 'construction_materials', 'jewelry', 'metals', 'machinery', "
         "'computers_electronics', 'consumer_appliances', 'vehicles_transport', 'instruments', "
         "'arms_ammunition', 'furniture_misc', 'art_antiques', 'uncategorized')")

CUST_ISSUES = f"""
WITH r AS ({CUST_RECORDS}),
neg AS (
  SELECT product_id, hsn_code, source_name, ord, field, val, pos FROM r,
  (VALUES ('cgst_rate', 1), ('sgst_rate', 2), ('igst_rate', 3), ('cess_rate', 4)) f(field, pos),
  LATERAL (SELECT CASE field WHEN 'cgst_rate' THEN cgst_rate WHEN 'sgst_rate' THEN sgst_rate
                             WHEN 'igst_rate' THEN igst_rate ELSE cess_rate END AS val)),
dk AS (SELECT *, row_number() OVER w AS rn, first_value(product_id) OVER w AS first_id
       FROM r WINDOW w AS (PARTITION BY hsn_code, lower(trim(gst_description)), igst_rate ORDER BY ord
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ps AS (SELECT hsn_code, source_name, arg_min(igst_rate, ord) AS rate, min(ord) AS pos
       FROM r WHERE hsn_code <> '' GROUP BY hsn_code, source_name),
pc AS (SELECT hsn_code, max(CASE WHEN source_name = 'N3' THEN rate END) AS pr,
              string_agg(source_name || '=' || {_dt('rate')} || '%', ', ' ORDER BY pos) AS txt
       FROM ps GROUP BY hsn_code HAVING count(DISTINCT rate) > 1
          AND max(CASE WHEN source_name = 'N3' THEN rate END) IS NOT NULL),
issues AS (
  SELECT 1 AS check_ord, 'missing_hsn' AS issue_type, 'warning' AS severity, product_id AS record_id,
         CAST(NULL AS VARCHAR) AS hsn_code,
         'Missing HSN code. Description: ' || substr(gst_description, 1, 80) AS description,
         source_name, ord AS row_ord, 0 AS sub_ord
  FROM r WHERE trim(hsn_code) = ''
  UNION ALL
  SELECT 2, 'negative_rate', 'error', product_id, hsn_code,
         'Negative ' || field || ': ' || {_dt('val')}, source_name, ord, pos
  FROM neg WHERE val < 0
  UNION ALL
  SELECT 3, 'invalid_category', 'error', product_id, hsn_code, 'Invalid top_category: ' || top_category,
         NULL, ord, 0 FROM r WHERE top_category NOT IN {_TOPS}
  UNION ALL
  SELECT 3, 'invalid_category', 'error', product_id, hsn_code, 'Invalid sub_category: ' || sub_category,
         NULL, ord, 1 FROM r WHERE sub_category NOT IN {_SUBS}
  UNION ALL
  SELECT 4, 'zero_rates', 'warning', product_id, hsn_code,
         'All rates are zero. May be exempt. Desc: ' || substr(gst_description, 1, 60), source_name, ord, 0
  FROM r WHERE cgst_rate = 0 AND sgst_rate = 0 AND igst_rate = 0
  UNION ALL
  SELECT 5, 'duplicate', 'warning', product_id, hsn_code,
         'Duplicate of record ' || first_id || '. HSN=' || hsn_code || ', Rate=' || {_dt('igst_rate')} || '%',
         source_name, ord, 0 FROM dk WHERE rn > 1
  UNION ALL
  SELECT 6, 'conflict', 'warning', r.product_id, r.hsn_code,
         'Rate conflict for HSN ' || r.hsn_code || ': ' || txt || '. Primary rate (' || {_dt('pr')}
           || '%) takes precedence.', r.source_name, r.ord, 0
  FROM r JOIN pc ON r.hsn_code = pc.hsn_code
  WHERE r.source_name <> 'N3' AND r.igst_rate <> pc.pr)
"""

ORACLES["validate_issues"] = CUST_ISSUES + """
SELECT check_ord, issue_type, severity, record_id, hsn_code, description, source_name FROM issues
"""

ORACLES["issues_top"] = CUST_ISSUES + """
SELECT check_ord, issue_type, severity, record_id, hsn_code, description, source_name FROM issues
ORDER BY check_ord, row_ord, sub_ord, record_id LIMIT 10000
"""

ORACLES["validation_report"] = f"""
WITH r AS ({CUST_RECORDS}),
ps AS (SELECT hsn_code, source_name, arg_min(igst_rate, ord) AS rate
       FROM r WHERE hsn_code <> '' GROUP BY hsn_code, source_name),
pc AS (SELECT hsn_code, max(CASE WHEN source_name = 'N3' THEN rate END) AS pr
       FROM ps GROUP BY hsn_code HAVING count(DISTINCT rate) > 1
          AND max(CASE WHEN source_name = 'N3' THEN rate END) IS NOT NULL),
c AS (SELECT count(*) AS conflicts_found FROM r JOIN pc ON r.hsn_code = pc.hsn_code
      WHERE r.source_name <> 'N3' AND r.igst_rate <> pc.pr),
b AS (SELECT count(*) AS total_records,
             count(DISTINCT (hsn_code, lower(trim(gst_description)), igst_rate)) AS keys,
             count(*) FILTER (WHERE trim(hsn_code) = '') AS missing_hsn_count,
             sum((cgst_rate < 0)::INT + (sgst_rate < 0)::INT + (igst_rate < 0)::INT + (cess_rate < 0)::INT)
               AS negative_rate_count,
             count(*) FILTER (WHERE top_category NOT IN {_TOPS})
               + count(*) FILTER (WHERE sub_category NOT IN {_SUBS}) AS invalid
      FROM r)
SELECT CAST(total_records AS BIGINT) AS total_records,
       CAST(total_records - negative_rate_count - invalid AS BIGINT) AS valid_records,
       CAST(total_records - keys AS BIGINT) AS duplicates_found,
       CAST(conflicts_found AS BIGINT) AS conflicts_found,
       CAST(missing_hsn_count AS BIGINT) AS missing_hsn_count,
       CAST(negative_rate_count AS BIGINT) AS negative_rate_count,
       (negative_rate_count + invalid) = 0 AS passed
FROM b, c
"""

# ------------------------------------------------------- classification

from ratebook.plans.sqlgen import keyword_case, range_case, q as _q  # noqa: E402
from ratebook.plans.bindings import PART_KEYWORDS, PART_KEYWORD_SUB, SIZE_RULES  # noqa: E402

ORACLES["classify_documents"] = f"""
SELECT doc_id, coalesce({keyword_case('text', 'top')}, 'other') AS top_category,
       coalesce({keyword_case('text', 'sub')}, 'uncategorized') AS sub_category
FROM documents
"""

ORACLES["category_counts"] = f"""
SELECT coalesce({keyword_case('text', 'top')}, 'other') AS top_category, count(*) AS n
FROM documents GROUP BY 1
"""

ORACLES["classify_parts"] = f"""
SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS hsn_code,
  {classify_sql('p_name', 'CAST(p_partkey AS VARCHAR)', 'top', PART_KEYWORDS, PART_KEYWORD_SUB)} AS top_category,
  {classify_sql('p_name', 'CAST(p_partkey AS VARCHAR)', 'sub', PART_KEYWORDS, PART_KEYWORD_SUB)} AS sub_category
FROM part
"""

_SIZE_CODE = "(lpad(CAST(p_size AS VARCHAR), 2, '0') || CAST(p_partkey % 100 AS VARCHAR))"
ORACLES["classify_ranges_join"] = f"""
SELECT p_partkey, {_SIZE_CODE} AS hsn_code,
  coalesce({range_case(_SIZE_CODE, 'top', SIZE_RULES)}, 'other') AS top_category,
  coalesce({range_case(_SIZE_CODE, 'sub', SIZE_RULES)}, 'uncategorized') AS sub_category
FROM part
"""

# -------------------------------------------------------------- lookups

_PICK = """product_id, product_name, hsn_code, gst_description, cgst_rate, sgst_rate, igst_rate,
  cess_rate, top_category, sub_category, schedule, confidence_flag"""

ORACLES["rate_by_product"] = f"""
SELECT {_PICK} FROM ({PART_PRODUCTS}) p
WHERE regexp_matches(product_name, 'RING', 'i') ORDER BY ord LIMIT 5
"""

ORACLES["rate_by_product_clamped"] = f"""
SELECT {_PICK} FROM ({PART_PRODUCTS}) p
WHERE regexp_matches(product_name, 'h.t (rod|gear)', 'i') ORDER BY ord LIMIT 20
"""

ORACLES["search_description"] = f"""
SELECT gst_description, arg_min(hsn_code, ord) AS hsn_code, arg_min(igst_rate, ord) AS igst_rate,
  arg_min(cgst_rate, ord) AS cgst_rate, arg_min(sgst_rate, ord) AS sgst_rate,
  arg_min(cess_rate, ord) AS cess_rate, arg_min(top_category, ord) AS top_category,
  arg_min(sub_category, ord) AS sub_category, arg_min(schedule, ord) AS schedule,
  count(*) AS product_count
FROM ({PART_PRODUCTS}) p WHERE regexp_matches(gst_description, 'promo', 'i')
GROUP BY gst_description ORDER BY product_count DESC, gst_description LIMIT 10
"""

ORACLES["rate_by_code"] = f"""
WITH t AS (SELECT * FROM ({PART_PRODUCTS}) p WHERE starts_with(hsn_code, '1') ORDER BY ord LIMIT 10),
d AS (SELECT *, row_number() OVER (PARTITION BY gst_description ORDER BY ord) AS rn FROM t)
SELECT {_PICK} FROM d WHERE rn = 1
"""

ORACLES["collection_size"] = "SELECT count(*) AS total_products FROM part"

# ------------------------------------------------------------ summaries

ORACLES["summary"] = """
SELECT count(*) AS total_records, count(DISTINCT CAST(l_partkey AS VARCHAR)) AS unique_hsn_codes FROM lineitem
"""

ORACLES["value_counts"] = """
SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
UNION ALL
SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
UNION ALL
SELECT 'o_year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2
"""

_REPORT_COLS = ["total_records", "valid_records", "duplicates_found", "conflicts_found",
                "missing_hsn_count", "negative_rate_count", "passed"]
ORACLES["summary_kv"] = "WITH rep AS (" + ORACLES["validation_report"] + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS key, CAST({c} AS VARCHAR) AS value FROM rep" for c in _REPORT_COLS)

ORACLES["top_categories"] = f"""
SELECT sub_category AS value, count(*) AS n FROM ({PART_PRODUCTS}) p
GROUP BY sub_category ORDER BY n DESC, value LIMIT 10
"""

ORACLES["find_one"] = f"""
SELECT {_PICK} FROM ({PART_PRODUCTS}) p WHERE hsn_code = '1234' ORDER BY ord LIMIT 1
"""

ORACLES["to_product"] = """
SELECT CAST(c_custkey AS VARCHAR) AS product_id,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS product_name,
  CASE WHEN c_custkey % 5 = 0 THEN 'other' ELSE lower(c_mktsegment) END AS top_category,
  'uncategorized' AS sub_category,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS hsn_code,
  'goods' AS gst_description,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'I' END AS schedule,
  CAST(NULL AS VARCHAR) AS serial_no,
  CASE WHEN c_custkey % 6 = 0 THEN 0.0 ELSE c_acctbal / 2 END AS cgst_rate,
  0.0 AS sgst_rate,
  CASE WHEN c_custkey % 4 = 0 THEN 0.0 ELSE c_acctbal END AS igst_rate,
  0.0 AS cess_rate,
  CAST(NULL AS VARCHAR) AS effective_from, '' AS source_name, 'http://x' AS source_url,
  'medium' AS confidence_flag, '2024-01-01 00:00:00' AS migrated_at
FROM customer
"""

# ------------------------------------------------------------ expansion

from ratebook.operators.expand import CHUNK_STEP, CYCLE_STEP, MULTIPLIERS  # noqa: E402

_SEED = 42
_MUL_ORDER = [MULTIPLIERS[(_SEED + k) % len(MULTIPLIERS)] for k in range(len(MULTIPLIERS))]
_A = "(CASE " + " ".join(f"WHEN nn_ % {m} <> 0 THEN {m}" for m in _MUL_ORDER) + f" ELSE {_MUL_ORDER[-1]} END)"

_EXP_BASE = """
base AS (SELECT lower(p_type) AS sub_category, CAST(p_partkey AS VARCHAR) AS hsn_code,
                p_name AS gst_description, CAST((p_size % 4) * 6 AS DOUBLE) AS igst_rate,
                p_partkey AS ord FROM part),
alloc AS (SELECT sub_category, count(*) AS n, min(ord) AS fp FROM base GROUP BY 1),
al AS (SELECT a.*, greatest(CAST(floor(CAST(tot.t AS DOUBLE) * (CAST(a.n AS DOUBLE) / CAST(tot.nall AS DOUBLE)))
                            AS BIGINT), a.n) AS tc
       FROM alloc a, (SELECT {target} AS t, (SELECT count(*) FROM base) AS nall) tot),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY sub_category ORDER BY ord) - 1 AS r FROM base b),
tpl0 AS (SELECT lower(p_type) AS sub_category, list(DISTINCT p_brand ORDER BY p_brand) AS brands,
                list(DISTINCT p_name ORDER BY p_name) AS names
         FROM part WHERE lower(p_type) <> 'promo' GROUP BY 1),
tpl AS (SELECT tpl0.*, (SELECT list(DISTINCT n_name ORDER BY n_name) FROM nation) AS variants FROM tpl0),
main AS (SELECT ranked.*, unnest(range(ranked.r, al.tc, al.n)) AS gen_index, -1 AS gen_chunk, 0 AS cseed
         FROM ranked JOIN al USING (sub_category)),
"""

_EXP_EMIT = f"""
emit AS (
  SELECT rows.*, coalesce(t.brands, d.brands) AS brands, coalesce(t.names, d.names) AS names,
         coalesce(t.variants, d.variants) AS variants
  FROM rows LEFT JOIN tpl t ON rows.sub_category = t.sub_category
  LEFT JOIN (SELECT * FROM tpl WHERE sub_category = 'standard') d ON true),
sized AS (SELECT *, CAST(len(brands) * len(names) * len(variants) AS BIGINT) AS nn_,
                 len(names) AS n_names, len(variants) AS n_vars FROM emit),
perm AS (SELECT *, ((({_A} % nn_) * (gen_index % nn_))
                    + ((gen_index // nn_) * {CYCLE_STEP} + {_SEED} + cseed * {CHUNK_STEP}) % nn_) % nn_ AS pos
         FROM sized),
named AS (SELECT *, brands[pos // (n_names * n_vars) + 1] || ' ' || names[(pos // n_vars) % n_names + 1]
                    || ' - ' || variants[pos % n_vars + 1] AS product_name FROM perm)
SELECT substr(sha256(product_name || '|' || hsn_code || '|' || CAST(gen_index AS VARCHAR)), 1, 16) AS product_id,
       product_name, sub_category, hsn_code, gst_description, igst_rate,
       CAST(gen_index AS BIGINT) AS gen_index, CAST(gen_chunk AS INTEGER) AS gen_chunk
FROM named
"""

_T_SYN = "((SELECT count(*) FROM lineitem) + (SELECT count(*) FROM nation))"
ORACLES["expand_synthetic"] = "WITH " + _EXP_BASE.format(target=_T_SYN) + f"""
cats AS (SELECT sub_category, n, row_number() OVER (ORDER BY n DESC, fp) - 1 AS ci,
                count(*) OVER () AS k FROM al),
deficit AS (SELECT {_T_SYN} - (SELECT sum(tc) FROM al) AS d),
padidx AS (SELECT g.range AS rr FROM deficit, range(CAST(greatest(deficit.d, 0) AS BIGINT)) g),
pad AS (SELECT ranked.*, p.rr % 1000 AS gen_index, CAST(p.rr // 1000 AS INTEGER) AS gen_chunk,
               p.rr // 1000 + 1 AS cseed
        FROM padidx p JOIN cats c ON (p.rr // 1000) % c.k = c.ci
        JOIN ranked ON ranked.sub_category = c.sub_category AND ranked.r = (p.rr % 1000) % c.n),
rows AS (SELECT sub_category, hsn_code, gst_description, igst_rate, gen_index, gen_chunk, cseed FROM main
         UNION ALL
         SELECT sub_category, hsn_code, gst_description, igst_rate, gen_index, gen_chunk, cseed FROM pad),
""" + _EXP_EMIT

_T_TRIM = "((SELECT count(*) FROM orders) // 10)"
ORACLES["expand_trim"] = "WITH " + _EXP_BASE.format(target=_T_TRIM) + """
rows AS (SELECT sub_category, hsn_code, gst_description, igst_rate, gen_index, gen_chunk, cseed FROM main),
""" + _EXP_EMIT + f"""
ORDER BY md5('{_SEED}' || '|' || sub_category || '|' || CAST(gen_index AS VARCHAR))
LIMIT {_T_TRIM}
"""

ORACLES["allocate"] = "WITH " + _EXP_BASE.format(target=_T_SYN).rstrip().rstrip(",").split("ranked AS")[0] \
    .rstrip().rstrip(",") + "\nSELECT sub_category, n, tc AS target FROM al"

_T_SIMPLE = "(SELECT count(*) FROM orders)"
ORACLES["expand_simple"] = "WITH " + _EXP_BASE.format(target=_T_SIMPLE).rstrip().rstrip(",") + """
SELECT substr(sha256(hsn_code || '|' || CAST(gen_index AS VARCHAR)), 1, 16) AS product_id,
       gst_description || ' - Variant ' || CAST(gen_index + 1 AS VARCHAR) AS product_name,
       sub_category, hsn_code, CAST(gen_index AS BIGINT) AS gen_index
FROM main
"""

# -------------------------------------------------------------- catalog

_CAT = """
rec AS (SELECT CASE WHEN p_partkey % 97 = 0 THEN '' ELSE CAST((p_partkey % 1500) * 3 AS VARCHAR) END AS code,
               p_name AS d, CAST((p_size % 4) * 6 AS DOUBLE) AS rate, p_brand AS src, p_partkey AS ord
        FROM part),
pc AS (SELECT code, arg_max(d, ord) AS d, arg_max(rate, ord) AS rate, arg_max(src, ord) AS src, min(ord) AS fp
       FROM rec WHERE code <> '' GROUP BY code),
cat AS (SELECT c_custkey AS ord, c_name AS name,
               CASE WHEN c_custkey % 11 = 0 THEN ''
                    ELSE CAST(c_custkey * 7 AS VARCHAR) || CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN '01' ELSE '9' END
               END AS sku
        FROM customer),
ex AS (SELECT cat.ord, pc.code FROM cat JOIN pc ON cat.sku = pc.code),
px AS (SELECT cat.ord, arg_min(pc.code, pc.fp) AS code FROM cat JOIN pc
         ON cat.sku <> '' AND starts_with(cat.sku, substr(pc.code, 1, 4)) GROUP BY cat.ord),
m AS (SELECT cat.*, coalesce(ex.code, px.code) AS mcode,
             CASE WHEN ex.code IS NOT NULL THEN 'exact' ELSE 'prefix' END AS match_kind
      FROM cat LEFT JOIN ex ON cat.ord = ex.ord LEFT JOIN px ON cat.ord = px.ord
      WHERE coalesce(ex.code, px.code) IS NOT NULL)
"""

ORACLES["enrich_catalog"] = "WITH " + _CAT + """
SELECT substr(sha256('catalog|' || m.name || '|' || m.sku), 1, 16) AS product_id, m.name AS product_name,
       CASE WHEN m.sku <> '' THEN m.sku ELSE pc.code END AS hsn_code, pc.d AS gst_description,
       pc.rate AS igst_rate, pc.src AS source_name, m.match_kind, m.ord
FROM m JOIN pc ON pc.code = m.mcode
"""

ORACLES["catalog_match_stats"] = "WITH " + _CAT + """
SELECT (SELECT count(*) FROM m) AS matched, (SELECT count(*) FROM cat) AS total
"""

ORACLES["catalog_unmatched"] = "WITH " + _CAT + """
SELECT name AS product_name, sku AS hsn_code, ord FROM cat WHERE ord NOT IN (SELECT ord FROM m)
"""

# --------------------------------------------------------------- ledger

_JOBS = """
jobs AS (SELECT user_id AS job_id, min(ts) AS created_at,
                CASE user_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'urgent' END AS priority,
                user_id % 10 = 0 AS is_primary, 'https://src.example/u' || CAST(user_id AS VARCHAR) AS url
         FROM events WHERE event_type = 'signup' GROUP BY user_id),
tr AS (SELECT user_id AS job_id, ts, event_id AS seq,
              CASE WHEN event_type IN ('view', 'click') THEN 'in_progress'
                   WHEN event_type = 'purchase' THEN 'completed' ELSE 'failed' END AS t,
              CASE WHEN event_type = 'purchase' THEN 'cache/u' || CAST(user_id AS VARCHAR) || '_'
                                                    || CAST(event_id AS VARCHAR) || '.html'
                   WHEN event_type = 'error' THEN props END AS detail
       FROM events WHERE event_type <> 'signup'),
agg AS (SELECT tr.job_id, arg_max(t, {'a': tr.ts, 'b': seq}) AS last_t,
               count(*) FILTER (WHERE t = 'failed') AS retries,
               max({'a': tr.ts, 'b': seq}) FILTER (WHERE t = 'failed') AS lf,
               max({'a': tr.ts, 'b': seq}) FILTER (WHERE t = 'completed') AS lc,
               arg_max(detail, {'a': tr.ts, 'b': seq}) FILTER (WHERE t = 'failed') AS err,
               arg_max(detail, {'a': tr.ts, 'b': seq}) FILTER (WHERE t = 'completed') AS content_path,
               max(tr.ts) AS upd
        FROM tr GROUP BY tr.job_id),
led AS (SELECT jobs.*, coalesce(last_t, 'pending') AS status, CAST(coalesce(retries, 0) AS BIGINT) AS retries,
               content_path, CASE WHEN lf IS NOT NULL AND (lc IS NULL OR lf > lc) THEN err END AS error,
               coalesce(upd, created_at) AS updated_at
        FROM jobs LEFT JOIN agg ON jobs.job_id = agg.job_id)
"""

ORACLES["ledger_fold"] = "WITH " + _JOBS + """
SELECT job_id, status, retries, content_path, error, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
       strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at FROM led
"""

ORACLES["ledger_completed"] = "WITH " + _JOBS + "SELECT job_id, content_path FROM led WHERE status = 'completed'"

ORACLES["job_stats"] = "WITH " + _JOBS + "SELECT status, count(*) AS n FROM led GROUP BY status"

ORACLES["ledger_reset_stale"] = "WITH " + _JOBS + """,
nw AS (SELECT max(ts) AS now FROM events),
st AS (SELECT led.*, status = 'in_progress' AND updated_at < now - INTERVAL 30 MINUTE AS stale FROM led, nw)
SELECT job_id, CASE WHEN stale THEN 'pending' ELSE status END AS status,
       strftime(CASE WHEN stale THEN now ELSE updated_at END, '%Y-%m-%d %H:%M:%S.%f') AS updated_at
FROM st, nw
"""

_ENQ = "WITH " + _JOBS + """,
src AS (SELECT 'https://src.example/u' || CAST(o_custkey AS VARCHAR) AS url,
               arg_min(o_custkey, o_orderkey) AS job_id,
               arg_min(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
                            WHEN o_orderpriority = '3-MEDIUM' THEN 'medium'
                            WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'unspecified' END, o_orderkey) AS priority,
               arg_min(o_orderstatus = 'F', o_orderkey) AS is_primary
        FROM orders GROUP BY 1),
enq AS (SELECT job_id, url, status, priority, is_primary, retries, 3 AS max_retries FROM led
        UNION ALL
        SELECT job_id, url, 'pending', priority, is_primary, CAST(0 AS BIGINT), 3 FROM src
        WHERE url NOT IN (SELECT url FROM led))
"""

ORACLES["ledger_enqueue"] = _ENQ + "SELECT job_id, url, status, priority, is_primary, retries FROM enq"

ORACLES["ledger_pending"] = _ENQ + """
SELECT job_id, priority, is_primary, status, retries FROM enq
WHERE status IN ('pending', 'failed') AND retries < max_retries
"""

ORACLES["parse_results"] = """
SELECT user_id AS job_id, count(*) AS results, CAST(sum(CAST(round(value) AS BIGINT)) AS BIGINT) AS records,
       count(*) FILTER (WHERE event_type = 'error' OR event_id % 10 = 0) AS failed_results
FROM events GROUP BY user_id
"""

ORACLES["latest_checkpoint"] = """
SELECT event_type || '-' || CAST(user_id % 10 AS VARCHAR) AS stage,
       arg_max('ckpt/' || CAST(event_id AS VARCHAR), {'a': ts, 'b': event_id}) AS data_path,
       arg_max(user_id, {'a': ts, 'b': event_id}) AS row_count,
       strftime(arg_max(ts, {'a': ts, 'b': event_id}), '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM events GROUP BY 1
"""

ORACLES["cache_key"] = """
SELECT page_id, url,
       replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '.', '_') || '_'
         || substr(md5(url), 1, 12) || '.html' AS cache_key
FROM pages
"""

# ----------------------------------------------------------- extraction

_EXTRACTED = """
WITH b AS (
  SELECT p_partkey // 40 AS page_id, row_number() OVER (PARTITION BY p_partkey // 40 ORDER BY p_partkey) - 1 AS row_idx,
         CAST(p_partkey AS VARCHAR) AS hsn_code,
         p_name || CASE WHEN p_partkey % 13 = 0 THEN ' & co' ELSE '' END AS gst_description,
         CAST(p_partkey % 40 + 1 AS VARCHAR) AS serial_no,
         CAST((p_size % 4) * 3 AS DOUBLE) AS cg,
         CASE WHEN p_partkey % 11 = 5 THEN 0.0 ELSE CAST((p_size % 4) * 3 AS DOUBLE) END AS sg,
         'page ' || CAST(p_partkey // 40 AS VARCHAR) AS source_name
  FROM part)
SELECT page_id, row_idx, hsn_code, gst_description, serial_no, cg AS cgst_rate, sg AS sgst_rate,
       cg + sg AS igst_rate, 0.0 AS cess_rate, source_name,
       CASE (CASE WHEN length(hsn_code) < 2 THEN 1 ELSE 0 END + CASE WHEN cg + sg = 0 THEN 1 ELSE 0 END)
         WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'review_required' END AS confidence_flag,
       substr(sha256(hsn_code || '|' || gst_description || '|' || CAST(CAST(cg + sg AS BIGINT) AS VARCHAR)), 1, 16)
         AS product_id
FROM b
"""

ORACLES["extract_tables"] = _EXTRACTED
ORACLES["extract_fallback"] = _EXTRACTED
ORACLES["extract_pages"] = "SELECT page_id, CAST(NULL AS VARCHAR) AS error, 0 AS n_rows FROM pages"
ORACLES["extract_layouts"] = """
WITH p AS (SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS k, CAST(p_size AS VARCHAR) AS a,
                  CAST(p_retailprice AS VARCHAR) AS b FROM part),
r AS (SELECT page_id, 0 AS row_idx, k AS hsn, a AS rate, '9' AS rate_1 FROM p
      UNION ALL SELECT page_id, 1, k, b, '8' FROM p
      UNION ALL SELECT page_id, 2, k, k, NULL FROM p)
SELECT page_id, 1 AS table_idx, row_idx, 1 AS strategy, concat_ws(' | ', hsn, rate, rate_1) AS raw_text, hsn, rate, rate_1
FROM r
"""


ORACLES["export_view"] = f"""
WITH r AS ({CUST_RECORDS})
SELECT product_id, CAST(NULL AS VARCHAR) AS product_name, top_category, sub_category, hsn_code,
       gst_description, CAST(NULL AS VARCHAR) AS schedule, CAST(NULL AS VARCHAR) AS serial_no,
       CAST(cgst_rate AS DOUBLE) AS cgst_rate, CAST(sgst_rate AS DOUBLE) AS sgst_rate,
       CAST(igst_rate AS DOUBLE) AS igst_rate, CAST(cess_rate AS DOUBLE) AS cess_rate,
       CAST(NULL AS VARCHAR) AS effective_from, source_name, CAST(NULL AS VARCHAR) AS source_url,
       CAST(NULL AS VARCHAR) AS raw_text, confidence_flag
FROM (SELECT *, 'high' AS confidence_flag FROM r)
"""

ORACLES["load_stats"] = """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE o_orderkey % 13 = 0) AS bad_rows,
       count(*) FILTER (WHERE o_orderkey % 13 <> 0) AS inserted
FROM orders
"""

# ---------------------------------------------------------------- sinks

ORACLES["stored_lookup"] = ORACLES["rate_by_code"]

ORACLES["export_chunks"] = """
WITH r AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS product_id,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey, l_tax, l_quantity,
                            l_extendedprice) - 1 AS pos
  FROM lineitem)
SELECT CAST(pos // 10000 + 1 AS BIGINT) AS chunk, count(*) AS n, arg_min(product_id, pos) AS first_id
FROM r GROUP BY 1
"""

ORACLES["normalize_quarantine"] = """
SELECT CAST(p_partkey AS VARCHAR) AS hsn_code,
       CASE p_partkey % 4 WHEN 1 THEN 1500000.0 WHEN 3 THEN 5.0 ELSE 0.0 END AS igst_rate,
       CASE WHEN p_partkey % 4 = 2 THEN 'rate_out_of_range' END AS error
FROM part
"""

ORACLES["envelope"] = f"""
WITH hit AS (SELECT * FROM ({PART_PRODUCTS}) p WHERE regexp_matches(product_name, 'RING', 'i') ORDER BY ord LIMIT 5)
SELECT 'RING' AS query, count(*) OVER () AS total_results,
       CAST(row_number() OVER (ORDER BY ord) - 1 AS INTEGER) AS place, {_PICK} FROM hit
"""

ORACLES["categories_nested"] = f"""
WITH p AS ({PART_PRODUCTS}),
subs AS (SELECT top_category, sub_category, count(*) AS product_count, arg_min(hsn_code, ord) AS sample_hsn
         FROM p GROUP BY top_category, sub_category ORDER BY top_category, product_count DESC, sub_category LIMIT 100)
SELECT top_category, CAST(sum(product_count) OVER (PARTITION BY top_category) AS BIGINT) AS total_products,
       CAST(row_number() OVER (PARTITION BY top_category ORDER BY product_count DESC, sub_category) - 1 AS INTEGER) AS place,
       sub_category AS name, product_count, sample_hsn
FROM subs
"""
