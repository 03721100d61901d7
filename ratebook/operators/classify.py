"""Ordered-rule classification (keyword substring rules, chapter range rules).

Rule tables are small configuration. Given as Python lists they compile into
one CASE expression (no join, no shuffle, codegen'd); given as DataFrames the
range rules expand to at most 109 chapter keys (-9..99: all two-character
integers) and join by broadcast hash join, a proven size bound, and keyword
rules of any number meet the texts by q-gram joins (``keyword_matches``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.fixed import (DEFAULT_SUB, DEFAULT_TOP, HSN_RANGE_RULES,
                            KEYWORD_RULES, KEYWORD_SUB)
from ratebook.functions.text import chapter_of, col_of
from ratebook.operators.joins import maybe_broadcast
from ratebook.session import write_stage_table

# Python-worker code of this module travels with the task (pickled by value),
# so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(__import__("sys").modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference pickling
    pass

CAT_TYPE = "struct<top_category:string,sub_category:string>"


def _cat(top: str, sub: str) -> Column:
    return F.struct(F.lit(top).alias("top_category"), F.lit(sub).alias("sub_category"))


def _null_cat() -> Column:
    return F.lit(None).cast(CAT_TYPE)


def keyword_category(text: Column | str,
                     rules: Sequence[tuple[str, str]] = KEYWORD_RULES,
                     sub_map: dict[str, str] = KEYWORD_SUB) -> Column:
    """The first rule (in rule order) whose keyword is a substring of
    the lower-cased text -> struct(top, sub); sub from ``sub_map`` else
    'uncategorized'; no match -> null."""
    low = F.lower(F.coalesce(col_of(text), F.lit("")))
    expr = None
    for kw, top in rules:
        cond = low.contains(kw)
        val = _cat(top, sub_map.get(kw, DEFAULT_SUB))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return _null_cat() if expr is None else expr.otherwise(_null_cat())


def range_category(code: Column | str,
                   rules: Sequence[tuple[int, int, str, str]] = HSN_RANGE_RULES) -> Column:
    """chapter = int(first two characters), code length >= 2; the first
    rule with lo <= chapter <= hi -> struct(top, sub); else null."""
    ch = chapter_of(code)
    expr = None
    for lo, hi, top, sub in rules:
        cond = ch.between(lo, hi)
        expr = F.when(cond, _cat(top, sub)) if expr is None else expr.when(cond, _cat(top, sub))
    return _null_cat() if expr is None else expr.otherwise(_null_cat())


def default_category() -> Column:
    return _cat(DEFAULT_TOP, DEFAULT_SUB)


def classify(df: DataFrame, text_col: str = "gst_description", code_col: str = "hsn_code",
             keyword_rules: Sequence[tuple[str, str]] | None = None,
             range_rules: Sequence[tuple[int, int, str, str]] | None = None,
             sub_map: dict[str, str] | None = None,
             top_col: str = "top_category", sub_col: str = "sub_category") -> DataFrame:
    """Keyword rules first, then chapter ranges, then other/uncategorized.

    Rules given replace the built-ins separately for keywords and ranges (an
    empty/None list means the built-ins); the keyword -> sub map is fixed
    unless passed explicitly.
    """
    kw = keyword_rules or KEYWORD_RULES
    rr = range_rules or HSN_RANGE_RULES
    sm = KEYWORD_SUB if sub_map is None else sub_map
    cat = F.coalesce(keyword_category(text_col, kw, sm), range_category(code_col, rr),
                     default_category())
    tmp = "__cat"
    return (df.withColumn(tmp, cat)
              .withColumn(top_col, F.col(f"{tmp}.top_category"))
              .withColumn(sub_col, F.col(f"{tmp}.sub_category"))
              .drop(tmp))


def category_for_code(df: DataFrame, code_col: str = "hsn_code",
                      range_rules: Sequence[tuple[int, int, str, str]] | None = None,
                      top_col: str = "top_category", sub_col: str = "sub_category") -> DataFrame:
    """Category from the code alone (ranges, then default)."""
    cat = F.coalesce(range_category(code_col, range_rules or HSN_RANGE_RULES),
                     default_category())
    return (df.withColumn("__cat", cat)
              .withColumn(top_col, F.col("__cat.top_category"))
              .withColumn(sub_col, F.col("__cat.sub_category"))
              .drop("__cat"))


def range_rules_frame(spark, rules=HSN_RANGE_RULES) -> DataFrame:
    """Range rules as a DataFrame (rule_ord, lo, hi, top_category, sub_category)."""
    rows = [(i, lo, hi, top, sub) for i, (lo, hi, top, sub) in enumerate(rules)]
    return spark.createDataFrame(
        rows, "rule_ord int, lo int, hi int, top_category string, sub_category string")


def classify_ranges_join(df: DataFrame, rules: DataFrame, code_col: str = "hsn_code",
                         top_col: str = "top_category", sub_col: str = "sub_category") -> DataFrame:
    """C3+C4 for rule tables held as DataFrames: explode each rule to its
    chapters (clipped to -9..99, the only values a two-character integer can
    take, so the dimension has at most 109 rows whatever the rule count),
    keep the first rule per chapter, then broadcast hash join on the chapter."""
    chapters = (rules
                .select("rule_ord", "top_category", "sub_category",
                        F.explode(F.sequence(F.greatest(F.col("lo"), F.lit(-9)),
                                             F.least(F.col("hi"), F.lit(99)))).alias("chapter"))
                .groupBy("chapter")
                .agg(F.min_by(F.struct("top_category", "sub_category"), "rule_ord").alias("c"))
                .select("chapter", F.col("c.top_category").alias("__rt"),
                        F.col("c.sub_category").alias("__rs")))
    out = (df.withColumn("__ch", chapter_of(code_col))
             .join(F.broadcast(chapters), F.col("__ch") == F.col("chapter"), "left"))
    return (out.withColumn(top_col, F.coalesce("__rt", F.lit(DEFAULT_TOP)))
               .withColumn(sub_col, F.coalesce("__rs", F.lit(DEFAULT_SUB)))
               .drop("__ch", "chapter", "__rt", "__rs"))


GRAM = 3
PIECE = 128
MAX_RULE_ROWS = 100_000


def keyword_matches(texts: DataFrame, rules: DataFrame, text_col: str = "text", gram: int = GRAM) -> DataFrame:
    """C1 for rule tables of any size: (text_key, rule_ord) with the first rule
    whose keyword is a substring of the lower-cased text, for every distinct
    text that has one; ``text_key`` is :func:`text_key` of the text.

    ``rules``: (rule_ord, keyword, ...); empty and null keywords match nothing.
    A text is cut into pieces that overlap by the longest keyword, a piece into
    its q-grams; q-grams meet the keywords that begin with them in an equi-join
    and are verified in place. Keywords shorter than a q-gram meet q-grams of
    their own length. The work per character does not grow with the rules."""
    low = F.lower(F.col("keyword"))
    first = write_stage_table(
        rules.where(F.length("keyword") > 0).groupBy(low.alias("kw")).agg(F.min("rule_ord").alias("rule_ord"))
             .select("kw", "rule_ord", F.substring("kw", 1, gram).alias("gram"), F.length("kw").alias("n")))
    longest, shorter = first.agg(F.max("n"), F.array_sort(F.collect_set(F.when(F.col("n") < gram, F.col("n"))))).first()
    if longest is None:
        return texts.sparkSession.createDataFrame([], "text_key binary, rule_ord int")
    size = max(PIECE, longest)
    cut = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    pieces = texts.select(text_key(text_col).alias("text_key"), cut.alias("p")).select(
        "text_key", F.explode(F.transform("p", lambda x, i: F.struct(
            F.concat(x, F.substring(F.coalesce(F.get(F.col("p"), i + 1), F.lit("")), 1, longest - 1)).alias("piece"),
            F.length(x).alias("own")))).alias("q")).select("text_key", "q.*")
    # One generated loop: a place makes a row only if its q-gram begins a keyword.
    found = pieces.select("text_key", "piece", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("at")).select(
        "text_key", "piece", "at", F.substr(F.col("piece"), F.col("at"), F.lit(gram)).alias("gram"))
    if shorter:
        found = found.select("text_key", "piece", "at", F.explode(F.array_distinct(F.array(
            "gram", *[F.substring("gram", 1, n) for n in shorter]))).alias("gram"))
    first = maybe_broadcast(first, MAX_RULE_ROWS)
    hit = found.join(first, "gram").where(F.substr("piece", F.col("at"), F.col("n")) == F.col("kw"))
    return hit.groupBy("text_key").agg(F.min("rule_ord").alias("rule_ord"))


def text_key(text: Column | str) -> Column:
    """16-byte key of a text as the rules see it: null for null."""
    return F.unhex(F.substring(F.sha2(F.lower(col_of(text)), 256), 1, 32))


def classify_rule_table(df: DataFrame, rules: DataFrame, text_col: str = "gst_description", code_col: str = "hsn_code",
                        range_rules: Sequence[tuple[int, int, str, str]] | None = None,
                        top_col: str = "top_category", sub_col: str = "sub_category") -> DataFrame:
    """C5 with keyword rules held as a DataFrame of any size (rule_ord,
    keyword, top_category, sub_category; rule_ord unique): first matching
    keyword rule, then chapter ranges, then other/uncategorized."""
    chosen = keyword_matches(df.select(text_col), rules, text_col).join(
        rules.select("rule_ord", F.struct("top_category", F.coalesce("sub_category", F.lit(DEFAULT_SUB)).alias("sub_category"))
                     .cast(CAT_TYPE).alias("__kw")), "rule_ord").select("text_key", "__kw")
    # Written, so the join with the rows knows its size; no match is no key.
    chosen = write_stage_table(chosen).withColumnRenamed("text_key", "__tk")
    ranges = (range_category(code_col, range_rules or HSN_RANGE_RULES) if code_col in df.columns else _null_cat())
    cat = F.coalesce("__kw", ranges, default_category())
    out = df.withColumn("__tk", text_key(text_col)).join(chosen, "__tk", "left").withColumn("__cat", cat)
    return (out.withColumn(top_col, F.col("__cat.top_category")).withColumn(sub_col, F.col("__cat.sub_category"))
               .drop("__tk", "__kw", "__cat"))


def category_counts(df: DataFrame, top_col: str = "top_category") -> DataFrame:
    """Rows per top category."""
    return df.groupBy(top_col).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ rule config

def rules_from_config(conf: dict | None):
    """(keyword_rules, range_rules) from a parsed configuration mapping
    (``classification.hsn_rules`` items with hsn_prefix_start / _end /
    top_category / sub_category; ``classification.keyword_overrides`` as an
    ordered mapping). Each empty or absent list falls back to the built-ins
    on its own; the keyword -> sub-category map is never replaced."""
    cls = ((conf or {}).get("classification") or {})
    ranges = [(int(r["hsn_prefix_start"]), int(r["hsn_prefix_end"]), str(r["top_category"]),
               str(r["sub_category"])) for r in (cls.get("hsn_rules") or [])]
    kws = [(str(k), str(v)) for k, v in (cls.get("keyword_overrides") or {}).items()]
    return kws or list(KEYWORD_RULES), ranges or list(HSN_RANGE_RULES)


def load_rules(path: str):
    """S6 from a YAML file (PyYAML when installed)."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - optional dependency
        raise RuntimeError("reading YAML rule files needs PyYAML") from e
    with open(path, encoding="utf-8") as f:
        return rules_from_config(yaml.safe_load(f))


def keyword_rules_frame(spark, rules=KEYWORD_RULES, sub_map=KEYWORD_SUB):
    """Keyword rules as a DataFrame (rule_ord, keyword, top_category, sub_category)."""
    rows = [(i, kw, top, sub_map.get(kw, DEFAULT_SUB)) for i, (kw, top) in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_ord int, keyword string, top_category string, sub_category string")


def keyword_rules_from_frame(rules: DataFrame):
    """Keyword rules held as a DataFrame (rule_ord, keyword, top_category[,
    sub_category]) -> (rules list, sub map) for :func:`classify`. Rule tables
    are configuration: they are brought to the driver, in order."""
    cols = ["keyword", "top_category"] + (["sub_category"] if "sub_category" in rules.columns else [])
    rows = rules.orderBy("rule_ord").select(*cols).collect()
    kws = [(r.keyword, r.top_category) for r in rows]
    sub = {r.keyword: r.sub_category for r in rows if "sub_category" in cols and r.sub_category}
    return kws, sub
