"""Bindings of the operators to the driver's tables.

Every query applies its operator, with production parameters, to the whole
table; the digest columns a contract asks for are derived here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm import bpe as BP
from ratebook.llm import decontaminate as DC
from ratebook.llm import fill_in_middle as FM
from ratebook.llm import hmm as HM
from ratebook.llm import language_id as LI
from ratebook.llm import line_dedup as LD
from ratebook.llm import prefix_trie as PT
from ratebook.llm import sanitise as SA
from ratebook.llm import simhash as SH
from ratebook.llm import substring_dedup as SD
from ratebook.llm import topk_search as TK
from ratebook.llm import toxicity as TX
from ratebook.llm import url_filter as UF
from ratebook.llm.common import crc_class, prepare

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# A document scored at least this is taken as toxic.
TOXIC = 0.3


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def default_tokenizer() -> str:
    """Place of the public byte-level vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op7_simhash_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = SH.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", SH.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


RULES = [UF.Rule("block", "net/"), UF.Rule("allow", "example.net/en/"),
         UF.Rule("block", "example.com/de/"), UF.Rule("allow", "org/fr/")]


@register("op5_url_filter")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UF.judge(table(spark, sf_dir, "pages"), RULES)


@register("op6_benchmark_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DC.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UNITS = ", ".join(f"'{u}'" for u in DC.UNITS)
_EDGES = DC.EDGES.replace("'", "''")
ORACLES["op6_benchmark_decontamination"] = rf"""
WITH raw AS (SELECT 'd' AS side, doc_id AS id, text FROM documents
             UNION ALL SELECT 'b', item_id, text FROM benchmark),
ws AS (SELECT side, id, list_filter(list_transform(string_split_regex(lower(regexp_replace(coalesce(text, ''),
         '([\p{{L}}\p{{N}},;] )(\p{{Lu}})', '\1' || chr(1) || '\2', 'g')), '[\x20\x09-\x0D]+'),
         lambda w: trim(w, '{_EDGES}')), lambda w: w <> '') AS w FROM raw),
word AS (SELECT side, id, p, w, lag(w) OVER (PARTITION BY side, id ORDER BY p) AS before
         FROM (SELECT side, id, unnest(range(len(w))) AS p, unnest(w) AS w FROM ws)),
kind AS (SELECT side, id, p, w, ltrim(w, chr(1)) AS plain, CASE WHEN starts_with(w, chr(1)) THEN 1
           WHEN regexp_matches(w, '^[0-9][0-9.,:/]*%?$') THEN 2
           WHEN w IN ({_UNITS}) AND regexp_matches(before, '^[0-9][0-9.,:/]*%?$') THEN 3 ELSE 0 END AS k FROM word),
arr AS (SELECT side, id, list(w ORDER BY p) AS w, list(k ORDER BY p) AS k, list(plain ORDER BY p) AS v,
          list(CASE k WHEN 0 THEN w ELSE '<' || k || '>' END ORDER BY p) AS t FROM kind GROUP BY side, id),
win AS (SELECT side, id, i, w[i:i + 7] AS w, k[i:i + 7] AS k, array_to_string(t[i:i + 7], ' ') AS t,
          array_to_string(v[i:i + 7], ' ') AS v, len(list_filter(k[i:i + 7], lambda x: x = 0)) * 2 >= 8 AS fits
        FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM arr)),
item AS (SELECT id, count(DISTINCT i) FILTER (fits) AS n_fit, count(DISTINCT i) AS n_all FROM win WHERE side = 'b' GROUP BY id),
met AS (SELECT d.id AS doc_id, b.id AS item_id, d.i - b.i AS shift, b.i AS j,
          list_distinct(list_filter(list_transform(range(1, 9), lambda x: CASE WHEN b.k[x] <> 0 THEN {{'b': b.w[x], 'd': d.w[x]}} END),
                                    lambda x: x IS NOT NULL)) AS s
        FROM win d JOIN win b ON d.t = b.t WHERE d.side = 'd' AND b.side = 'b' AND b.fits),
agreed AS (SELECT doc_id, item_id, shift, count(DISTINCT j) AS n, len(list_distinct(flatten(list(s)))) AS slots FROM met
           WHERE len(s) = len(list_distinct(list_transform(s, lambda x: x.b)))
             AND len(s) = len(list_distinct(list_transform(s, lambda x: x.d))) GROUP BY doc_id, item_id, shift),
dense AS (SELECT d.id AS doc_id, b.id AS item_id, d.i - b.i AS shift, count(DISTINCT b.i) AS n, max(n_all) AS n_all,
            len(list_distinct(flatten(list(list_filter(list_transform(range(1, 9), lambda x: CASE WHEN b.k[x] <> 0 THEN b.w[x] END),
                                                       lambda x: x IS NOT NULL))))) AS slots
          FROM win d JOIN win b ON d.v = b.v JOIN item ON item.id = b.id
          WHERE d.side = 'd' AND b.side = 'b' AND n_fit = 0 GROUP BY d.id, b.id, d.i - b.i),
brief AS (SELECT d.id AS doc_id, b.id AS item_id, 1 AS n,
            len(list_distinct(list_filter(list_transform(range(1, len(b.w) + 1), lambda x: CASE WHEN b.k[x] <> 0 THEN b.w[x] END),
                                          lambda x: x IS NOT NULL))) AS slots
          FROM arr d JOIN arr b ON contains(' ' || array_to_string(d.v, ' ') || ' ', ' ' || array_to_string(b.v, ' ') || ' ')
          WHERE d.side = 'd' AND b.side = 'b' AND len(b.w) BETWEEN {DC.SHORTEST} AND 7),
hit AS (SELECT doc_id, item_id, n, slots FROM agreed JOIN item ON item.id = item_id WHERE n >= least(3, n_fit)
        UNION ALL SELECT doc_id, item_id, n, slots FROM dense WHERE n >= least(3, n_all)
        UNION ALL SELECT doc_id, item_id, n, slots FROM brief)
SELECT doc_id, item_id, max(n) AS n_windows, max(slots) AS n_slots FROM hit GROUP BY doc_id, item_id
"""


@register("op8_bpe")
def op8(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    path = tokenizer_path or default_tokenizer()
    out = BP.decode(BP.encode(table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@register("op9_pii_sanitisation")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = SA.personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    n = [F.size(F.filter(kinds, lambda k: k == F.lit(SA.KINDS.index(name)))).cast("long").alias(f"n_{name}")
         for name in SA.KINDS]
    return out.select("doc_id", *n, F.sha2(SA.span_text(F.col("base")), 256).alias("base_sha256"),
                      SA.span_text(F.col("spans")).alias("spans"))


@register("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.dropped_lines(table(spark, sf_dir, "documents"))


ORACLES["op10_line_dedup"] = """
WITH doc AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
occ AS (SELECT doc_id, line_no, line FROM (
          SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM doc)
        WHERE trim(translate(line, chr(9) || chr(13), '  ')) <> ''),
one AS (SELECT line, min({'d': doc_id, 'l': line_no}) AS f FROM occ GROUP BY line),
var AS (SELECT line, f, length(line) AS n, i, left(line, i - 1) || substr(line, i + 1) AS rest
        FROM (SELECT line, f, unnest(range(1, length(line) + 1)) AS i FROM one WHERE length(line) >= 10)),
same AS (SELECT rest, i, min(f) AS f FROM var GROUP BY rest, i HAVING count(*) > 1),
near AS (
  SELECT v.line, s.f FROM var v JOIN same s ON v.rest = s.rest AND v.i = s.i
  UNION ALL SELECT v.line, o.f FROM var v JOIN one o ON v.rest = o.line AND length(o.line) >= 10
  UNION ALL SELECT o.line, v.f FROM var v JOIN one o ON v.rest = o.line AND length(o.line) >= 10),
best AS (SELECT line, min(f) AS f FROM near GROUP BY line)
SELECT o.doc_id, o.line_no, k.d AS keep_doc_id, k.l AS keep_line_no,
       CASE WHEN k < f THEN 1 ELSE 0 END AS distance
FROM (SELECT occ.doc_id, occ.line_no, one.f, least(one.f, coalesce(best.f, one.f)) AS k
      FROM occ JOIN one ON occ.line = one.line LEFT JOIN best ON best.line = occ.line) o
WHERE {'d': o.doc_id, 'l': o.line_no} <> k
"""


@register("op1_topk_binary_search")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = TK.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", dims=64, k=10)
    return found.select(F.col("query_id").alias("vec_id"), "rank", F.col("id").alias("neighbor_id"), "distance")


ORACLES["op1_topk_binary_search"] = """
WITH code AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS c FROM embeddings),
pair AS (SELECT q.vec_id, d.vec_id AS neighbor_id,
           len(list_filter(range(1, 65), lambda i: q.c[i] <> d.c[i])) AS distance
         FROM code q CROSS JOIN code d WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM pair)
SELECT vec_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
"""


@register("op2_hmm_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return HM.lm_scores(table(spark, sf_dir, "documents"))


def toxic_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with held_out and score; learns from labelled rows outside the
    held-out class only."""
    labels = table(spark, sf_dir, "labels").where(crc_class("doc_id", 4) != 2)
    weights = TX.fit(docs, labels)
    held = F.coalesce(crc_class("doc_id", 4) == 2, F.lit(True))
    return TX.score(docs.withColumn("held_out", held), weights)


@register("op3_ftrl_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxic_scores(spark, docs, sf_dir).select(
        "doc_id", "held_out", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@register("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SD.without_repeats(table(spark, sf_dir, "documents"), width=13)


ORACLES["op4_substring_dedup"] = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS w
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM doc)),
least AS (SELECT w, min(doc_id) AS m FROM win GROUP BY w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
         FROM win JOIN least USING (w) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS w FROM doc),
kept AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS t
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


@register("op12_fill_in_middle")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = FM.fill_in_middle(table(spark, sf_dir, "documents"))
    back = FM.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
                      F.sha2(F.encode(back, "UTF-8"), 256).alias("restored_sha256"))


ORACLES["op12_fill_in_middle"] = """
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
             FROM documents),
cut AS (SELECT doc_id, t, length(t) AS n,
          CAST('0x' || substr(x, 1, 8) AS BIGINT) % (length(t) + 1) AS c1,
          CAST('0x' || substr(x, 9, 8) AS BIGINT) % (length(t) + 1) AS c2,
          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                 OR CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
               WHEN CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM doc),
piece AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b, substr(t, 1, least(c1, c2)) AS p,
            substr(t, least(c1, c2) + 1, abs(c1 - c2)) AS m, substr(t, greatest(c1, c2) + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM piece
"""


@register("op13_language_id")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = LI.fit(docs.where(crc_class("doc_id", 4) != 2))
    held = F.coalesce(crc_class("doc_id", 4) == 2, F.lit(True))
    out = LI.identify(docs.select("doc_id", "text", held.alias("held_out")), model)
    return out.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"),
                      F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))


@register("op11_prefix_trie")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PT.conversation_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = """
WITH src AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
                       FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, r, t, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
          left(sha256(CAST(octet_length(encode(r)) AS VARCHAR) || ':' || r || t), 32)) AS p FROM src),
conv AS (SELECT c, c - c % 100 AS b, xor(list_reduce(list_concat([4294967295::UBIGINT],
             list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)),
           lambda acc, byte: list_reduce(list_concat([xor(acc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
             lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384::UBIGINT) ELSE y >> 1 END)),
           4294967295::UBIGINT) % 6 AS h FROM (SELECT DISTINCT c FROM src)),
turn AS (SELECT conv.c, 0 AS part, p, r, t FROM conv JOIN own ON own.c = conv.b WHERE p <= h
         UNION ALL SELECT conv.c, 1, p, r, t FROM conv JOIN own ON own.c = conv.c WHERE p > h),
path AS (SELECT conv.c, coalesce(list({'r': r, 't': t} ORDER BY part, p) FILTER (t IS NOT NULL), []) AS s
         FROM conv LEFT JOIN turn ON turn.c = conv.c GROUP BY conv.c),
step AS (SELECT c, len(s) AS n, d, s[:d] AS s FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM path)),
id AS (SELECT s, min(c) AS c, d, count(*) AS n_convs, coalesce(length(last(s)[d].t), 0) AS chars,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
       FROM step GROUP BY s, d),
kid AS (SELECT s[:d - 1] AS s, count(*) AS n FROM id WHERE d > 0 GROUP BY ALL),
node AS (SELECT id.*, coalesce(kid.n, 0) AS n_children FROM id LEFT JOIN kid ON kid.s = id.s),
below AS (SELECT s[:u] AS s, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (n_children = 0) AS leaves
          FROM (SELECT s, n_convs, chars, n_children, unnest(range(d + 1)) AS u FROM node) GROUP BY ALL)
SELECT node.c AS conv_id, node.d AS depth, up.c AS parent_conv_id, node.n_convs, node.n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.s = node.s LEFT JOIN node up ON up.s = node.s[:node.d - 1] AND up.d = node.d - 1
"""
