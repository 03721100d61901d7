"""URL filter: host and path rules, and for other urls a logistic regression
on hashed character n-grams of host and path.

Built-in expressions only. The classifier learns from a small labelled url
table: at most ``SAMPLE`` distinct (host, path) rows, those with the smallest
hashes. Each training round is one aggregation of the gradient per hashed
coordinate, at most ``DIMENSIONS`` rows, which the driver turns into the next
weights (AdaGrad); judging is one projection over all pages.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import prepare, staged

DIMENSIONS = 4_096
SAMPLE = 4_000
ROUNDS = 20
GRAM = 4
RATE, L2 = 1.0, 1e-3


@dataclass(frozen=True)
class Rule:
    """``host/path`` rule: fits the host and its subdomains where the path
    starts with the rule's."""
    action: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_rule(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """``urls`` (host, path, ...) with ``rule`` and its ``action``; the longest
    fitting rule, null if none fits."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.text))
    host, path = F.col("host"), F.col("path")

    def first(value) -> Column:
        return F.coalesce(*[F.when(r.fits(host, path), F.lit(value(r))) for r in ranked], F.lit(None).cast("string"))
    return urls.withColumn("rule", first(lambda r: r.text)).withColumn("action", first(lambda r: r.action))


def features(host: Column, path: Column) -> Column:
    """Distinct hashed coordinates of the character n-grams, ends marked."""
    def grams(side: str, text: Column) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked) - (GRAM - 1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(side), F.substring(marked, i, F.lit(GRAM))),
                                                    F.lit(DIMENSIONS)).cast("int"))
    return F.array_distinct(F.concat(grams("h", host), grams("p", path)))


def probability(coordinates: Column, weights: list[float], bias: float) -> Column:
    """Logistic score; coordinates count 1 / sqrt(their number)."""
    table = F.expr("array(" + ",".join(f"{w!r}D" for w in weights) + ")")
    total = F.aggregate(coordinates, F.lit(0.0), lambda s, f: s + F.get(table, f))
    return 1 / (1 + F.exp(-(F.lit(bias) + total / F.sqrt(F.size(coordinates)))))


def train(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[float], float]:
    """Weights and bias from (host, path, label 0/1). Null labels are left
    out; without rows all weights are zero (probability one half)."""
    rows = (labelled.where("label in (0, 1)").select("host", "path", "label").distinct()
            .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(sample)
            .select(F.col("label").cast("double").alias("y"), features(F.col("host"), F.col("path")).alias("x")))
    rows = staged(rows.repartition(4), "urls")
    n = rows.count()
    weights, bias = [0.0] * DIMENSIONS, 0.0
    seen, seen_bias = [1e-8] * DIMENSIONS, 1e-8
    for _ in range(ROUNDS if n else 0):
        error = rows.select("x", (probability(F.col("x"), weights, bias) - F.col("y")).alias("e"))
        each = error.select(F.explode(F.concat("x", F.array(F.lit(-1)))).alias("f"), "e", F.sqrt(F.size("x")).alias("r"))
        gradient = each.groupBy("f").agg(F.sum(F.when(F.col("f") < 0, F.col("e")).otherwise(F.col("e") / F.col("r"))).alias("g"))
        for f, g in gradient.collect():
            g = g / n
            if f < 0:
                seen_bias += g * g
                bias -= RATE * g / math.sqrt(seen_bias)
            else:
                g += L2 * weights[f]
                seen[f] += g * g
                weights[f] -= RATE * g / math.sqrt(seen[f])
    return weights, bias


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url", sample: int = SAMPLE) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (the
    classifier's probability of block).

    ``labelled`` has (host, path, label); by default the pages that a rule
    decides, block as 1. Null urls and urls without ``://`` have empty host
    and path, fit no rule and are judged by the classifier. Repeated rows stay;
    an empty table gives no rows; other columns are ignored."""
    prepare(pages.sparkSession)
    host, path = split_url(pages[url_col])
    urls = with_rule(pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path")), rules)
    if labelled is None:
        labelled = urls.where("rule is not null").select("host", "path", (F.col("action") == "block").cast("int").alias("label"))
    weights, bias = train(labelled, sample)
    scored = urls.withColumn("score", probability(features(F.col("host"), F.col("path")), weights, bias))
    verdict = F.coalesce("action", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
