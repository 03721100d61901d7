"""Line deduplication by a deletion-neighbourhood join (edit bound: one).

A line (text between line feeds) that isn't blank is dropped when an equal
line, or one within one edit (insert, delete or replace one code point), occurs
earlier in (doc_id, line_no) order, judged on the input; the earliest stays.
Lines of fewer than ``min_chars`` code points are too short for an edit to mean
anything: they meet equal lines alone.

How. Equal lines collapse by a 128-bit key with their first occurrence. Two
lines within one edit have the same first or the same last half (for the
shorter length), and again all but one of ``PIECES`` pieces. So only lines
that share a half and then all but a piece with another line emit deletion
neighbourhoods: the line with one code point of that piece left out, hashed.
The neighbourhood keys join in two kinds of groups:

* same length, same position left out, same rest: all members differ in that
  one place, so each member's earliest partner is the group's minimum;
* the rest equals a whole shorter line: that line and each longer one.

Both are minima per key, aggregated before the shuffle, so a group of any size
costs one row per member and no pairs. The partner each line would follow is
then fetched and the edit distance verified on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import prepare, staged

MIN_CHARS = 10
PIECES = 16
# Odd multiplier of the polynomial hash modulo 2^64 and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a polynomial hash over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class LineHashes:
    """Polynomial hashes of a line's parts, in linear time:
    hash(s) = sum of s[j] * BASE^j."""

    def __init__(self, line: str):
        c = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(c)
        power = np.cumprod(np.r_[np.uint64(1), np.full(self.n, BASE, np.uint64)])
        self.pre = np.r_[np.uint64(0), np.cumsum(c * power[:-1])]
        self.whole = int(_mix(self.pre[-1:])[0])

    def without(self, a: int, b: int) -> np.ndarray:
        """Hash of the line without the code point at each of [a, b)."""
        return _mix(self.pre[a:b] + (self.pre[-1] - self.pre[a + 1:b + 1]) * np.uint64(BASE_INVERSE))

    def around(self, base: int) -> np.ndarray:
        """For each piece of a line of ``base`` code points, the hash of what
        stands before and behind it (counted from the end)."""
        cut = _cuts(base)
        before, tail = self.pre[cut[:-1]], self.n - (base - cut[1:])
        behind = (self.pre[-1] - self.pre[tail]) * np.cumprod(np.r_[np.uint64(1), np.full(self.n, BASE_INVERSE, np.uint64)])[tail]
        return _mix(_mix(before) + _mix(behind ^ np.uint64(BASE)) * np.uint64(3)
                    + np.arange(len(cut) - 1, dtype=np.uint64) + np.uint64(base << 8))


def _cuts(base: int) -> np.ndarray:
    return np.arange(PIECES + 1) * base // PIECES


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, line_no, line) of the lines that aren't blank (blanks: space,
    tab, carriage return); null ids and null texts have none."""
    return (docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
            .where("doc_id is not null and text is not null")
            .select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .where(F.trim(F.translate("line", "\r\t", "  ")) != ""))


def _key(line="line"):
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), F.col(line)).alias("h2")]


def _halves():
    """Keys of the first and last half, with the line as the shorter or as the
    longer one of a pair."""
    n = F.length("line")

    def both(base):
        h = F.floor(base / 2).cast("int")
        return [F.xxhash64(F.lit(0), base, F.substring("line", F.lit(1), h)),
                F.xxhash64(F.lit(1), base, F.substring("line", n - (base - h) + 1, base - h))]
    return both(n) + both(n - 1)


ME = "h1 long, h2 long, doc_id long, line_no int"


def _pieces(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(part, base, piece) of each line: all of it but one piece, as the
    shorter (base = its length) or the longer one of a pair."""
    for pdf in it:
        out = []
        for row in pdf.itertuples(index=False):
            h = LineHashes(row.line)
            for base in (h.n, h.n - 1):
                out.append(pd.DataFrame({"part": h.around(base).view(np.int64), "base": np.int32(base),
                                         "piece": np.arange(PIECES, dtype=np.int32), "h1": row.h1, "h2": row.h2,
                                         "doc_id": row.doc_id, "line_no": np.int32(row.line_no)}))
        if out:
            yield pd.concat(out)


def _neighbourhood(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, n, at, long): the deletion variants of each line in the pieces it
    has to vary (at: the place left out; long: as the longer line of a pair),
    and the line itself (at -1); n is the length of the pair's shorter line."""
    for pdf in it:
        out = []
        for row in pdf.itertuples(index=False):
            h = LineHashes(row.line)
            key, n, at = [[h.whole]], [[h.n]], [[-1]]
            for v in row.vary:
                cut = _cuts(v["base"])
                a, b = int(cut[v["piece"]]), int(cut[v["piece"] + 1]) + (h.n - v["base"])
                key.append(h.without(a, b).tolist())
                n.append([v["base"]] * (b - a))
                at.append(list(range(a, b)))
            got = pd.DataFrame({"key": np.concatenate([np.array(k, np.uint64) for k in key]).view(np.int64),
                                "n": np.concatenate(n).astype(np.int32), "at": np.concatenate(at).astype(np.int32)})
            got["long"] = got["n"] < h.n
            out.append(got.assign(h1=row.h1, h2=row.h2, doc_id=row.doc_id, line_no=np.int32(row.line_no)))
        if out:
            yield pd.concat(out)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, line_no, keep_doc_id, keep_line_no, distance): each dropped
    line, the earliest line it repeats and their edit distance (0 or 1).

    Rows with equal doc_id count as one document's text at the same lines; an
    empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    prepare(spark)
    every = lines(docs, id_col, text_col)
    # Lines under the floor have no halves: equal ones alone meet.
    halves = F.when(F.length("line") >= min_chars, F.array(*_halves())).otherwise(F.array().cast("array<bigint>"))
    first = staged(every.select("doc_id", "line_no", *_key(), halves.alias("halves"))
                   .groupBy("h1", "h2", "halves")
                   .agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
                   .select("h1", "h2", "first.doc_id", "first.line_no", "halves"), "lines")

    # Lines that share a half with another line, with their texts.
    half = first.select("doc_id", "line_no", F.explode("halves").alias("half"))
    shared = half.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    near = half.join(shared, "half", "left_semi").select("doc_id", "line_no").distinct()
    wanted = near.groupBy("doc_id").agg(F.collect_list("line_no").alias("want"))
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    got = (texts.join(wanted, "doc_id")
           .select("doc_id", F.split("text", "\n").alias("all"), F.explode("want").alias("line_no"))
           .select("doc_id", "line_no", F.get("all", F.col("line_no")).alias("line"))
           .where(F.length("line") >= min_chars).select("doc_id", "line_no", "line", *_key()))
    got = staged(got.distinct(), "near")

    # Of those, the pieces outside which a line equals another one.
    me = F.struct("doc_id", "line_no", "h1", "h2")
    part = staged(got.mapInPandas(_pieces, "part long, base int, piece int, " + ME), "parts")
    twice = part.groupBy("part").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("part")
    vary = (part.join(twice, "part", "left_semi").groupBy("h1", "h2", "doc_id", "line_no")
            .agg(F.collect_set(F.struct("base", "piece")).alias("vary")))
    var = (got.join(vary, ["h1", "h2", "doc_id", "line_no"])
           .mapInPandas(_neighbourhood, "key long, n int, at int, long boolean, " + ME)
           .withColumn("me", me).select("key", "n", "at", "long", "me"))
    var = staged(var, "variants")
    # Same length and place: everyone's earliest partner is the minimum.
    same = var.where("at >= 0 and not long").select("key", "n", "at", "me").distinct()
    group = same.groupBy("key", "n", "at").agg(F.min("me").alias("to"), F.max("me").alias("last")).where("to < last")
    replaced = same.join(group.select("key", "n", "at", "to"), ["key", "n", "at"]).select("me", "to")
    # A whole line of length n and the lines of length n + 1 that reduce to it.
    whole = var.where("at < 0").select("key", "n", F.col("me").alias("short")).distinct()
    less = var.where("long").select("key", "n", F.col("me").alias("more")).distinct()
    longer = less.join(whole, ["key", "n"])
    pairs = (replaced.union(longer.select(F.col("more").alias("me"), F.col("short").alias("to")))
             .union(longer.groupBy("short").agg(F.min("more").alias("to")).select(F.col("short").alias("me"), "to"))
             .where("to < me"))
    best = pairs.groupBy("me").agg(F.min("to").alias("to"))

    # Verify on the texts, then settle every occurrence.
    a = got.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("a"))
    b = got.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("b"))
    follows = (best.select("me.h1", "me.h2", F.col("to.h1").alias("b1"), F.col("to.h2").alias("b2"),
                           F.col("to.doc_id").alias("to_doc"), F.col("to.line_no").alias("to_line"))
               .join(a, (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2"))).join(b, ["b1", "b2"])
               .where(F.levenshtein("a", "b", 1) == 1)
               .select("h1", "h2", "to_doc", "to_line"))
    # Written, so that the join of all lines with it is one that AQE may split
    # where a line is very common.
    rule = staged(first.select("h1", "h2", F.col("doc_id").alias("f_doc"), F.col("line_no").alias("f_line"))
                  .join(follows, ["h1", "h2"], "left"), "rules")
    hit = every.select("doc_id", "line_no", *_key()).join(rule, ["h1", "h2"])
    is_first = (F.col("doc_id") == F.col("f_doc")) & (F.col("line_no") == F.col("f_line"))
    return (hit.where(~is_first | F.col("to_doc").isNotNull())
            .select("doc_id", "line_no", F.coalesce("to_doc", "f_doc").alias("keep_doc_id"),
                    F.coalesce("to_line", "f_line").alias("keep_line_no"),
                    F.col("to_doc").isNotNull().cast("int").alias("distance")).distinct())


def without_lines(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines taken out of the text column, and a
    boolean ``__emptied`` (lines were dropped and nothing but blanks is left)."""
    drops = dropped.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("line_no").alias("__drop"))

    @F.pandas_udf("string")
    def rest(text: pd.Series, drop: pd.Series) -> pd.Series:
        def one(t, d):
            if t is None or d is None:
                return t
            gone = set(d.tolist())
            return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        return pd.Series([one(t, d) for t, d in zip(text, drop)], dtype=object)

    out = docs.join(drops, docs[id_col].cast("long") == F.col("__id"), "left")
    out = out.withColumn("__rest", rest(F.col(text_col), F.col("__drop")))
    return (out.withColumn(text_col, F.col("__rest"))
            .withColumn("__emptied", F.col("__drop").isNotNull() & (F.trim(F.translate("__rest", "\r\n\t", "   ")) == ""))
            .drop("__id", "__drop", "__rest"))
