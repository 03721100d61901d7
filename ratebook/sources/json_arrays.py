"""Splittable scan of files that hold one JSON array of objects.

Spark's text source cuts a file at any separator, in parallel splits, so the
file is read in pieces that begin behind each ``{``. What a piece means depends
on all text before it: it may begin inside a string, and at any bracket depth.
Each piece yields, by expressions, its quote count and its depth change for
either start; each split the composition of its pieces; the splits of a file
are composed in order, a table of one row per split. With its true start known,
a second scan runs through every split and marks the pieces that begin a
record. Nearly all records of flat objects are one piece and need no shuffle;
only pieces of records with a ``{`` inside are grouped.

A backslash hides the character behind it, inside strings only, where JSON
allows it; a piece never begins behind a pending backslash.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.session import stage_path

# A table of this many splits is broadcast (about 100 bytes each); beyond it
# the scan meets its splits in a shuffle join.
SPLITS = 200_000
# A record longer than this is not put together: its pieces come back as
# unreadable texts. A file whose quotes don't match is one such record.
RECORD_BYTES = 64 << 20

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(f, b, i, value, quotes, out0, out1): pieces in stored order with their
    quote count and depth change from a start outside or inside a string; the
    ``{`` before a piece counts for it. (The head of a file has none before
    it; who reads the pieces takes it off again.)"""
    text = spark.read.option("lineSep", "{").text(paths).select(
        "value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"))
    bare = F.regexp_replace("value", r"(?s)\\.", "")

    def count(c: Column, characters: str) -> Column:
        return F.length(c) - F.length(F.translate(c, characters, ""))

    def change(c: Column) -> Column:
        outside = F.regexp_replace(c, r'"[^"]*+("|$)', "")
        return count(outside, "[") - count(outside, "]}")

    return text.select("*", count(bare, '"').alias("quotes"), (change(bare) + 1).alias("out0"),
                       change(F.concat(F.lit('"'), bare)).alias("out1"))


def split_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per split (f, b): its number n over all files, whether it begins
    ``inside`` a string, its ``depth`` there, and the file's ``head`` (the text
    before its first ``{``, cut to one character; null in later splits)."""

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for pdf in batches:
            key = pdf["f"].ne(pdf["f"].shift()) | pdf["b"].ne(pdf["b"].shift())
            out = []
            for _, part in pdf.groupby(key.cumsum(), sort=False):
                f, b = part["f"].iloc[0], int(part["b"].iloc[0])
                if now is None or (f, b) != (now[0], now[1]):
                    if now is not None:
                        out.append(tuple(now))
                    now = [f, b, 0, 0, 0, part["head"].iloc[0] if b == 0 else None]
                    if b == 0:  # no brace before the head
                        now[3], now[4] = -1, 0
                before = (part["quotes"].cumsum() - part["quotes"] + now[2]) % 2 == 1
                now[3] += int(part["out1"].where(before, part["out0"]).sum())
                now[4] += int(part["out0"].where(before, part["out1"]).sum())
                now[2] = (now[2] + int(part["quotes"].sum())) % 2
            yield pd.DataFrame(out, columns=["f", "b", "odd", "change0", "change1", "head"])
        if now is not None:
            yield pd.DataFrame([tuple(now)], columns=["f", "b", "odd", "change0", "change1", "head"])

    head = F.substring(F.regexp_replace("value", r"^[\s﻿]+", ""), 1, 1).alias("head")
    found = _pieces(spark, paths).select("f", "b", "quotes", "out0", "out1", head).mapInPandas(
        compose, "f string, b long, odd int, change0 long, change1 long, head string")
    path = stage_path(spark, "json-splits", uuid.uuid4().hex)
    found.write.parquet(path)
    # Few rows: one per split. The start of a split inside a string is the
    # parity before it; then its own change is known, and the depth before it.
    file = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    inside = spark.read.parquet(path).withColumn(
        "inside", F.coalesce(F.sum("odd").over(file) % 2, F.lit(0)) == 1)
    change = F.when(F.col("inside"), F.col("change1")).otherwise(F.col("change0"))
    starts = inside.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(file), F.lit(0)))
    path = stage_path(spark, "json-splits", uuid.uuid4().hex)
    starts.select("f", "b", F.xxhash64("f", "b").alias("n"), "inside", "depth", "head").write.parquet(path)
    return spark.read.parquet(path)


WALKED = "inside boolean, depth long, head boolean, opened long"


def _walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """State before each piece, in stored order: inside a string, bracket
    depth, whether it is a file's head, and how many records that don't end in
    their first piece this split has opened so far."""
    now, odd, depth, opened = None, 0, 0, 0
    for n, b, inside, start, quotes, out0, out1 in batches:
        parts = []
        frame = pd.DataFrame({"n": n, "b": b, "s": inside, "d": start, "q": quotes, "o0": out0, "o1": out1})
        for _, p in frame.groupby(frame["n"].ne(frame["n"].shift()).cumsum(), sort=False):
            fresh = p["n"].iloc[0] != now
            if fresh:
                now, odd, depth, opened = p["n"].iloc[0], int(p["s"].iloc[0]), int(p["d"].iloc[0]), 0
            head = pd.Series(False, index=p.index)
            head.iloc[0] = fresh and p["b"].iloc[0] == 0
            after = (p["q"].cumsum() + odd) % 2
            before = ((after - p["q"]) % 2) == 1
            change = p["o1"].where(before, p["o0"] - head)
            end = change.cumsum() + depth
            at = end - change
            starts = ~before & (at == 1) & ~head
            open_ = starts & ((end > 1) | (after == 1))
            count = open_.cumsum() + opened
            parts.append(pd.DataFrame({"inside": before, "depth": at, "head": head, "opened": count}))
            odd, depth, opened = int(after.iloc[-1]), int(end.iloc[-1]), int(count.iloc[-1])
        yield pd.concat(parts) if parts else pd.DataFrame(
            {"inside": pd.Series(dtype=bool), "depth": pd.Series(dtype="int64"), "head": pd.Series(dtype=bool),
             "opened": pd.Series(dtype="int64")})


def array_records(spark: SparkSession, paths: list[str], splits: DataFrame | None = None) -> DataFrame:
    """(ord, text, broken): every object of the arrays in ``paths`` as JSON
    text, and what stands between them and is no separator, also as text.
    ``ord`` is (file, split start, position); texts between objects come behind
    the object before them. ``broken`` marks pieces of a record over
    ``RECORD_BYTES``."""
    splits = split_table(spark, paths) if splits is None else splits
    starts = splits.select("f", "b", "n", F.col("inside").alias("s"), F.col("depth").alias("d"))
    pieces = _pieces(spark, paths)
    if splits.limit(SPLITS + 1).count() <= SPLITS:
        joined = pieces.join(F.broadcast(starts), ["f", "b"], "left")
    else:
        joined = pieces.join(starts, ["f", "b"], "left").sortWithinPartitions("n", "i")
    known = F.when(F.col("n").isNull(), F.raise_error(F.lit("the splits of the input changed while it was read"))
                   ).otherwise(F.col("n"))
    walk = F.pandas_udf(_walk, WALKED).asNondeterministic()(known, "b", "s", "d", "quotes", "out0", "out1")
    walked = joined.select("f", "b", "i", "n", "value", "quotes", "out0", "out1", walk.alias("w")).select(
        "f", "b", "i", "n", "value", "w.*",
        (F.col("w.depth") + F.when(F.col("w.inside"), F.col("out1")).otherwise(F.col("out0"))).alias("end"),
        ((F.col("quotes") + F.col("w.inside").cast("int")) % 2 == 1).alias("cut"))
    starts_here = ~F.col("inside") & (F.col("depth") == 1) & ~F.col("head")
    whole = F.col("head") | (starts_here & (F.col("end") <= 1) & ~F.col("cut"))
    marked = walked.withColumn("whole", whole)

    order = F.struct("f", "b", "i")
    ready = marked.where("whole").select(
        order.alias("ord"), F.when(F.col("head"), F.regexp_replace("value", r"^[\s﻿]*\[", "")).otherwise(
            F.concat(F.lit("{"), F.col("value"))).alias("text"), F.lit(False).alias("broken"))
    return _trimmed(ready.unionByName(_joined(spark, marked.where("not whole"))))


def _joined(spark: SparkSession, parts: DataFrame) -> DataFrame:
    """Records of several pieces. Pieces before the first opening of their
    split belong to the last record that an earlier split opened."""
    path = stage_path(spark, "json-parts", uuid.uuid4().hex)
    parts.select("f", "b", "i", "n", "opened", "value").write.parquet(path)
    parts = spark.read.parquet(path)
    last = parts.groupBy("f", "b", "n").agg(F.max("opened").alias("opened"))
    earlier = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    owner = last.select("n", F.last(F.when(F.col("opened") > 0, F.struct("n", "opened")), ignorenulls=True)
                        .over(earlier).alias("own"))
    lead = parts.where("opened = 0").join(owner, "n").select(
        "f", "b", "i", "value", F.coalesce("own.n", F.col("n")).alias("n"), F.coalesce("own.opened", F.lit(0)).alias("k"))
    every = parts.where("opened > 0").select("f", "b", "i", "value", "n", F.col("opened").alias("k")).union(lead)
    size = every.groupBy("n", "k").agg(F.sum(F.octet_length("value")).alias("size"))
    long = size.where(F.col("size") > RECORD_BYTES).select("n", "k")
    order = F.struct("f", "b", "i")
    short = (every.join(long, ["n", "k"], "left_anti").groupBy("n", "k")
             .agg(F.sort_array(F.collect_list(F.struct(order.alias("ord"), "value"))).alias("p"))
             .select(F.col("p")[0]["ord"].alias("ord"),
                     F.concat(F.lit("{"), F.array_join(F.transform("p", lambda x: x["value"]), "{")).alias("text"),
                     F.lit(False).alias("broken")))
    return short.unionByName(every.join(long, ["n", "k"], "left_semi").select(
        order.alias("ord"), F.concat(F.lit("{"), F.col("value")).alias("text"), F.lit(True).alias("broken")))


def _trimmed(records: DataFrame) -> DataFrame:
    """Each record without the separators behind it; more than separators
    behind its last brace is a text of its own."""
    between = r"^[\s,\]]+|[\s,\[\]]+$"
    close = F.length("text") - F.instr(F.reverse("text"), "}") + 1
    found = F.instr("text", "}") > 0
    head = F.when(found & F.col("text").startswith("{"), F.expr("left(text, length(text) - instr(reverse(text), '}') + 1)"))
    rest = F.when(head.isNotNull(), F.substr("text", close + 1)).otherwise(F.col("text"))
    texts = F.filter(F.array(head, F.regexp_replace(rest, between, "")), lambda t: t.isNotNull() & (t != ""))
    return records.select("ord", "broken", F.posexplode(texts).alias("place", "text")).select(
        F.struct("ord.f", "ord.b", "ord.i", "place").alias("ord"), "text", "broken")
