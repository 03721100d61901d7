"""Repeated passages found with FM-indexes, one per shard of the corpus.

A window is ``width`` consecutive words of one document; a word is removed
when a window that covers it also starts in a document with a smaller doc_id.

Sharding. Streaming every document through every shard's index would cost
documents x shards. Instead each window is sent to the shard of its minimizer,
the smallest hash among its ``MINIMIZER``-word grams: equal windows have equal
minimizers, so one shard holds all of a window's occurrences. Neighbouring
windows mostly share a minimizer and travel as one fragment. A fragment whose
minimizer occurs nowhere else has no partner and stays at home.

Index. A shard's distinct fragments are concatenated over word ids; suffixes
are sorted to the depth that windows need, and the Burrows-Wheeler transform
is kept as a wavelet matrix of packed bit vectors with block ranks. Backward
search extends every window of the streamed fragments word by word; a window
whose interval narrows to its own position has a matching statistic below the
threshold and stops, the others report their interval, whose smallest doc_id
decides.

Scale. Equal fragments collapse to one with the smallest doc_id before they
are indexed. A minimizer with more than ``HOT_FRAGMENTS`` distinct fragments
(the edges of a passage that a share of all documents holds) is taken apart
into single windows, collapsed and dealt by their own hash. Shards hold about
``SHARD_WORDS`` words whatever the corpus size; answers go back by join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import ids_and_texts, prepare, staged

WIDTH = 13
MINIMIZER = 5
SHARD_WORDS = 200_000
HOT_FRAGMENTS = 2_000
RUN = 60_000  # longest run of windows in one fragment
ODD = 0x9E3779B97F4A7C15
ODD_INVERSE = pow(ODD, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fragments(words: list[bytes], width: int, gram: int) -> tuple[np.ndarray, ...] | None:
    """(pos, windows, minimizer, content hash) of the runs of windows that
    share a minimizer value; None when the text is shorter than a window."""
    n = len(words)
    if n < width:
        return None
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], dtype=np.uint64)
    g = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        g = g * np.uint64(ODD) + h[k:k + len(g)]
    g = _mix(g)
    span, low, have = width - gram + 1, g, 1
    while have < span:  # sliding minimum by doubling
        step = min(have, span - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    begin = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    if len(low) > RUN:
        begin = np.union1d(begin, np.arange(0, len(low), RUN))
    count = np.diff(np.r_[begin, len(low)])
    power = np.cumprod(np.r_[np.uint64(1), np.full(n, ODD, np.uint64)])
    back = np.cumprod(np.r_[np.uint64(1), np.full(n, ODD_INVERSE, np.uint64)])
    pre = np.r_[np.uint64(0), np.cumsum(h * power[:n])]
    content = _mix((pre[begin + count + width - 1] - pre[begin]) * back[begin])
    return begin, count, low[begin], content


# ------------------------------------------------------------ the index

class FMIndex:
    """FM-index of an integer text for patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        n = len(text)
        rank, have = text.astype(np.int64), 1
        while have < depth:
            ahead = np.r_[rank[have:] + 1, np.zeros(min(have, n), np.int64)][:n]
            rank = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)[1].astype(np.int64)
            have *= 2
        self.sa = np.argsort(rank, kind="stable")
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))]
        bwt = text[self.sa - 1]
        self.levels = []
        origin = np.zeros(sigma, np.int64)
        symbols = np.arange(sigma)
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (bwt >> bit) & 1 == 1
            packed = np.packbits(np.r_[ones, np.zeros(-n % 64 + 64, bool)], bitorder="little").view("<u8")
            block = np.r_[0, np.cumsum(np.bitwise_count(packed))[:-1]].astype(np.int64)
            zeros = n - int(ones.sum())
            self.levels.append((bit, packed, block, zeros))
            bwt = np.r_[bwt[~ones], bwt[ones]]
            origin = self._down(origin, (symbols >> bit) & 1 == 1, packed, block, zeros)
        self.origin = origin

    @staticmethod
    def _down(i, right, packed, block, zeros):
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        rank1 = block[word] + np.bitwise_count(packed[word] & below)
        return np.where(right, zeros + rank1, i - rank1)

    def step(self, lo, hi, c):
        """Intervals of c + pattern from the intervals of the pattern."""
        both = np.r_[lo, hi]
        right = np.r_[c, c]
        for bit, packed, block, zeros in self.levels:
            both = self._down(both, (right >> bit) & 1 == 1, packed, block, zeros)
        both += np.r_[self.first[c], self.first[c]] - np.r_[self.origin[c], self.origin[c]]
        return both[:len(lo)], both[len(lo):]


def smallest_owner(units: list[list], owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each unit (list of words), the smallest owner of a
    unit with that window; and the number of windows of each unit."""
    size = np.array([len(u) for u in units])
    flat = [w for u in units for w in u]
    ids, vocab = pd.factorize(np.array(flat, dtype=object))
    text = np.zeros(len(flat) + len(units), np.int64)  # 0 ends a unit
    begin = np.cumsum(size + 1) - size - 1
    place = np.arange(len(flat)) + np.repeat(np.arange(len(units)), size)
    text[place] = ids + 1
    unit = np.repeat(np.arange(len(units)), size + 1)
    windows = size - width + 1
    start = np.arange(windows.sum()) + np.repeat(begin - (np.cumsum(windows) - windows), windows)
    fm = FMIndex(text, len(vocab) + 1, width)
    best = owner[unit[start]].copy()
    c = text[start + width - 1]
    lo, hi, live = fm.first[c], fm.first[c + 1], np.arange(len(start))
    for k in range(width - 2, -1, -1):
        more = hi - lo > 1
        live, lo, hi = live[more], lo[more], hi[more]
        if not len(live):
            return best, windows
        lo, hi = fm.step(lo, hi, text[start[live] + k])
    more = hi - lo > 1
    live, lo, hi = live[more], lo[more], hi[more]
    if len(live):
        lo, at, inverse = np.unique(lo, return_index=True, return_inverse=True)
        hi = hi[at]
        cover = np.arange((hi - lo).sum()) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
        least = np.minimum.reduceat(owner[unit[fm.sa[cover]]], np.cumsum(hi - lo) - (hi - lo))
        best[live] = least[inverse]
    return best, windows


# ------------------------------------------------------------ Spark

def _shard_answers(units: DataFrame, width: int) -> DataFrame:
    """units (k1, k2, owner, words) -> (k1, k2, least array<long>)."""
    total = units.agg(F.coalesce(F.sum(F.length("words")), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // (6 * SHARD_WORDS)))

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        best, windows = smallest_owner([w.split(" ") for w in pdf["words"]], pdf["owner"].to_numpy(), width)
        return pd.DataFrame({"k1": pdf["k1"], "k2": pdf["k2"],
                             "least": np.split(best, np.cumsum(windows)[:-1])})

    return (units.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)).cast("int"))
            .groupBy("shard").applyInPandas(answer, "k1 long, k2 long, least array<long>"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = WIDTH) -> DataFrame:
    """(doc_id, starts array<int>): where the document's windows start that
    also start in a document with a smaller id. Null ids have none."""
    spark = docs.sparkSession
    prepare(spark)
    texts = ids_and_texts(docs, id_col, text_col).where("doc_id is not null")

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            parts = []
            for d, t in zip(pdf["doc_id"], pdf["text"]):
                got = fragments(t.encode().split(), width, MINIMIZER)
                if got is not None:
                    begin, count, low, content = got
                    parts.append((np.full(len(begin), d), begin.astype(np.int32), count.astype(np.int32),
                                  low.view(np.int64), content.view(np.int64)))
            if parts:
                d, b, c, m, h = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"mv": m, "fh": h, "doc_id": d, "pos": b, "n": c})

    every = staged(texts.mapInPandas(cut, "mv long, fh long, doc_id long, pos int, n int"), "fragments")
    again = every.groupBy("mv").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("mv")
    held = staged(every.join(again, "mv", "left_semi"), "repeated")

    first = held.groupBy("mv", "fh", "n").agg(F.min(F.struct("doc_id", "pos")).alias("f"))
    kinds = first.groupBy("mv").agg((F.count(F.lit(1)) > HOT_FRAGMENTS).alias("hot"))
    wanted = (first.join(kinds, "mv").select("f.doc_id", F.struct("mv", "fh", "n", "f.pos", "hot").alias("w"))
              .groupBy("doc_id").agg(F.collect_list("w").alias("want")))

    def take(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for d, t, want in zip(pdf["doc_id"], pdf["text"], pdf["want"]):
                words = t.encode().split()
                for w in want:
                    a, n = w["pos"], w["n"]
                    if not w["hot"]:
                        out.append((w["mv"], w["fh"], -1, d, b" ".join(words[a:a + n + width - 1]).decode()))
                    else:
                        out += [(w["mv"], w["fh"], i, d, b" ".join(words[a + i:a + i + width]).decode())
                                for i in range(n)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=["mv", "fh", "off", "owner", "words"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["mv", "fh", "off", "owner", "words"])

    units = staged(texts.join(wanted, "doc_id").mapInPandas(
        take, "mv long, fh long, off int, owner long, words string"), "units")
    plain = units.where("off < 0").select(F.col("mv").alias("k1"), F.col("fh").alias("k2"), "owner", "words",
                                          F.col("mv").alias("route")).dropDuplicates(["k1", "k2"])
    single = units.where("off >= 0").withColumn("k1", F.xxhash64("words")).withColumn("k2", F.xxhash64(F.lit(1), "words"))
    windows = single.groupBy("k1", "k2", "words").agg(F.min("owner").alias("owner"))
    answers = staged(_shard_answers(plain.union(windows.select("k1", "k2", "owner", "words", F.col("k1").alias("route"))),
                                    width), "answers")
    hot = (single.select("k1", "k2", "mv", "fh", "off").join(answers, ["k1", "k2"])
           .groupBy("mv", "fh").agg(F.array_sort(F.collect_list(F.struct("off", F.col("least")[0].alias("m")))).alias("a"))
           .select("mv", "fh", F.col("a.m").alias("least")))
    known = plain.select("k1", "k2").join(answers, ["k1", "k2"]).select(F.col("k1").alias("mv"), F.col("k2").alias("fh"), "least")
    starts = (held.join(known.union(hot), ["mv", "fh"])
              .select("doc_id", F.filter(F.transform("least", lambda m, i: F.when(m < F.col("doc_id"), F.col("pos") + i)),
                                         lambda x: x.isNotNull()).alias("s")).where(F.size("s") > 0))
    return starts.groupBy("doc_id").agg(F.flatten(F.collect_list("s")).alias("starts"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (hex
    SHA-256 of the kept words joined by one space).

    Null and empty texts have no words. A doc_id names one text: its repeated
    rows are judged alike and do not count against each other. Null ids keep
    all their words. An empty table gives no rows; other columns are ignored."""
    texts = ids_and_texts(docs, id_col, text_col)
    starts = repeated_windows(docs, id_col, text_col, width)

    def settle(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for t, s in zip(pdf["text"], pdf["starts"]):
                words = t.encode().split()
                n = len(words)
                if s is not None and len(s):
                    s = np.asarray(s)
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, s, 1)
                    np.add.at(change, s + width, -1)
                    stay = np.cumsum(change)[:n] == 0
                    words = [w for w, k in zip(words, stay.tolist()) if k]
                out.append((n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
            got = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256"])
            got.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield got

    return (texts.join(starts, "doc_id", "left").select("doc_id", "text", "starts")
            .mapInPandas(settle, "doc_id long, n_words long, n_removed long, kept_sha256 string"))
