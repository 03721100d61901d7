"""SimHash near-duplicates over a Gray-order hierarchical index.

``fingerprints`` computes a 64-bit SimHash of each text's word shingles.
``near_duplicates`` links fingerprints that differ in at most ``max_bits``
bits and returns every document's connected component.

The index. With ``max_bits + 1`` blocks of bits, two fingerprints within the
bound agree on one whole block. A block's mask and value are the topmost
factored nodes: a fingerprint belongs to one node per block (accumulated
difference 0), and only nodes travel. Below a node the fingerprints are
sorted by Gray rank and packed bottom-up into groups of ``FAN_OUT``; each
group keeps the bit pattern its members share and the mask of the shared bits.
A pair of groups is descended into only while the differences accumulated on
bits shared by both stay within the bound, so whole groups are pruned.

Scale. Copies collapse to one fingerprint with its smallest document first.
A node with more than ``NODE_LIMIT`` fingerprints is cut into hash parts and
each pair of parts is its own unit of work, so no task holds a whole hot node.
A unit returns at most one link per fingerprint (a spanning forest of what it
linked), never all pairs, and groups already connected are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import ids_and_texts, prepare, staged
from ratebook.llm.components import components

FAN_OUT = 8
NODE_LIMIT = 40_000
UNIT_ROWS = 100_000
PAIR_CHUNK = 1 << 15
HASH_CHUNK = 1 << 16


def simhash(text: str, shingle: int) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles, repeats
    included; fewer words than a shingle: the whole sequence; none: zero."""
    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return 0
    buf = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(buf, 42)
    length = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(length + 1) - 1
    starts = (ends - length)[: n - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(buf[a:b], 42) for a, b in zip(starts, ends)], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), HASH_CHUNK):
        part = hashes[i:i + HASH_CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * ones > len(hashes))
    return sum(1 << int(b) for b in bits)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the SimHash as a signed 64-bit number."""
    prepare(docs.sparkSession)

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            fp = np.array([simhash(t, shingle) for t in pdf["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fp.view(np.int64)})

    return ids_and_texts(docs, id_col, text_col).mapInPandas(batches, "doc_id long, fp long")


# ------------------------------------------------------------ the index

def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of a code in the reflected Gray sequence (prefix xor)."""
    rank = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest-index component labels after adding links a-b."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        label = label.copy()
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _levels(node: np.ndarray, code: np.ndarray) -> list[dict]:
    """Bottom-up groups: for each level the shared pattern (``all``: bits set
    in every member, ``any``: in some) and the range of children."""
    levels = [{"node": node, "all": code, "any": code}]
    while len(levels[-1]["node"]) > len(np.unique(levels[-1]["node"])):
        low = levels[-1]
        n = len(low["node"])
        first = np.r_[True, low["node"][1:] != low["node"][:-1]]
        begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        cut = np.flatnonzero((np.arange(n) - begin) % FAN_OUT == 0)
        levels.append({"node": low["node"][cut], "from": cut, "to": np.r_[cut[1:], n],
                       "all": np.bitwise_and.reduceat(low["all"], cut),
                       "any": np.bitwise_or.reduceat(low["any"], cut)})
    return levels


def _uniform(levels: list[dict], label: np.ndarray) -> None:
    """The label all members of a group share, else -1."""
    low, high = label, label
    levels[0]["label"] = label
    for lev in levels[1:]:
        low, high = np.minimum.reduceat(low, lev["from"]), np.maximum.reduceat(high, lev["from"])
        lev["label"] = np.where(low == high, low, -1)


def link_units(node: np.ndarray, code: np.ndarray, max_bits: int) -> np.ndarray:
    """Component label (index of a member) of each fingerprint, linking those
    of equal ``node`` within ``max_bits``; arrays sorted by (node, Gray rank)."""
    n = len(code)
    label = np.arange(n)
    for step in (1, 2, 3):  # neighbours in Gray order: most links of a dense group
        a = np.arange(max(0, n - step))
        near = (node[a] == node[a + step]) & (np.bitwise_count(code[a] ^ code[a + step]) <= max_bits)
        label = merge_labels(label, a[near], a[near] + step)
    levels = _levels(node, code)
    _uniform(levels, label)
    roots = np.arange(len(levels[-1]["node"]))
    stack = [(len(levels) - 1, roots[i:i + PAIR_CHUNK], roots[i:i + PAIR_CHUNK])
             for i in range(0, len(roots), PAIR_CHUNK)]
    while stack:
        at, a, b = stack.pop()
        lev = levels[at]
        same = (lev["label"][a] >= 0) & (lev["label"][a] == lev["label"][b])
        a, b = a[~same], b[~same]
        if not len(a):
            continue
        if at == 0:
            fresh = merge_labels(label, a, b)
            if fresh is not label:
                label = fresh
                _uniform(levels, label)
            continue
        sub = levels[at - 1]
        na, nb = lev["to"][a] - lev["from"][a], lev["to"][b] - lev["from"][b]
        size = na * nb
        pair = np.repeat(np.arange(len(a)), size)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        x = lev["from"][a][pair] + k // nb[pair]
        y = lev["from"][b][pair] + k % nb[pair]
        keep = x < y if at == 1 else x <= y
        x, y = x[keep], y[keep]
        shared = ~(sub["all"][x] ^ sub["any"][x]) & ~(sub["all"][y] ^ sub["any"][y])
        near = np.bitwise_count((sub["all"][x] ^ sub["all"][y]) & shared) <= max_bits
        x, y = x[near], y[near]
        stack += [(at - 1, x[i:i + PAIR_CHUNK], y[i:i + PAIR_CHUNK]) for i in range(0, len(x), PAIR_CHUNK)]
    return label


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of max_bits + 1 blocks that cover 64 bits."""
    k = max_bits + 1
    cuts = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def links(codes: DataFrame, max_bits: int = 4) -> DataFrame:
    """(fp, rep) distinct fingerprints -> (u, v) links between representatives
    that connect exactly what the bound connects."""
    spark = codes.sparkSession
    nodes = codes.select("fp", "rep", F.posexplode(F.array(
        *[F.shiftrightunsigned("fp", s).bitwiseAND((1 << w) - 1) for s, w in _blocks(max_bits)]))
        .alias("block", "value"))
    nodes = nodes.select("fp", "rep", (F.col("value") * 64 + F.col("block")).alias("node"))
    # One row per top node: at most (max_bits + 1) * 2^13 rows for the default bound.
    size = staged(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "nodes")
    total = size.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    many = size.where(F.col("n") > 1)
    if max_bits >= 3:  # blocks of at most 16 bits: the row count above is a fixed bound
        many = F.broadcast(many)
    parts = F.ceil(F.col("n") / F.lit(float(NODE_LIMIT))).cast("int")
    units = (nodes.join(many, "node")
             .withColumn("own", F.pmod(F.xxhash64("fp"), parts).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("fp", "rep", "node", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j")))
    groups = max(1, -(-int(total) // UNIT_ROWS) * 4)
    units = units.withColumn("g", F.pmod(F.xxhash64("node", "i", "j"), F.lit(groups)).cast("int"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        code = pdf["fp"].to_numpy().view(np.uint64)
        unit = pdf.groupby(["node", "i", "j"], sort=False).ngroup().to_numpy()
        order = np.lexsort((gray_rank(code), unit))
        rep = pdf["rep"].to_numpy()[order]
        label = link_units(unit[order], code[order], max_bits)
        linked = label != np.arange(len(label))
        return pd.DataFrame({"u": rep[linked], "v": rep[label[linked]]})

    prepare(spark)
    return units.groupBy("g").applyInPandas(join, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id
    reachable over links of at most ``max_bits`` bits).

    Null and empty texts have fingerprint zero and link like any other; rows
    with equal text and even equal id are kept as rows; an empty table gives
    an empty result; other columns are ignored."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "simhash")
    codes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "codes")
    found = components(links(codes, max_bits))
    where = (codes.join(found, codes.rep == found.id, "left")
             .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return prints.join(where, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
