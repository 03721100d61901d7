"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into 16-bit segments and indexed once per segment. A query
looks up each segment's values at radius 0, 1, 2, ... around its own. Once
segments 0..s are searched to radius r and the others to r - 1, every code
within r * segments + s bits has been met (otherwise each segment would differ
by more than searched), so the search stops as soon as k verified distances
lie within that bound: the k-th is provably covered.

Scale. Rows of equal code keep only the k smallest ids, which is all an exact
answer can hold (a group limit before the shuffle, so a hot code costs k rows
per task). Codes and queries are dealt into blocks; a pair of blocks is one
unit of work that returns at most k rows per query, and the units' answers are
merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratebook.llm.common import prepare, shuffle_partitions, staged

BLOCK = 16_384
QUERY_BLOCK, LEAST_QUERIES = 1_024, 64


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(id, code): one bit per component, set where it is above zero, padded
    to 16-bit segments. Null vectors and those of another length have none."""
    prepare(vectors.sparkSession)

    def pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            x = np.array([np.asarray(v, dtype=float) for v in pdf["v"]]).reshape(len(pdf), dims)
            bits = np.packbits(np.pad(x > 0, ((0, 0), (0, -dims % 16))), axis=1)
            yield pd.DataFrame({"id": pdf["id"], "code": [r.tobytes() for r in bits]})

    return (vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v"))
            .where((F.size("v") == dims) & F.col("id").isNotNull()).mapInPandas(pack, "id long, code binary"))


class MultiIndex:
    """Per-segment lookup tables of a block of codes."""

    def __init__(self, segments: np.ndarray):
        self.segments = segments  # (n, m) uint16
        self.tables = []
        for s in range(segments.shape[1]):
            value = segments[:, s].astype(np.int64)
            self.tables.append((np.argsort(value, kind="stable"),
                                np.r_[0, np.cumsum(np.bincount(value, minlength=1 << 16))]))

    def nearest(self, query: np.ndarray, ids: np.ndarray, k: int, masks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k smallest by (distance, id)."""
        n, m = self.segments.shape
        distance = np.full(n, -1, np.int64)
        within = np.zeros(m * 16 + 1, np.int64)
        for radius in range(17):
            for s, (order, start) in enumerate(self.tables):
                value = int(query[s]) ^ masks[radius]
                lo, size = start[value], start[value + 1] - start[value]
                full = size > 0
                lo, size = lo[full], size[full]
                rows = order[np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)]
                rows = rows[distance[rows] < 0]
                if len(rows):
                    distance[rows] = np.bitwise_count(self.segments[rows] ^ query).sum(1)
                    within += np.bincount(distance[rows], minlength=len(within))
                if within[:radius * m + s + 1].sum() >= min(k, n):
                    met = np.flatnonzero(distance >= 0)
                    best = met[np.lexsort((ids[met], distance[met]))][:k]
                    return best, distance[best]
        raise AssertionError("radius 16 covers every code")


def radius_masks() -> list[np.ndarray]:
    return [np.array([sum(1 << b for b in c) for c in combinations(range(16), r)], np.int64) for r in range(17)]


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, distance): for each row of ``queries`` (id, code)
    the k rows of ``codes`` (id, code) that are nearest by (Hamming distance,
    id); a query that is itself a row finds itself. Repeated (id, code) rows
    count once; codes must be of one length; empty tables give no rows."""
    codes = codes.select("id", "code").distinct()
    few = Window.partitionBy("code").orderBy("id")
    kept = codes.withColumn("n", F.row_number().over(few)).where(F.col("n") <= k).drop("n")
    n, nq = kept.count(), queries.select("code").distinct().count()
    blocks = max(1, -(-n // BLOCK))
    # Blocks of queries bounded by size, and as many as give every task a unit
    # while the blocks of codes alone are fewer than the tasks.
    tasks = shuffle_partitions(codes.sparkSession)
    query_blocks = max(1, -(-nq // QUERY_BLOCK), min(-(-nq // LEAST_QUERIES), -(-tasks // blocks)))
    units = min(blocks * query_blocks, max(tasks, blocks))
    rows = (kept.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
            .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    asks = (queries.select("code").distinct().withColumn("q", F.pmod(F.xxhash64("code"), F.lit(query_blocks)).cast("int"))
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def search(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held) and len(asked):
            ids = held["id"].to_numpy()
            index = MultiIndex(np.frombuffer(b"".join(held["code"]), np.uint16).reshape(len(held), -1))
            masks = radius_masks()
            for code in asked["code"]:
                best, distance = index.nearest(np.frombuffer(code, np.uint16), ids, k, masks)
                out.append(pd.DataFrame({"code": code, "id": ids[best], "distance": distance}))
        return pd.concat(out) if out else pd.DataFrame({"code": [], "id": [], "distance": []})

    # A stated number of partitions: units are work, however few bytes they have.
    rows, asks = rows.repartition(units, "b", "q"), asks.repartition(units, "b", "q")
    found = rows.groupBy("b", "q").cogroup(asks.groupBy("b", "q")).applyInPandas(search, "code binary, id long, distance int")
    place = Window.partitionBy("code").orderBy("distance", "id")
    best = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return (queries.select(F.col("id").alias("query_id"), "code").distinct().join(best, "code")
            .select("query_id", "rank", "id", "distance"))


def top_k(vectors: DataFrame, id_col: str, vector_col: str, dims: int, k: int, every: int = 100) -> DataFrame:
    """``nearest_codes`` of the rows whose id is divisible by ``every``
    against all rows, on the sign codes of ``vectors``."""
    codes = staged(sign_codes(vectors, id_col, vector_col, dims), "codes")
    return nearest_codes(codes, codes.where(F.col("id") % every == 0), k)
