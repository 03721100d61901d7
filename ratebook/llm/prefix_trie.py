"""Prefix trie of conversations by fixed-length blocks of turns.

A turn is known by a digest of its role and text; texts stay behind at the
first scan. The fingerprint of a prefix is the exclusive-or of hashes of
(position, turn digest), so a prefix fingerprint is a running aggregate that
any split of a long conversation can continue.

Conversations are grouped by their successive blocks of ``BLOCK`` turns first:
a block is known by the fingerprint of the conversation up to its end, its
parent by that up to its start. Only where a parent has several distinct
blocks do their turn boundaries need a look: those blocks, each already one
row with its number of conversations, are cut into turns and grouped by turn
fingerprint. A block without siblings is a plain chain, cut without a shuffle.

Sums over subtrees need no walk over levels. Every node belongs to its smallest
member; the nodes of one conversation are then the lower end of its path. With
T(c) the weight of all nodes of c, the subtree of a node weighs the sum of T
over its members, less what its own conversation holds above it: one more
grouping by blocks and turns.

No step gathers a group: aggregates are partial first, per-conversation and
per-node runs are computed over bounded stretches (``STRETCH``), hot join keys
meet copies of the other side per stretch or are split by AQE, and member
lists are hashed from a sorted stream of joined chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.llm.common import prepare, shuffle_partitions, staged
from ratebook.operators.order import rank_within

BLOCK = 4
STRETCH = 4096
FP = ["hi", "lo"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, pos, digest, chars): turns numbered from 0 by turn (null
    first), equal turns by digest, so repeated rows stay and ties have one
    order. Rows without a conversation id belong to none and are left out."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in (role_col, text_col))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(conversations[conv_col].cast("long").alias("conv_id"), conversations[turn_col].alias("turn"),
                                F.unhex(F.substring(F.sha2(named, 256), 1, 32)).alias("digest"),
                                F.length(text).cast("long").alias("chars")).where("conv_id is not null")
    ranked = rank_within(rows, ["conv_id"], ["turn", "digest"], "pos", checkpoint=True)
    return ranked.select("conv_id", "pos", "digest", "chars")


def shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """``turns`` of conversations rebuilt to share heads: conversation c gets
    the first h turns of conversation c - c % group, then its own behind its
    first h; h is crc32 of the decimal id, modulo ``most``. Positions run on
    without a gap; a conversation left without a turn has no row here."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    base = F.col("conv_id") - F.col("conv_id") % group
    ends = turns.groupBy("conv_id").agg(F.max("pos").alias("last"))
    heads = (turns.where((F.col("pos") < most) & (F.col("conv_id") == base)).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("head"))
             .withColumnRenamed("conv_id", "base"))
    # One row per conversation; at most ``group`` of them meet one head.
    plan = staged(ends.withColumn("base", base).join(heads, "base", "left").select(
        "conv_id", "last", h.alias("h"), F.slice(F.coalesce("head", F.array()), F.lit(1), h.cast("int")).alias("head")), "heads")
    given = plan.select("conv_id", F.inline("head"))
    # Where the head is shorter than h, the own turns move up. Such a
    # conversation has one row of the plan for every stretch of its turns.
    short = plan.where(F.size("head") < F.col("h")).select(
        "conv_id", (F.col("h") - F.size("head")).alias("up"),
        F.explode(F.sequence(F.lit(0), (F.col("last") / STRETCH).cast("long"))).alias("at"))
    own = (turns.where(F.col("pos") >= h).withColumn("at", (F.col("pos") / STRETCH).cast("long"))
           .join(short, ["conv_id", "at"], "left")
           .select("conv_id", (F.col("pos") - F.coalesce("up", F.lit(0))).alias("pos"), "digest", "chars"))
    return given.select("conv_id", F.col("pos").cast("long").alias("pos"), "digest", "chars").union(own)


def _running(rows: DataFrame, key: str, at: str, columns: dict[str, str], combine) -> DataFrame:
    """``rows`` with, for every (name, new name) of ``columns``, the aggregate
    ``combine`` of name over the rows of ``key`` before this one by ``at``;
    null for the first. Rows meet in stretches of ``STRETCH``; what lies before
    a stretch is joined to it."""
    stretch = (F.col(at) / STRETCH).cast("long")
    within = Window.partitionBy(key, "stretch").orderBy(at)
    inside = rows.withColumn("stretch", stretch)
    inside = inside.select("*", *[combine(F.col(c)).over(within.rowsBetween(Window.unboundedPreceding, -1)).alias(n)
                                  for c, n in columns.items()])
    # Only keys that reach past their first stretch have anything before one.
    sums = rows.withColumn("stretch", stretch).groupBy(key, "stretch").agg(
        *[combine(F.col(c)).alias(n) for c, n in columns.items()])
    over = Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    longer = sums.groupBy(key).agg(F.max("stretch").alias("most")).where("most > 0").select(key)
    before = (sums.join(longer, key, "left_semi")
              .select(key, "stretch", *[combine(F.col(n)).over(over).alias(f"{n}_0") for n in columns.values()])
              .where("stretch > 0"))
    joined = inside.join(before, [key, "stretch"], "left")
    parts = [F.array_compact(F.array(n, f"{n}_0")) for n in columns.values()]
    return joined.select(*[F.col(c) for c in rows.columns],
                         *[_fold(p, combine).alias(n) for p, n in zip(parts, columns.values())])


def _fold(values: Column, combine) -> Column:
    """The one or two values of an array, combined as ``combine`` does."""
    both = values[0].bitwiseXOR(values[1]) if combine is F.bit_xor else values[0] + values[1]
    return F.when(F.size(values) == 2, both).when(F.size(values) == 1, values[0])


def _fingerprint(pos: Column, digest: Column) -> list[Column]:
    return [F.xxhash64(F.lit(lane), pos, digest) for lane in (1, 2)]


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, k, depth, up_hi, up_lo, hi, lo, turns): one row per block of
    ``BLOCK`` turns of a conversation; depth and hi, lo belong to its end,
    up_hi, up_lo to its start; turns holds (hi, lo, chars) of each turn."""
    hi, lo = _fingerprint(F.col("pos"), F.col("digest"))
    rows = turns.select("conv_id", (F.col("pos") / BLOCK).cast("long").alias("k"),
                        F.struct("pos", hi.alias("hi"), lo.alias("lo"), "chars").alias("turn"))
    cut = rows.groupBy("conv_id", "k").agg(F.sort_array(F.collect_list("turn")).alias("turns"),
                                           F.bit_xor("turn.hi").alias("own_hi"), F.bit_xor("turn.lo").alias("own_lo"))
    cut = staged(cut, "cut")
    run = _running(cut, "conv_id", "k", {"own_hi": "up_hi", "own_lo": "up_lo"}, F.bit_xor)
    up = {f"up_{x}": F.coalesce(f"up_{x}", F.lit(0).cast("long")) for x in FP}
    return run.select("conv_id", "k", (F.col("k") * BLOCK + F.size("turns")).alias("depth"),
                      *[c.alias(n) for n, c in up.items()], *[up[f"up_{x}"].bitwiseXOR(F.col(f"own_{x}")).alias(x) for x in FP],
                      F.transform("turns", lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["chars"].alias("chars"))
                                  ).alias("turns"))


def _cut(distinct: DataFrame, measures: list[str]) -> DataFrame:
    """Turn boundaries of distinct blocks: (depth, hi, lo, up_hi, up_lo, chars)
    and the block's measures, one row per turn."""
    zero = F.struct(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))
    # The start of the block, then the fingerprint behind each of its turns.
    chain = F.aggregate("turns", F.array(zero), lambda acc, t: F.concat(acc, F.array(F.struct(
        F.element_at(acc, -1)["hi"].bitwiseXOR(t["hi"]).alias("hi"),
        F.element_at(acc, -1)["lo"].bitwiseXOR(t["lo"]).alias("lo")))))
    steps = distinct.select("k", "turns", *measures, F.posexplode(F.slice(chain, 1, F.size("turns"))).alias("i", "start"))
    turn = F.col("turns")[F.col("i")]
    return steps.select(
        (F.col("k") * BLOCK + F.col("i") + 1).alias("depth"),
        F.col("start.hi").bitwiseXOR(turn["hi"]).alias("hi"), F.col("start.lo").bitwiseXOR(turn["lo"]).alias("lo"),
        F.col("start.hi").alias("up_hi"), F.col("start.lo").alias("up_lo"), turn["chars"].alias("chars"), *measures)


def grouped(cut: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row per node but the root: (depth, hi, lo, up_hi, up_lo, chars) and
    ``measures``, aggregates that can be taken of themselves again."""
    key = ["k", "depth", *FP]
    distinct = staged(cut.groupBy(*key).agg(
        *[m.alias(n) for n, m in measures.items()],
        *[F.first(c).alias(c) for c in ("up_hi", "up_lo", "turns")]), "blocks")
    # Blocks whose parent has no other; the root may be the parent of all
    # first blocks, so it is counted by partial aggregates, not by a window.
    alone = (distinct.groupBy("k", "up_hi", "up_lo")
             .agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("depth", *FP)])
             .where("n = 1").select(*key))
    names = list(measures)
    again = {n: (F.min if n == "conv_id" else F.sum)(n) for n in names}
    chains = _cut(distinct.join(alone, key, "left_semi"), names)
    diverging = (_cut(distinct.join(alone, key, "left_anti"), names).groupBy("depth", *FP)
                 .agg(*[F.first(c).alias(c) for c in ("up_hi", "up_lo", "chars")], *[c.alias(n) for n, c in again.items()]))
    return chains.unionByName(diverging)


def _member_hashes(ends: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256) from (depth, hi, lo, conv_id): SHA-256 of
    the ids in ascending order, comma-joined. Sorted ids are joined into a
    chunk per Arrow batch in parallel; one task streams the few chunks of a
    node, it never holds them."""
    spark = ends.sparkSession
    n = shuffle_partitions(spark)
    key = ["depth", *FP]

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = pdf.assign(ids=pdf["conv_id"].astype(str)).groupby(key, sort=False)
            yield got.agg(first=("conv_id", "first"), ids=("ids", ",".join)).reset_index()[[*key, "first", "ids"]]

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for pdf in batches:
            out = []
            for *now, ids in pdf[[*key, "ids"]].itertuples(index=False, name=None):
                if now == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = now, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*key, "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*key, "ends_sha256"])

    types = "depth long, hi long, lo long"
    runs = (ends.repartitionByRange(n, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
            .mapInPandas(chunks, f"{types}, first long, ids string"))
    return (runs.repartition(n, *key).sortWithinPartitions(*key, "first")
            .select(*key, "ids").mapInPandas(digests, f"{types}, ends_sha256 string"))


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The trie's nodes from ``turns`` (conv_id, pos, digest, chars) and all
    ``members`` (conv_id, once each; also those without a turn): conv_id (the
    smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Without members: no rows."""
    cut = staged(blocks(turns), "conversation_blocks")
    zero = F.lit(0).cast("long")
    root = [zero.alias("depth"), zero.alias("hi"), zero.alias("lo")]
    first = {"n_convs": F.count(F.lit(1)), "conv_id": F.min("conv_id")}
    top = members.agg(*[c.alias(n) for n, c in first.items()]).where("n_convs > 0")
    node = ["depth", *FP, "up_hi", "up_lo", "chars"]
    nodes = staged(grouped(cut, first).select(*node, *first)
                   .union(top.select(*root, F.lit(None).cast("long"), F.lit(None).cast("long"), zero, *first)), "nodes")

    key = ["depth", *FP]
    # Where each conversation ends: its last block, or the root.
    last = cut.groupBy("conv_id").agg(F.max(F.struct("depth", *FP)).alias("end")).select("conv_id", "end.*")
    last = staged(members.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in key]), "ends")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"),
                                               F.col("up_lo").alias("lo")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", zero))
                   .withColumn("weight", (F.col("n_convs") - 1) * F.col("chars")), "counted")

    # What the nodes of a conversation weigh, and whether one is childless.
    own = nodes.groupBy("conv_id").agg(F.sum("weight").alias("total"),
                                       F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"))
    own = staged(own.join(last.select("conv_id", F.col("depth").alias("deepest")), "conv_id").select(
        "conv_id", "total", "leaf", "deepest"), "owners")
    spread = own.withColumn("stretch", F.explode(F.sequence(zero, (F.col("deepest") / (BLOCK * STRETCH)).cast("long"))))
    owned = staged(cut.withColumn("stretch", (F.col("k") / STRETCH).cast("long"))
                   .join(spread.select("conv_id", "stretch", "total", "leaf"), ["conv_id", "stretch"])
                   .drop("conv_id", "stretch"), "owned_blocks")
    sums = {"total": F.sum("total"), "leaf": F.sum("leaf")}
    below = (grouped(owned, sums).select(*key, *sums)
             .union(own.agg(*[c.alias(n) for n, c in sums.items()]).where("total is not null").select(*root, *sums)))
    above = _running(nodes, "conv_id", "depth", {"weight": "above"}, F.sum)

    found = staged(above.join(below, key).join(_member_hashes(last), key, "left").select(
        *key, "up_hi", "up_lo", "conv_id", "n_convs", "n_children", F.col("leaf").alias("n_leaves"),
        (F.col("total") - F.coalesce("above", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")), "measured")
    # A node with very many children is a hot key here; this written join is
    # one that AQE may split.
    parent = found.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"),
        F.col("conv_id").alias("parent_conv_id"))
    out = found.join(parent, ["depth", "up_hi", "up_lo"], "left")
    return staged(out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                             "ends_sha256"), "trie")


def conversation_trie(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text) rebuilt by
    ``shared_heads``. Null roles and texts are empty ones, null turns come
    first, rows with a null conv_id are left out, repeated rows are turns of
    their own; other columns play no part. An empty table gives no rows."""
    prepare(conversations.sparkSession)
    turns = staged(turn_rows(conversations), "turns")
    members = turns.where("pos = 0").select("conv_id")
    return trie(shared_heads(turns, group, most), members)
