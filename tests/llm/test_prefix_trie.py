"""The prefix trie against a trie built turn by turn in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratebook.llm import prefix_trie as PT

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = own.get(base, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, len(path) == d))
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, got in members.items():
        ends = ",".join(str(c) for c, end in sorted(got) if end)
        up = min(members[node[:-1]])[0] if node else None
        out.append((min(got)[0], len(node), up, len(got), len(kids[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("pos", "digest", "chars", "h", "base", "head", "k", "depth", "stretch", "hi"):
        frame = frame.withColumn(name, F.lit("clash"))
    out = PT.conversation_trie(frame.repartition(5))
    assert out.columns == COLUMNS
    want = by_hand(rows)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    return want


def talk(n, seed, texts=3, longest=11):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"][t % 2:]), rng.choice(["hello", "é 中😀", "x" * 9][:texts]))
            for c in range(n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("seed", [1, 2])
def test_many_shared_prefixes(spark, seed):
    check(spark, talk(230, seed))


def test_stretches_and_blocks_of_two(spark, monkeypatch):
    monkeypatch.setattr(PT, "STRETCH", 3)
    monkeypatch.setattr(PT, "BLOCK", 2)
    check(spark, talk(150, 3, texts=2, longest=40))


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(PT, "STRETCH", 16)
    rows = talk(60, 4) + [(500, t, "user", f"turn {t}") for t in range(900)] + [(503, t, "user", f"turn {t}") for t in range(700)]
    check(spark, rows)


def test_one_prefix_holds_most_conversations(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(900) for t in range(5)] + [(c, 5, "bot", f"end {c % 3}") for c in range(0, 900, 2)]
    out = check(spark, rows)
    assert max(r[3] for r in out if r[1] == 1) > 300


def test_messy_rows(spark):
    rows = [(1, None, None, None), (1, None, "", ""), (1, 0, "user", None), (1, 0, "user", None), (1, 0, "user", "b"),
            (None, 0, "user", "no id"), (None, None, None, None), (2, 7, "user", "a"), (2, 3, "user", "b"), (100, 0, "", "a"),
            (105, 0, "a", ""), (-5, 1, "user", "n"), (-5, 2, "user", "n"), (0, 0, "user", "base"), (300, -4, "user", "L" * 200_000),
            (301, 0, "x", "y")] + [(301, t, "x", "y") for t in range(1, 9)]
    check(spark, rows)


def test_turnless_conversations_make_the_root(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    assert check(spark, [(c, 0, "user", "its own turn goes")]) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_empty_table(spark):
    check(spark, [])


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)
