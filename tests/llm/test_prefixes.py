"""The prefix trie against tries built by hand, on odd rows as well."""

from __future__ import annotations

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from emberwave.llm import prefixes

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_hand(rows):
    turns = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(xs)] for c, xs in turns.items()}
    whole = {}
    for c, xs in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + xs[h:])
    members = collections.defaultdict(list)
    for c, xs in whole.items():
        for d in range(len(xs) + 1):
            members[xs[:d]].append(c)
    children = collections.Counter(x[:-1] for x in members if x)
    leaves, saved = collections.Counter(), collections.Counter()
    for x, cs in members.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += not children[x]
            saved[x[:d]] += (len(cs) - 1) * len(x[-1][1]) if x else 0
    said = lambda x: hashlib.sha256(",".join(map(str, sorted(c for c in members[x] if whole[c] == x))).encode()).hexdigest()
    return collections.Counter((min(cs), len(x), min(members[x[:-1]]) if x else None, len(cs), children[x], leaves[x], saved[x], said(x)) for x, cs in members.items())


ODD = [
    (None, 0, "user", "belongs nowhere"),
    (0, None, "user", "first of all"),
    (0, 3, None, None),
    (0, 1, "user", "tie b"),
    (0, 1, "user", "tie a"),
    (0, 1, "user", "tie a"),
    (7, 2, "user", ""),
    (9, 2, "user", "é\U0001f642"),
    (-5, 0, "user", "first of all"),
    (-105, 0, "user", "x"),
    (-205, 0, "user", "y"),
    (12345678901, 0, "user", "no base"),
    *[(300 + c, t, "user", f"turn {t}") for c in range(60) for t in range(3 + c % 2)],
    *[(512, t, "user", f"long {t % 3}") for t in range(700)],
    *[(513, t, "user", f"long {t % 3}") for t in range(650)],
    *[(500, t, "user", f"long {t % 3}") for t in range(9)],
    (401, 0, "a", "b"),
    (402, 0, "", "1:b"),
    (403, 0, "a:1", "b"),
]


@pytest.mark.parametrize("block", [prefixes.BLOCK, 3])
def test_trie_by_hand(spark, small, block):
    own = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = ODD + [(c + 10_000, *x) for c, *x in own]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for name in ("node", "parent", "depth", "part", "at", "digest", "chars", "last", "jump", "s1", "x1", "block", "number"):
        frame = frame.withColumn(name, F.lit(name))
    found = prefixes.prefix_trie(frame, block)
    assert collections.Counter(tuple(r[c] for c in COLUMNS) for r in found.collect()) == by_hand(rows)


def test_no_conversations(spark, small):
    frame = spark.read.parquet(f"{small}/conversations.parquet")
    assert prefixes.prefix_trie(frame.limit(0)).count() == 0
    assert prefixes.prefix_trie(frame.withColumn("conv_id", F.lit(None).cast("long"))).count() == 0


def test_turnless_conversations(spark):
    """Conversations whose own turns all go, without a base, are members of the root alone."""
    ids = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1][:3]
    found = prefixes.prefix_trie(spark.createDataFrame([(c, 0, "user", "x") for c in ids], "conv_id long, turn long, role string, text string"))
    want = (ids[0], 0, None, 3, 0, 1, 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert [tuple(r[c] for c in COLUMNS) for r in found.collect()] == [want]


def test_hot_keys_are_looked_up_by_broadcast(spark):
    left = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("key"))
    right = spark.range(10_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    counts = left.groupBy("key").agg(F.count("*").alias("n_in"))
    found = prefixes.looked_up(left, "key", counts, 10_000, right)
    assert found.count() == 10_000 and found.where("value <> 2 * key").count() == 0
