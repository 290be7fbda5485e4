import hashlib
import random
import zlib

import pytest

from quarry.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, rebuild=True):
    """All nodes, from the definition."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(xs)] for c, xs in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        convs[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, ends, kids = {}, {}, {}
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
            if d:
                kids.setdefault(turns[:d - 1], set()).add(turns[:d])
        ends.setdefault(turns, []).append(c)

    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids.get(node, ())]
        charge = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(b[0] for b in below) or 1 if below else 1, sum(b[1] for b in below) + charge)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, ())), *totals[n],
                   hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest()) for n, m in members.items())


def made(rng, n):
    """Conversations with shared openings, of 0 to 40 turns."""
    rows = []
    for c in [*range(n), 1000, 1005, 2007, 2 ** 53 + 1]:
        for turn in range(rng.choice([1, 2, 5, 8, 40])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["", "a", "é😀", None]) if turn < 3 else rng.choice("xy") * 3))
        if c % 7 == 0:
            rows.append((c, None, "system", "first"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_equals_brute_force(spark, block):
    rows = made(random.Random(block), 130)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, T.prefix_trie(T.rebuilt(T.numbered_turns(df)), block).collect()))
    assert got == plain(rows)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(map(tuple, T.conversation_trie(df).collect())) == plain(rows)


def test_as_they_are(spark):
    rows = made(random.Random(3), 40)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, T.prefix_trie(T.plain_sequences(T.numbered_turns(df)), 8).collect()))
    assert got == plain(rows, rebuild=False)


def test_one_long_conversation_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(T, "JOINED", 3)
    rows = [(100, i, "user", f"{i % 10}") for i in range(3000)] + [(c, i, "user", f"{i % 10}") for c in range(101, 130) for i in range(c % 9)]
    rows += [(100 + 200 * k, 0, "user", "0") for k in range(1, 30)]
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        got = sorted(map(tuple, T.prefix_trie(T.rebuilt(T.numbered_turns(spark.createDataFrame(rows, SCHEMA))), 64).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got == plain(rows)


def test_nulls_ties_repeats_empty_and_clashing_columns(spark):
    schema = SCHEMA + ", conv long, depth long, n1 string"
    assert T.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, 0, "user", "lost"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b"), (2, None, None, None), (-3, 1, "user", "n")]
    got = sorted(map(tuple, T.conversation_trie(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema)).collect()))
    assert got == plain(rows)
