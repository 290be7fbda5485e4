"""A prefix trie over conversations by van Emde Boas recursion.

A node is a distinct sequence of first turns. No conversation is walked turn by
turn across tasks and no node holds a list of its members:

* Positions: turns are sorted once over all conversations. A task counts
  inside its range; only conversations that go on into the next range (at most
  one a range) get an offset.
* Names: a sequence is laid out in blocks of ``BLOCK`` turns, the recursion's
  lowest pieces, each named in one task. Above that, depth is halved: pieces
  are joined in pairs (upper and lower half of a span), the spans are solved
  recursively, which gives each span the name of the prefix that it hangs
  from, and the lower half hangs from that name joined with the upper half's.
  All pieces of a level are one job. Equal names are equal prefixes.
* The trie: nodes are the distinct names, parents the names one turn shorter.
* Totals: every node is charged to its smallest member. That member's row at
  each depth above carries the charge upward, as the recursion's sums are
  grafted back the same way; a node's total is the sum over its members' rows.
* The list of members that end in a node is hashed in order: sorted ids are
  joined into strings by range first, so a node with a third of all members is
  a few strings for the task that hashes it.

Turns are told apart by two 64-bit digests of role and text, names by 128 bits.

Defined cases: null role or text counts as empty; a null turn comes first;
turns of one number are ordered by role, then by a digest of role and text;
rows without a conversation id belong to none and are left out; rows repeated
outright are turns of their own; a conversation rebuilt to nothing ends in the
root; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, pick

BLOCK = 1024
HEADS = 6  # a rebuilt conversation takes 0 to 5 turns of its base
BASE = 100
JOINED = 10_000  # ids in one string
SALT = 7


def numbered_turns(df: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
                   text_column: str = "text") -> DataFrame:
    """(conv, pos, t1, t2, size): turns with their place in the conversation, from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = pick(df, conv_id=id_column, turn=turn_column, role=role_column, text=text_column).where("conv_id is not null") \
        .select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), F.xxhash64(role, text).alias("t1"),
                F.xxhash64(F.lit(SALT), text, role).alias("t2"), F.length(text).cast("long").alias("size"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "t1", "t2"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "t1", "t2", "size")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, seen, place = None, 0, TaskContext.get().partitionId()
        for part in parts:
            if not len(part):
                continue
            conv = part["conv"].to_numpy()
            start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            run = np.arange(len(conv)) - np.repeat(start, np.diff(np.r_[start, len(conv)]))
            if conv[0] == last:  # the batch goes on with the last one's conversation
                run[conv == last] += seen
            last, seen = conv[-1], run[-1] + 1
            yield part.assign(pos=run, place=place)

    counted = cut(ranged.mapInPandas(count, "conv long, t1 long, t2 long, size long, pos long, place int"))
    pieces = counted.groupBy("conv", "place").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = pieces.withColumn("offset", F.sum("n").over(before)).where("offset is not null").drop("n")
    # one conversation at most goes on into a range, so there are no more offsets than partitions
    return counted.join(F.broadcast(offsets), ["conv", "place"], "left") \
        .select("conv", (F.col("pos") + F.coalesce("offset", F.lit(0))).alias("pos"), "t1", "t2", "size")


def rebuilt(turns: DataFrame, base: int = BASE, heads: int = HEADS) -> DataFrame:
    """(conv, depth, total, t1, t2, size): each conversation with its first
    h = crc32(id) % ``heads`` turns replaced by those of the conversation at
    the next lower multiple of ``base``; depth 0 is the root."""
    convs = turns.groupBy("conv").agg(F.count("*").alias("own")) \
        .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(heads)) \
        .withColumn("of", F.col("conv") - F.pmod("conv", F.lit(base)))
    first = turns.where((F.pmod("conv", F.lit(base)) == 0) & (F.col("pos") < heads - 1)).groupBy("conv") \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "size"))).alias("first")).withColumnRenamed("conv", "of")
    convs = convs.join(first, "of", "left").withColumn("first", F.slice(F.coalesce("first", F.array()), F.lit(1), F.col("h").cast("int"))) \
        .withColumn("taken", F.size("first").cast("long")) \
        .withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = cut(convs.select("conv", "h", "taken", "total", "first"))
    head = convs.select("conv", "total", F.explode("first").alias("x")) \
        .select("conv", (F.col("x.pos") + 1).alias("depth"), "total", "x.t1", "x.t2", "x.size")
    tail = turns.join(convs.drop("first"), "conv").where("pos >= h") \
        .select("conv", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "total", "t1", "t2", "size")
    nought = F.lit(0).cast("long")
    root = convs.select("conv", nought.alias("depth"), "total", nought.alias("t1"), nought.alias("t2"), nought.alias("size"))
    return root.unionByName(head).unionByName(tail)


def plain_sequences(turns: DataFrame) -> DataFrame:
    """(conv, depth, total, t1, t2, size) of conversations as they are."""
    return rebuilt(turns, heads=1)


# --- names ---------------------------------------------------------------------------------------

def _joined(above: list[str], below: list[str]) -> list[Column]:
    """The name of a prefix followed by a piece; without a prefix the piece's own."""
    parts = [F.col(c) for c in (*above, *below)]
    return [F.when(parts[0].isNull(), F.col(below[0])).otherwise(F.xxhash64(*parts)),
            F.when(parts[0].isNull(), F.col(below[1])).otherwise(F.xxhash64(F.lit(SALT), *parts))]


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """(conv, piece, total, names, sizes, e1, e2): per block the names of its
    prefixes, seen from its start, and its own name."""

    def chain(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            ones, twos = [], []
            for t1, t2 in zip(part["t1"], part["t2"]):
                turns = np.stack([np.asarray(t1, np.int64), np.asarray(t2, np.int64)], axis=1).tobytes()
                name, names = b"", []
                for at in range(0, len(turns), 16):
                    name = hashlib.md5(name + turns[at:at + 16]).digest()
                    names.append(name)
                digits = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                ones.append(digits[:, 0].copy())
                twos.append(digits[:, 1].copy())
            yield part.assign(t1=ones, t2=twos)

    held = rows.groupBy("conv", F.floor(F.col("depth") / block).alias("piece")) \
        .agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("depth", "t1", "t2", "size"))).alias("x"))
    named = held.select("conv", "piece", "total", "x.t1", "x.t2", "x.size") \
        .mapInPandas(chain, "conv long, piece long, total long, t1 array<long>, t2 array<long>, size array<long>")
    return cut(named.withColumns({"e1": F.element_at("t1", -1), "e2": F.element_at("t2", -1)}))


def _hung(pieces: DataFrame) -> DataFrame:
    """(conv, piece, c1, c2): the name of the prefix that each piece (conv,
    piece, e1, e2) hangs from; null at the root."""
    if pieces.where("piece > 0").isEmpty():
        none = F.lit(None).cast("long")
        return pieces.select("conv", "piece", none.alias("c1"), none.alias("c2"))
    half = F.when(F.pmod("piece", F.lit(2)) == 0, F.struct("e1", "e2"))
    rest = F.when(F.pmod("piece", F.lit(2)) == 1, F.struct("e1", "e2"))
    spans = cut(pieces.groupBy("conv", F.floor(F.col("piece") / 2).alias("span")).agg(F.max(half).alias("up"), F.max(rest).alias("down"))
                .select("conv", "span", "up.e1", "up.e2", F.col("down.e1").alias("d1"), F.col("down.e2").alias("d2")))
    whole = _joined(["e1", "e2"], ["d1", "d2"])
    # a span without a lower half is its conversation's last; nothing hangs from it
    above = _hung(spans.where("d1 is not null").select("conv", F.col("span").alias("piece"), whole[0].alias("e1"), whole[1].alias("e2"))
                  .unionByName(spans.where("d1 is null").select("conv", F.col("span").alias("piece"), "e1", "e2")))
    solved = spans.join(above.withColumnRenamed("piece", "span"), ["conv", "span"])
    name = _joined(["c1", "c2"], ["e1", "e2"])
    upper = solved.select("conv", (F.col("span") * 2).alias("piece"), "c1", "c2")
    lower = solved.where("d1 is not null").select("conv", (F.col("span") * 2 + 1).alias("piece"), name[0].alias("c1"), name[1].alias("c2"))
    return cut(upper.unionByName(lower))


def _after(pieces: DataFrame) -> DataFrame:
    """(conv, piece, a_saved, a_leaves): the sums of (saved, leaves) over the
    later pieces of a conversation."""
    if pieces.where("piece > 0").isEmpty():
        return pieces.select("conv", "piece", F.lit(0).cast("long").alias("a_saved"), F.lit(0).cast("long").alias("a_leaves"))
    odd = F.pmod("piece", F.lit(2)) == 1
    below = [F.sum(F.when(odd, F.col(c)).otherwise(0)).alias(f"d_{c}") for c in ("saved", "leaves")]
    spans = cut(pieces.groupBy("conv", F.floor(F.col("piece") / 2).alias("span"))
                .agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"), *below))
    above = _after(spans.select("conv", F.col("span").alias("piece"), "saved", "leaves"))
    solved = spans.join(above.withColumnRenamed("piece", "span"), ["conv", "span"])
    upper = solved.select("conv", (F.col("span") * 2).alias("piece"), (F.col("a_saved") + F.col("d_saved")).alias("a_saved"),
                          (F.col("a_leaves") + F.col("d_leaves")).alias("a_leaves"))
    lower = solved.select("conv", (F.col("span") * 2 + 1).alias("piece"), "a_saved", "a_leaves")
    return cut(upper.unionByName(lower))


# --- the trie ------------------------------------------------------------------------------------

def _grafted(blocks: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """(n1, n2, saved, leaves): totals of the subtrees."""
    charged = nodes.where("charge > 0 or leaf > 0") \
        .select(F.col("conv_id").alias("conv"), F.floor(F.col("depth") / block).alias("piece"), (F.col("depth") % block).alias("at"), "charge", "leaf")
    held = cut(charged.groupBy("conv", "piece").agg(
        F.sum("charge").alias("saved"), F.sum("leaf").alias("leaves"), F.collect_list(F.struct("at", "charge", "leaf")).alias("x")))
    rows = blocks.select("conv", "piece", "names").join(held, ["conv", "piece"], "left")
    sums = rows.select("conv", "piece", F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("leaves", F.lit(0)).alias("leaves"))
    rows = rows.join(_after(sums), ["conv", "piece"]) \
        .select("names.n1", "names.n2", "x.at", "x.charge", "x.leaf", "a_saved", "a_leaves")

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for n1, n2, at, charge, leaf, a_saved, a_leaves in part.itertuples(index=False):
                sums = np.zeros((2, len(n1)), np.int64)
                if at is not None:
                    sums[0, at], sums[1, at] = charge, leaf
                sums = sums[:, ::-1].cumsum(axis=1)[:, ::-1]
                keep = (sums[0] + a_saved > 0) | (sums[1] + a_leaves > 0)
                out.append(np.stack([n1, n2, sums[0] + a_saved, sums[1] + a_leaves], axis=1)[keep])
            if out:
                yield pd.DataFrame(np.concatenate(out), columns=["n1", "n2", "saved", "leaves"])

    return rows.mapInPandas(spread, "n1 long, n2 long, saved long, leaves long") \
        .groupBy("n1", "n2").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def _ends(rows: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256) of nodes in which members (n1, n2, conv) end."""

    def join(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            conv, n1, n2 = (part[c].to_numpy() for c in ("conv", "n1", "n2"))
            starts = np.flatnonzero(np.r_[True, (n1[1:] != n1[:-1]) | (n2[1:] != n2[:-1])])
            bounds = sorted({*starts.tolist(), *range(0, len(part), JOINED), len(part)})
            out = [(n1[a], n2[a], conv[a], ",".join(map(str, conv[a:b].tolist()))) for a, b in zip(bounds, bounds[1:])]
            yield pd.DataFrame(out, columns=["n1", "n2", "least", "ids"])

    def digest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for part in parts:
            out = []
            for n1, n2, ids in zip(part["n1"], part["n2"], part["ids"]):
                if (n1, n2) != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (n1, n2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["n1", "n2", "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["n1", "n2", "ends_sha256"])

    order = ["n1", "n2", "conv"]
    joined = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInPandas(join, "n1 long, n2 long, least long, ids string")
    return joined.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "least") \
        .mapInPandas(digest, "n1 long, n2 long, ends_sha256 string")


def prefix_trie(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), one row per node."""
    blocks = _blocks(sequences, block)
    hung = _hung(blocks.select("conv", "piece", "e1", "e2"))
    name = lambda x: F.when(F.col("c1").isNull(), F.struct(x["t1"].alias("n1"), x["t2"].alias("n2"))).otherwise(
        F.struct(F.xxhash64(F.col("c1"), F.col("c2"), x["t1"], x["t2"]).alias("n1"),
                 F.xxhash64(F.lit(SALT), F.col("c1"), F.col("c2"), x["t1"], x["t2"]).alias("n2")))
    blocks = blocks.join(hung, ["conv", "piece"]).select(
        "conv", "piece", "total", "size", F.transform(F.arrays_zip("t1", "t2"), name).alias("names"))
    blocks = cut(blocks)
    # a piece hangs from the last node of the piece before it; its hook is another name of the same prefix
    ends = blocks.select("conv", (F.col("piece") + 1).alias("piece"), F.element_at("names", -1).alias("hook"))
    none = F.lit(None).cast("struct<n1:bigint,n2:bigint>")
    hooked = blocks.where("piece = 0").withColumn("hook", none) \
        .unionByName(blocks.where("piece > 0").join(ends, ["conv", "piece"]))
    above = F.concat(F.array("hook"), F.slice("names", F.lit(1), F.size("names") - 1))
    rows = hooked.select("conv", "piece", "total", F.posexplode(F.arrays_zip("names", above.alias("above"), "size")).alias("at", "x")) \
        .select("conv", (F.col("piece") * block + F.col("at")).alias("depth"), "total", "x.names.n1", "x.names.n2",
                F.col("x.above.n1").alias("p1"), F.col("x.above.n2").alias("p2"), "x.size")
    nodes = rows.groupBy("n1", "n2").agg(
        F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2"), F.min("size").alias("size"))
    nodes = cut(nodes)
    children = nodes.where("p1 is not null").groupBy("p1", "p2").agg(F.count("*").alias("n_children")) \
        .withColumnsRenamed({"p1": "n1", "p2": "n2"})
    nodes = cut(nodes.join(children, ["n1", "n2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                .withColumn("charge", (F.col("n_convs") - 1) * F.col("size")).withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0)))
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(_grafted(blocks, nodes, block), ["n1", "n2"], "left") \
        .join(_ends(rows.where("depth = total")), ["n1", "n2"], "left") \
        .join(parents, ["p1", "p2"], "left") \
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("leaves", F.lit(0)).alias("n_leaves"),
                F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(df: DataFrame) -> DataFrame:
    """The trie over the rebuilt conversations of a table (conv_id, turn, role, text)."""
    return prefix_trie(rebuilt(numbered_turns(df)))
