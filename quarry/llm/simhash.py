"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are computed in tasks (numpy). The linking of fingerprints at a
bounded bit distance is exact and distributed:

* The 64 bits are cut into ``blocks`` parts. Two fingerprints that differ in
  at most d bits agree in at least ``blocks - d`` parts, so they meet in the
  bucket of some choice of that many parts (pigeonhole). A bucket above
  ``max_bucket`` rows is cut again by the same rule over the bits that its
  key leaves open, as often as needed, so no task ever holds a hot bucket.
* Inside a bucket the fingerprints are sorted by Gray rank and a hierarchy of
  groups is laid over them. A node holds the mask of bits that all its
  fingerprints share and their pattern; a child only counts the bits that
  its parent did not share, so differences accumulate on the way down and a
  whole group is pruned as soon as they exceed d.
* A bucket hands on one spanning edge per fingerprint, never its pairs;
  components come from alternating star contraction over those edges.

Defined cases: null text counts as empty; a text without words has
fingerprint zero and links like any other; a null id takes part in links but
is a component's id only if every row of the component has a null id;
repeated rows give repeated result rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quarry.llm.common import cut, hex_text, pick, whole_text
from quarry.llm.components import connected_components

SHINGLE = 4
DISTANCE = 4
BLOCKS = 6
MAX_BUCKET = 50_000
LEAF = 16  # fingerprints under a lowest node, and nodes under a higher one
CHUNK = 1 << 16


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = text.encode().lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], blanks + 1)).tolist()
    ends = np.concatenate((blanks, [len(joined)])).tolist()
    total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, total, CHUNK):
        high = min(low + CHUNK, total)
        hashes = np.array([digest(joined[s:e], 42) for s, e in
                           zip(starts[low:high], ends[low + shingle - 1:high + shingle - 1])], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed 64-bit integer."""

    @F.pandas_udf(LongType())
    def of_texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            values = np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.Series(values.view(np.int64), index=texts.index)

    return of_texts(whole_text(text))


# --- the index of one bucket ---------------------------------------------------------------------

def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each bit pattern in the reflected Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Groups of ``LEAF`` over Gray-sorted fingerprints, level upon level.

    Per level and node: ``mask`` (bits that all fingerprints below share) and
    ``pattern`` (their values there). ``fresh`` are the bits of the mask that
    the parent's mask lacks: only these are compared at the node.
    """

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        low, high = self.values, self.values  # AND and OR of the fingerprints below
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while len(low) > 1:
            cuts = np.arange(0, len(low), LEAF)
            low, high = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)
            self.levels.append((~(low ^ high), low))
        self.levels.reverse()  # root first
        fresh = []
        for depth, (mask, _) in enumerate(self.levels):
            above = self.levels[depth - 1][0] if depth else np.zeros(1, np.uint64)
            fresh.append(mask & ~above[np.arange(len(mask)) // LEAF] if depth else mask)
        self.fresh = fresh
        self.last = np.zeros(len(self.values), np.uint64)
        if self.levels:
            self.last = ~self.levels[-1][0][np.arange(len(self.values)) // LEAF]

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (query, value) at ``distance`` or fewer bits."""
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        spent = np.zeros(len(queries), np.int64)
        widths = [len(mask) for mask, _ in self.levels] + [len(self.values)]
        for depth, width in enumerate(widths):
            if depth:  # step to the children of the nodes that are left
                q, spent = np.repeat(q, LEAF), np.repeat(spent, LEAF)
                node = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
                inside = node < width
                q, node, spent = q[inside], node[inside], spent[inside]
            fresh = self.fresh[depth] if depth < len(self.levels) else self.last
            pattern = self.levels[depth][1] if depth < len(self.levels) else self.values
            spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & fresh[node])
            near = spent <= distance
            q, node, spent = q[near], node[near], spent[near]
        return q, node


def bucket_links(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (fingerprint, smallest of its bucket component)."""
    index = GrayIndex(np.unique(values))
    values = index.values
    label = np.arange(len(values))

    def root(x: np.ndarray) -> np.ndarray:
        while True:
            up = label[x]
            if np.array_equal(up, x):
                return x
            x = up

    step = 256
    for low in range(0, len(values), step):
        q, found = index.search(values[low:low + step], distance)
        q = q + low
        keep = found > q
        q, found = q[keep], found[keep]
        while len(q):  # union by hooking the larger root onto the smaller one
            a, b = root(q), root(found)
            apart = a != b
            q, found, a, b = q[apart], found[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
    roots = root(np.arange(len(values)))
    least = np.full(len(values), np.iinfo(np.int64).max)
    signed = values.view(np.int64)
    np.minimum.at(least, roots, signed)
    target = least[roots]
    linked = signed != target
    return signed[linked], target[linked]


# --- the distributed join ------------------------------------------------------------------------

def _cuts(open_bits: list[int], blocks: int, keep: int) -> list[int]:
    """Masks of every choice of ``keep`` out of ``blocks`` runs of the bits."""
    runs = [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(open_bits), blocks)]
    return [sum(choice) for choice in combinations(runs, keep)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS,
          max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (a, b) that span every set of linked fingerprints in ``fps.fp``."""
    distinct = fps.select("fp").distinct()
    spread = lambda masks: F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    masks = _cuts(list(range(64)), blocks, blocks - distance)
    rows = distinct.select("fp", F.explode(spread(masks)).alias("mask"))
    done: list[DataFrame] = []
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "key").count()
        hot = cut(sizes.where(F.col("count") > max_bucket).select("mask", "key"))
        if hot.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(hot, ["mask", "key"], "left_anti"))
        finer = {}
        for mask in masks:
            free = [b for b in range(64) if not mask >> b & 1]
            if len(free) > distance:
                finer[mask] = [mask | more for more in _cuts(free, distance + 1, 1)]
            # else the bucket has 2**distance fingerprints at most and is never hot
        steps = F.create_map(*[x for m, more in finer.items() for x in (F.lit(_signed(m)).cast("long"), spread(more))])
        rows = rows.join(hot, ["mask", "key"], "left_semi").select("fp", F.explode(steps[F.col("mask")]).alias("mask"))
        masks = sorted({m for more in finer.values() for m in more})
    keyed = done[0]
    for more in done[1:]:
        keyed = keyed.unionByName(more)

    def link(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:  # one bucket a row, of max_bucket fingerprints at most
            found = [bucket_links(np.asarray(fps).view(np.uint64), distance) for fps in part["fps"]]
            if found:
                yield pd.DataFrame({"a": np.concatenate([x for x, _ in found]),
                                    "b": np.concatenate([y for _, y in found])})

    # a bucket of one fingerprint links nothing and never reaches Python
    buckets = keyed.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return buckets.select("fps").mapInPandas(link, "a long, b long").distinct()


def roots(rows: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(fp, root) for every distinct ``rows.fp``: the smallest of its component."""
    labels = connected_components(links(rows, distance, blocks)).withColumnRenamed("node", "fp")
    return rows.select("fp").distinct().join(labels, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def components(rows: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, fp, component_id) for (doc_id, fp) rows."""
    rows = cut(rows)
    rooted = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots(rows, distance, blocks), "fp")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``df``."""
    rows = pick(df, doc_id=id_column, text=text_column).select("doc_id", fingerprint(F.col("text"), shingle).alias("fp"))
    found = components(rows, distance, blocks)
    return found.select("doc_id", hex_text(F.col("fp")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component is kept:
    the first by (doc_id, hash of the text), null ids last. All columns kept."""
    mark = "quarry_copy_of_row"
    rows = cut(docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("copy"),
                           fingerprint(docs.text, shingle).alias("fp")))
    place = F.struct(F.col("id").isNull().alias("missing"), "id", "copy")
    least = rows.groupBy("fp").agg(F.min(place).alias("least"))
    stay = least.join(roots(rows, distance, blocks), "fp").groupBy("root").agg(F.min("least").alias("first")) \
        .select("first.id", "first.copy")
    kept = docs.withColumn(mark, F.xxhash64("text"))
    kept = kept.join(stay, kept.doc_id.eqNullSafe(stay.id) & (kept[mark] == stay["copy"]), "left_semi")
    if not rows.groupBy("id", "copy").count().where("count > 1").isEmpty():  # rows repeated outright
        kept = kept.dropDuplicates(["doc_id", mark])
    return kept.drop(mark)
