"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector x (unit length) is turned by a shared random rotation P. Its code is
the signs of Px; the stored correction factor f is the inner product of the
code (as a unit vector) with Px. A second vector y keeps Py in four bits a
coordinate. ``<code(x), y> / f(x)`` is an unbiased estimate of the cosine of x
and y. If the cosine is c, the estimate's error is sqrt(1 - c^2) times a part
of the code that points off x, which the factor bounds, plus the rounding of
the four bits. A pair whose estimates stay under the bound that belongs to
c = ``COSINE`` is dropped; all others are recomputed from the vectors in
double precision, so no link is ever taken from an estimate.

How pairs meet, without comparing all of a label:

* Vectors of one label and one length meet in ``tables`` tables, in the bucket
  of ``bits`` further signs. Both numbers follow from the size of the largest
  label: buckets of about ``BUCKET`` vectors, and so many tables that a pair
  at exactly the least cosine misses all of them with a chance of ``MISS``
  (nearer pairs miss far more seldom). Tables grow with the tenth root of the
  rows. This is the only way a link can be lost, besides a bound of
  ``SIGMAS`` deviations.
* Equal vectors are one group with a weight and travel once.
* Tables carry ids and codes only. A bucket hands on the groups that have an
  open pair in it; only these get their vectors sent and are recomputed there.
  A pair that meets in several tables counts in the first of them.
* Where more than ``SLICE`` different vectors crowd together, a pivot is set at
  their mean. Vectors within half the angle of a pivot are all linked with each
  other (triangle inequality): a ball, whose links are counted by its weight
  alone. A third of all rows being near copies of one vector so costs no more
  than other rows; only pairs that are not in one ball are compared.
* A bucket above ``SLICE`` groups is dealt into slices, those of a ball apart; each
  pair of slices that are not of one ball is a task of its own, so memory is
  bounded.
* A bucket hands on link counts and one spanning edge a group, never pairs.

Defined cases: a null label, and a vector that is null, empty, zero or holds a
null, NaN or infinite component, links with nothing and is its own component;
vectors of different lengths never link; rows that repeat an id are vectors of
their own; a null id takes part but names a component only if all ids of it
are null; ties need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, pick, worker_cache
from quarry.llm.components import connected_components

COSINE = 0.98
BUCKET = 512
MISS = 0.001
SIGMAS = 4.5
SLICE = 2048
STEP = 256  # rows of a bucket compared at once
LEVELS = 15  # steps of a four-bit coordinate


def tables_for(rows: int, cosine: float = COSINE, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for a label of ``rows`` vectors."""
    bits = max(1, math.ceil(math.log2(max(rows, 2) / bucket)))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - meet)))


def rotations(size: int, wanted: int) -> np.ndarray:
    """``wanted`` rows of random rotations of ``size`` dimensions, the same in
    every task; rows of one rotation are orthogonal."""
    cache = worker_cache()
    if ("rotations", size, wanted) not in cache:
        rng = np.random.default_rng([20241, size])
        blocks = []
        for _ in range(-(-wanted // size)):
            q, r = np.linalg.qr(rng.standard_normal((size, size)))
            blocks.append(q * np.sign(np.diag(r)))
        cache["rotations", size, wanted] = np.vstack(blocks)[:wanted]
    return cache["rotations", size, wanted]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of finite, non-zero vectors at length one, without overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Codes:
    """Codes of ``n`` vectors of one length: signs, correction factors, four-bit
    coordinates, and the keys of the tables."""

    def __init__(self, signs, factor, low, step, levels, keys):
        self.signs, self.factor, self.low, self.step, self.levels, self.keys = signs, factor, low, step, levels, keys

    @classmethod
    def of(cls, vectors: np.ndarray, bits: int, tables: int) -> Codes:
        size = vectors.shape[1]
        turned = vectors @ rotations(size, size + bits * tables).T
        own, rest = turned[:, :size], turned[:, size:]
        factor = np.abs(own).sum(axis=1) / math.sqrt(size)
        low = own.min(axis=1)
        step = np.maximum((own.max(axis=1) - low) / LEVELS, 1e-12)
        dither = np.random.default_rng([7, size]).random(size)  # rounding up or down at random, alike in every task
        levels = np.clip(np.floor((own - low[:, None]) / step[:, None] + dither), 0, LEVELS).astype(np.uint8)
        weights = (1 << np.arange(bits, dtype=np.uint32))
        keys = ((rest.reshape(len(vectors), tables, bits) > 0) * weights).sum(axis=2, dtype=np.uint32)
        f4 = lambda x: x.astype(np.float32)
        return cls(own > 0, f4(factor), f4(low), f4(step), levels, keys)

    def packed(self) -> list[bytes]:
        """One string of bytes a vector."""
        n, size = self.signs.shape
        head = np.stack([self.factor, self.low, self.step], axis=1).view(np.uint8).reshape(n, 12)
        nibbles = np.zeros((n, size + size % 2), np.uint8)
        nibbles[:, :size] = self.levels
        body = [head, np.packbits(self.signs, axis=1), nibbles[:, ::2] << 4 | nibbles[:, 1::2], self.keys.view(np.uint8).reshape(n, -1)]
        return [row.tobytes() for row in np.hstack(body)]

    @classmethod
    def unpacked(cls, rows: list[bytes], size: int, tables: int) -> Codes:
        data = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
        cuts = np.cumsum([12, -(-size // 8), -(-size // 2), 4 * tables])
        head = np.ascontiguousarray(data[:, :12]).view(np.float32)
        signs = np.unpackbits(data[:, cuts[0]:cuts[1]], axis=1, count=size).astype(bool)
        pairs = data[:, cuts[1]:cuts[2]]
        levels = np.stack([pairs >> 4, pairs & 15], axis=2).reshape(len(rows), -1)[:, :size]
        keys = np.ascontiguousarray(data[:, cuts[2]:cuts[3]]).view(np.uint32)
        return cls(signs, head[:, 0], head[:, 1], head[:, 2], levels, keys)

    def least(self, cosine: float, sigmas: float) -> np.ndarray:
        """Under a vector's value here, an estimate by its code rules the cosine out."""
        size = self.signs.shape[1]
        off = math.sqrt(1 - cosine * cosine) * np.sqrt(np.maximum(0, 1 - self.factor ** 2)) / self.factor
        return cosine - off * min(1, sigmas / math.sqrt(max(1, size - 1))) - 1e-4

    def coordinates(self) -> np.ndarray:
        """The turned vectors, as the four bits have them."""
        return self.low[:, None] + self.step[:, None] * self.levels

    def open_pairs(self, rows: slice, others: np.ndarray, table: int, cosine: float, sigmas: float) -> np.ndarray:
        """Which pairs (rows x others) the estimates leave open and no earlier table has met."""
        size = self.signs.shape[1]
        signs = np.where(self.signs, 1, -1).astype(np.float32) / math.sqrt(size)
        coordinates = self.coordinates()
        least = self.least(cosine, sigmas)
        rounding = sigmas * self.step / 2 / self.factor.min()  # the four bits' own error
        there = signs[rows] @ coordinates[others].T / self.factor[rows, None]
        back = coordinates[rows] @ signs[others].T / self.factor[None, others]
        open_ = (there >= least[rows, None] - rounding[None, others]) & (back >= least[None, others] - rounding[rows, None])
        for earlier in range(table):
            open_ &= self.keys[rows, None, earlier] != self.keys[None, others, earlier]
        return open_


def _blocks(sides: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Blocks of rows and the rows they meet: within one slice each pair once,
    between two slices only across."""
    n = len(sides)
    across = sides[0] != sides[-1]  # sorted by side
    border = int(np.searchsorted(sides, sides[-1])) if across else n
    for low in range(0, border, STEP):
        rows = slice(low, min(low + STEP, border))
        yield rows, (np.arange(border, n) if across else np.arange(low, n))


def _pairs(codes: Codes, sides: np.ndarray, balls: np.ndarray, table: int, cosine: float, sigmas: float) -> Iterator[tuple]:
    for rows, others in _blocks(sides):
        open_ = codes.open_pairs(rows, others, table, cosine, sigmas)
        open_ &= (balls[rows, None] < 0) | (balls[rows, None] != balls[None, others])  # pairs of one ball are known
        if others[0] == rows.start:  # a slice with itself
            open_ &= others[None, :] > np.arange(rows.start, rows.stop)[:, None]
        yield rows, others, open_


def _sound(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    return embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _encoder(bits: int, tables: int):
    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = part.drop(columns="embedding")
            out["code"] = None
            sizes = part["embedding"].map(len)
            for size in sizes.unique():
                here = sizes == size
                codes = Codes.of(unit(_matrix(part.loc[here, "embedding"])), bits, tables)
                out.loc[here, "code"] = pd.Series(codes.packed(), index=out.index[here], dtype=object)
            yield out
    return encode


def links(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
          cosine: float = COSINE, bucket: int = BUCKET, miss: float = MISS, sigmas: float = SIGMAS,
          slice_rows: int = SLICE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``df``."""
    rows = pick(df, vec_id=id_column, vector=vector_column, label=label_column)
    value = F.col("vector").cast("array<double>")
    rows = rows.select("vec_id", "label", "vector", F.coalesce(F.col("label").isNotNull() & _sound(value), F.lit(False)).alias("sound"),
                       F.xxhash64("label", value).alias("h1"), F.xxhash64(F.lit(7), value, "label").alias("h2"))
    sound = rows.where("sound")
    most = sound.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(most, cosine, bucket, miss)

    # codes, then one group per label and content
    id_type = rows.schema["vec_id"].dataType.simpleString()
    coded = sound.select(F.xxhash64("label").alias("of_label"), "h1", "h2", F.size("vector").alias("size"),
                         F.struct("vec_id").alias("id"), value.alias("embedding")) \
        .withColumn("id", F.to_json("id", {"ignoreNullFields": "true"})) \
        .mapInPandas(_encoder(bits, tables), "of_label long, h1 long, h2 long, size int, id string, code binary")
    coded = coded.withColumn("vec_id", F.from_json("id", f"vec_id {id_type}")["vec_id"])
    groups = cut(coded.groupBy("h1", "h2", "of_label", "size").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.min("code").alias("code"))
        .withColumn("gid", F.monotonically_increasing_id()))
    pivots = _pivots(groups, tables, slice_rows, cosine)
    if pivots:
        groups = cut(groups.join(_in_balls(sound, pivots, cosine), ["h1", "h2"], "left").withColumn("ball", F.coalesce("ball", F.lit(-1))))
    else:
        groups = groups.withColumn("ball", F.lit(-1))

    cells = _cells(groups, bits, tables, slice_rows)
    found = cut(_recomputed(_open(cells, tables, cosine, sigmas), groups, sound, bits, tables, cosine, sigmas))
    edges = found.where("root is not null and root <> gid").select(F.col("gid").alias("a"), F.col("root").alias("b"))
    if pivots:
        inside = groups.where("ball >= 0").groupBy("ball").agg(F.sum("weight").alias("whole"), F.min("gid").alias("first"))
        within = cut(groups.where("ball >= 0").join(F.broadcast(inside), "ball"))  # a row a pivot
        found = found.select("gid", "n").unionByName(within.select("gid", (F.col("whole") - F.col("weight")).alias("n")))
        edges = edges.unionByName(within.where("gid <> first").select(F.col("gid").alias("a"), F.col("first").alias("b")))

    counts = found.groupBy("gid").agg(F.sum("n").alias("n"))
    roots = connected_components(edges)
    named = groups.select("gid", "h1", "h2", "weight", "least").join(roots.withColumnRenamed("node", "gid"), "gid", "left") \
        .withColumn("root", F.coalesce("root", "gid")).join(counts, "gid", "left")
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(component, "root").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    linked = sound.select("vec_id", "h1", "h2").join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


# --- balls ---------------------------------------------------------------------------------------

CROWD_BITS = 16  # signs by which crowded vectors are noticed


def _pivots(groups: DataFrame, tables: int, slice_rows: int, cosine: float) -> dict[int, tuple[list[int], np.ndarray]]:
    """By length of the vectors: (labels, pivots in turned coordinates). A pivot
    stands for more than ``slice_rows`` groups with equal first signs, so there
    are no more than groups / ``slice_rows``; one within half the angle of a
    fuller one is left out."""
    first = F.substring("code", 13, CROWD_BITS // 8)  # behind the twelve bytes of numbers
    marked = groups.select("of_label", "size", "code", F.when(F.col("size") >= CROWD_BITS, first).otherwise(F.lit(b"")).alias("crowd"))
    full = cut(marked.groupBy("of_label", "size", "crowd").count().where(F.col("count") > slice_rows))
    if full.isEmpty():
        return {}

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for part in parts:
            for key, rows in part.groupby(["of_label", "size", "crowd"], sort=False):
                values = Codes.unpacked(rows["code"].tolist(), int(key[1]), tables).coordinates().sum(axis=0, dtype=np.float64)
                sums[key] = sums.get(key, 0) + values
        if sums:
            yield pd.DataFrame([(*key, values.tolist()) for key, values in sums.items()], columns=["of_label", "size", "crowd", "total"])

    members = marked.join(F.broadcast(full), ["of_label", "size", "crowd"]).select("of_label", "size", "crowd", "code")
    parts = members.mapInPandas(add, "of_label long, size int, crowd binary, total array<double>")
    total = parts.select("of_label", "size", "crowd", F.posexplode("total").alias("at", "x")) \
        .groupBy("of_label", "size", "crowd", "at").agg(F.sum("x").alias("x")) \
        .groupBy("of_label", "size", "crowd").agg(F.sort_array(F.collect_list(F.struct("at", "x")))["x"].alias("total"))
    found: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for row in total.join(full, ["of_label", "size", "crowd"]).orderBy(F.col("count").desc(), "of_label", "size", "crowd").collect():
        mean = np.array(row["total"])
        if not mean.any():
            continue
        mean /= np.linalg.norm(mean)
        labels, centres = found.setdefault(row["size"], ([], []))
        if all(label != row["of_label"] or mean @ centre < _half(cosine) for label, centre in zip(labels, centres)):
            labels.append(row["of_label"])
            centres.append(mean)
    return {size: (labels, np.array(centres)) for size, (labels, centres) in found.items()}


def _half(cosine: float) -> float:
    """The cosine of half the angle, a little more for rounding."""
    return math.sqrt((1 + cosine) / 2) + 1e-9


def _in_balls(sound: DataFrame, pivots: dict, cosine: float) -> DataFrame:
    """(h1, h2, ball) of the contents within half the angle of a pivot of their
    label: the fullest such pivot's number."""
    numbers, n = {}, 0
    for size, (labels, _) in pivots.items():
        numbers[size] = n
        n += len(labels)

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sizes = part["vector"].map(len)
            for size, (labels, centres) in pivots.items():
                rows = part[sizes == size]
                if not len(rows):
                    continue
                turned = unit(_matrix(rows["vector"])) @ rotations(size, size).T
                near = (turned @ centres.T >= _half(cosine)) & (rows["of_label"].to_numpy()[:, None] == np.array(labels)[None])
                hit = near.any(axis=1)
                if hit.any():
                    yield pd.DataFrame({"h1": rows["h1"].to_numpy()[hit], "h2": rows["h2"].to_numpy()[hit],
                                        "ball": near.argmax(axis=1)[hit] + numbers[size]})

    values = sound.select("h1", "h2", F.xxhash64("label").alias("of_label"), "vector")
    return values.mapInPandas(assign, "h1 long, h2 long, ball int").distinct()


# --- buckets -------------------------------------------------------------------------------------

def _cells(groups: DataFrame, bits: int, tables: int, slice_rows: int) -> DataFrame:
    """(bucket, low, high, side, ball, table, gid, size, code): the cells of
    slices a group belongs to. A bucket of one slice is one cell; in a larger
    one slices are of one ball, or of none, and a ball's own pairs need no cell."""
    at = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(tables - 1)),
                                  lambda t: F.substring("code", F.length("code") - 4 * (tables - t) + 1, F.lit(4))))
    rows = groups.select("gid", "size", "of_label", "ball", "code", at.alias("table", "key")) \
        .select("gid", "size", "table", "ball", "code", F.xxhash64("of_label", "size", "table", "key").alias("bucket"))
    # by bucket, where the slices of each ball begin: at most one entry a pivot
    entry = F.struct("ball", F.ceil(F.col("count") / slice_rows).cast("int").alias("slices"))
    sizes = rows.groupBy("bucket", "ball").count().groupBy("bucket").agg(F.sum("count").alias("count"), F.sort_array(F.collect_list(entry)).alias("of")) \
        .where("count > 1").withColumn("of", F.when(F.col("count") > slice_rows, F.col("of")))
    rows = rows.join(sizes.select("bucket", "of"), "bucket")
    mine = F.element_at(F.filter("of", lambda x: x["ball"] == F.col("ball")), 1)["slices"]
    add = lambda total, x: total + x["slices"]
    start = F.aggregate(F.filter("of", lambda x: x["ball"] < F.col("ball")), F.lit(0), add)
    rows = rows.withColumns({"mine": F.coalesce(mine, F.lit(1)), "start": F.coalesce(start, F.lit(0)),
                             "all": F.coalesce(F.aggregate("of", F.lit(0), add), F.lit(1))})
    rows = rows.withColumn("side", (F.col("start") + F.pmod(F.xxhash64("gid"), F.col("mine"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("all") - 1)
    own_ball = F.col("of").isNotNull() & (F.col("ball") >= 0)
    others = F.when(own_ball, F.filter(others, lambda s: (s < F.col("start")) | (s >= F.col("start") + F.col("mine")))).otherwise(others)
    return rows.select("*", F.explode(others).alias("other")).select(
        "bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "ball", "table", "gid", "size", "code")


def _open(cells: DataFrame, tables: int, cosine: float, sigmas: float) -> DataFrame:
    """(bucket, low, high, side, table, gid) of groups with an open pair in a cell."""

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for bucket, low, high, table, size, members in part.itertuples(index=False):
                sides, gids, balls = (np.array([m[c] for m in members]) for c in ("side", "gid", "ball"))
                order = np.lexsort((gids, sides))
                sides, gids, balls = sides[order], gids[order], balls[order]
                if low != high and sides[0] == sides[-1]:
                    continue
                codes = Codes.unpacked([members[i]["code"] for i in order], size, tables)
                needed = np.zeros(len(gids), bool)
                for rows, others, open_ in _pairs(codes, sides, balls, table, cosine, sigmas):
                    needed[rows] |= open_.any(axis=1)
                    needed[others] |= open_.any(axis=0)
                if needed.any():
                    yield pd.DataFrame({"bucket": bucket, "low": low, "high": high, "table": table,
                                        "side": sides[needed], "ball": balls[needed], "gid": gids[needed]})

    held = cells.groupBy("bucket", "low", "high", "table", "size") \
        .agg(F.collect_list(F.struct("gid", "side", "ball", "code")).alias("members")).where(F.size("members") > 1)
    return held.mapInPandas(search, "bucket long, low int, high int, table int, side int, ball int, gid long")


def _recomputed(needed: DataFrame, groups: DataFrame, sound: DataFrame, bits: int, tables: int, cosine: float,
                sigmas: float) -> DataFrame:
    """(gid, n, root): by cell, the weight of the vectors a group links with, and
    the smallest group of its component in the cell (null: none)."""
    needed = cut(needed)
    wanted = needed.select("gid").distinct().join(groups.select("gid", "h1", "h2", "least", "weight"), "gid")
    same = (sound.h1 == wanted.h1) & (sound.h2 == wanted.h2) & sound.vec_id.eqNullSafe(wanted.least)
    vectors = sound.join(wanted, same).select("gid", "weight", "vector").dropDuplicates(["gid"])

    def recompute(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for table, members in zip(part["table"], part["members"]):
                sides, gids, balls = (np.array([m[c] for m in members]) for c in ("side", "gid", "ball"))
                order = np.lexsort((gids, sides))
                sides, gids, balls = sides[order], gids[order], balls[order]
                weights = np.array([members[i]["weight"] for i in order], np.int64)
                vectors = unit(_matrix([members[i]["vector"] for i in order]))
                codes = Codes.of(vectors, bits, tables)
                links = np.zeros(len(gids), np.int64)
                label = np.arange(len(gids))
                for rows, others, open_ in _pairs(codes, sides, balls, table, cosine, sigmas):
                    near = open_ & (vectors[rows] @ vectors[others].T >= cosine)
                    links[rows] += near @ weights[others]
                    links[others] += weights[rows] @ near
                    a, b = np.nonzero(near)
                    _unite(label, a + rows.start, others[b])
                label = _root(label, np.arange(len(gids)))
                least = np.full(len(gids), np.iinfo(np.int64).max)
                np.minimum.at(least, label, gids)
                hit = links > 0
                yield pd.DataFrame({"gid": gids[hit], "n": links[hit], "root": least[label][hit]})

    held = needed.join(vectors, "gid").groupBy("bucket", "low", "high", "table") \
        .agg(F.collect_list(F.struct("gid", "side", "ball", "weight", "vector")).alias("members"))
    return held.select("table", "members").mapInPandas(recompute, "gid long, n long, root long")


def _root(label: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = label[x]
        if np.array_equal(up, x):
            return x
        x = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i] in the parent table ``label``."""
    while len(a):
        x, y = _root(label, a), _root(label, b)
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
