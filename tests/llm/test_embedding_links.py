import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import embedding_links as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.98):
    """(n_links, component_id) a row, by comparing everything."""
    n = len(rows)
    units = []
    for _, v, label in rows:
        ok = label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v or [])
        x = np.array(v, np.float32).astype(float) if ok else None
        units.append(x / np.linalg.norm(x) if ok else None)
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((len(near[i]), min(ids) if ids else None))
    return out


def made(rng, n, size, label, first=0):
    """Random vectors, near copies at many distances, chains and exact copies."""
    out = [rng.standard_normal(size) for _ in range(n)]
    for _ in range(3):
        v = rng.standard_normal(size)
        for k in range(n // 4):
            step = rng.standard_normal(size)
            step -= (step @ v) / (v @ v) * v
            step *= np.linalg.norm(v) / np.linalg.norm(step)
            out.append(v + rng.uniform(0, 0.21) * step)  # a cosine about 0.98 and up
            if k % 5 == 0:
                v = out[-1]
    out += [out[-1] * 3.0, out[0], out[0]]
    return [(first + i, [float(x) for x in v], label) for i, v in enumerate(out)]


@pytest.mark.parametrize("bucket,slice_rows", [(512, 2048), (16, 2048), (64, 24)])
def test_equals_brute_force(spark, bucket, slice_rows):
    rng = np.random.default_rng(5)
    rows = made(rng, 120, 64, 1) + made(rng, 40, 64, 2, 1000) + made(rng, 30, 7, 1, 2000)
    rows += [(9, rows[3][1], 2), (rows[5][0], rows[5][1], 1), (None, rows[7][1], 1)]
    got = sorted(map(tuple, E.links(spark.createDataFrame(rows, SCHEMA), bucket=bucket, miss=1e-6,
                                    slice_rows=slice_rows).collect()), key=str)
    want = sorted(((r[0], n, c, r[0] == c) for r, (n, c) in zip(rows, plain(rows))), key=str)
    assert got == want


def test_values_that_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 3.0], 1),
            (7, [1.0, float("nan"), 3.0], 1), (8, [1.0, float("inf"), 3.0], 1), (9, v, 2), (10, [1.0, 2.0], 1),
            (11, [-0.0, 0.0, 0.0], 1), (12, [2.0, 4.0, 6.0], 1), (None, v, None), (13, [5.0], 3), (14, [1.0], 3), (15, [-1.0], 3)]
    got = {r[0]: tuple(r)[1:] for r in E.links(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (0, i, True) for i in [2, 3, 4, 5, 6, 7, 8, 9, 10, 11, None, 15]} | {
        1: (1, 1, True), 12: (1, 1, False), 13: (1, 13, True), 14: (1, 13, False)}


def test_empty_table_large_ids_and_clashing_columns(spark):
    assert E.links(spark.createDataFrame([], SCHEMA)).collect() == []
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, [1.0, 2.0], 1, 5, "x"), (None, [1.0, 2.0], 1, 6, "y"), (big + 2, [1e300, 2e300], 1, 7, "z")],
                               "vec_id long, embedding array<double>, label int, gid long, code string")
    assert sorted(map(tuple, E.links(df).collect()), key=str) == sorted(
        [(big, 2, big, True), (None, 2, big, False), (big + 2, 2, big, False)], key=str)


def test_codes_survive_packing_and_bounds_hold():
    rng = np.random.default_rng(1)
    x = E.unit(rng.standard_normal((500, 33)))
    codes = E.Codes.of(x, 5, 6)
    back = E.Codes.unpacked(codes.packed(), 33, 6)
    for name in ("signs", "factor", "low", "step", "levels", "keys"):
        assert np.array_equal(getattr(codes, name), getattr(back, name)), name
    step = rng.standard_normal((500, 33))
    step -= (step * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98 ** 2) * E.unit(step)  # at exactly the least cosine
    both = E.Codes.of(np.vstack([x, y]), 5, 6)
    open_ = both.open_pairs(slice(0, 500), np.arange(500, 1000), 0, 0.98, E.SIGMAS)
    assert np.diag(open_).all()
    assert open_.mean() < 0.02  # and nearly everything else is ruled out


def test_estimate_is_unbiased():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(300):
        size = int(rng.integers(40, 60))
        q, r = np.linalg.qr(rng.standard_normal((size, size)))
        x, y = E.unit(rng.standard_normal((2, size)) + 0.5)
        a, b = q @ x, q @ y
        factor = np.abs(a).sum() / math.sqrt(size)
        errors.append(np.sign(a) @ b / math.sqrt(size) / factor - x @ y)
    assert abs(np.mean(errors)) < 0.02


def test_tables_reach_the_stated_recall():
    for rows in (10, 5000, 10 ** 7, 10 ** 10):
        bits, tables = E.tables_for(rows)
        assert (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** tables <= E.MISS
        assert rows / 2 ** bits <= E.BUCKET


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").where("label = 1")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    x = E.unit(np.array([r[1] for r in rows], np.float64))
    want = int((x @ x.T >= 0.98).sum()) - len(rows)
    got = sum(r.n_links for r in E.links(df).collect())
    assert want > 0 and 0.99 * want <= got <= want


def test_crowds_are_counted_by_balls(spark):
    """Thousands of near copies of two vectors, and vectors around the balls'
    rims, with slices far smaller than the crowds: the counts stay exact and
    the pairs of a ball are never compared."""
    rng = np.random.default_rng(9)
    rows, label = [], 1
    around = lambda v, spread: v + spread * np.linalg.norm(v) / math.sqrt(len(v)) * rng.standard_normal(len(v))
    a, b = rng.standard_normal((2, 64))
    vectors = [around(a, 0.03) for _ in range(500)] + [around(b, 0.05) for _ in range(200)]
    vectors += [around(a, rng.uniform(0.05, 0.2)) for _ in range(150)] + [rng.standard_normal(64) for _ in range(150)]
    vectors += [vectors[0] * 2.0, vectors[1]]
    rows = [(i, [float(x) for x in v], label if i % 50 else 2) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, E.links(df, miss=1e-6, slice_rows=64).collect()))
    assert got == sorted((r[0], n, c, r[0] == c) for r, (n, c) in zip(rows, plain(rows)))
    coded = df.select("label", F.xxhash64("label", F.col("embedding").cast("array<double>")).alias("h1"), F.lit(0).cast("long").alias("h2"),
                      F.col("embedding").alias("vector"))
    units = E.unit(np.array([a, b]))
    pivots = {64: ([df.select(F.xxhash64(F.lit(1))).first()[0]] * 2, units @ E.rotations(64, 64).T)}
    balls = {r.h1: r.ball for r in E._in_balls(coded, pivots, 0.98).collect()}
    by_hash = {r.h1: r.vector for r in coded.collect()}
    assert set(balls.values()) == {0, 1} and len(balls) > 600
    for h, k in balls.items():
        assert E.unit(np.array([by_hash[h]], np.float64))[0] @ units[k] >= math.sqrt(0.99)
