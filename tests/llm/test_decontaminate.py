import random
from itertools import combinations

import pytest

from quarry.llm import decontaminate as D


def plain(docs, items):
    """Every document against every item at every shift."""
    words = lambda t: [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
    found = {}
    for d, text in docs:
        doc = words(text)
        for i, item_text in items:
            item = words(item_text)
            if len(item) < D.SHORTEST:
                continue
            size = min(D.WINDOW, len(item))
            allowed = D.MISSES if len(item) >= D.WINDOW else 0
            for shift in range(-len(item), len(doc)):
                equal = [0 <= shift + k < len(doc) and doc[shift + k] == item[k] for k in range(len(item))]
                for s in range(len(item) - size + 1):
                    n = sum(equal[s:s + size])
                    if size - n <= allowed:
                        best = (n, -(shift + s), -s)
                        found[d, i] = max(found.get((d, i), best), best)
    return {k: (n, -a, -b) for k, (n, a, b) in found.items()}


def test_the_seed_survives_every_choice_of_misses():
    for misses in combinations(range(D.WINDOW), D.MISSES):
        assert any(all(mark == "0" or a + i not in misses for i, mark in enumerate(seed))
                   for seed in D.SEEDS for a in range(D.WINDOW - len(seed) + 1)), misses


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of", "é"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rng.choice([3, 6, 9, 13, 20, 40]))) for i in range(25)]
    docs = []
    for d in range(120):
        doc = text(rng.randint(0, 60))
        if d % 2:
            item = list(rng.choice(items)[1])
            low = rng.randint(0, max(0, len(item) - 13))
            part = item[low:] if d % 4 == 1 else item
            for _ in range(rng.randint(0, 4)):
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            at = rng.randint(0, len(doc))
            doc[at:at] = part
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(doc).upper()))
    return docs, [(i, " ".join(t)) for i, t in items]


@pytest.mark.parametrize("bound", [0, 250_000])  # 0: the join without a broadcast
def test_overlaps_match_brute_force(spark, bound):
    docs, items = corpus(random.Random(7))
    out = D.find_overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=bound).collect()
    want = plain(docs, items)
    assert len(out) == len(want) > 20
    assert {(r.doc_id, r.item_id): (r.matched, r.doc_start, r.item_start) for r in out} == want


def test_odd_rows(spark):
    item = " ".join(f"t{i}" for i in range(20))
    docs = [(1, None, 0), (1, "", 0), (None, "x " + item, 0), (2, item, 0), (2, item, 0), (2, "clean", 0),
            (3, "pad " * 50_000 + item, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(5, item), (5, item), (None, None), (6, "")], "item_id long, text string")
    out = D.find_overlaps(df, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.matched) for r in out) == [(0, 5, 13), (2, 5, 13), (3, 5, 13)]
    kept = D.decontaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(2, "clean")] and kept.count() == 3
    assert D.find_overlaps(df.limit(0), bench).count() == 0
    assert D.find_overlaps(df, bench.limit(0)).count() == 0


def test_the_plan_is_native_and_splits_texts_once(spark, tmp_path):
    spark.createDataFrame([(1, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    bench = spark.createDataFrame([(5, " ".join(f"t{i}" for i in range(20)))], "item_id long, text string")
    plan = D.find_overlaps(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("split(") == 1, plan
