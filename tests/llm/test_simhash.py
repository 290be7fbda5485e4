import random

import numpy as np
import xxhash

from quarry.llm import simhash as H
from quarry.llm.components import connected_components


def plain_simhash(text, k=4):
    words = []
    for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).translate(
            {c: " " for c in (9, 10, 11, 12, 13)}).split(" "):
        if w:
            words.append(w)
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < k else [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(values, distance):
    """Smallest member of each component, by comparing everything."""
    values = sorted(set(values))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


def family(rng, n):
    """Random fingerprints, dense clusters and chains of small steps."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(3):
        v = rng.getrandbits(64)
        for _ in range(n // 3):
            out.append(v)
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
    return [v - 2 ** 64 if v >= 2 ** 63 else v for v in out]


def test_fingerprint_matches_the_definition():
    rng = random.Random(3)
    texts = ["", " \t\n", "One", "a b c", "a b c d", "É x\x85y Z", "a " * 300]
    texts += [" ".join(rng.choice(["The", "of", "xé", "b", "\x0bq"]) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    for t in texts:
        assert H.simhash(t) == plain_simhash(t), t


def test_chunked_texts_agree(monkeypatch):
    text = " ".join(str(i * 7919) for i in range(500))
    whole = H.simhash(text)
    monkeypatch.setattr(H, "CHUNK", 17)
    assert H.simhash(text) == whole


def test_gray_rank_orders_the_gray_sequence():
    codes = np.arange(1 << 10, dtype=np.uint64)
    codes ^= codes >> np.uint64(1)
    assert (H.gray_rank(codes) == np.arange(1 << 10, dtype=np.uint64)).all()


def test_index_finds_every_neighbour():
    rng = random.Random(4)
    values = np.unique(np.array(family(rng, 900), np.int64).view(np.uint64))
    index = H.GrayIndex(values)
    q, found = index.search(index.values[:200], 4)
    want = np.bitwise_count(index.values[:200, None] ^ index.values[None]) <= 4
    assert {*zip(q.tolist(), found.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(want)))}


def test_bucket_links_span_the_components():
    rng = random.Random(5)
    values = family(rng, 300)
    a, b = H.bucket_links(np.array(values, np.int64).view(np.uint64), 4)
    classes = plain_classes(values, 4)
    assert dict(zip(a.tolist(), b.tolist())) == {v: r for v, r in classes.items() if v != r}


def test_components_match_brute_force(spark):
    rng = random.Random(6)
    values = family(rng, 150)
    rows = [(i, v) for i, v in enumerate(values)] + [(None, values[0]), (7, values[7])]
    for blocks, limit in ((6, 50_000), (6, 12)):  # the small limit forces hot buckets to be cut again
        df = spark.createDataFrame(rows, "doc_id long, fp long")
        edges = H.links(df, 4, blocks, limit)
        roots = {r.node: r.root for r in connected_components(edges).collect()}
        classes = plain_classes(values, 4)
        assert {v: roots.get(v, v) for v in classes} == classes
    got = {(r.doc_id, r.fp): r.component_id for r in H.components(df).collect()}
    least = {}
    for i, v in rows:
        if i is not None:
            least[classes[v]] = min(i, least.get(classes[v], i))
    assert got == {(i, v): least[classes[v]] for i, v in rows}


def test_operator_rows(spark):
    rows = [(5, None, 1), (3, "", 2), (9, "the cat sat on the mat", 3), (9, "the cat sat on the mat", 3), (None, "x", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    out = sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in H.near_duplicates(df).collect())
    assert out[0][2] is None and out[0][0] == -1
    assert [(x[0], x[2]) for x in out[1:]] == [(3, 3), (5, 3), (9, 9), (9, 9)]
    assert out[1][1] == "0" * 16 and out[3][1] == f"{plain_simhash('the cat sat on the mat'):016x}"
    assert H.near_duplicates(df.limit(0)).count() == 0
