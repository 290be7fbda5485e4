import hashlib
import random

import numpy as np
import pytest

from quarry.llm import suffix_dedup as S


def plain(docs, window):
    """Every window of every document in order, in a dictionary."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        keep = [True] * len(data)
        for i in range(len(data) - window + 1):
            w = data[i:i + window]
            if w in seen:
                keep[i:i + window] = [False] * window
            seen.add(w)
        spans = sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep))
        left = bytes(b for b, k in zip(data, keep) if k)
        out[doc_id] = (len(data), keep.count(False), spans, hashlib.sha256(left).hexdigest())
    return out


def corpus(rng, n, alphabet="abc é"):
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(10, 200))) for _ in range(5)]
    docs = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
                 for _ in range(rng.randint(0, 8))]
        docs.append((i * 3, "".join(parts)))
    docs += [(1000, docs[3][1]), (1001, docs[3][1]), (1002, "a" * 300), (1003, "a" * 120), (1004, None), (1005, "")]
    return docs


def test_suffix_array_and_prefixes_match_sorting():
    rng = random.Random(1)
    for n in (1, 2, 30, 400):
        for letters in (b"a", b"ab", b"abcdefgh\0"):
            data = bytes(rng.choice(letters) for _ in range(n))
            text = np.frombuffer(data, np.uint8)
            order = S.suffix_array(text, 128)
            depth = lambda i: data[i:i + 100]
            assert [depth(i) for i in order] == sorted(depth(i) for i in range(n))
            want = [0] + [next((k for k in range(100) if max(a, b) + k >= n or data[a + k] != data[b + k]), 100)
                          for a, b in zip(order[:-1].tolist(), order[1:].tolist())]
            assert S.common_prefixes(text, order, 100).tolist() == want


def test_equal_windows_pick_equal_anchors(monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 64)
    rng = random.Random(2)
    for _ in range(50):
        data = bytes(rng.choice(b"abcd ") for _ in range(rng.randint(20, 300)))
        h, at, first, last = S.anchors(data, 20, 6)
        assert first[0] == 0 and last[-1] == len(data) - 20 and (first[1:] == last[:-1] + 1).all()
        chosen = {}
        for a, p, f, l in zip(h, at, first, last):
            for i in range(f, l + 1):
                key = data[i:i + 20]
                assert i <= p <= i + 14
                assert chosen.setdefault(key, (a, p - i)) == (a, p - i)


@pytest.mark.parametrize("share,shard", [(20_000, 4 << 20), (3, 200)])  # small: hot anchors over many shards
def test_removal_matches_brute_force(spark, share, shard):
    docs = corpus(random.Random(share), 60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = S.remove_repeats(df, window=20, gram=6, share=share, shard_bytes=shard).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out}
    assert len(out) == len(docs) and got == plain(docs, 20)


def test_production_window_and_odd_rows(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ñ") for _ in range(n))
    shared, long_text = text(180), text(60_000)
    docs = [(9, text(50) + shared + text(20)), (2, shared + text(70)), (5, long_text), (6, text(10) + long_text[777:]),
            (7, None), (8, "")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, place int")
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(df).collect()}
    assert out == plain(docs, 100) and out[9][1] >= 180
    assert S.remove_repeats(df.limit(0)).count() == 0
    # null and repeated ids: null first, one id by its texts' hashes, equal rows are judged alike
    odd = spark.createDataFrame([(None, shared), (3, shared), (3, shared), (4, "x" + shared)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in S.remove_repeats(odd).collect())
    size = len(shared.encode())
    assert got == [(0, 0), (3, size), (3, size), (4, size)]


def test_shares_of_a_hot_anchor_meet_by_window(spark):
    """One line in every document: no key of the merge has more rows than shares."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(15))
    docs = [(i, f"{word()}!!common line!!{word()}") for i in range(60)]
    docs += [(60 + i, docs[i][1]) for i in (4, 50)] + [(70 + 20 * i + k, "x" * k + docs[i][1][k:]) for i in (1, 33) for k in (9, 11, 13, 14)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = df.selectExpr("doc_id as place", "text")
    settled = S.settled_runs(rows, S.later_copies(rows, 20), 20, 6, 4, 200)
    sizes = [r["count"] for r in settled.where("not whole").groupBy("hi", "lo").count().collect()]
    assert sum(sizes) > 400 and 1 < max(sizes) <= -(-len(docs) // 4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in S.remove_repeats(df, window=20, gram=6, share=4, shard_bytes=200).collect()}
    assert got == plain(docs, 20)


def test_large_ids_beside_a_null(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, "x" * 200), (None, "d"), (big + 2, "e")], "doc_id long, text string")
    out = S.remove_repeats(df)
    assert {r.doc_id for r in out.collect()} == {big, None, big + 2} and dict(out.dtypes)["doc_id"] == "bigint"
