import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import elias_fano as E
from quarry.llm import ngram_lm as N
from quarry.llm import shared_files


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in lower.translate({c: " " for c in range(9, 14)}).split(" ") if w] + ["</s>"]


class Plain:
    """The model with dictionaries."""

    def __init__(self, texts, order, prior):
        self.order, self.prior = order, prior
        self.counts = [Counter() for _ in range(order)]
        for t in texts:
            w = words_of(t)
            for i, x in enumerate(w):
                self.counts[0][x,] += 1
                for k in range(1, order):
                    if i >= k - 1:
                        self.counts[k][tuple((["</s>"] + w)[i + 1 - k:i + 2])] += 1
        self.n, self.v = sum(self.counts[0].values()), len(self.counts[0])

    def p(self, context, word):
        if not context:
            return (self.counts[0][word,] + 0.1) / (self.n + 0.1 * (self.v + 1))
        lower = self.p(context[1:], word)
        seen = self.counts[len(context) - 1][context]
        return (self.counts[len(context)][(*context, word)] + self.prior * lower) / (seen + self.prior) if seen else lower

    def score(self, text):
        w = ["</s>"] + words_of(text)
        return sum(math.log10(self.p(tuple(w[max(0, i - self.order + 1):i]) if self.order > 1 else (), w[i]))
                   for i in range(1, len(w)))


def corpus(rng, n):
    vocabulary = ["the", "Of", "é", "x"] + [f"w{i}" for i in range(30)]
    text = lambda: rng.choice([" ", "\n", "\x0b "]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25)))
    return [(i, text()) for i in range(n)] + [(n, None), (n + 1, "")]


@pytest.mark.parametrize("n,u", [(0, 10), (1, 1), (5, 5), (1000, 1000), (1000, 10 ** 12), (5000, 7001)])
def test_elias_fano(n, u):
    rng = np.random.default_rng(n)
    values = np.sort(rng.choice(u, n, replace=False)) if u < 10 ** 7 else np.unique(rng.integers(0, u, n))
    s = E.Sequence(E.encode(values, u))
    assert (s.access(np.arange(len(values))) == values).all()
    queries = np.concatenate((rng.integers(0, u, 2000), values))
    if n:
        at = np.searchsorted(values, queries)
        assert (s.successor(queries) == at).all()
        hit = (at < n) & (values[np.minimum(at, n - 1)] == queries)
        assert (s.find(queries) == np.where(hit, at, -1)).all()
    repeated = np.sort(rng.integers(0, 50, 300))
    assert (E.Sequence(E.encode(repeated, 51)).access(np.arange(300)) == repeated).all()


def test_packed_numbers_and_files(tmp_path):
    for values in (np.array([], np.int64), np.array([0]), np.array([1, 255, 256, 2 ** 40])):
        assert shared_files.unpack_numbers(shared_files.pack_numbers(values), len(values)).tolist() == values.tolist()
    shared_files.save(f"file://{tmp_path}/a/b", {"x": np.arange(7), "y": np.array([], np.uint16)})
    got = shared_files.load(f"{tmp_path}/a/b")
    assert got["x"].tolist() == list(range(7)) and got["y"].dtype == np.uint16


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_match_dictionaries(spark, order):
    docs = corpus(random.Random(order), 150)
    out = {r.doc_id: r for r in N.language_model_scores(
        spark.createDataFrame(docs, "doc_id long, text string"), order=order, shards=3, prior=4.0).collect()}
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 10 == 0}
    model = Plain([t for i, t in docs if i not in held], order, 4.0)
    assert len(out) == len(docs) and 3 < len(held) < 40
    for i, t in docs:
        w = words_of(t)
        r = out[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (i in held, len(w), model.n)
        assert r.n_known == sum(model.counts[0][x,] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(math.log10((model.counts[0][x,] + 0.1) / (model.n + 0.1 * (model.v + 1))) for x in w))
        assert r.score == pytest.approx(model.score(t), abs=1e-3 * len(w) * order)


def test_probabilities_sum_to_one():
    model = Plain([t for _, t in corpus(random.Random(9), 60)], 3, 2.0)
    words = [w for w, in model.counts[0]] + ["never seen"]
    for context in ((), ("the",), ("the", "x"), ("never", "seen")):
        assert sum(model.p(context, w) for w in words) == pytest.approx(1)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b", 1), (1, "a " * 400_000, 1), (1, "a b", 1), (1, "a b", 1)],
                               "doc_id long, text string, score int")
    out = N.language_model_scores(df).collect()
    assert sorted(r.n_tokens for r in out) == [3, 3, 3, 400_001] and all(r.score < 0 for r in out)
    assert N.language_model_scores(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(20, "a b")], "doc_id long, text string")  # no training rows if held out
    assert [r.n_tokens for r in N.language_model_scores(alone).collect()] == [3]


def test_default_model_scores_with_two_words_of_context(spark):
    docs = corpus(random.Random(11), 200)
    out = {r.doc_id: r.score for r in N.language_model_scores(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    train = [t for i, t in docs if zlib.crc32(str(i).encode()) % 10]
    bigram, trigram = Plain(train, 2, N.PRIOR), Plain(train, 3, N.PRIOR)
    for i, t in docs:
        assert out[i] == pytest.approx(trigram.score(t), abs=2e-3 * len(words_of(t)))
    assert sum(abs(out[i] - bigram.score(t)) > 1e-2 * len(words_of(t)) for i, t in docs) > 20


def test_tokens_match_a_plain_split():
    texts = ["", " ", "a", "\x0b A b\x0c\ta\r\n", "É é x y", "a " * 50, "\x1c\x1d z\x85"]
    tokens = N.Tokens(N.pa.array(texts)[1:])  # a slice, as chunks are
    names = {}
    for t, low, size in zip(texts[1:], tokens.starts, tokens.sizes):
        words = words_of(t)
        assert size == len(words)
        for w, i in zip(words, tokens.ids[low:low + size]):
            assert names.setdefault(w, i) == i
    assert names["</s>"] == 0 and len(set(names.values())) == len(names) == len(set(tokens.hashes.tolist()))


def test_a_lookup_selects_about_once(monkeypatch):
    values = np.unique(np.random.default_rng(1).integers(0, 10 ** 12, 20_000))
    s = E.Sequence(E.encode(values, 10 ** 12))
    asked, plain = [], E.Sequence._select
    monkeypatch.setattr(E.Sequence, "_select", lambda self, k, ones: (asked.append(len(k)), plain(self, k, ones))[1])
    assert (s.find(values) == np.arange(len(values))).all()
    assert sum(asked) < 1.3 * len(values)  # once for the bucket, again only where it runs over a word


@pytest.mark.parametrize("n,u", [(1, 1), (1000, 70), (1000, 10 ** 6), (3000, 3100)])
def test_a_value_and_the_one_after(n, u):
    values = np.sort(np.random.default_rng(n).integers(0, u, n + 1))
    one, two = E.Sequence(E.encode(values, u)).access_two(np.arange(n))
    assert (one == values[:-1]).all() and (two == values[1:]).all()


def test_large_ids_beside_a_null_keep_their_value(spark):
    df = spark.createDataFrame([(2 ** 53 + 1, "a b"), (None, "a"), (2 ** 60 + 3, None)], "doc_id long, text string")
    assert {r.doc_id for r in N.language_model_scores(df).collect()} == {2 ** 53 + 1, None, 2 ** 60 + 3}


def test_a_lookup_goes_to_its_bucket_by_a_pointer(monkeypatch):
    values = np.unique(np.random.default_rng(2).integers(0, 10 ** 12, 20_000))
    s = E.Sequence(E.encode(values, 10 ** 12))
    asked, plain = [], E.Sequence._select
    monkeypatch.setattr(E.Sequence, "_select", lambda self, k, ones: (asked.append(len(k)), plain(self, k, ones))[1])
    assert (s.find(values) == np.arange(len(values))).all()
    assert sum(asked) < 0.01 * len(values)


def test_crowded_buckets_are_searched():
    rng = np.random.default_rng(3)
    near = [start + rng.choice(1500, 700, replace=False) for start in (0, 10 ** 6, 10 ** 6 + 4000, 10 ** 9 - 1500)]
    values = np.unique(np.concatenate([*near, rng.integers(0, 10 ** 9, 300)]))
    s = E.Sequence(E.encode(values, 10 ** 9))
    queries = np.concatenate((values, values[:-1] + 1, rng.integers(0, 10 ** 9, 1000)))
    at = np.searchsorted(values, queries)
    assert (s.successor(queries) == at).all()
    hit = (at < len(values)) & (values[np.minimum(at, len(values) - 1)] == queries)
    assert (s.find(queries) == np.where(hit, at, -1)).all()


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_words_of_a_shard_spread_over_its_buckets(tmp_path, shards):
    hashes = np.unique(np.random.default_rng(shards).integers(0, 1 << 62, 4000))
    of = N.shard_of_hash(hashes, shards)
    assert all(of[np.searchsorted(hashes, N.first_hash(s, shards))] == s for s in range(shards))
    meta = {"shards": [shards], "total": 4000, "sizes": [len(hashes)], "prior": 1.0, "offsets": [np.searchsorted(of, range(shards)).tolist()],
            "counts": [np.bincount(of, minlength=shards).tolist()]}
    counts = np.where(np.arange(len(hashes)) % 7, 1, 10 ** 10)
    for s in range(shards):
        N._write_level(1, str(tmp_path), meta)(packed(s, hashes[of == s], counts[of == s]))
    trie = N.Trie(str(tmp_path), meta)
    asked = np.random.default_rng(4).permutation(np.concatenate((hashes, hashes + 1)))
    words, seen = trie.words(asked)
    at = np.searchsorted(hashes, asked)
    known = hashes[np.minimum(at, len(hashes) - 1)] == asked
    assert (words == np.where(known, at, -1)).all() and (seen == np.where(known, counts[np.minimum(at, len(hashes) - 1)], 0)).all()
    for s in range(shards):
        begin, end = trie.shard(1, s)["keys"]._bucket(hashes[of == s] - N.first_hash(s, shards))
        assert (end - begin).mean() < 2


def packed(shard, keys, counts):
    gaps = np.diff(keys, prepend=0)
    return N.pd.DataFrame({"shard": [shard], "n": [len(keys)], "keys": [shared_files.pack_numbers(gaps)],
                           "counts": [shared_files.pack_numbers(counts)]})


def test_a_level_is_written_without_lookups_in_lower_ones(tmp_path):
    meta = {"shards": [2, 2], "total": 100, "sizes": [10], "prior": 1.0, "counts": [[5, 5]], "offsets": [[0, 5]]}
    keys, counts = np.arange(0, 50, 7), np.array([1, 2, 254, 255, 256, 2 ** 40, 3, 1])
    out = N._write_level(2, f"{tmp_path}/no_lower", meta)(packed(0, keys, counts))
    assert out.total.tolist() == [counts.sum()]
    file = shared_files.load(f"{tmp_path}/no_lower/level2/0")
    assert file["count"].nbytes == len(keys)  # a byte each, the large ones apart
    assert N.counts_at(file, np.arange(8)[::-1]).tolist() == counts[::-1].tolist()
