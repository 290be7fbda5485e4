import hashlib
import random

import numpy as np

from quarry.llm import edit_embedding as X


def plain_fingerprint(text):
    """One walk at a time, and for each slot the best step it reached."""
    moves, symbols = X._moves(), X.classes(text).tolist()
    written, at, j = [], 0, 0
    while at < len(symbols):
        written.append(symbols[at])
        at += moves[j % X.PERIOD, symbols[at]]
        j += 1
    j = np.arange(len(written), dtype=np.uint64)
    slot = X._mix(j + np.uint64(X.SEED * 3)) % np.uint64(X.SLOTS)
    priority = X._mix(j + np.uint64(X.SEED * 7))
    out = [0] * X.SLOTS
    for s in range(X.SLOTS):
        own = np.flatnonzero(slot == s)
        if len(own):
            out[s] = written[own[priority[own].argmin()]] % 15 + 1
    return "".join(f"{d:x}" for d in out)


def prints(texts):
    return X.walk([X.classes(t) for t in texts])


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdluñé") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_walks_side_by_side_equal_single_walks():
    rng = random.Random(1)
    texts = ["", "a", "aa", "é🙂", prose(rng, 3), prose(rng, 400), "", prose(rng, 60), "x" * 3000]
    assert X.as_text(prints(texts)) == [plain_fingerprint(t) for t in texts]
    assert (X.from_text(X.as_text(prints(texts))) == prints(texts)).all()


def test_long_texts_extend_the_sample(monkeypatch):
    monkeypatch.setattr(X, "SAMPLE_STEPS", 256)
    X.worker_cache().pop("samples", None)
    text = prose(random.Random(2), 300)
    small = X.as_text(prints([text]))
    X.worker_cache().pop("samples", None)
    assert small == [plain_fingerprint(text)]


def test_likeness_follows_edits():
    rng = random.Random(3)
    near, far = [], []
    for _ in range(40):
        text = prose(rng, 300)
        at = rng.randrange(len(text))
        one = text[:at] + rng.choice("xyz") + text[at + rng.randint(0, 1):]
        a, b, c = prints([text, one, prose(rng, 300)])
        near.append(X.likeness(a[None], b[None])[0])
        far.append(X.likeness(a[None], c[None])[0])
    assert np.mean(near) > 0.85 and np.mean(far) < 0.25 and np.mean(near) > 3 * np.mean(far)
    empty = prints(["", "abc"])
    assert X.likeness(empty[:1], empty[:1])[0] == 1 and X.likeness(empty[:1], empty[1:])[0] == 0


def rows_of(docs):
    docs = [(i, t or "") for i, t in sorted(docs)]
    out = {}
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        k = len(text) // 4
        edited = text[:len(text) - k] + following[:k]
        a, b, c = prints([text, edited, following])
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), *X.as_text(np.array([a, b])),
                  X.likeness(a[None], b[None])[0], X.likeness(a[None], c[None])[0])
    return out


def got(df, **options):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
            for r in X.edit_fingerprints(df, **options).collect()}


def test_query_rows_match_the_definition(spark):
    rng = random.Random(5)
    docs = [(i * 7, prose(rng, rng.choice([0, 1, 5, 40, 200]))) for i in range(90)] + [(3, None), (4, ""), (5, "ab")]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, place string")
    want = rows_of(docs)
    for options in ({}, {"rows_per_part": 7}):
        out = got(df, **options)
        assert out == want
    assert np.mean([v[4] for v in want.values() if v[0] > 300]) > 0.7
    alone = got(df.where("doc_id = 7"))
    assert alone == rows_of([d for d in docs if d[0] == 7])
    assert got(df.limit(0)) == {}


def test_odd_ids_and_long_text(spark):
    df = spark.createDataFrame([(None, "abc"), (None, "abc"), (1, "b" * 200_000), (1, "b" * 200_000), (1, "c")],
                               "doc_id long, text string")
    out = X.edit_fingerprints(df).collect()
    assert len(out) == 5 and sorted(r.n_chars for r in out) == [1, 3, 3, 200_000, 200_000]
    assert len({(r.fingerprint, r.edited_sha256) for r in out if r.n_chars == 200_000}) == 1


def test_near_classes_match_brute_force(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(12):
        text = prose(rng, 200)
        texts.append(text)
        for _ in range(rng.randint(0, 4)):
            text = text[:-rng.randint(1, 20)] + prose(rng, 2)
            texts.append(text)
    names = sorted(set(X.as_text(prints(texts))))
    found = X.from_text(names)
    root = {n: n for n in names}
    for i, a in enumerate(names):
        for j in range(i):
            if X.shares_band(found[[i]], found[[j]])[0] and X.likeness(found[[i]], found[[j]])[0] >= 0.8:
                low, high = sorted((root[a], root[names[j]]))
                root = {k: low if v == high else v for k, v in root.items()}
    df = spark.createDataFrame([(n,) for n in names + names[:5]], "fingerprint string")
    for limit in (20_000, 2):
        assert {r.fingerprint: r["class"] for r in X.near_classes(df, max_bucket=limit).collect()} == root
    assert len(set(root.values())) < len(names)
