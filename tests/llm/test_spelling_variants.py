import random
import re
import zlib
from collections import Counter

import pytest

from quarry.llm import spelling_variants as S


def plain_words(rows, spoil):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if spoil and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain(words):
    forms, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return out


def variants(rng, n):
    """Words in families: edits of edits, runs of one letter, far counts."""
    out = {}
    for _ in range(n):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        for k in range(rng.randint(1, 8)):
            out[w] = rng.choice([5, 6, 25, 30, 125, 200, 1000, 5000])
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abéÿ") + w[i:], w[:i] + rng.choice("abé") + w[i + 1:], w + w[-1]])
            if len(w) < 6:
                break
    return out


@pytest.mark.parametrize("longest", [64, 4])
def test_variants_equal_brute_force(spark, longest):
    words = variants(random.Random(longest), 120)
    words |= {"x" * 70: 900, "x" * 71: 20, "x" * 64: 7, "x" * 65: 40, "x" * 69 + "y": 10, "y" + "x" * 64: 6}
    got = S.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"), longest=longest).collect()
    assert len(got) == len(words)
    assert {tuple(r) for r in got} == plain(words)


@pytest.mark.parametrize("spoil", [False, True])
def test_documents_equal_brute_force(spark, spoil):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(None, "Straße straße STRASSE " * 6), (rows[0][0], rows[0][1]), (7, None), (8, ""), (9, "naïveté×÷ " * 3 + "1Abcdef2" * 4)]
    got = S.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), spoil=spoil).collect()
    words = plain_words(rows, spoil)
    assert {r.word: r.n for r in got} == words
    assert {tuple(r) for r in got} == plain(words)


def test_words_of_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 7)
    text = "Abcdefghij kl mnopqrstuvwxyzabcdefg, é hij " * 5
    assert list(S.words_in(text)) == re.findall(S.PATTERN, text.lower())


def test_every_pair_meets_once():
    rng = random.Random(1)
    words = list(variants(rng, 60))
    for a in words:
        keys = {}
        for key, whole, inserted in S.rotations(a):
            keys.setdefault(key, []).append((whole, inserted))
        for b in words:
            if a == b:
                continue
            met = 0
            for key, whole, inserted in S.rotations(b):
                for w, i in keys.get(key, []):
                    met += (not w and not whole) or (w and inserted and not whole) or (whole and i and not w)
            assert met == one_edit(a, b), (a, b)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, word string, n long, id long"
    assert S.spelling_variants(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, "colour " * 30 + "color " * 6, "x", 1, 1)], schema)
    assert [tuple(r) for r in S.spelling_variants(df).collect()] == [("colour", None, "colour", 30, 0, None)]
