import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quarry.llm import packing as P


def plain_ids(text):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return tok.encode(text, add_special_tokens=False).ids


TEXTS = ["", " ", "Hello world", "naïve café ñandú ß Ähre", "<|endoftext|> x", "a" * 400, "\t\n\r  \x0b  x", "日本語 🙂🙂",
         "can't WON'T it's", "12345 67,89", "  x​", "!!??##"]


def test_ids_equal_those_of_the_tokenizer_file():
    rng = random.Random(1)
    encode = P.encoder()
    for text in TEXTS + ["".join(rng.choice("abE é\n'sßñ.!? 0123日🙂") for _ in range(rng.randint(1, 80))) for _ in range(300)]:
        assert encode(text) == plain_ids(text), text


def test_sum_of_squares_follows_the_rule():
    """Against the rule written out: try every open sequence."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.integers(1, 33, rng.integers(1, 60))
        place, offset = P.sum_of_squares(lengths, 32)
        gaps = {}
        for i in np.argsort(-lengths, kind="stable"):
            size, chosen = int(lengths[i]), int(place[i])

            def squares(b):
                after = [g - size if k == b else g for k, g in gaps.items()]
                counts = np.bincount([g for g in after if g > 0], minlength=1)
                return int((counts ** 2).sum())

            fits = {k: squares(k) for k, g in gaps.items() if g >= size}
            if fits:
                assert chosen in fits and fits[chosen] == min(fits.values())
            else:
                assert chosen not in gaps
            assert offset[i] == 32 - gaps.get(chosen, 32)
            gaps[chosen] = gaps.get(chosen, 32) - size


def test_cut_points():
    assert P.cut_points(1024) == [(0, 1024)]
    assert P.cut_points(1025) == [(0, 1), (1, 1024)]
    assert P.cut_points(2048) == [(0, 1024), (1024, 1024)]


def test_round_trip_and_fill(spark):
    rng = random.Random(3)
    words = ["the", "of", "naïve", "x1", "-", "longer", "words"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 5, 50, 300, 2500]))), "x") for i in range(400)]
    rows += [(None, None, "x"), (7, None, "x"), (7, "", "x"), (500, "w " * 60_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    out = [r.asDict() for r in P.pack(P.pieces(df), group=90).collect()]
    assert set(out[0]) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    want = sorted((i or -1, n, s, k, zlib.crc32(np.array(ids[s:s + k], "<u4").tobytes())) for i, t, _ in rows
                  for ids in [plain_ids(t or "") + [2]] for n, (s, k) in enumerate(P.cut_points(len(ids))))
    assert sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.1 * sum(r["length"] for r in out) / 1024 + 5
    assert P.best_fit_packing(df.limit(0)).count() == 0


def test_large_ids_beside_a_null(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, "a b c"), (None, "d"), (big + 2, "e " * 3000)], "doc_id long, text string")
    out = P.best_fit_packing(df).collect()
    assert {r.doc_id for r in out} == {big, None, big + 2} and len(out) > 4
