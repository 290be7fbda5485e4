import random

import numpy as np

from quarry.llm import toxicity as T

WORDS = ("idiot", "moron", "scum", "loser", "trash")

def made(n, rng):
    """Texts whose toxic ones hold a fixed word or a made-up stem."""
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 7))) for _ in range(rng.randint(5, 40))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(WORDS) if i % 2 else "zworg" + rng.choice("aeiou") * 2)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_feature_entries_agree_with_the_counted_ones():
    lexicon = ["idiot ", "zwor", "ab "]
    index = {e: i for i, e in enumerate(lexicon)}
    for text in ("Idiot idiot IDIOTS", "zworga zworg zwor", "ab abc", "", "x!!! AB"):
        got, plain = T.features(text, index, T.heads_of(index))
        words = T.count_words(text)
        for e, i in index.items():
            assert got.get(i, 0) == sum(n for w, n in words.items() if e in T.entries({w: 1})), (text, e)
        assert plain[-1] == sum(words.values()) and len(plain) == T.PLAIN


def test_patterns():
    fires = lambda text: {n for n, p in T.PATTERNS.items() if p.search(text)}
    assert fires("A plain text, with a.b@c.de and 3 things? Yes! See p. 12, NATO.") == {"capital words"}
    assert fires("what?! sooooo st*pid, t h a t @#$! 1d10t fo0l") >= {"marks", "drawn-out letters", "masked word", "symbols",
                                                                         "spaced letters", "numbered letters"}
    assert T.plain_features("no no no", ["no"] * 3)[len(T.PATTERNS)] == 1


def test_the_cheap_look_spares_no_match():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("aabBAÉé 1 4!?*#$%&@ _") for _ in range(rng.randint(0, 14)))
        words = T.WORD.findall(text.lower())
        letters = sum(map(len, words))
        got = T.plain_features(text, words)
        assert got[:len(T.PATTERNS)] == [len(list(p.finditer(text))) for p in T.PATTERNS.values()], text
        assert got[-2] == (sum(map(str.isupper, text)) / letters if letters else 0.0)


def test_counts_equal_brute_force(spark):
    docs, labels = made(300, random.Random(3))
    rows = [(t, y) for (_, t), (_, _, y) in zip(docs, labels)] + [("", 1), ("", 0)]
    want = {}
    for text, y in rows:
        words = ["", *T.WORD.findall(text.lower()), ""]
        first = {}
        for before, word, after in zip(words, words[1:], words[2:]):
            for e in T.entries({word: 1}):
                first.setdefault(e, (before, after))
        for e, context in first.items():
            pos, contexts, neg = want.setdefault(e, [0, set(), 0])
            want[e] = [pos + y, contexts | {context} if y else contexts, neg + 1 - y]
    got = {r.entry: (r.pos, r.contexts, r.neg) for r in T.count_entries(spark.createDataFrame(rows, "text string, toxic int").repartition(7)).collect()}
    assert got == {e: (pos, len(contexts), neg) for e, (pos, contexts, neg) in want.items()}


def test_label_model_equals_a_plain_one():
    """Expectation maximisation written row by row, without shared weights
    (independent voters), from the definition."""
    rng = np.random.default_rng(4)
    y = rng.random(400) < 0.3
    votes = np.column_stack([np.where(y, rng.random(400) < a, rng.random(400) < b) for a, b in ((0.7, 0.02), (0.5, 0.05), (0.2, 0.1))])
    given = np.where(rng.random(400) < 0.05, ~y, y).astype(int)
    out = T.label_model(votes, given, rounds=5)  # correlations come in later
    all_votes = [[*map(int, v), int(g == 1), int(g != 1)] for v, g in zip(votes, given)]
    belief = [0.95 if g else 0.02 for g in given]
    prior = sum(given) / 400
    for _ in range(5):
        rates = []
        for k in range(5):
            on = (sum(p * v[k] for p, v in zip(belief, all_votes)) + 0.05) / (sum(belief) + 0.1)
            off = (sum((1 - p) * v[k] for p, v in zip(belief, all_votes)) + 0.05) / (400 - sum(belief) + 0.1)
            rates.append((on, off))
        new = []
        for v in all_votes:
            toxic, clean = prior, 1 - prior
            for k, fired in enumerate(v):
                if fired:
                    toxic, clean = toxic * rates[k][0], clean * rates[k][1]
            new.append(toxic / (toxic + clean))
        belief = new
    assert np.allclose(out["posterior"], belief)


def test_label_model_recovers_rates_and_shares_correlated_votes():
    rng = np.random.default_rng(1)
    y = rng.random(8000) < 0.3
    fire = lambda on, off: np.where(y, rng.random(8000) < on, rng.random(8000) < off)
    a, b = fire(0.7, 0.02), fire(0.5, 0.05)
    fires_on_noise = rng.random(8000) < 0.1
    c, d = a | fires_on_noise, a | fires_on_noise  # two copies of one voter
    given = np.where(rng.random(8000) < 0.05, ~y, y).astype(int)  # labels with errors
    none = ~(a | b | c)
    out = T.label_model(np.column_stack([a, b, c, d, none]), given)
    assert abs(out["prior"] - 0.3) < 0.05
    assert abs(out["on_toxic"][1] - 0.5) < 0.07 and abs(out["on_clean"][1] - 0.05) < 0.04
    assert out["correlation"][2, 3] > 0.9 and out["weight"][2] < 0.6
    assert ((out["posterior"] > 0.5) == y).mean() > 0.93


def test_held_out_accuracy(spark):
    docs, labels = made(1500, random.Random(8))
    out = T.toxicity(spark.createDataFrame(docs, "doc_id long, text string"),
                     spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out]
    assert len(out) == 1500 and 250 < len(held) < 500
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_held_out_labels_are_never_used(spark):
    docs, labels = made(400, random.Random(9))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = {r.doc_id for r in T.toxicity(df, truth).where("held_out").collect()}
    flipped = spark.createDataFrame([(i, q, 1 - t if i in held else t) for i, q, t in labels],
                                    "doc_id long, quality int, toxic int")
    one, two = ({r.doc_id: r.score for r in T.toxicity(df, x).collect()} for x in (truth, flipped))
    assert one == two


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "you idiot", 5), (2, "idiot " * 100_000, 5)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([(None, None), (1, None)], "doc_id long, toxic int")
    assert [r.score for r in T.toxicity(docs, none).collect()] == [T.PRIOR] * 4
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], "doc_id long, toxic int")
    out = T.toxicity(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 4
    assert len({r.score for r in out.where("doc_id = 1").collect()}) == 1
    assert T.toxicity(docs.limit(0), labels).count() == 0
    assert T.without_toxic(docs, none).columns == docs.columns


def test_lexicon_counts_all_rows_and_keeps_rare_and_noisy_entries(spark):
    rng = random.Random(8)
    plain = ["house", "river", "music", "garden", "winter", "market"]
    rows = []
    for i in range(12_000):
        words = rng.sample(plain, 3)
        toxic = int(i < 2400)
        if toxic and i % 150 == 0:
            words.append("zorbl")  # in under 1 % of the toxic documents
        if toxic and i % 2 or not toxic and i % 100 == 0:
            words.append("vexil")  # half of the toxic, 1 % of the clean
        if toxic:
            words += [f"quill{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}"] * 2  # 100 forms
        rows.append((" ".join(words), toxic))
    found = T.mine_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    matched = lambda word: any(e in found for e in T.entries(T.Counter([word])))
    assert matched("zorbl") and matched("vexil") and matched("quillab")
    assert not any(matched(w) for w in plain)


def test_lexicon_is_mined_outside_the_sample(spark):
    docs = [(i, f"plain words {'house' * (i % 7)} {'grumpf' if i % 5 == 0 else 'house'} {'river' * (i % 9)}") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in docs], "doc_id long, toxic int")
    model = T.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels, sample=10)
    assert any(e in model.lexicon for e in T.entries(T.Counter(["grumpf"])))


def test_copies_of_a_toxic_document_are_no_further_evidence(spark):
    rows = [("some words around blorptal in one copied text", 1)] * 200 + [(f"clean words {'xy' * (i % 50)}", 0) for i in range(800)]
    assert T.mine_lexicon(spark.createDataFrame(rows, "text string, toxic int")) == []
