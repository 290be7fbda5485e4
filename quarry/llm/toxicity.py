"""Toxicity scores by weak supervision.

1. Voters. Each is a lexicon entry (a word, or a word beginning) or a pattern
   of the text; a vote says "toxic" or abstains, and an abstention is no
   evidence. One voter says "clean" where no entry occurs. No word is given: entries
   are the words and beginnings that are telling. Their document
   frequencies over all labelled training documents, counted in Spark, show
   them significantly more than ``LEAST_LIFT`` times as often in toxic ones.
   Patterns are general (marks, capitals, drawn-out, masked, spaced or numbered
   letters, repeated words).
2. Label model. A generative model (expectation maximisation over the votes)
   estimates how often each voter fires on toxic and on clean documents. The
   given label is one more voter, whose own error rates are estimated too.
   Voters that still fire together once the posterior is known are correlated;
   the weight of their votes is shared, so that one cause counted by several
   voters is not taken for several causes.
3. Classifier. A linear (logistic) model over the voters' counts and a few
   plain features learns the posterior labels and scores every document.

Steps 2 and 3 run on the driver over a bounded sample: at most
``SAMPLE`` labelled training documents, chosen by a hash of the id (so the
choice does not depend on order or partitioning). An entry that fires on fewer
than ``LEAST_FIRES`` of them has no weight of its own there: such entries vote,
and count, together. So both matrices are bounded by the sample. What grows with the
corpus (counting the words of all labelled training documents, scoring every
whole text) runs in Spark tasks. The telling entries reach the driver; each
stands in at least one of ``RAREST`` toxic documents, which bounds them by that
many times the entries of a document.

Defined cases: null and empty texts get the score of a text without words;
a null id is never a training row; several labels of an id count as the
largest; ids repeated in the documents are scored row by row; without any
training rows every score is ``PRIOR``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quarry.llm.common import crc_bucket, cut, pick, whole_text

SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PRIOR = 0.05
STEM = (4, 5, 6, 7)  # lengths of word beginnings that may become voters
LEAST_LIFT = 2.0
CHANCE = 0.01  # that any entry at all is taken for telling by chance
RAREST = 20_000
LEAST_FIRES = 5
BROADCAST_IDS = 2_000_000
FLUSH = 500_000  # counters held by a task before they are handed on

WORD = re.compile(r"[^\W\d_]+")
#: What a text may do whatever its language; each is a voter.
PATTERNS = {
    "marks": re.compile(r"[!?]{2,}"),
    "capital words": re.compile(r"\b[A-Z]{4,}\b"),
    "drawn-out letters": re.compile(r"([^\W\d_])\1{3,}"),
    "masked word": re.compile(r"[^\W\d_][*#$%]+[^\W\d_]"),
    "symbols": re.compile(r"[#$%&*@!?]{3,}"),
    "spaced letters": re.compile(r"(?<!\w)(?:[^\W\d_] ){3,}[^\W\d_](?!\w)"),
    "numbered letters": re.compile(r"[^\W\d_]{2}[0134579]+[^\W\d_]"),
}
PLAIN = len(PATTERNS) + 3  # and: words three times over, share of capitals, number of words


def entries(words: Counter) -> set[str]:
    """The lexicon entries that a text's words could match: a word is marked
    by a trailing blank, a beginning by none."""
    found = set()
    for w in words:
        found.add(w + " ")
        for n in STEM:
            if len(w) > n:
                found.add(w[:n])
    return found


def count_words(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def hits(words: Counter, lexicon: dict[str, int], heads: set[str]) -> dict[int, int]:
    """Hits by lexicon entry."""
    out: dict[int, int] = {}
    for w, n in words.items():
        if w[:STEM[0]] not in heads:
            continue
        for entry in (w + " ", *(w[:k] for k in STEM if len(w) > k)):
            i = lexicon.get(entry)
            if i is not None:
                out[i] = out.get(i, 0) + n
    return out


def may_occur(points: np.ndarray) -> dict[str, bool]:
    """Patterns that a text (its code points) has what they need for; a cheap
    look that spares most texts most of the matching."""

    def side_by_side(mask: np.ndarray, n: int, step: int = 1) -> bool:
        """Does the mask hold at n places, each ``step`` after the one before?"""
        span = (n - 1) * step
        if len(mask) <= span:
            return False
        held = mask[:len(mask) - span]
        for i in range(step, span + 1, step):
            held = held & mask[i:len(mask) - span + i]
        return bool(held.any())

    mark = (points == ord("!")) | (points == ord("?"))
    mask = np.isin(points, [ord(c) for c in "*#$%"])
    digit = (points >= ord("0")) & (points <= ord("9"))
    return {
        "marks": side_by_side(mark, 2),
        "capital words": side_by_side((points >= ord("A")) & (points <= ord("Z")), 4),
        "drawn-out letters": side_by_side(points[1:] == points[:-1], 3),
        "masked word": bool(mask.any()),
        "symbols": side_by_side(mark | mask | (points == ord("&")) | (points == ord("@")), 3),
        "spaced letters": side_by_side(points == ord(" "), 3, 2),
        "numbered letters": bool((digit[:-1] & (points[1:] >= ord("A"))).any()),
    }


def capitals(points: np.ndarray) -> int:
    beyond = points[points > 127].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return int(((points >= ord("A")) & (points <= ord("Z"))).sum()) + sum(map(str.isupper, beyond))


def plain_features(text: str, words: list[str]) -> list[float]:
    """How often each pattern occurs; words three times over; the share of
    capitals; the number of words."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    may = may_occur(points)
    found = [sum(1 for _ in pattern.finditer(text)) if may[name] else 0 for name, pattern in PATTERNS.items()]
    found.append(sum(1 for a, b, c in zip(words, words[1:], words[2:]) if a == b == c))
    letters = sum(map(len, words))
    found.append(capitals(points) / letters if letters else 0.0)
    found.append(len(words))
    return found


def heads_of(lexicon: dict[str, int]) -> set[str]:
    return {entry.strip()[:STEM[0]] for entry in lexicon}


def features(text: str, lexicon: dict[str, int], heads: set[str]) -> tuple[dict[int, int], list[float]]:
    words = WORD.findall(text.lower())
    return hits(Counter(words), lexicon, heads), plain_features(text, words)


# --- lexicon -------------------------------------------------------------------------------------

def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of all labelled training ids."""
    labelled = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return labelled.where(crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)


def training_rows(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of at most ``sample`` labelled training rows."""
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # a top-k: one bounded heap per task
    # the chosen ids are bounded by ``sample``, 16 bytes each
    return docs.join(F.broadcast(cut(chosen)), "doc_id").select("doc_id", "text", "toxic")


def count_entries(rows: DataFrame) -> DataFrame:
    """(entry, pos, contexts, neg) over labelled texts (text, toxic): how many
    toxic and clean texts hold an entry, and how many different pairs of words
    stand beside it where a toxic text first holds it. A task sums what it
    reads before it hands anything on."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic_counts: Counter = Counter()
        clean_counts: Counter = Counter()

        def handed_on() -> pd.DataFrame:
            keys = [*toxic_counts, *((e, None) for e in clean_counts)]
            out = pd.DataFrame({"entry": [e for e, _ in keys], "context": pd.array([c for _, c in keys], dtype="Int64"),
                                "n": [*toxic_counts.values(), *clean_counts.values()]})
            toxic_counts.clear()
            clean_counts.clear()
            return out

        for part in parts:
            for text, toxic in zip(part["text"], part["toxic"]):
                if not toxic:
                    clean_counts.update(entries(count_words(text)))
                else:
                    words = ["", *WORD.findall(text.lower()), ""]
                    first: dict[str, int] = {}
                    for before, word, after in zip(words, words[1:], words[2:]):
                        for entry in entries(Counter((word,))):
                            if entry not in first:
                                first[entry] = xxhash.xxh64_intdigest(f"{before} {after}") - (1 << 63)
                    toxic_counts.update(first.items())
                if len(toxic_counts) + len(clean_counts) > FLUSH:
                    yield handed_on()
        if toxic_counts or clean_counts:
            yield handed_on()

    counted = rows.select("text", (F.col("toxic") > 0).alias("toxic")).mapInPandas(count, "entry string, context long, n long")
    by_context = counted.groupBy("entry", "context").agg(F.sum("n").alias("n"))
    toxic = F.col("context").isNotNull()
    total = lambda mask: F.coalesce(F.sum(F.when(mask, F.col("n"))), F.lit(0))
    return by_context.groupBy("entry").agg(total(toxic).alias("pos"), F.count("context").alias("contexts"), total(~toxic).alias("neg"))


def mine_lexicon(rows: DataFrame) -> list[str]:
    """Entries that tell toxic training texts from clean ones (text, toxic). A
    longer entry covered by a chosen beginning goes.

    Of the documents that hold an entry, the toxic ones would be a share of at
    most q, were it LEAST_LIFT times as frequent there or less. Chernoff's
    bound on that many of them is the level of its test, which is divided by
    the number of entries tested. Copies and near copies of a toxic document
    are no further evidence: documents count as far as the words beside the
    entry differ.
    """
    sizes = rows.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    n_pos, n_neg = sizes
    if not n_pos or not n_neg:
        return []
    share = LEAST_LIFT * n_pos / (LEAST_LIFT * n_pos + n_neg)
    counted = cut(count_entries(rows).where(F.col("pos") > 0))
    level = math.log(max(counted.count(), 1) / CHANCE)
    of = F.col("pos") + F.col("neg")
    evidence = F.col("pos") * F.log(F.col("pos") / (of * share)) \
        + F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (of * (1 - share)))).otherwise(0.0)
    telling = counted.where((F.col("pos") > of * share) & (F.col("pos") * RAREST >= n_pos)) \
        .withColumn("evidence", evidence * F.col("contexts") / F.col("pos")).where(F.col("evidence") >= level) \
        .orderBy(F.col("evidence").desc(), F.length("entry"), "entry").select("entry").collect()
    chosen, taken, beginnings = [], set(), set()
    for (entry,) in telling:
        if any(entry[:n] in beginnings for n in STEM if len(entry.strip()) >= n):
            continue
        if entry + " " in taken:  # a beginning that only ever is a chosen word itself
            continue
        chosen.append(entry)
        taken.add(entry)
        if not entry.endswith(" "):
            beginnings.add(entry)
    return chosen


# --- label model ---------------------------------------------------------------------------------

def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 50) -> dict[str, np.ndarray | float]:
    """Expectation maximisation for P(vote | toxic) and P(vote | clean).

    ``votes`` are 0/1 (documents x voters; a 0 abstains), ``given`` the labels,
    which vote both ways and set the prior. Returns the prior, the firing rates, the voters'
    shared weights, their correlations and the posterior of every row.
    """
    voters = np.column_stack([votes, given == 1, given != 1]).astype(float)
    posterior = np.where(given == 1, 0.95, 0.02)
    prior = float(np.clip(given.mean(), 1e-4, 1 - 1e-4))  # the class balance is the labels'
    n, m = voters.shape
    weight = np.ones(m)
    correlation = np.eye(m)
    for step in range(rounds):
        on_toxic = (posterior @ voters + 0.05) / (posterior.sum() + 0.1)
        on_clean = ((1 - posterior) @ voters + 0.05) / ((1 - posterior).sum() + 0.1)
        if step in (5, 15):  # correlations left over once the label is known
            left = voters - np.outer(posterior, on_toxic) - np.outer(1 - posterior, on_clean)
            spread = np.sqrt((left ** 2).mean(axis=0)) + 1e-9
            correlation = (left.T @ left / n) / np.outer(spread, spread)
            np.fill_diagonal(correlation, 1.0)
            weight = 1 / np.where(correlation > 0.1, correlation, 0).sum(axis=1)
            weight[-2:] = 1.0  # the given label is one cause of its own
        score = math.log(prior / (1 - prior)) + voters @ (np.log(on_toxic / on_clean) * weight)
        updated = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        settled = np.abs(updated - posterior).max() < 1e-5 and step > 15
        posterior = updated
        if settled:
            break
    return {"prior": prior, "on_toxic": on_toxic, "on_clean": on_clean, "weight": weight, "correlation": correlation,
            "posterior": posterior}


def prepared(own: np.ndarray, total: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Classifier inputs: log counts of the entries with a weight of their own,
    log counts of all entries, also per hundred words, any hit at all, and the
    plain features."""
    words = plain[:, -1:]
    total = total[:, None]
    return np.hstack([np.minimum(np.log1p(own), 2.0), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1)),
                      total > 0, np.log1p(plain[:, :-2]), plain[:, -2:-1], np.log1p(words) / 5])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (last: constant) of a ridge logistic regression on soft labels."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + penalty * w
        hessian = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def table_of(found: list[dict[int, int]], own: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(hits of the entries of ``own`` by column, hits of all entries), a row a text."""
    x, total = np.zeros((len(found), len(own))), np.zeros(len(found))
    for row, hit in enumerate(found):
        for i, n in hit.items():
            total[row] += n
            if i in own:
                x[row, own[i]] = n
    return x, total


class Model:
    """What scoring needs: the lexicon, the entries with weights of their own
    and the classifier's weights."""

    def __init__(self, lexicon: list[str], own: dict[int, int] | None = None, weights: np.ndarray | None = None):
        self.lexicon = {entry: i for i, entry in enumerate(lexicon)}
        self.heads = heads_of(self.lexicon)
        self.own, self.weights = own or {}, weights

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None or not texts:
            return np.full(len(texts), PRIOR)
        found, plain = zip(*(features(t, self.lexicon, self.heads) for t in texts))
        x = prepared(*table_of(found, self.own), np.array(plain, dtype=float))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    texts = pick(docs, doc_id="doc_id", text="text").withColumn("text", whole_text("text"))
    labelled = cut(training_labels(pick(labels, doc_id="doc_id", toxic="toxic")))
    # ids and labels are broadcast up to a number, 16 bytes each; beyond it the texts move to them
    known = F.broadcast(labelled) if labelled.count() <= BROADCAST_IDS else labelled
    lexicon = mine_lexicon(texts.join(known, "doc_id").select("text", "toxic"))
    rows = cut(training_rows(texts, labelled, sample))
    model = Model(lexicon)

    @F.pandas_udf("hits map<int,int>, plain array<double>")
    def of_texts(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found = [features(t, model.lexicon, model.heads) for t in texts]
            yield pd.DataFrame({"hits": [h for h, _ in found], "plain": [p for _, p in found]}, index=texts.index)

    got = rows.select("doc_id", "toxic", of_texts("text").alias("x"), F.xxhash64("text").alias("copy")).orderBy("doc_id", "copy") \
        .select("toxic", "x.hits", "x.plain").collect()
    if not got or not 0 < sum(r.toxic for r in got) < len(got):
        return model
    given = np.array([r.toxic for r in got])
    plain = np.array([r.plain for r in got], dtype=float)
    fires = Counter(i for r in got for i in r.hits)
    own = {i: column for column, i in enumerate(sorted(i for i, n in fires.items() if n >= LEAST_FIRES))}
    x, total = table_of([r.hits for r in got], own)
    rest = total - x.sum(axis=1)
    votes = np.column_stack([x > 0, rest > 0, plain[:, :-2] > 0, plain[:, -2] > 0.5, total == 0])
    posterior = label_model(votes, given)["posterior"]
    return Model(lexicon, own, fit_logistic(prepared(x, total, plain), posterior))


def scored(docs: DataFrame, model: Model, text_column: str = "text"):
    """The score column of ``docs``' texts."""

    @F.pandas_udf(DoubleType())
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.score(texts.tolist()), index=texts.index, dtype=float)

    return score(whole_text(docs[text_column]))


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    model = fit(rows, labels)
    return rows.select("doc_id", (crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       scored(rows, model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept."""
    return docs.where(scored(docs, fit(docs, labels)) < THRESHOLD)
