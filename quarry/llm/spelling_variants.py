"""Spelling variants by permuterm rotations.

A word w gets an end mark and all its rotations: for w = uv the rotation v$u.
Two kinds of keys are sorted together:

* the whole rotation v$u of w = uv, and
* the rotation v$u of w = uav with its last character, a, skipped.

Words uav and ubv meet under the second kind of key (a replacement), uv and
uav where one's whole rotation is the other's skipped one (an insertion or a
deletion). So near words stand in one range of the sorted rotations, and a scan
over the sorted rows sees each range in one piece. A range holds at most one
word for every letter of the alphabet and one whole rotation, so it is small
however large the corpus is. It hands on, for each of its words, the number of
near words in it and the commonest of them, never pairs.

A pair of equally long words meets in exactly one range. An inserted letter
that stands in a run of its like could be skipped at every place of the run;
only the last one counts, so those pairs too meet once.

Rotations above ``LONGEST`` characters are named by a digest of their two
parts, so a word of a million letters costs a million short rows.

Counting: each task counts the words of its texts and hands on sums. The rule
that spoils some words (crc32 of id and word) is the query's; the operator
takes it as a parameter.

Defined cases: a null text has no words; a null id counts as the empty text
in the spoiling rule; rows repeated outright count as often as they stand; of
near words with equal counts the first in code-point order is the form; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, pick, whole_text

PATTERN = "[a-zÀ-ÿ]+"
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5
SPOIL = 199
LONGEST = 64
PIECE = 1 << 20  # characters of a text searched at once
FLUSH = 200_000  # entries held by a task before they are handed on
MARK = "$"


def words_in(text: str) -> Iterator[str]:
    """The words of a text, A-Z lower-cased; the text is read in pieces that
    end between words."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    find, inside = re.compile(PATTERN), re.compile(PATTERN).match
    low = 0
    while low < len(text):
        high = min(low + PIECE, len(text))
        run = inside(text, high) if high < len(text) else None
        high = run.end() if run else high
        yield from find.findall(text, low, high)
        low = high


def spoiled(word: str, crc: int) -> str:
    """``word`` without the character that its checksum names, if any."""
    if crc % SPOIL:
        return word
    at = crc % len(word)
    return word[:at] + word[at + 1:]


def count_words(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT, spoil: bool = False) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def handed_on() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})
            total.clear()
            return out

        for part in parts:
            for doc_id, text in zip(part["doc_id"], part["text"]):
                found = Counter(words_in(text))
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in found.items():
                    if spoil:
                        crc = zlib.crc32(word.encode(), start)
                        if crc % SPOIL == 0:
                            word = spoiled(word, crc)
                    if len(word) >= least_letters:
                        total[word] += n
                if len(total) > FLUSH:
                    yield handed_on()
        if total:
            yield handed_on()

    rows = pick(df, doc_id=id_column, text=text_column) \
        .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), whole_text("text").alias("text"))
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= least_count)


# --- rotations -----------------------------------------------------------------------------------

PRIME = (1 << 61) - 1
BASES = (0x1F3D5B79, 0x2E4C6A87)


def _digests(word: str) -> tuple[list, list]:
    """Prefix sums of two polynomial hashes, and the powers they need."""
    sums, powers = [], []
    for base in BASES:
        s, p = [0], [1]
        for c in word:
            s.append((s[-1] * base + ord(c) + 1) % PRIME)
            p.append(p[-1] * base % PRIME)
        sums.append(s)
        powers.append(p)
    return sums, powers


def rotations(word: str, longest: int = LONGEST) -> Iterator[tuple[str, bool, bool]]:
    """(key, whole, counts as an inserted letter) for all rotations of a word."""
    size = len(word)
    sums, powers = _digests(word) if size > longest else (None, None)

    def key(u: int, v: int) -> str:
        """The rotation of word[:u] and word[v:]: the second part, the mark, the first."""
        if u + size - v <= longest:
            return word[v:] + MARK + word[:u]
        parts = [f"{s[u]:x}.{(s[size] - s[v] * p[size - v]) % PRIME:x}" for s, p in zip(sums, powers)]
        return f"{MARK}{u}.{size - v}.{'.'.join(parts)}"

    for i in range(size + 1):
        yield key(i, i), True, False
    for i in range(size):
        yield key(i, i + 1), False, i + 1 == size or word[i] != word[i + 1]


def _ranges(rows: pd.DataFrame) -> pd.DataFrame:
    """(id, near, best_n, best_id) for the words of whole ranges of equal keys."""
    keys = rows["key"].to_numpy()
    start = np.r_[True, keys[1:] != keys[:-1]]
    group = np.cumsum(start) - 1
    shared = (np.bincount(group) > 1)[group]
    group = np.unique(group[shared], return_inverse=True)[1]
    whole, inserted, ids, counts = (rows[c].to_numpy()[shared] for c in ("whole", "inserted", "id", "n"))
    groups = int(group.max()) + 1 if len(group) else 0

    def best(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the commonest and second commonest word of each group, -1 for none."""
        order = np.flatnonzero(mask)
        order = order[np.lexsort((ids[order], -counts[order], group[order]))]
        first = np.r_[True, group[order][1:] != group[order][:-1]] if len(order) else np.zeros(0, bool)
        one, two = np.full(groups, -1), np.full(groups, -1)
        one[group[order][first]] = order[first]
        second = np.r_[False, first[:-1]] & ~first if len(order) else first
        two[group[order][second]] = order[second]
        return one, two

    gaps, ends = ~whole, ~whole & inserted
    n_gaps, n_ends = (np.bincount(group[m], minlength=groups) for m in (gaps, ends))
    full, _ = best(whole)  # at most one a group
    top, next_ = best(gaps)
    end, _ = best(ends)

    near = np.where(whole, n_ends[group], n_gaps[group] - 1 + (inserted & (full[group] >= 0)))
    this = np.arange(len(group))
    other = np.where(whole, end[group], np.where(top[group] == this, next_[group], top[group]))
    also = np.where(ends, full[group], -1)

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        worse = (b >= 0) & ((a < 0) | (counts[b] > counts[a]) | ((counts[b] == counts[a]) & (ids[b] < ids[a])))
        return np.where(worse, b, a)

    chosen = better(other, also)
    hit = near > 0
    return pd.DataFrame({"id": ids[hit], "near": near[hit], "best_n": counts[chosen[hit]], "best_id": ids[chosen[hit]]})


def near_words(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(id, n_near, best_n, best_id) of the words (id, word, n) that have near
    ones; ids follow the code-point order of the words."""

    def rotate(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "whole", "inserted", "id", "n"]
        for part in parts:
            held = []
            for id_, word, n in zip(part["id"], part["word"], part["n"]):
                for key, whole, inserted in rotations(word, longest):
                    held.append((key, whole, inserted, id_, n))
                    if len(held) >= FLUSH:
                        yield pd.DataFrame(held, columns=columns)
                        held = []
            if held:
                yield pd.DataFrame(held, columns=columns)

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the last range of a batch may go on in the next one
        for part in parts:
            if not len(part):
                continue
            rest = part if rest is None else pd.concat([rest, part], ignore_index=True)
            border = int(np.argmax(rest["key"].to_numpy() == rest["key"].iat[-1]))
            if border:
                yield _ranges(rest.iloc[:border])
                rest = rest.iloc[border:]
        if rest is not None:
            yield _ranges(rest)

    rows = words.select("id", "word", "n").mapInPandas(rotate, "key string, whole boolean, inserted boolean, id long, n long")
    found = rows.repartitionByRange("key").sortWithinPartitions("key") \
        .mapInPandas(scan, "id long, near long, best_n long, best_id long")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.max(F.struct("best_n", (-F.col("best_id")).alias("back"))).alias("best")) \
        .select("id", "n_near", "best.best_n", (-F.col("best.back")).alias("best_id"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) for words with a form: the last of the chain id -> form. A
    step doubles the way gone; counts grow along a chain, so it has no loop
    and few links."""
    ways = cut(forms.select("id", F.col("form_id").alias("root"), F.lit(True).alias("open")))
    while not ways.where("open").isEmpty():
        on = ways.select(F.col("id").alias("at"), F.col("root").alias("further"))
        ways = cut(ways.join(on, ways.root == on["at"], "left")
                   .select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open")))
    return ways.select("id", "root")


def group_variants(counted: DataFrame, ratio: int = FORM_RATIO, longest: int = LONGEST) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per row of ``counted``
    (word, n)."""
    words = cut(counted.select("word", "n").orderBy("word").withColumn("id", F.monotonically_increasing_id()))
    near = near_words(words, longest)
    known = cut(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(F.col("best_n") >= ratio * F.col("n"), F.col(c)).alias(to) for c, to in (("best_id", "form_id"), ("best_n", "form_n"))]))
    forms = known.where("form_id is not null")
    named = forms.join(_roots(forms), "id")
    for part, column in (("form", "form_id"), ("root", "root")):
        text = words.select(F.col("id").alias(f"{part}_of"), F.col("word").alias(f"{part}_word"))
        named = named.join(text, named[column] == text[f"{part}_of"])
    alone = known.where("form_id is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"),
                                                  "n", "n_near", "form_n")
    return alone.unionByName(named.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", spoil: bool = False) -> DataFrame:
    """The variants among the words of a table of texts."""
    return group_variants(count_words(df, id_column, text_column, spoil=spoil))
