"""Document fingerprints from a randomised edit embedding.

A walk reads a text from left to right. At step j it writes the character it
stands on and then moves on by one or stays, as a random bit of (j, character)
decides; all texts share these bits. Two texts that differ by few edits are
carried apart by an edit and, being moved by the same bits, soon fall into step
again, so their written strings differ in few places: edit distance becomes
Hamming distance. The walk goes to the end of the text, about two steps per
character.

The written string is sampled. Each step belongs to one of ``SLOTS`` slots
and has a priority there; a slot keeps the symbol (4 bits of the character's
hash, never 0) of the step with the best priority that the walk reached. Walks
of like length keep the same steps, so equal texts have equal fingerprints and
the share of equal slots estimates the Hamming likeness over the whole text.
Slots that a short walk never reached hold 0.

Near texts are found by bands: ``BANDS`` groups of sampled slots. Texts equal in
some band are candidates and are verified on all slots.

All texts of a batch walk side by side in numpy, longest first; a step costs
two table look-ups per text.

Defined cases: a null text counts as empty; empty texts have the fingerprint of
zeros and are like each other (1.0); the document after the last one is the
first; documents with one id follow each other by the hash of their text, null
ids first; rows repeated outright count as one document and share its result;
a single document is its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from quarry.llm.common import cut, pick, placed, whole_text, worker_cache
from quarry.llm.components import connected_components

SLOTS = 256
BANDS = 32
PERIOD = 4093  # steps after which the shared random bits recur
SEED = 20_240_607
SAMPLE_STEPS = 1 << 16  # sampled steps are listed for so many steps at first, and doubled as texts need it
CHECK = 128  # steps between two looks for texts that have ended
CHUNK_CHARS = 16 << 20  # text walked at once
ROWS_PER_PART = 8192
MAX_PARTS = 4096
EDIT_SHARE = 4  # an edited text replaces the last 1/EDIT_SHARE


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _moves() -> np.ndarray:
    """PERIOD x 256 bits; class 0 marks the end of a text and never moves."""
    cache = worker_cache()
    if "moves" not in cache:
        bits = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2, (PERIOD, 256), dtype=np.int8)
        bits[:, 0] = 0
        cache["moves"] = bits.astype(np.int64)
    return cache["moves"]


def classes(text: str) -> np.ndarray:
    """1 .. 255 for each code point."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return (_mix(points.astype(np.uint64) + np.uint64(SEED)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def _samples(steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(step, slot): the steps that are best in their slot so far, below at
    least ``steps``."""
    cache = worker_cache()
    known = cache.get("samples")
    if known is None or known[2] < steps:
        total = SAMPLE_STEPS
        while total < steps:
            total *= 2
        j = np.arange(total, dtype=np.uint64)
        slot = (_mix(j + np.uint64(SEED * 3)) % np.uint64(SLOTS)).astype(np.int64)
        priority = _mix(j + np.uint64(SEED * 7))
        order = np.lexsort((j, slot))
        best: list[np.ndarray] = []
        cuts = np.searchsorted(slot[order], np.arange(SLOTS + 1))
        for s in range(SLOTS):
            own = order[cuts[s]:cuts[s + 1]]
            if not len(own):
                continue
            least = np.minimum.accumulate(priority[own])
            best.append(own[np.r_[True, least[1:] < least[:-1]]])
        at = np.sort(np.concatenate(best))
        cache["samples"] = known = (at, slot[at], total)
    return known[0], known[1]


def walk(texts: list[np.ndarray]) -> np.ndarray:
    """Fingerprints (texts x SLOTS) of class arrays, all walked side by side."""
    out = np.zeros((len(texts), SLOTS), np.uint8)
    if not texts:
        return out
    moves = _moves()
    sizes = np.array([len(t) for t in texts], np.int64)
    text_of = np.argsort(-sizes, kind="stable")
    gap = np.zeros(1, np.uint8)  # class 0 after every text: the walk stays there
    buffer = np.concatenate([x for i in text_of.tolist() for x in (texts[i], gap)])
    at = np.concatenate(([0], np.cumsum(sizes[text_of] + 1)))[:-1]
    steps, slots = _samples(1)
    sample, step = 0, 0
    while len(at):
        if step % CHECK == 0:
            going = buffer.take(at) != 0
            if not going.all():
                at, text_of = at[going], text_of[going]
                if not len(at):
                    break
            if step + CHECK > _known_steps():
                steps, slots = _samples(step + CHECK)
        here = buffer.take(at)
        if sample < len(steps) and steps[sample] == step:
            written = here != 0
            out[text_of[written], slots[sample]] = here[written] % 15 + 1
            sample += 1
        at += moves[step % PERIOD].take(here)
        step += 1
    return out


def _known_steps() -> int:
    return worker_cache()["samples"][2]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise share of equal slots among those that either walk reached."""
    reached = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(reached > 0, equal / np.maximum(reached, 1), 1.0)


def as_text(fingerprints: np.ndarray) -> list[str]:
    """One hex digit per slot."""
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)[fingerprints]
    return [row.tobytes().decode() for row in digits]


def from_text(values: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(values).encode(), np.uint8).reshape(len(values), SLOTS)
    return np.where(raw < 58, raw - 48, raw - 87).astype(np.uint8)


def shares_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise: are all slots of some band equal?"""
    return (a == b).reshape(len(a), BANDS, -1).all(axis=2).any(axis=1)


def fingerprint_column():
    @F.pandas_udf(StringType())
    def fingerprint(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            found = [as_text(walk([classes(t) for t in texts.iloc[low:high]])) for low, high in _chunks(texts.tolist())]
            yield pd.Series([f for part in found for f in part], index=texts.index, dtype=object)

    return fingerprint


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK_CHARS:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


# --- near texts ----------------------------------------------------------------------------------

def near_classes(fingerprints: DataFrame, least: float = 0.8, max_bucket: int = 20_000) -> DataFrame:
    """(fingerprint, class): near fingerprints of ``fingerprints.fingerprint``
    by bands, verified at ``least`` on all slots; class is the smallest one
    reachable. A band's bucket hands on spanning edges, not pairs; a bucket
    above ``max_bucket`` is dealt to blocks, and every pair of blocks is
    compared, so no task holds more than two blocks and no link is lost."""
    distinct = cut(fingerprints.select("fingerprint").distinct())
    width = SLOTS // BANDS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.substring(F.col("fingerprint"), b * width + 1, F.lit(width)).alias("key")))
    rows = distinct.select("fingerprint", F.explode(bands).alias("x")).select("fingerprint", "x.*") \
        .where(F.col("key") != "0" * width)
    sizes = rows.groupBy("band", "key").count().where("count > 1") \
        .withColumn("blocks", F.ceil(F.col("count") / max_bucket).cast("int"))
    block = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, ["band", "key"]).withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def link(part: pd.DataFrame) -> pd.DataFrame:
        names = part["fingerprint"].sort_values().unique().tolist()
        found = from_text(names)
        root = np.arange(len(names))
        for i in range(len(names)):  # each against the later ones that are not yet with it
            rest = np.flatnonzero(root[i + 1:] != root[i]) + i + 1
            near = rest[likeness(np.broadcast_to(found[i], (len(rest), SLOTS)), found[rest]) >= least]
            joined = np.unique(np.append(root[near], root[i]))
            root[np.isin(root, joined)] = joined[0]
        return pd.DataFrame([(names[i], names[r]) for i, r in enumerate(root.tolist()) if i != r], columns=["a", "b"])

    edges = dealt.groupBy("band", "key", "low", "high").applyInPandas(link, "a string, b string")
    labels = connected_components(edges).select(F.col("node").alias("fingerprint"), "root")
    return distinct.join(labels, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("class"))


# --- documents and what follows them -------------------------------------------------------------

RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, band_edited boolean, band_next boolean")


def _in_order(rows: DataFrame, parts: int) -> DataFrame:
    """(part, extra, place, ...): rows dealt to consecutive ranges of
    ``place``, each range followed by the first row of the next one (of the
    last: the first of all) as an extra row."""
    found = rows.select("place").agg(
        F.percentile_approx("place", [i / parts for i in range(1, parts)] or [0.5], 100 * parts).alias("cuts"),
        F.min("place").alias("first")).first()
    first = found["first"]
    cuts = sorted({c for c in (found["cuts"] or []) if c > first}) if parts > 1 else []
    table = np.array(cuts, np.int64)

    @F.pandas_udf(IntegerType())
    def range_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(table, places.to_numpy(), side="right"), dtype="int32")

    ranged = rows.withColumn("part", range_of("place"))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("extra"))
    before = F.struct((F.col("part") - 1).alias("part"), F.lit(1).alias("extra"))
    round_ = F.struct(F.lit(len(cuts)).alias("part"), F.lit(1).alias("extra"))
    copies = F.when(F.col("place") == F.lit(first), F.array(own, round_))
    if cuts:
        copies = copies.when(F.col("place").isin(cuts), F.array(own, before))
    dealt = ranged.withColumn("copy", F.explode(copies.otherwise(F.array(own)))) \
        .select("place", "doc_id", "text", "copy.part", "copy.extra")
    return dealt.repartition(len(cuts) + 1, "part").sortWithinPartitions("part", "extra", "place")


def _compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: pd.DataFrame | None = None  # the last row, whose successor may open the next batch
    for part in parts:
        rows = part if held is None else pd.concat([held, part], ignore_index=True)
        texts = rows["text"].tolist()
        for low, high in _chunks(texts):
            high = min(high + 1, len(rows))  # with the successor of the chunk's last row
            yield from _compare_rows(rows.iloc[low:high], texts[low:high])
        held = rows.iloc[-1:]


def _compare_rows(rows: pd.DataFrame, texts: list[str]) -> Iterator[pd.DataFrame]:
    extra = rows["extra"].to_numpy()
    own = np.flatnonzero(extra[:-1] == 0)  # the row after is the successor, in the same part
    if not len(own):
        return
    known = [classes(t) for t in texts]
    edited_texts, edited = [], []
    for i in own.tolist():
        n = len(texts[i])
        k = n // EDIT_SHARE
        edited_texts.append(texts[i][:n - k] + texts[i + 1][:k])
        edited.append(np.concatenate((known[i][:n - k], known[i + 1][:k])))
    found = walk(known + edited)
    plain, changed = found[:len(texts)], found[len(texts):]
    yield pd.DataFrame({
        "place": rows["place"].to_numpy()[own], "n_chars": [len(texts[i]) for i in own.tolist()],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited_texts],
        "fingerprint": as_text(plain[own]), "edited_fingerprint": as_text(changed),
        "near_edited": likeness(plain[own], changed), "near_next": likeness(plain[own], plain[own + 1]),
        "band_edited": shares_band(plain[own], changed), "band_next": shares_band(plain[own], plain[own + 1])})


def edit_fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (the
    last quarter replaced by the beginning of the next document), and how
    like its own fingerprint those of the edited text and of the next document
    are; band_edited and band_next say whether banding finds them."""
    rows, once = placed(pick(df, doc_id=id_column, text=text_column).withColumn("text", whole_text("text")))
    parts = max(1, min(MAX_PARTS, -(-once.select("place").count() // rows_per_part)))
    found = _in_order(once, parts).mapInPandas(_compare, f"place long, {RESULT}")
    columns = [c.split()[0] for c in RESULT.split(", ")]
    if rows is once:  # the place is the id
        return found.select(F.col("place").cast(rows.schema["doc_id"].dataType).alias("doc_id"), *columns)
    return rows.select("doc_id", "place").join(found, "place").select("doc_id", *columns)
