"""Benchmark decontamination by spaced-seed hashing, DataFrame functions only.

Both sides are tokenised alike (lower case, runs of letters and digits). A
seed is a fixed mask over a few neighbouring tokens; the hash of
the tokens at its 1 positions ignores those at its 0 positions, so a replaced
word under a 0 does not spoil the hit. Hashes of every document position join
the hashes of every test position, and each hit is verified: along its
diagonal (document position minus test position) the tokens are compared one
by one, and the document is contaminated by the item if some window of
``WINDOW`` aligned tokens has at most ``MISSES`` that differ.

The mask in ``SEEDS`` is complete for this rule: whichever ``MISSES`` tokens of
a window differ, it fits into the window somewhere with all its 1 positions on
equal tokens (a test enumerates every choice). An item shorter than a window
must occur whole and unchanged; where such items exist, ``EXACT_SEED`` finds
them. An item under ``SHORTEST`` tokens proves nothing and is never matched.

Document positions never leave their task unless they hit: the hashes of the
test side are broadcast while their counted number stays under
``BROADCAST_ROWS``. Beyond it an ordinary join moves bare positions and hashes,
and only rows with hits fetch their tokens again.

Defined cases: null texts and empty texts match nothing; ids may be null or
repeated (a result row speaks of the pair of ids, whichever of the rows with
that id it came from); equal best windows keep the smallest start; empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, pick, whole_text

WINDOW = 13
MISSES = 2
SHORTEST = 5
SEEDS = ("11010011",)
EXACT_SEED = "11111"
BROADCAST_ROWS = 250_000  # some 20 MB; their texts have as many tokens at most


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(whole_text(text)), r"[^\p{L}\p{N}]+"), "")


def _hash(seed: str) -> Column:
    """Hash of the tokens of ``words`` under the 1s of a seed laid at ``at``;
    null where it would reach past the end."""
    taken = [F.expr(f"get(words, at + {i})") for i, mark in enumerate(seed) if mark == "1"]
    return F.when(F.size("words") - F.col("at") >= len(seed), F.xxhash64(F.lit(seed), *taken))


def _seeded(rows: DataFrame, seeds: tuple[str, ...]) -> DataFrame:
    """One row per position and seed: the columns of rows, at, seed hash."""
    # the outer form keeps Spark from splitting the text a second time to see whether there is a position
    starts = rows.withColumn("at", F.explode_outer(F.expr("sequence(0, greatest(size(words) - 1, 0))")))
    hashes = [_hash(seed) for seed in seeds]
    return starts.withColumn("seed", hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes)))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_id_column: str = "item_id", item_text_column: str = "text",
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id, matched, compared, doc_start, item_start) for every
    pair of a document and a benchmark item that overlap, with the best
    window of the pair in token positions."""
    rows = pick(docs, doc_id=id_column, text=text_column).select("doc_id", tokens(F.col("text")).alias("words"))
    overlaps = _overlaps(rows, benchmark, item_id_column, item_text_column, broadcast_rows)
    best = F.max_by(F.struct("matched", "compared", "doc_start", "item_start"),
                    F.struct("matched", -F.col("doc_start"), -F.col("item_start")))
    return overlaps.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def _overlaps(rows: DataFrame, benchmark: DataFrame, item_id_column: str, item_text_column: str,
              broadcast_rows: int) -> DataFrame:
    """Verified hits: the key columns of rows (all but words), item_id and
    the window."""
    keys = [c for c in rows.columns if c != "words"]
    items = cut(pick(benchmark, item_id=item_id_column, text=item_text_column)
                .select("item_id", tokens(F.col("text")).alias("words")).where(F.size("words") >= SHORTEST)
                .withColumn("item_key", F.xxhash64("item_id", "words")).dropDuplicates(["item_key"]))
    whole = F.size("words") >= WINDOW
    placed_items = _seeded(items.where(whole), SEEDS)
    seeds = SEEDS
    short = items.where(~whole)
    if not short.isEmpty():
        seeds = (*SEEDS, EXACT_SEED)
        placed_items = placed_items.unionByName(_seeded(short, (EXACT_SEED,)).where("at = 0"))
    known = cut(placed_items.where("seed is not null").select(
        "seed", "item_key", F.col("at").alias("item_at"), F.size("words").alias("item_size")))
    items = items.select("item_key", "item_id", F.col("words").alias("item_words"))
    if known.count() <= broadcast_rows:
        known, items = F.broadcast(known), F.broadcast(items)
        found = _seeded(rows, seeds).join(known, "seed")
    else:
        rows = rows.withColumn("row_key", F.xxhash64(*keys, "words"))
        found = _seeded(rows, seeds).select("row_key", "at", "seed").join(known, "seed") \
            .select("row_key", "at", "item_key", "item_at", "item_size").distinct().join(rows, "row_key")
    hits = found.select(
        *keys, "item_key", (F.col("at") - F.col("item_at")).alias("shift"),
        # the stretch of the document under the item, null where it lies outside
        F.expr("transform(sequence(0, item_size - 1), i -> get(words, i + at - item_at))").alias("stretch"))
    hits = hits.join(items, "item_key").withColumn(
        "equal", F.expr("zip_with(stretch, item_words, (d, w) -> coalesce(d = w, false))"))
    size = F.expr(f"least(size(equal), {WINDOW})")
    windows = hits.withColumn("compared", size).withColumn("best", F.expr(
        "array_max(transform(sequence(0, size(equal) - compared), s -> struct("
        "aggregate(slice(equal, s + 1, compared), 0, (n, e) -> n + int(e)) as matched, -s as back)))"))
    allowed = F.when(F.size("equal") >= WINDOW, MISSES).otherwise(0)
    return windows.where(F.col("compared") - F.col("best.matched") <= allowed).select(
        *keys, "item_id", F.col("best.matched").alias("matched"), "compared",
        (F.col("shift") - F.col("best.back")).alias("doc_start"), (-F.col("best.back")).alias("item_start"))


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
                      text_column: str = "text") -> DataFrame:
    """Distinct (key_id, key_text) of the rows of ``docs`` that overlap some
    item: the id and a hash of the text, so that rows which share an id but
    not a text are judged apart."""
    rows = pick(docs, key_id="doc_id", text=text_column).select(
        "key_id", F.xxhash64("text").alias("key_text"), tokens(F.col("text")).alias("words"))
    return _overlaps(rows, benchmark, "item_id", "text", broadcast_rows).select("key_id", "key_text").distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, all columns kept."""
    found = contaminated_rows(docs, benchmark)
    hit = docs.doc_id.eqNullSafe(found.key_id) & (F.xxhash64(docs.text) == found.key_text)
    return docs.join(found, hit, "left_anti")
