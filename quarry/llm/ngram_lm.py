"""N-gram language model in an Elias-Fano trie.

Words are lower-cased runs between ASCII blanks; every text ends in one end
token, which is also the context of the first word. Training has one pass per
order:

* Level 1: word counts. A word is its 62-bit hash; its number is the rank of
  the hash, cut by the leading bits into shards of one sorted sequence.
* Level k: distinct (context, word) pairs with counts, where a context is the
  number of its own node on level k - 1. Tasks count their part of the corpus
  and hand on sorted, byte-packed pairs; the task of a shard merges them and
  writes one file.

The shard of a pair comes from the leading parts of both numbers, so the
successors of a very common context (and the contexts of a very common word)
are spread over all shards, while inside a shard the word of a context only
takes ``1 / SHARDS`` of the numbers and needs fewer bits.

A shard file holds the trie level in Elias-Fano form: the successors of all
contexts as one monotone sequence (context * range + word) with pointers to
where the successors of each few neighbouring contexts, or with frequent ones of a
part of their words, begin (so many that their number follows the entries), and
the counts, a byte each and the large ones apart. Scoring tasks map the files into memory.
A query goes to the pointer before its context and word and looks for the successor
in the few entries there; what is not found backs off to the shorter context.

Probabilities have a Dirichlet prior of the lower order:
p(w | c) = (n(c w) + PRIOR p(w | c')) / (n(c) + PRIOR), and on the lowest
level p(w) = (n(w) + 0.1) / (N + 0.1 (V + 1)); they sum to one with one unknown word.
A task works them out of the counts it meets on its way up the levels; their
logarithms, and those of the back-off weights, are rounded to 16 bits.

Defined cases: a null text counts as empty (the end token alone); a null id is
treated as the id ''; repeated rows are counted and scored one by one; without
training rows every token is unknown; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import elias_fano, shared_files
from quarry.llm.common import crc_bucket, pick, whole_text
from quarry.session import scratch_path

ORDER = 3
SHARDS = 16  # at least; more where the corpus is larger
ROWS_PER_SHARD = 100_000  # training rows for a shard of words
TOKENS_PER_SHARD = 12_000_000  # training tokens for a shard of a higher level
PRIOR = 50.0
ADD = 0.1
FOLDS = 10
CHUNK_BYTES = 4 << 20  # text handled at once in a task
FLUSH = 4 << 20  # distinct pairs a task holds before it hands them on
END = b"\n"  # never a word

LOW, STEPS = -24.0, 65535  # rounded log10 values: LOW .. 0
LARGE = 255  # a count from here on is kept apart


def rounded(log10: np.ndarray) -> np.ndarray:
    return np.round((np.clip(log10, LOW, 0) / LOW) * STEPS) / STEPS * LOW


# --- tokens --------------------------------------------------------------------------------------

class Tokens:
    """Some texts as numbers into their distinct words; 0 is the end token."""

    def __init__(self, texts: pa.Array):
        runs = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = runs.flatten()
        filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # blanks at the ends of a text leave empty runs
        upto = np.concatenate(([0], np.cumsum(filled)))[np.concatenate(([0], np.cumsum(runs.value_lengths())))]
        coded = words.filter(pa.array(filled)).dictionary_encode()
        self.sizes = np.diff(upto) + 1
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1].astype(np.int64)
        self.ids = np.insert(coded.indices.to_numpy().astype(np.int64) + 1, upto[1:], 0)
        # 62 bits of the hash: room for signed arithmetic
        spelt = [END, *coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)]
        self.hashes = (np.array([*map(xxhash.xxh64_intdigest, spelt)], np.uint64) >> np.uint64(2)).astype(np.int64)

    def contexts(self, numbers: np.ndarray, end: int) -> np.ndarray:
        """The number before each token; before the first of a text, the end."""
        before = np.empty_like(numbers)
        before[1:] = numbers[:-1]
        before[self.starts] = end
        return before


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, length in enumerate(pc.binary_length(texts).to_pylist()):
        size += length
        if size >= CHUNK_BYTES:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


# --- the trie ------------------------------------------------------------------------------------

def shard_of_hash(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> 30) * shards >> 32  # the leading 32 of 62 bits


def first_hash(shard: int, shards: int) -> int:
    return -(-(shard << 32) // shards) << 30


class Layout:
    """Where the pairs of a level go: ``contexts`` numbers x ``words`` numbers."""

    def __init__(self, contexts: int, words: int, shards: int):
        self.shards = shards
        self.slab = max(1, -(-contexts // shards))
        self.range = max(1, -(-words // shards))
        self.contexts = contexts
        self.words = words

    @property
    def limit(self) -> int:
        """Above all keys of a shard."""
        return self.contexts * self.range

    def place(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """shard * limit + key, where key = context * range + word inside its range."""
        part = word // self.range
        shard = context // self.slab + part
        shard -= self.shards * (shard >= self.shards)
        return shard * self.limit + context * self.range + (word - part * self.range)


class Trie:
    """The levels that are written, mapped. Sizes come in ``meta``; files are
    opened when first asked for."""

    def __init__(self, folder: str, meta: dict):
        self.folder, self.meta = folder, meta
        self.files: dict[tuple[int, int], dict] = {}
        self.total, self.vocabulary = meta["total"], meta["sizes"][0] if meta["sizes"] else 0
        self.log_unknown = math.log10(ADD / (self.total + ADD * (self.vocabulary + 1)))

    def shard(self, level: int, shard: int) -> dict:
        if (level, shard) not in self.files:
            arrays = shared_files.load(f"{self.folder}/level{level}/{shard}")
            arrays["keys"] = elias_fano.Sequence(arrays, "key_")
            self.files[level, shard] = arrays
        return self.files[level, shard]

    def layout(self, level: int) -> Layout:
        return Layout(self.meta["sizes"][level - 2], self.vocabulary, self.meta["shards"][level - 1])

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words, -1 where unknown, and their counts, 0 there."""
        order = np.argsort(hashes)
        words, counts = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        words[order], counts[order] = self.nodes(1, hashes[order])
        return words, counts

    def nodes(self, level: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of nodes on a level, -1 where missing, and their counts, 0
        there, by their ascending codes: hashes of words, or (context, word) as
        in ``Layout.place``."""
        nodes, counts = np.full(len(codes), -1, np.int64), np.zeros(len(codes), np.int64)
        shards = self.meta["shards"][level - 1]
        starts = [first_hash(s, shards) if level == 1 else s * self.layout(level).limit for s in range(shards + 1)]
        cuts = np.searchsorted(codes, np.array(starts, np.int64))
        for s, size in enumerate(self.meta["counts"][level - 1] if self.meta["sizes"] else []):
            low, high = cuts[s], cuts[s + 1]
            if size and low < high:
                file = self.shard(level, s)
                found = file["keys"].find(codes[low:high] - starts[s])
                hit = np.flatnonzero(found >= 0)
                found = found[hit]
                nodes[low + hit] = found + self.meta["offsets"][level - 1][s]
                counts[low + hit] = counts_at(file, found)
        return nodes, counts


def count_columns(counts: np.ndarray) -> dict[str, np.ndarray]:
    large = np.flatnonzero(counts >= LARGE)
    return {"count": np.minimum(counts, LARGE).astype(np.uint8), "large": large, "large_count": counts[large]}


def counts_at(columns: dict[str, np.ndarray], places: np.ndarray) -> np.ndarray:
    counts = columns["count"][places].astype(np.int64)
    large = np.flatnonzero(counts == LARGE)
    counts[large] = columns["large_count"][np.searchsorted(columns["large"], places[large])]
    return counts


# --- training ------------------------------------------------------------------------------------

COUNTED = "shard int, n int, keys binary, counts binary"
COUNTED_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
WRITTEN = "shard int, n long, total long"


class Counter:
    """Sorted distinct codes with counts, handed on when large. A code is
    shard * limit + key, or (limit 0) a key that implies its shard."""

    def __init__(self, shard_of: Callable[[np.ndarray], np.ndarray], limit: int) -> None:
        self.shard_of, self.limit = shard_of, limit
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((codes, counts.astype(np.int32)))  # of one chunk
        self.held += len(codes)

    def drain(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.held <= least:
            return
        codes, counts = map(np.concatenate, zip(*self.parts))
        self.parts, self.held = [], 0
        codes, counts = _summed(codes, counts)
        shards = self.shard_of(codes)
        heads = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]])
        rows = []
        for low, high in zip(heads, np.append(heads[1:], len(shards))):
            gaps = np.diff(codes[low:high], prepend=shards[low] * self.limit)
            rows.append((int(shards[low]), int(high - low), shared_files.pack_numbers(gaps),
                         shared_files.pack_numbers(counts[low:high])))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), COUNTED_TYPES)], ["shard", "n", "keys", "counts"])


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")  # merges the sorted parts
    codes, counts = codes[order], counts[order]
    heads = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[heads], np.add.reduceat(counts, heads, dtype=np.int64)


def _count_level(level: int, shards: int, folder: str, meta: dict):
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(folder, meta) if level > 1 else None
        limit = trie.layout(level).limit if trie else 0
        counter = Counter(lambda codes: codes // limit if limit else shard_of_hash(codes, shards), limit)
        for part in parts:
            texts = part.column("text")
            for low, high in chunks(texts):
                tokens = Tokens(texts[low:high])
                if level == 1:
                    counter.add(tokens.hashes, np.bincount(tokens.ids))
                else:
                    words, _ = trie.words(tokens.hashes)
                    ids = words[tokens.ids]
                    context = ids_on(trie, tokens, ids, words[0], level - 1)
                    pairs = context >= 0  # a text shorter than the context has none
                    counter.add(*np.unique(trie.layout(level).place(context[pairs], ids[pairs]), return_counts=True))
                yield from counter.drain(FLUSH)
        yield from counter.drain(0)

    return count


def ids_on(trie: Trie, tokens: Tokens, ids: np.ndarray, end: int, level: int) -> np.ndarray:
    """For each token, the node of the ``level`` tokens before it."""
    node = tokens.contexts(ids, end)
    if level == 1:
        return node
    # the node that ends one token earlier, step by step; texts shorter than the context have no node
    context = ids_on(trie, tokens, ids, end, level - 1)
    return tokens.contexts(nodes_of(trie, level, context, ids)[0], -1)


def nodes_of(trie: Trie, level: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node lookups, each distinct pair once, with the nodes' counts."""
    known = np.flatnonzero((context >= 0) & (word >= 0))
    codes = trie.layout(level).place(context[known], word[known])
    order = np.argsort(codes)
    codes, known = codes[order], known[order]
    heads = np.ones(len(codes), bool)
    heads[1:] = codes[1:] != codes[:-1]
    found, seen = trie.nodes(level, codes[heads])
    of = np.cumsum(heads) - 1
    nodes, counts = np.full(len(context), -1, np.int64), np.zeros(len(context), np.int64)
    nodes[known], counts[known] = found[of], seen[of]
    return nodes, counts


def _write_level(level: int, folder: str, meta: dict):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        ends = np.cumsum(rows["n"].to_numpy(np.int64))
        keys, counts = np.empty(ends[-1], np.int64), np.empty(ends[-1], np.int64)
        for k, c, n, end in zip(rows["keys"], rows["counts"], rows["n"], ends):
            np.cumsum(shared_files.unpack_numbers(k, n).view(np.int64), out=keys[end - n:end])
            counts[end - n:end] = shared_files.unpack_numbers(c, n)
        order = np.argsort(keys, kind="stable")  # merges the sorted parts
        keys = keys[order]
        counts = counts[order]
        del order
        heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[heads], np.add.reduceat(counts, heads)
        del heads
        if level == 1:
            low, high = (first_hash(s, meta["shards"][0]) for s in (shard, shard + 1))
            keys -= low
            limit = high - low
        else:
            limit = Trie(folder, meta).layout(level).limit
        shared_files.save(f"{folder}/level{level}/{shard}", {**elias_fano.encode(keys, limit, "key_"), **count_columns(counts)})
        return pd.DataFrame({"shard": [shard], "n": [len(keys)], "total": [int(counts.sum())]})

    return merge


def train(texts: DataFrame, order: int = ORDER, shards: int = SHARDS, prior: float = PRIOR) -> tuple[str, dict]:
    """Write the trie of ``texts.text`` to the shared folder: (folder, sizes)."""
    spark = texts.sparkSession
    folder = scratch_path(spark, "trie")
    meta: dict = {"shards": [max(shards, -(-texts.count() // ROWS_PER_SHARD))], "total": 0, "prior": prior, "sizes": [], "counts": [], "offsets": []}
    for level in range(1, order + 1):
        if level > 1:
            meta["shards"].append(max(shards, -(-meta["total"] // TOKENS_PER_SHARD)))
        number = meta["shards"][level - 1]
        counted = texts.select("text").mapInArrow(_count_level(level, number, folder, dict(meta)), COUNTED)
        # one row per shard reaches the driver
        written = {r.shard: r for r in counted.groupBy("shard").applyInPandas(
            _write_level(level, folder, dict(meta)), WRITTEN).collect()}
        if not written:
            break
        sizes = [written[s].n if s in written else 0 for s in range(number)]
        meta["counts"].append(sizes)
        meta["offsets"].append(np.concatenate(([0], np.cumsum(sizes)))[:-1].tolist())
        meta["sizes"].append(sum(sizes))
        if level == 1:
            meta["total"] = sum(r.total for r in written.values())
    return folder, meta


# --- scoring -------------------------------------------------------------------------------------

SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(trie: Trie, texts: pa.Array) -> list[np.ndarray]:
    tokens = Tokens(texts)
    words, counts = trie.words(tokens.hashes)
    known = words >= 0
    exact = np.where(known, np.log10((counts + ADD) / (trie.total + ADD * (trie.vocabulary + 1))), trie.log_unknown)
    ids = words[tokens.ids]
    log10 = np.where(known, rounded(exact), trie.log_unknown)[tokens.ids]
    prior = trie.meta["prior"]
    context, seen = tokens.contexts(ids, int(words[0])), tokens.contexts(counts[tokens.ids], int(counts[0]))
    top = len(trie.meta["sizes"])
    for level in range(2, top + 1):
        node, count = nodes_of(trie, level, context, ids)
        hit = np.flatnonzero(node >= 0)
        found = rounded(np.log10((count[hit] + prior * 10 ** log10[hit]) / (seen[hit] + prior)))
        log10 += rounded(np.log10(prior / (seen + prior)))
        log10[hit] = found
        if level < top:  # one word longer; texts shorter than it have none
            context, seen = tokens.contexts(node, -1), tokens.contexts(count, 0)
    add = lambda x: np.add.reduceat(x, tokens.starts)
    return [tokens.sizes, add(known[tokens.ids].astype(np.int64)), np.full(len(texts), trie.total), add(exact[tokens.ids]), add(log10)]


def score(docs: DataFrame, folder: str, meta: dict) -> DataFrame:
    """The rows of ``docs`` (all columns but text) with their scores."""
    others = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in others] + [c.split()[0] for c in SCORED.split(", ")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(folder, meta)
        for part in parts:
            texts = part.column("text")
            for low, high in chunks(texts):
                rest = [part.column(n)[low:high] for n in names[:len(others)]]
                yield pa.RecordBatch.from_arrays([*rest, *map(pa.array, score_texts(trie, texts[low:high]))], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return docs.mapInArrow(run, f"{schema}, {SCORED}")


def language_model_scores(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER,
                          shards: int = SHARDS, prior: float = PRIOR) -> DataFrame:
    """Scores of every row by a model learnt from the rows of nine folds in ten."""
    rows = pick(df, doc_id=id_column, text=text_column).withColumn("text", whole_text("text")) \
        .withColumn("held_out", crc_bucket(F.col("doc_id"), FOLDS) == 0)
    folder, meta = train(rows.where("not held_out"), order, shards, prior)
    return score(rows.select("doc_id", "held_out", "text"), folder, meta)
