"""Packing of documents into sequences by the sum-of-squares rule.

Documents become token ids (public byte-level BPE, then the end id). Only a
document longer than a sequence is cut; its first piece takes the remainder,
so every later piece fills a sequence of its own. The remaining pieces are
packed: with N(g) open sequences of residual gap g, a piece goes into the open
sequence for which the sum of N(g)^2 becomes smallest, longest pieces first; a
new sequence is opened only where no open one has room.

Pieces are written to the shared folder once and dealt in equal shares to
groups of about ``GROUP`` pieces, so groups need no common key, a repeated
document cannot fill one of them, and each task packs a bounded number. A
group ends with few unfilled sequences, which costs well under one per cent.

Defined cases: a null text counts as empty and is the end id alone; ids of
documents may be null or repeated (each row is packed by itself); ties go to
the smallest gap that fits and, inside a group, by length, then row order; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, pick, whole_text, worker_cache

CAPACITY = 1024
END_ID = 2
GROUP = 5000
VOCABULARY = "byte_bpe_50k.tiktoken"  # the ranks of byte_bpe_50k.json: the same ids, several times faster

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def encoder(vocabulary: str = VOCABULARY):
    """The encoding function str -> array of ids, made once in a worker."""
    cache = worker_cache()
    if ("encoder", vocabulary) not in cache:
        import base64

        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        cache["encoder", vocabulary] = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return cache["encoder", vocabulary].encode_ordinary


def cut_points(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` ids."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, total, capacity))]


def pieces(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), one row per piece."""

    def tokenise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for part in parts:
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                ids = np.array([*encode(text), end_id], dtype="<u4")
                rows.extend((doc_id, n, start, length, zlib.crc32(ids[start:start + length].tobytes()))
                            for n, (start, length) in enumerate(cut_points(len(ids), capacity)))
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = pick(df, doc_id=id_column, text=text_column)
    # ids go through pandas as text: beside a null it would hold whole numbers as floating-point ones
    texts = rows.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text("text").alias("text"))
    return texts.mapInPandas(tokenise, PIECES).withColumn("doc_id", F.col("doc_id").cast(rows.schema["doc_id"].dataType))


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item; lengths are 1 to capacity.

    Moving a sequence from gap g to gap g - s changes the sum of squares by
    2 (N(g - s) - N(g)) + 2, or by 1 - 2 N(g) where it becomes full.
    """
    order = np.argsort(-lengths, kind="stable")
    open_bins = np.zeros(capacity + 1, np.int64)  # N(g); full sequences are not open
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    place = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    never = np.iinfo(np.int64).max
    for i in order:
        size = int(lengths[i])
        before = open_bins[size:capacity]  # gaps size .. capacity - 1
        change = 2 * (open_bins[:capacity - size] - before) + 2
        if len(change):
            change[0] = 1 - 2 * before[0]
            change = np.where(before > 0, change, never)
            best = int(change.argmin())
        if len(change) and change[best] != never:
            gap = size + best
            chosen = waiting[gap].pop()
            open_bins[gap] -= 1
        else:
            gap, chosen = capacity, opened
            opened += 1
        place[i], offset[i] = chosen, capacity - gap
        if gap > size:
            open_bins[gap - size] += 1
            waiting[gap - size].append(chosen)
    return place, offset


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset."""
    id_type = cut_pieces.schema["doc_id"].dataType
    cut_pieces = cut_pieces.withColumn("doc_id", F.col("doc_id").cast("string"))
    rows = cut(cut_pieces).withColumn("row", F.monotonically_increasing_id())  # stable: the rows are written
    columns = cut_pieces.columns
    full = rows.where(F.col("length") == capacity) \
        .select(*columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = rows.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        chosen, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows[columns].assign(sequence_id=(rows["share"].to_numpy() << 32) + chosen, offset=offset)

    schema = cut_pieces.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    packed = short.withColumn("share", F.pmod(F.col("row"), F.lit(groups).cast("long"))) \
        .groupBy("share").applyInPandas(place, f"{schema.replace(',', ', ')}, sequence_id long, offset long")
    return packed.unionByName(full).withColumn("doc_id", F.col("doc_id").cast(id_type))


def best_fit_packing(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
                     end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(df, id_column, text_column, capacity, end_id, vocabulary), capacity)
