"""Exact removal of repeated passages with suffix arrays.

Every byte covered by a ``WINDOW``-byte string that also starts earlier (in a
smaller doc_id, or in the same document further left) is removed. Suffix
arrays over a whole corpus would be sorted mostly for text that occurs once,
so the work is narrowed first, without losing a repeat:

1. Copies. All but the first document of equal texts go entirely and take no
   further part.
2. Anchors. Each window of ``WINDOW`` bytes picks the ``GRAM``-byte substring
   with the smallest hash in it (the leftmost of equals). Equal windows pick
   equal anchors at equal places, so only windows whose anchor hash occurs
   twice can repeat.
3. Shards. The windows of one anchor occurrence are one stretch of its
   document; stretches are dealt by anchor hash, so equal windows meet in one
   shard. An anchor with more than ``SHARE`` occurrences is dealt to several
   shards, in document order. Stretches equal as a whole are settled first, in
   the task that cuts them and again in the shard.
4. In a shard: a suffix array by Larsson-Sadakane refinement in numpy (groups
   of equal prefixes double their sorted depth and only unsettled groups are
   sorted again), common prefixes by Kasai's method, and every window start
   whose prefix of WINDOW bytes has an earlier start in the shard is covered.
5. Across the shards of one anchor: each hands on its first occurrences, a
   window as its place and a 128-bit digest of its bytes. They are dealt by the
   digest, not by the anchor, and all but the first of equal ones are covered.
   A window comes at most once from each shard, so a task gets its share of
   the different windows however often their anchor occurs.
6. Covered runs are merged per document, which yields the bytes that stay.

But for the digests of the texts it is one Spark query: the texts cross the network once, and the exchange that
brings them to their runs is the one that brought them to their stretches.

Defined cases: a null text counts as empty; texts under WINDOW bytes keep
everything; documents with one id are taken in the order of their text's hash,
null ids first; of rows repeated outright each is judged as if it were alone
with the other documents; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, pick, placed, whole_text, worker_cache

WINDOW = 100
GRAM = 24
SHARE = 20_000
SHARD_BYTES = 4 << 20
WINDOWS_AT_ONCE = 50_000  # first occurrences handed on in one batch

BASE = 0x9E3779B97F4A7C15
BLOCK = 1 << 20  # bytes hashed at once; the rolling hash starts anew in each block


# --- anchors -------------------------------------------------------------------------------------

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    cache = worker_cache()
    if "powers" not in cache or len(cache["powers"][0]) < n:
        cache["powers"] = tuple(np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, np.uint64))))
                                for b in (BASE, pow(BASE, -1, 1 << 64)))
    return cache["powers"]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes from each start, equal for equal bytes."""
    out = []
    for low in range(0, len(data) - gram + 1, BLOCK):
        part = data[low:low + BLOCK + gram - 1]
        power, inverse = _powers(BLOCK + gram)
        sums = np.concatenate(([np.uint64(0)], np.cumsum((part + np.uint64(1)) * power[:len(part)])))
        out.append((sums[gram:] - sums[:-gram]) * inverse[:len(part) - gram + 1])
    h = np.concatenate(out)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def anchors(text: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first, last): each anchor of the text with the range
    of window starts that picked it. Every window start is in one range."""
    hashes = gram_hashes(np.frombuffer(text, np.uint8), gram)
    width = window - gram + 1
    least, span = hashes, 1
    while span * 2 <= width:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    if span < width:
        rest = width - span
        least = np.minimum(least[:-rest], least[rest:])
    # leftmost place of the minimum: the next start at or after the window start with that hash
    places = np.flatnonzero(_is_picked(hashes, least, width))
    starts = np.arange(len(least))
    picked = places[np.searchsorted(places, starts)]
    wrong = hashes[picked] != least
    while wrong.any():  # a place between that is a minimum of other windows only
        at = np.searchsorted(places, picked[wrong] + 1)
        picked[wrong] = places[at]
        wrong = hashes[picked] != least
    cuts = np.flatnonzero(np.r_[True, picked[1:] != picked[:-1]])
    return hashes[picked[cuts]], picked[cuts], cuts, np.r_[cuts[1:], len(least)] - 1


def _is_picked(hashes: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the minimum of some window around them: the
    largest of the minima of the windows over a place equals its hash."""
    n = len(hashes)
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    most, span = padded, 1
    while span * 2 <= width:
        most, span = np.maximum(most[:-span], most[span:]), span * 2
    if span < width:
        rest = width - span
        most = np.maximum(most[:-rest], most[rest:])
    return most[:n] == hashes


# --- suffix arrays -------------------------------------------------------------------------------

def suffix_array(text: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """Suffixes of the bytes in order of their first ``depth`` bytes or more.

    Larsson-Sadakane refinement: suffixes that share a sorted prefix of length
    k form a group; inside a group, the group number of the suffix k bytes
    on is the next sort key, which doubles k. Settled suffixes stay put.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    for i in range(8):  # the first eight bytes as one number
        key = key << np.uint64(8) | padded[i:n + i]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    number = np.empty(n + 1, np.int64)  # of a suffix's group: the place of the group's first
    number[n] = -1  # past the end: before everything
    number[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    done = 8
    while done < depth:
        alone = head & np.r_[head[1:], True]
        loose = np.flatnonzero(~alone)  # places in groups of two or more
        if not len(loose):
            break
        suffixes = order[loose]
        group, following = number[suffixes], number[np.minimum(suffixes + done, n)]
        again = np.argsort(group * (n + 1) + following + 1, kind="stable")
        suffixes, group, following = suffixes[again], group[again], following[again]
        order[loose] = suffixes
        fresh = np.r_[True, (group[1:] != group[:-1]) | (following[1:] != following[:-1])]
        head[loose] = fresh
        number[suffixes] = loose[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        done *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = WINDOW) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in
    order, ``most`` at most, by Kasai's rule in numpy.

    Where the neighbours of two successive suffixes are successive too, the
    length shrinks by the one byte dropped. So bytes are compared at length
    only at the end of each such chain; inside it, the length is the distance
    to the next unequal byte or to that end.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)  # the suffix that precedes it in order
    before[order[1:]] = order[:-1]
    known = before >= 0
    goes_on = np.r_[known[:-1] & known[1:] & (before[1:] == before[:-1] + 1), False]
    ends = np.flatnonzero(known & ~goes_on)
    at_end = np.zeros(n, np.int64)
    live, depth = ends, 0
    while len(live) and depth < most:
        live = live[(live + depth < n) & (before[live] + depth < n)]
        live = live[text[live + depth] == text[before[live] + depth]]
        depth += 1
        at_end[live] = depth
    unequal = known & (text != text[before])
    stops = np.where(goes_on & ~unequal, n, np.arange(n))
    stop = np.minimum.accumulate(stops[::-1])[::-1]
    length = stop - np.arange(n) + np.where(unequal[stop], 0, at_end[stop])
    return np.minimum(np.where(known, length, 0), most)[order]


# --- one shard -----------------------------------------------------------------------------------

class Shard:
    """Stretches of documents, in (place, position) order, as one text."""

    def __init__(self, stretches: list[bytes], window: int = WINDOW):
        self.window = window
        sizes = np.array([len(s) for s in stretches], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.text = np.frombuffer(b"".join(stretches), np.uint8)
        self.order = suffix_array(self.text, window)
        prefixes = common_prefixes(self.text, self.order, window)
        # only starts with a whole window inside their stretch count
        inside = np.zeros(len(self.text), bool)
        counts = np.maximum(sizes - window + 1, 0)
        first = np.repeat(self.starts, counts)
        inside[first + np.arange(len(first)) - np.repeat(np.concatenate(([0], np.cumsum(counts)))[:-1], counts)] = True
        group = np.cumsum(prefixes < window)  # suffixes with an equal window are neighbours in order
        use = inside[self.order]
        by_content, group = self.order[use], group[use]  # window starts
        self.repeated = np.zeros(len(self.text), bool)
        if len(by_content):
            heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            self.firsts = np.minimum.reduceat(by_content, heads)  # sorted by content
            self.repeated[by_content] = True
            self.repeated[self.firsts] = False
        else:
            self.firsts = by_content
        del self.order, prefixes

    def runs_of(self, marked: np.ndarray, place: np.ndarray, first: np.ndarray) -> tuple:
        """(place, first, stop) of the runs of marked window starts, given
        where each stretch comes from. A run never leaves its stretch, as the
        last window - 1 starts of a stretch do not count."""
        starts, stops = runs(marked)
        owner = np.searchsorted(self.starts, starts, side="right") - 1
        shift = first[owner] - self.starts[owner]
        return place[owner], starts + shift, stops + shift + self.window - 1

    def first_windows(self, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(digests as two numbers, stretch, start) of the first occurrences
        in the chosen stretches, some at a time."""
        owner = np.searchsorted(self.starts, self.firsts, side="right") - 1
        use = chosen[owner]
        starts, owner = self.firsts[use], owner[use]
        data = self.text.tobytes()
        for low in range(0, len(starts), WINDOWS_AT_ONCE):
            some = starts[low:low + WINDOWS_AT_ONCE]
            digests = b"".join([hashlib.blake2b(data[i:i + self.window], digest_size=16).digest() for i in some.tolist()])
            yield np.frombuffer(digests, np.int64).reshape(-1, 2), owner[low:low + WINDOWS_AT_ONCE], some


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    return edges[::2], edges[1::2]


# --- the job -------------------------------------------------------------------------------------

ANCHOR = "h long, place long, first int, last int"
#: A stretch to be compared, or (h and stretch null) a covered run that passes through.
PART = "h long, share int, more boolean, place long, first int, stop int, stretch binary"
#: A first occurrence by its digest (hi, lo), or (whole) a covered run by where it starts.
SETTLED = "hi long, lo long, place long, first int, stop int, whole boolean"


def _find_anchors(window: int, gram: int):
    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [[], [], [], []]
            for place, text, copy in zip(part["place"], part["text"], part["copy"]):
                data = text.encode()
                if copy is not None or len(data) < window:
                    continue
                h, _, first, last = anchors(data, window, gram)
                for column, values in zip(out, (h.view(np.int64), np.full(len(h), place), first, last)):
                    column.append(values)
            if out[0]:
                yield pd.DataFrame(dict(zip(("h", "place", "first", "last"), map(np.concatenate, out))))

    return find


def _covered(place, first, stop) -> pd.DataFrame:
    out = pd.DataFrame({"place": np.asarray(place, np.int64), "first": np.asarray(first, np.int32),
                        "stop": np.asarray(stop, np.int32)})
    return out.assign(h=None, share=0, more=False, stretch=None)[_PART_NAMES]


_PART_NAMES = [c.split()[0] for c in PART.split(", ")]


def _cut_stretches(window: int):
    """The stretches of some documents; those that an earlier one of the same
    batch equals are covered as a whole and stay here."""

    def take(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen: set[tuple[int, bytes]] = set()
            rows, runs_found = [], []
            for place, text, found in sorted(zip(part["place"], part["text"], part["found"]), key=lambda x: x[0]):
                data = text.encode()
                for x in sorted(found, key=lambda x: x["first"]):
                    first, stop = x["first"], x["last"] + window
                    stretch = data[first:stop]
                    if (x["h"], stretch) in seen:
                        if runs_found and runs_found[-1][0] == place and first <= runs_found[-1][2]:  # one run with the last one
                            first = runs_found.pop()[1]
                        runs_found.append((place, first, stop))
                    else:
                        seen.add((x["h"], stretch))
                        rows.append((x["h"], x["share"], x["more"], place, first, stop, stretch))
            if rows:
                yield pd.DataFrame(rows, columns=_PART_NAMES)
            if runs_found:
                yield _covered(*zip(*runs_found))

    return take


def _groups_of(keys: list[str], parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by the keys, cut so that no group of equal keys is
    divided; covered runs (null keys, first) come as they are."""
    held: pd.DataFrame | None = None
    for part in parts:
        through = part["stretch"].isna()
        if through.any():
            yield part[through]
            part = part[~through]
        if not len(part):
            continue
        rows = part if held is None else pd.concat([held, part], ignore_index=True)
        last = int(_heads(rows, keys)[-1])
        if last:
            yield rows.iloc[:last]
        held = rows.iloc[last:]
    if held is not None:
        yield held


def _heads(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(rows), bool)
    new[0] = True
    for key in keys:
        values = rows[key].to_numpy(dtype=np.int64)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _settle(window: int, shard_bytes: int):
    """Covered runs of each shard; and, of anchors dealt to several shards,
    the first occurrence of each window."""

    def settle(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _groups_of(["h", "share"], parts):
            if rows["stretch"].iloc[0] is None:
                yield _whole(rows["place"], rows["first"], rows["stop"])
                continue
            heads = np.append(_heads(rows, ["h", "share"]), len(rows))
            sizes = np.concatenate(([0], np.cumsum(rows["stretch"].map(len).to_numpy(dtype=np.int64))))
            low = 0
            while low < len(heads) - 1:  # whole groups together, up to shard_bytes: one suffix array each
                high = int(np.searchsorted(sizes[heads], sizes[heads[low]] + shard_bytes, side="right")) - 1
                high = max(low + 1, min(high, len(heads) - 1))
                yield from settle_shard(rows.iloc[heads[low]:heads[high]])
                low = high

    def settle_shard(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        place, first = rows["place"].to_numpy(), rows["first"].to_numpy()
        stretches = rows["stretch"].tolist()
        seen: set[bytes] = set()
        kept, copies = [], []
        for i in np.lexsort((first, place)).tolist():
            (copies if stretches[i] in seen else kept).append(i)
            seen.add(stretches[i])
        shard = Shard([stretches[i] for i in kept], window)
        kept, copies = np.array(kept, np.int64), np.array(copies, np.int64)
        yield _whole(*shard.runs_of(shard.repeated, place[kept], first[kept]))
        if len(copies):
            yield _whole(place[copies], first[copies], rows["stop"].to_numpy()[copies])
        heads = _heads(rows, ["h", "share"])
        dealt = (rows["more"].to_numpy(dtype=bool) | (rows["share"].to_numpy() > 0)).astype(np.int8)
        dealt = np.repeat(np.maximum.reduceat(dealt, heads), np.diff(np.append(heads, len(rows)))) > 0
        if dealt[kept].any():
            for digests, owner, starts in shard.first_windows(dealt[kept]):
                at = starts - shard.starts[owner] + first[kept][owner]
                yield _settled(digests[:, 0], digests[:, 1], place[kept][owner], at, at + window, False)

    return settle


def _settled(hi, lo, place, first, stop, whole: bool) -> pd.DataFrame:
    return pd.DataFrame({"hi": np.asarray(hi, np.int64), "lo": np.asarray(lo, np.int64), "place": np.asarray(place, np.int64),
                         "first": np.asarray(first, np.int32), "stop": np.asarray(stop, np.int32), "whole": whole})


def _whole(place, first, stop) -> pd.DataFrame:
    return _settled(place, first, place, first, stop, True)


def covered_of(settled: DataFrame) -> DataFrame:
    """(place, first, stop): the covered runs, and the windows that an earlier
    shard of their anchor holds."""
    same = Window.partitionBy("hi", "lo", "whole").orderBy("place", "first")
    return settled.withColumn("n", F.row_number().over(same)).where("whole or n > 1").select("place", "first", "stop")


def _strip():
    def strip(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text, covered in zip(part["text"], part["covered"]):
                data = text.encode()
                spans = [] if covered is None else merged((x["first"], x["stop"]) for x in covered)
                kept, at = hashlib.sha256(), 0
                for start, stop in spans:
                    kept.update(data[at:start])
                    at = stop
                kept.update(data[at:])
                rows.append((len(data), sum(e - s for s, e in spans), len(spans), kept.hexdigest()))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            out.insert(0, "doc_id", part["doc_id"])
            yield out

    return strip, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping or touching runs joined."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def later_copies(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(place, n) of the documents whose whole text an earlier one has."""
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    heads = cut(rows.select("place", F.octet_length("text").alias("n"), digest.alias("digest")).where(F.col("n") >= window))
    firsts = heads.groupBy("digest").agg(F.min("place").alias("least"), F.count("*").alias("copies")).where("copies > 1")
    return heads.join(firsts, "digest").where("place > least").select("place", "n")


def settled_runs(rows: DataFrame, copies: DataFrame, window: int = WINDOW, gram: int = GRAM, share: int = SHARE,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """What the shards of (place, text) rows find, ``SETTLED``."""
    # an outer join, as an anti join would be moved below the projection and the exchange could not be reused
    marked = rows.join(copies.select("place", F.lit("copy").alias("copy")), "place", "left")
    found = marked.mapInPandas(_find_anchors(window, gram), ANCHOR)
    same = Window.partitionBy("h").orderBy("place", "first")
    repeated = found.select(
        "*", F.lag("h").over(same).alias("before"), F.lead("h").over(same).alias("after"),
        F.floor((F.row_number().over(same) - 1) / share).cast("int").alias("share"),
        F.lead("h", share).over(same).isNotNull().alias("more")).where("before is not null or after is not null")
    listed = repeated.groupBy("place").agg(F.collect_list(F.struct("h", "share", "more", "first", "last")).alias("found"))
    # stretches go to the shard of their anchor, covered runs wherever their document's number says
    cut_up = rows.join(listed, "place").mapInPandas(_cut_stretches(window), PART)
    return cut_up.repartition(F.coalesce("h", "place"), "share").sortWithinPartitions("h", "share") \
        .mapInPandas(_settle(window, shard_bytes), SETTLED)


def covered_runs(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, share: int = SHARE,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(place, first, stop): runs of covered bytes of (place, text) rows with
    different places; the runs of a document may overlap."""
    rows = rows.select("place", "text")
    copies = later_copies(rows, window)
    found = covered_of(settled_runs(rows, copies, window, gram, share, shard_bytes))
    return found.unionByName(copies.select("place", F.lit(0).alias("first"), F.col("n").cast("int").alias("stop")))


def remove_repeats(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW,
                   gram: int = GRAM, share: int = SHARE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row."""
    rows, once = placed(pick(df, doc_id=id_column, text=text_column).withColumn("text", whole_text("text")))
    id_type = rows.schema["doc_id"].dataType
    runs_of = covered_runs(once, window, gram, share, shard_bytes) \
        .groupBy("place").agg(F.collect_list(F.struct("first", "stop")).alias("covered"))
    strip, schema = _strip()
    # ids go through pandas as text: beside a null it would hold whole numbers as floating-point ones
    if rows is once:  # the place is the id: the same two columns as before, so the exchange of the texts is reused
        found = rows.select("place", "text").join(runs_of, "place", "left") \
            .select(F.col("place").cast("string").alias("doc_id"), "text", "covered")
    else:
        found = rows.join(runs_of, "place", "left").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "covered")
    return found.mapInPandas(strip, schema).withColumn("doc_id", F.col("doc_id").cast(id_type))
