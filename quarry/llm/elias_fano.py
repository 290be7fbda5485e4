"""Elias-Fano sequences in numpy: sorted numbers in about 2 + log2(u / n) bits.

The low bits of each value are packed, the high bits are written in unary: value
i sets bit (high + i). Everything is a flat array, so a sequence can be read
straight out of a memory-mapped file. Pointers tell where the elements of every
few buckets (equal high bits) begin, so a search goes to its bucket directly. All
operations take whole arrays of queries.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BLOCK = 4  # words per directory entry, so that counts inside one fit a byte
GROUP = 16  # buckets to a pointer: about a word of unary bits
SLICE = 1 << 18  # values packed at once
#: BIT[b, k]: the place of the k-th set bit of the byte b
BIT = np.array([[*(i for i in range(8) if b >> i & 1), *[0] * (8 - b.bit_count())] for b in range(256)], np.uint8)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value, one after the other, in 64-bit words."""
    words = np.zeros(len(values) * width // 64 + 2, U)
    for low in range(0, len(values) if width else 0, SLICE):
        part = values[low:low + SLICE] & U((1 << width) - 1)
        at = np.arange(low, low + len(part), dtype=U) * U(width)
        word, shift = (at >> U(6)).astype(np.int64), at & U(63)
        np.bitwise_or.at(words, word, part << shift)
        spill = shift > U(64 - width)
        np.bitwise_or.at(words, word[spill] + 1, part[spill] >> (U(64) - shift[spill]))
    return words


def read_bits(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(index), U)
    at = index.astype(U) * U(width)
    word, shift = (at >> U(6)).astype(np.int64), at & U(63)
    low = words[word] >> shift
    high = words[word + 1] << U(1) << (U(63) - shift)  # nothing of it at shift 0
    return (low | high) & U((1 << width) - 1)


def encode(values: np.ndarray, universe: int, name: str = "") -> dict[str, np.ndarray]:
    """The arrays of a sequence of ascending values below ``universe``."""
    values = np.ascontiguousarray(values).astype(np.int64, copy=False).view(U)
    n = len(values)
    width = max(0, (universe // max(n, 1)).bit_length() - 2)  # two to four buckets an element: few elements share one
    size = n + (universe >> width) + 2
    words = np.zeros((size // 64 // BLOCK + 2) * BLOCK, U)
    for first in range(0, n, SLICE):
        high = (values[first:first + SLICE] >> U(width)).astype(np.int64)
        at = high + np.arange(first, first + len(high))
        np.bitwise_or.at(words, at >> 6, U(1) << (at & 63).astype(U))
    ones = np.bitwise_count(words).astype(np.int64).reshape(-1, BLOCK).sum(axis=1)
    rank = np.concatenate(([0], np.cumsum(ones)))
    low = pack_bits(values, width)
    groups = np.arange((universe >> width) // GROUP + 1, dtype=U) * U(GROUP) << U(width)
    begins = np.searchsorted(values, groups).astype(np.uint32 if n < 1 << 32 else np.int64)
    return {f"{name}meta": np.array([n, width, universe], np.int64), f"{name}low": low, f"{name}high": words,
            f"{name}rank": rank, f"{name}begins": begins}


def pick_bits(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each word; all words have as many."""
    parts = words.view(np.uint8)
    # byte i of the product: the set bits before byte i of the word
    before = (np.bitwise_count(parts).view(U) * U(0x0101010101010100)).view(np.uint8)
    # k + 128 - before keeps its top bit where before <= k
    fits = (k.astype(U) * U(0x0101010101010101) + U(0x8080808080808080) - before.view(U)) & U(0x8080808080808080)
    byte = np.bitwise_count(fits).astype(np.int64) - 1
    at = np.arange(0, len(k) * 8, 8) + byte
    return byte * 8 + BIT[parts[at], k - before[at]]


class Sequence:
    def __init__(self, arrays: dict[str, np.ndarray], name: str = ""):
        self.n, self.width, self.universe = (int(x) for x in arrays[f"{name}meta"])
        self.low, self.high, self.rank, self.begins = (arrays[f"{name}{part}"] for part in ("low", "high", "rank", "begins"))
        self.zero_rank = np.arange(len(self.rank), dtype=np.int64) * (64 * BLOCK) - self.rank

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero of the unary bits."""
        ranks = self.rank if ones else self.zero_rank
        block = np.searchsorted(ranks, k, side="right") - 1
        left = (k - ranks[block]).astype(np.uint8)
        words = self.high.reshape(-1, BLOCK)[block]
        if not ones:
            words = ~words
        # byte i of the product: the set bits before word i of the block
        before = (np.bitwise_count(words).view(np.uint32) * np.uint32(0x01010100)).view(np.uint8)
        slot = np.bitwise_count((before <= left[:, None]).view(np.uint32).ravel()).astype(np.int64) - 1
        at = np.arange(0, len(k) * BLOCK, BLOCK) + slot
        word, left = words.ravel()[at], left - before.ravel()[at]
        return (block * BLOCK + slot) * 64 + pick_bits(word, left)

    def _rest(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits of a word from a position on, and how many they are."""
        shift = position & 63
        return self.high[position >> 6] >> shift.astype(U), 64 - shift

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at the given places."""
        index = np.asarray(index, np.int64)
        return self._value(index, self._select(index, True))

    def _value(self, index: np.ndarray, position: np.ndarray) -> np.ndarray:
        return ((position - index).astype(U) << U(self.width) | read_bits(self.low, index, self.width)).astype(np.int64)

    def access_two(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at the given places and at the places after them."""
        index = np.asarray(index, np.int64)
        position = self._select(index, True)
        bits, _ = self._rest(position + 1)
        after = position + 1 + np.bitwise_count(~bits & (bits - U(1)))  # the zeros below the next one
        far = np.flatnonzero(bits == 0)
        after[far] = self._select(index[far] + 1, True)
        return self._value(index, position), self._value(index + 1, after)

    def _word(self, position: np.ndarray) -> np.ndarray:
        """The 64 unary bits from a position on."""
        word, shift = position >> 6, (position & 63).astype(U)
        return self.high[word] >> shift | self.high[word + 1] << U(1) << (U(63) - shift)

    def _bucket(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places [begin, end) of the elements with a value's high bits."""
        bucket = values >> self.width
        group = bucket // GROUP
        first = self.begins[group] + group * GROUP  # the group's first bit
        skip = bucket - group * GROUP
        bits = self._word(first)
        # the zero before the group, then its bits: the bucket follows the zero number ``skip``
        zeros = ~(bits << U(1))
        near = np.bitwise_count(zeros) > skip
        start = first + pick_bits(zeros, np.where(near, skip, 0))
        far = np.flatnonzero(~near)  # the group runs over a word
        start[far] = self._select(bucket[far] - 1, False) + 1
        bits = self._word(start)
        ones = np.bitwise_count(bits & ~(bits + U(1))).astype(np.int64)  # the ones below the next zero
        begin = start - bucket
        end = begin + ones
        far = np.flatnonzero(ones == 64)
        end[far] = self._select(bucket[far], False) - bucket[far]
        return begin, end

    def _stretch(self, values: np.ndarray, first: np.ndarray | None, last: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """(begin, end, low bits): the bucket of each value inside [first, last)."""
        begin, end = self._bucket(values)
        if first is not None:
            begin, end = np.clip(begin, first, last), np.clip(end, first, last)
        return begin, end, values.astype(U) & U((1 << self.width) - 1)

    def _search(self, begin: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Place of the first element of [begin, end) with no smaller low bits, else the end."""
        out = np.maximum(begin, end)
        live = np.flatnonzero(begin < end)
        begin, end, wanted = begin[live], end[live], wanted[live]
        while len(live):
            middle = (begin + end) >> 1
            less = read_bits(self.low, middle, self.width) < wanted
            begin, end = np.where(less, middle + 1, begin), np.where(less, end, middle)
            out[live] = end
            on = np.flatnonzero(begin < end)
            live, begin, end, wanted = live[on], begin[on], end[on], wanted[on]
        return out

    def successor(self, values: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Place of the first element >= value, optionally inside [first, last)."""
        return self._search(*self._stretch(np.asarray(values, np.int64), first, last))

    def find(self, values: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Place of each value, -1 where it does not occur."""
        values = np.asarray(values, np.int64)
        out = np.full(len(values), -1, np.int64)
        if self.n and len(values):
            begin, end, wanted = self._stretch(values, first, last)
            inside = np.flatnonzero(begin < end)
            begin, end, wanted = begin[inside], end[inside], wanted[inside]
            place = self._search(begin, end - 1, wanted)  # if none before it, the last one is left
            same = np.flatnonzero(read_bits(self.low, place, self.width) == wanted)  # the high bits agree
            out[inside[same]] = place[same]
        return out
