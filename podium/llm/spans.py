"""Spans of a byte string, grouped by their bytes in numpy, and a memo of them."""

from __future__ import annotations

import numpy as np

from podium.llm.bloom import mix

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SYMBOLS = mix(np.arange(513, 769, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    np.multiply.accumulate(out, out=out)
    return out


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans' bytes by prefix polynomials modulo 2^64; starts and ends rise."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    low, high = int(starts[0]), int(ends[-1])
    part = np.frombuffer(data, np.uint8, high - low, low)
    sums = np.zeros(high - low + 1, np.uint64)
    np.cumsum(SYMBOLS[part] * _powers(BASE, high - low), dtype=np.uint64, out=sums[1:])
    return mix((sums[ends - low] - sums[starts - low]) * _powers(BASE_INVERSE, high - low + 1)[starts - low])


def loads(data) -> np.ndarray:
    """The eight bytes from each place of ``data`` on, as one number."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def equal_spans(a: np.ndarray, starts: np.ndarray, b: np.ndarray, others: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which spans of the loads ``a`` equal those of the same size of the loads ``b``, compared eight bytes at a time."""
    same = np.ones(len(size), bool)
    left = np.arange(len(size))
    for j in range(0, int(size.max(initial=0)), 8):
        left = left[size[left] > j]
        unused = np.uint64(8) * np.maximum(0, 8 - (size[left] - j)).astype(np.uint64)
        differ = (a[starts[left] + j] ^ b[others[left] + j]) << unused
        same[left[differ != 0]] = False
    return same


def span_heads(data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
    """For each span the first one with the same bytes.

    Spans meet by hash (``hashes``, if they are known); each is then compared with the first of its hash,
    and one that differs is told apart by its bytes. ``data`` needs eight bytes behind the last span.
    """
    hashes = span_hashes(data, starts, ends) if hashes is None else hashes
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    head = np.empty(len(order), np.int64)
    head[order] = order[new][np.cumsum(new) - 1]
    size = ends - starts
    same = size == size[head]
    left = np.flatnonzero(same & (head != np.arange(len(head))))
    words = loads(data)
    same[left] = equal_spans(words, starts[left], words, starts[head[left]], size[left])
    odd: dict[bytes, int] = {}
    for k in np.flatnonzero(~same).tolist():
        head[k] = odd.setdefault(data[starts[k]:ends[k]], k)
    return head


class SpanMemo:
    """Integer lists of short byte strings, in arrays: a string is found by its hash and compared byte by byte.

    ``limit`` bounds the bytes held. Beyond it the strings met again since the last time stay, if they take
    no more than half of it; all others are forgotten, which only costs time.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # in order
        self.number = np.zeros(0, np.int32)  # the string of each hash
        self.text = np.zeros(8, np.uint8)  # all strings, and eight bytes behind them
        self.bounds = np.zeros(1, np.int64)  # of the strings in the text
        self.values = np.zeros(0, np.uint32)
        self.value_bounds = np.zeros(1, np.int64)
        self.met = np.zeros(0, bool)

    @property
    def size(self) -> int:
        return sum(x.nbytes for x in (self.hashes, self.number, self.text, self.bounds, self.values,
                                      self.value_bounds, self.met))

    def strings(self) -> list[bytes]:
        raw = self.text.tobytes()
        return [raw[a:b] for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())]

    def shrink(self) -> None:
        """Forgets strings if the memo is beyond its limit; their numbers change."""
        if self.size <= self.limit:
            return
        met, sizes, lengths = self.met, np.diff(self.bounds), np.diff(self.value_bounds)
        each = self.hashes.itemsize + self.number.itemsize + 2 * self.bounds.itemsize + met.itemsize
        if 2 * int((sizes + self.values.itemsize * lengths + each)[met].sum()) > self.limit:
            return self._reset()
        keyed = met[self.number]
        self.hashes, self.number = self.hashes[keyed], (np.cumsum(met, dtype=np.int32) - 1)[self.number[keyed]]
        self.text = np.concatenate([self.text[:-8][np.repeat(met, sizes)], np.zeros(8, np.uint8)])
        self.values = self.values[np.repeat(met, lengths)]
        self.bounds = np.concatenate([[0], np.cumsum(sizes[met])])
        self.value_bounds = np.concatenate([[0], np.cumsum(lengths[met])])
        self.met = np.zeros(len(self.bounds) - 1, bool)

    def find(self, data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the spans' strings, -1 for those not held. ``data`` needs eight bytes behind the last span."""
        out = np.full(len(hashes), -1, np.int64)
        place = np.searchsorted(self.hashes, hashes)
        known = np.flatnonzero(place < len(self.hashes))
        known = known[self.hashes[place[known]] == hashes[known]]
        number, size = self.number[place[known]], (ends - starts)[known]
        same = self.bounds[number + 1] - self.bounds[number] == size
        known, number, size = known[same], number[same], size[same]
        same = equal_spans(loads(data), starts[known], loads(self.text), self.bounds[number], size)
        out[known[same]] = number[same]
        self.met[number[same]] = True
        return out

    def add(self, strings: list[bytes], hashes: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of distinct strings that are not held yet. One whose hash is taken is not found again."""
        before = len(self.met)
        key, first = np.unique(hashes, return_index=True)
        place = np.searchsorted(self.hashes, key)
        free = np.ones(len(key), bool)
        inner = np.flatnonzero(place < len(self.hashes))
        free[inner] = self.hashes[place[inner]] != key[inner]
        self.hashes = np.insert(self.hashes, place[free], key[free])
        self.number = np.insert(self.number, place[free], before + first[free])
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.text = np.concatenate([self.text[:-8], np.frombuffer(b"".join([*strings, bytes(8)]), np.uint8)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.values = np.concatenate([self.values, values])
        self.value_bounds = np.concatenate([self.value_bounds, self.value_bounds[-1] + np.cumsum(lengths)])
        self.met = np.concatenate([self.met, np.zeros(len(strings), bool)])
        return np.arange(before, before + len(strings))

    def lists(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the numbered strings in a row, and how many each has."""
        first = self.value_bounds[numbers]
        lengths = self.value_bounds[numbers + 1] - first
        last = np.cumsum(lengths)
        at = np.repeat(first - (last - lengths), lengths) + np.arange(int(last[-1]) if len(last) else 0)
        return self.values[at], lengths
