"""Simple-8b word-aligned integer coding in numpy.

The ids of a run are cut into blocks of ``BLOCK`` ids. Each 64-bit word holds a 4-bit
selector (high bits) and ``count`` ids of ``bits`` bits each. A block starts on a word border
and its word number is kept, so blocks decode independently and all words of one selector
decode as one array operation. An id of 60 bits or more is escaped: selector ESCAPE, then
the raw id as a word of its own.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
_U = np.uint64
_SMALL = np.searchsorted([1 << b for b in BITS], np.arange(1 << 16), side="right").astype(np.int8)


def _classes(values: np.ndarray) -> np.ndarray:
    """For each value the first selector whose slots hold it (len(BITS) if none does)."""
    limits = np.array([1 << b for b in BITS], _U)
    small = _SMALL[np.minimum(values, _U(len(_SMALL) - 1)).astype(np.int64)]
    big = values >= _U(len(_SMALL))
    if big.any():
        small[big] = np.searchsorted(limits, values[big], side="right")
    return small


def _fitting(at: np.ndarray, count: int) -> np.ndarray:
    """Those of the ascending positions ``at`` that start a run of ``count`` consecutive ones
    within their block, or a run up to the end of the block."""
    if not len(at):
        return at
    last = np.concatenate([(np.diff(at) != 1) | (at[1:] % BLOCK == 0), [True]])
    ends = np.flatnonzero(last)
    stop = at[np.repeat(ends, np.diff(np.concatenate([[-1], ends])))] + 1
    return at[(stop - at >= count) | (stop % BLOCK == 0)]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words as uint64, word number at which each block starts as int32)."""
    values = np.asarray(values, _U)
    n = len(values)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int32)
    blocks_n = -(-n // BLOCK)
    kind = np.zeros(blocks_n * BLOCK, np.int8)
    kind[:n] = _classes(values)
    kind = kind.reshape(blocks_n, BLOCK)
    # selector of the word that would start at each position: the first one, from the
    # smallest slots up, whose slots all hold their ids; a word that reaches the end of its
    # block may have unused slots
    col = np.arange(BLOCK, dtype=np.int16)
    selector = np.full((blocks_n, BLOCK), ESCAPE, np.int8)
    open_ = np.ones((blocks_n, BLOCK), bool)
    for s in range(len(BITS)):
        narrow = kind <= s
        if 4 * np.count_nonzero(narrow) < narrow.size:  # few runs: look at those alone
            fits = np.zeros_like(open_)
            fits.reshape(-1)[_fitting(np.flatnonzero(narrow), COUNTS[s])] = True
        else:
            wide = np.where(narrow, np.int16(BLOCK), col)
            stop = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1]
            fits = stop >= np.minimum(col + np.int16(COUNTS[s]), np.int16(BLOCK))
        fits &= open_
        selector[fits] = s
        open_ ^= fits
    selector = selector.reshape(-1)[:n]
    idx = np.arange(n, dtype=np.int64)
    end = np.minimum((idx // BLOCK + 1) * BLOCK, n)
    counts = np.array(COUNTS + (1, 1), np.int64)
    size = np.minimum(counts[selector], end - idx)
    # follow the chain of words in all blocks at once
    at = np.arange(0, n, BLOCK, dtype=np.int64)
    block = np.arange(len(at))
    starts, owner = [], []
    while len(at):
        starts.append(at)
        owner.append(block)
        nxt = at + size[at]
        more = nxt < end[at]
        at, block = nxt[more], block[more]
    start = np.concatenate(starts)
    owner_ = np.concatenate(owner)
    order = np.argsort(start, kind="stable")
    start, owner_ = start[order], owner_[order]
    sel = selector[start].astype(np.int64)
    used = np.where(sel == ESCAPE, 2, 1)
    place = np.cumsum(used) - used
    words = np.zeros(int(used.sum()), _U)
    padded = np.concatenate([values, np.zeros(COUNTS[0], _U)])
    ends = start + size[start]
    for s in np.unique(sel):
        mine = sel == s
        first, to = start[mine], place[mine]
        if s == ESCAPE:
            words[to] = _U(ESCAPE) << _U(60)
            words[to + 1] = values[first]
            continue
        word = np.full(len(first), _U(s) << _U(60), _U)
        last = ends[mine]
        for j in range(COUNTS[s]):
            slot = np.where(first + j < last, padded[first + j], _U(0))
            word |= slot << _U(j * BITS[s])
        words[to] = word
    offsets = place[np.searchsorted(owner_, np.arange(blocks_n))]
    return words, offsets.astype(np.int32)


def decode(words: np.ndarray, n: int, offsets: np.ndarray | None = None,
           first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ``n`` ids of a run, or those of blocks ``first_block`` to ``last_block``."""
    words = np.asarray(words, _U)
    if offsets is None or not len(offsets):
        return np.zeros(0, _U)
    blocks = len(offsets)
    last_block = blocks if last_block is None else last_block
    bounds = np.concatenate([offsets.astype(np.int64), [len(words)]])
    lo, hi = bounds[first_block], bounds[last_block]
    total = min(n, last_block * BLOCK) - first_block * BLOCK
    part = words[lo:hi]
    sel = (part >> _U(60)).astype(np.int64)
    raw = _raw_words(sel, part)
    head = np.flatnonzero(~raw)
    sel = sel[head]
    # ids of each word: full, but the last word of a block ends with its block
    counts = np.array(COUNTS + (1, 1), np.int64)[sel]
    block_of = np.searchsorted(bounds[first_block:last_block] - lo, head, side="right") - 1
    before = np.cumsum(counts) - counts
    first_word = np.searchsorted(block_of, np.arange(last_block - first_block))
    in_block = before - before[first_word][block_of]
    limit = np.minimum(total - block_of * BLOCK, BLOCK)
    counts = np.minimum(counts, limit - in_block)
    to = block_of * BLOCK + in_block
    out = np.zeros(total, _U)
    for s in np.unique(sel):
        mine = sel == s
        if s == ESCAPE:
            out[to[mine]] = part[head[mine] + 1]
            continue
        word, target, take = part[head[mine]], to[mine], counts[mine]
        mask = _U((1 << BITS[s]) - 1)
        for j in range(COUNTS[s]):
            ok = take > j
            out[target[ok] + j] = (word[ok] >> _U(j * BITS[s])) & mask
    return out


def _raw_words(sel: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which words are raw ids: a word after an escape that is not itself a raw id."""
    raw = np.zeros(len(words), bool)
    escapes = np.flatnonzero(sel == ESCAPE)
    last = -2
    for i in escapes:  # escapes are rare: ids of 60 bits or more
        if i != last + 1:
            last = i
            raw[i + 1] = True
        else:
            last = -2
    return raw
