"""Token ids of whole texts with a public byte-level BPE tokenizer.

The library's tokenizer cuts a text into pre-tokens and encodes each by itself, so a text's ids are
those of its pieces in order wherever the cuts between pieces are borders of pre-tokens. Sure borders are
found in numpy on the texts' bytes: before a lone space, around a lone line end, and between ASCII
(or Latin-1) letters, ASCII digits and ASCII signs; nothing is cut next to other characters, in
white space or behind an apostrophe. Equal pieces of a block are found by their bytes, and each distinct one
is encoded once; a memo in arrays keeps the ids of short pieces, and beyond its limit those of pieces met again.
Both block and memo are bounded by bytes, and a long piece is encoded by itself and kept nowhere. A piece that is one pre-token for sure (letters or
digits, with or without a space before) goes straight to the library's model, without another search for
added tokens and pre-tokens; only a plain byte-level vocabulary is used in that way. The string of an added
token in a text gets that token's id, as in the library with ``add_special_tokens=False``.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from podium.llm.common import blocks
from podium.llm.spans import SpanMemo, span_hashes, span_heads

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1 << 20  # bytes whose pieces are found at once
LONGEST = 256  # bytes of a piece that is kept
MEMO_BYTES = 32 << 20

# kinds of bytes: borders of pre-tokens lie between letters, digits and signs
_OTHER, _SPACE, _LETTER, _DIGIT, _SIGN = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[range(48, 58)] = _DIGIT
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = _SIGN
_APOSTROPHE = ord("'")

# pieces of one pre-token: ASCII or Latin-1 letters, or ASCII digits, behind one space or none
_ONE = re.compile(rb" ?(?:(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+|[0-9]+)")
# what may be a part of such a piece
_PART = re.compile(rb"[ A-Za-z0-9\x80-\xFF]+")


def _byte_characters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(shown))
    return dict(zip(shown, shown)) | {b: 256 + i for i, b in enumerate(hidden)}


_CHARACTERS = _byte_characters()
_ID = operator.attrgetter("id")
_CHARACTERS_END = chr(_CHARACTERS[ord("\n")])


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Place of a public vocabulary file on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path(name)


def borders(data: np.ndarray) -> np.ndarray:
    """Places of ``data`` (UTF-8 bytes of text) before which a pre-token surely ends."""
    kind = _KIND[data]
    # the two bytes of a Latin-1 letter count as a letter (0xD7 and 0xF7 are signs)
    lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    kind[lead] = kind[lead + 1] = _LETTER
    solid = kind >= _LETTER  # certainly no white space
    cut = np.zeros(len(data), bool)
    change = solid[1:] & solid[:-1] & (kind[1:] != kind[:-1]) & (data[:-1] != _APOSTROPHE)
    cut[1:] = change
    lone = np.flatnonzero(((data[1:-1] == 32) | (data[1:-1] == 10)) & solid[:-2] & solid[2:]) + 1
    cut[lone] = True
    cut[lone[data[lone] == 10] + 1] = True
    return np.flatnonzero(cut)


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str = DEFAULT_VOCABULARY) -> TokenEncoder:
    """The encoder of this Python worker: its memo outlives a task."""
    return TokenEncoder(vocabulary)


class TokenEncoder:
    """Ids of many texts at once. ``vocabulary`` is a file name of the public set or a path."""

    def __init__(self, vocabulary: str = DEFAULT_VOCABULARY, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per Spark task
        from tokenizers import Tokenizer

        path = vocabulary if "/" in vocabulary else vocabulary_path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = sorted({t.content.encode() for t in added if t.content})
        self.model = self.tokenizer.model if self._plain() else None
        self.memo = SpanMemo(memo_bytes)

    @property
    def size(self) -> int:
        """Bytes of the memo."""
        return self.memo.size

    @property
    def index(self) -> list[bytes]:
        """The pieces in the memo."""
        return self.memo.strings()

    def _plain(self) -> bool:
        """Whether ``_ONE`` holds what the library passes to its model as it stands, byte by byte."""
        cutter = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        return (cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
                and self.tokenizer.normalizer is None and self.tokenizer.truncation is None
                and self.tokenizer.padding is None and not any(map(_PART.fullmatch, self.added)))

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of short pieces, how many each has, and the order in which the pieces come."""
        one = np.fromiter(map(bool, map(_ONE.fullmatch, pieces)), bool, len(pieces)) & (self.model is not None)
        order = np.argsort(~one, kind="stable")
        plain, other = np.split(order, [np.count_nonzero(one)])
        names = b"\n".join([pieces[i] for i in plain.tolist()]).decode("latin-1").translate(_CHARACTERS)
        found = list(map(self.model.tokenize, names.split(_CHARACTERS_END))) if len(plain) else []
        ids = list(map(_ID, itertools.chain.from_iterable(found)))
        rest = self._whole_ids([pieces[i] for i in other.tolist()])
        ids.extend(itertools.chain.from_iterable(rest))
        lengths = np.fromiter(map(len, itertools.chain(found, rest)), np.int64, len(pieces))
        return np.array(ids, np.uint32), lengths, order

    def _whole_ids(self, pieces: list[bytes]) -> list[list[int]]:
        texts = [p.decode() for p in pieces]
        return [] if not texts else [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _codes(self, data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Memo numbers of distinct short pieces; new ones are encoded."""
        self.memo.shrink()
        codes = self.memo.find(data, starts, ends, hashes)
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            new = [data[a:b] for a, b in zip(starts[unknown].tolist(), ends[unknown].tolist())]
            flat, lengths, order = self._ids(new)
            unknown = unknown[order]
            codes[unknown] = self.memo.add([new[i] for i in order.tolist()], hashes[unknown], flat, lengths)
        return codes

    def _pieces(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rising spans of ``data`` in order, and how many each has; none is long."""
        hashes = span_hashes(data, starts, ends)
        head = span_heads(data, starts, ends, hashes)
        first = head == np.arange(len(head))
        distinct = np.flatnonzero(first)
        codes = self._codes(data, starts[distinct], ends[distinct], hashes[distinct])
        return self.memo.lists(codes[(np.cumsum(first) - 1)[head]])

    def _inside_added(self, data: bytes) -> np.ndarray:
        """Places inside the string of an added token, where nothing is cut."""
        places = []
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                places.append(np.arange(at + 1, at + len(token)))
                at = data.find(token, at + 1)
        return np.concatenate(places) if places else np.zeros(0, np.int64)

    def _spans(self, data: bytes, ends: np.ndarray) -> Iterator[np.ndarray]:
        """Bounds of the pieces of ``data``, window by window; texts end at ``ends``."""
        view = np.frombuffer(data, np.uint8)
        total, start = int(ends[-1]) if len(ends) else 0, 0
        inside = self._inside_added(data)
        # windows of equal size, none of which is a small rest
        step = -(-total // max(1, round(total / WINDOW)))
        for low in range(0, total, max(1, step)):
            high = min(total, low + step)
            # a border depends on the bytes around it; those of the neighbouring windows count
            near = max(0, low - 4)
            cuts = borders(view[near:min(total, high + 4)]) + near
            if len(inside):
                cuts = cuts[~np.isin(cuts, inside)]
            texts = ends[np.searchsorted(ends, low, side="right"):np.searchsorted(ends, high, side="right")]
            bounds = np.sort(np.concatenate([[start], cuts[(cuts > low) & (cuts <= high)], texts]), kind="stable")
            bounds = bounds[np.concatenate([bounds[1:] != bounds[:-1], [True]]) & (bounds >= start)]
            if len(bounds) > 1:
                yield bounds
                start = int(bounds[-1])
        if start < total:
            yield np.array([start, total], np.int64)

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and counts per text."""
        raw = [t.encode() for t in texts]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        data = b"".join([*raw, bytes(8)])
        values, counts = [], np.zeros(len(raw) + 1, np.int64)
        for bounds in self._spans(data, ends):
            starts, stops = bounds[:-1], bounds[1:]
            text = np.searchsorted(ends, starts, side="right")
            long = np.flatnonzero(stops - starts > LONGEST)
            for first, last, i in zip([0, *(long + 1).tolist()], [*long.tolist(), len(starts)], [*long.tolist(), None]):
                if last > first:
                    ids, lengths = self._pieces(data, starts[first:last], stops[first:last])
                    values.append(ids)
                    np.add.at(counts, text[first:last], lengths)
                if i is not None:
                    ids = np.array(self._whole_ids([data[starts[i]:stops[i]]])[0], np.uint32)
                    values.append(ids)
                    counts[text[i]] += len(ids)
        return (np.concatenate(values) if values else np.zeros(0, np.uint32)), counts[:-1]

    def encode(self, texts: Iterable[str | None], n: int, end_id: int | None = None,
               size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``n`` texts in order (each followed by ``end_id``), and counts per text."""
        parts: list[np.ndarray] = []
        counts = np.zeros(n, np.int64)
        for chunk, rows in blocks(texts, size):
            values, lengths = self._block(chunk)
            parts.append(values)
            np.add.at(counts, rows, lengths)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        if end_id is None:
            return ids, counts
        out = np.empty(len(ids) + n, np.uint32)
        ends = np.cumsum(counts + 1) - 1
        keep = np.ones(len(out), bool)
        keep[ends] = False
        out[ends] = end_id
        out[keep] = ids
        return out, counts + 1
