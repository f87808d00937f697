"""Language identification with interpolated Kneser-Ney character models.

Each language has a character model of order ``ORDER`` over words padded with a border mark.
All training texts are counted: tasks count whole words, turn them into character n-grams and
the n-gram counts are summed by a shuffle. N-grams are kept by a ``HASH_BITS``-bit hash, so a
language holds at most 2^HASH_BITS n-grams per order whatever the corpus holds; the model is
a few sorted hash arrays per language, of discounted probabilities and of back-off weights.

A text is scored whole: its cross-entropy per character under each language. The lowest wins,
unless it is rejected. Rejection is calibrated by the model itself: mean and deviation of the
entropy of a language follow from its n-gram counts, that is from all its training text, and
a text is rejected if its entropy exceeds mean + SLACK * deviation + Z * deviation / sqrt(n).

Defined cases: a text that is null or has no letter is ``und`` with score 0 and is rejected;
without a training text every text is ``und``; ties go to the first language by name; repeated
rows are judged alike; an empty table gives no rows; only text is ever read for a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import PieceTable, blocks, crc_mod, release, releasing

ORDER = 4
HASH_BITS = 22
SLACK, Z = 0.5, 6.0
UND = "und"
_WORD = re.compile(r"[^\W\d_]+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_GRAMS = [f"g{k}" for k in range(1, ORDER + 1)] + [f"c{k}" for k in range(2, ORDER + 1)]


def _letters(piece: str) -> str:
    """The letter runs of a piece, joined by the border mark (a space)."""
    return " ".join(w for w in _WORD.findall(piece) if any(map(str.isalpha, w)))


def _mix(state: np.ndarray, chars: np.ndarray) -> np.ndarray:
    x = (state ^ chars.astype(np.uint64)) * _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    return x ^ (x >> np.uint64(32))


def grams(words: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Hashes of all n-grams of padded words, and the n-grams per word.

    For each character (and the end mark): g1..gN, the n-grams ending there, and c2..cN, their
    contexts. ``words`` may hold spaces, which stand for word borders.
    """
    pad = " " * (ORDER - 1)
    padded = [pad + w.replace(" ", " " + pad) + " " for w in words]
    chars = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    ends = np.cumsum(sizes)
    here = np.ones(len(chars), bool)
    # a position is scored if it is a letter, or the first border after one
    space = chars == 32
    here = ~space
    here[1:] |= ~space[:-1] & space[1:]
    at = np.flatnonzero(here)
    mask = np.uint64((1 << HASH_BITS) - 1)
    out = {}
    for k in range(1, ORDER + 1):
        state = np.full(len(at), k, np.uint64)
        for j in range(k - 1, 0, -1):
            state = _mix(state, chars[at - j])
        if k > 1:
            out[f"c{k}"] = ((state * _M1) >> np.uint64(40)) & mask
        out[f"g{k}"] = (_mix(state, chars[at]) >> np.uint64(40)) & mask
    before = np.concatenate([[0], np.cumsum(here)])
    return out, before[ends] - before[ends - sizes]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, g4, g3, g2, g1, c4, c3, c2, n) over all rows with a language."""
    names = _GRAMS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, dict[str, int]] = {}
        kept: dict[str, pd.DataFrame] = {}

        def fold(lang: str) -> None:
            pieces = words.pop(lang)
            texts = [_letters(p) for p in pieces]
            found, sizes = grams(texts)
            frame = pd.DataFrame(found)
            frame["n"] = np.repeat(np.fromiter(pieces.values(), np.int64, len(pieces)), sizes)
            if lang in kept:
                frame = pd.concat([kept[lang], frame])
            kept[lang] = _summed(frame)

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for part, _ in blocks(texts.tolist()):
                    seen = words.setdefault(lang, {})
                    for text in part:
                        for piece in text.lower().split():
                            seen[piece] = seen.get(piece, 0) + 1
                    if len(seen) > 200_000:
                        fold(lang)
        for lang in list(words):
            fold(lang)
        for lang, frame in kept.items():
            yield frame.astype(np.int64).assign(lang=lang)[["lang", *names, "n"]]

    rows = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInPandas(releasing(count), "lang string, " + ", ".join(f"{c} long" for c in names) + ", n long")
    top = f"g{ORDER}"
    # one row per language and hash of the highest order; a collision keeps the lowest parts
    return counted.groupBy("lang", top).agg(
        *[F.min(c).alias(c) for c in names if c != top], F.sum("n").alias("n"))


def _summed(frame: pd.DataFrame) -> pd.DataFrame:
    top = frame[f"g{ORDER}"].to_numpy()
    _, first, inverse = np.unique(top, return_index=True, return_inverse=True)
    out = frame.iloc[first].copy()
    out["n"] = np.bincount(inverse, frame["n"].to_numpy()).astype(np.int64)
    return out


class CharModel:
    """Sorted hash arrays of one language: value per n-gram and weight per context."""

    def __init__(self, counts: pd.DataFrame):
        self.tables = []
        rows = counts
        weight = rows["n"].to_numpy(np.float64)
        for k in range(ORDER, 0, -1):
            gram = rows[f"g{k}"].to_numpy(np.int64)
            context = rows[f"c{k}"].to_numpy(np.int64) if k > 1 else np.zeros(len(rows), np.int64)
            one, two = (weight == 1).sum(), (weight == 2).sum()
            discount = one / (one + 2 * two) if one and two else 0.5
            contexts, inverse = np.unique(context, return_inverse=True)
            total = np.bincount(inverse, weight)
            kinds = np.bincount(inverse, minlength=len(contexts))
            value = np.maximum(weight - discount, 0) / total[inverse]
            order = np.argsort(gram, kind="stable")
            self.tables.append((gram[order], value[order], contexts, discount * kinds / total))
            if k > 1:
                # the next order counts in how many kinds of n-grams each of its n-grams ends
                shorter, first, inverse = np.unique(rows[f"g{k - 1}"].to_numpy(np.int64),
                                                    return_index=True, return_inverse=True)
                weight = np.bincount(inverse).astype(np.float64)
                rows = rows.iloc[first]
        self.floor = 1.0 / (len(self.tables[-1][0]) + 1)
        log = -np.log(self.chances({c: counts[c].to_numpy(np.int64) for c in _GRAMS}))
        n = counts["n"].to_numpy(np.float64)
        self.mean = float((log * n).sum() / n.sum())
        self.deviation = float(np.sqrt(((log - self.mean) ** 2 * n).sum() / n.sum()))

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], missing)

    def chances(self, found: dict[str, np.ndarray]) -> np.ndarray:
        """Interpolated probability of each n-gram of the highest order."""
        chance = np.full(len(found["g1"]), self.floor)
        for k in range(1, ORDER + 1):
            keys, values, contexts, weights = self.tables[ORDER - k]
            own = self._look(keys, values, found[f"g{k}"].astype(np.int64), 0.0)
            context = found[f"c{k}"].astype(np.int64) if k > 1 else np.zeros(len(own), np.int64)
            chance = own + self._look(contexts, weights, context, 1.0) * chance
        return np.maximum(chance, 1e-12)


class Identifier:
    """Models of all learned languages, in the order of their names."""

    def __init__(self, models: dict[str, CharModel]):
        self.langs = sorted(models)
        self.models = [models[x] for x in self.langs]
        self.memo = PieceTable(self._describe, np.int64, limit=200_000)
        self.losses = np.zeros((0, len(self.langs)))
        self.sizes = np.zeros(0, np.int64)

    def _describe(self, pieces: list[str]) -> list[list[int]]:
        """Losses and sizes of new pieces are appended; the memo holds their row."""
        if not self.memo.index:  # a new or emptied memo
            self.losses, self.sizes = self.losses[:0], self.sizes[:0]
        texts = [_letters(p) for p in pieces]
        found, sizes = grams(texts)
        top, first, inverse = np.unique(found[f"g{ORDER}"], return_index=True, return_inverse=True)
        distinct = {k: v[first] for k, v in found.items()}
        ends = np.cumsum(sizes)
        losses = np.empty((len(pieces), len(self.langs)))
        for j, model in enumerate(self.models):
            sums = np.concatenate([[0.0], np.cumsum(-np.log(model.chances(distinct))[inverse])])
            losses[:, j] = sums[ends] - sums[ends - sizes]
        base = len(self.sizes)
        self.losses = np.concatenate([self.losses, losses])
        self.sizes = np.concatenate([self.sizes, sizes])
        return [[base + i] for i in range(len(pieces))]

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score, entropy and rejected per text."""
        n, langs = len(texts), len(self.langs)
        loss, size = np.zeros((n, langs)), np.zeros(n)
        for part, rows in blocks(texts) if langs else ():
            at, counts = self.memo.flat([x.lower().split() for x in part])
            owner = np.repeat(np.asarray(rows, np.int64), counts)
            size += np.bincount(owner, self.sizes[at], n)
            for j in range(langs):
                loss[:, j] += np.bincount(owner, self.losses[at, j], n)
        some = size > 0
        pred = np.full(n, UND, object)
        score, entropy, rejected = np.zeros(n), np.zeros(n), np.ones(n, bool)
        if langs and some.any():
            rate = loss[some] / size[some, None]
            best = rate.argmin(axis=1)
            lowest = rate[np.arange(len(best)), best]
            pred[some] = np.array(self.langs, object)[best]
            entropy[some] = lowest
            # posterior of the winner, tempered by the square root of the length
            score[some] = 1 / np.exp((lowest[:, None] - rate) * np.sqrt(size[some])[:, None]).sum(axis=1)
            mean = np.array([m.mean for m in self.models])[best]
            deviation = np.array([m.deviation for m in self.models])[best]
            rejected[some] = lowest > mean + deviation * (SLACK + Z / np.sqrt(size[some]))
        return pd.DataFrame({"lang_pred": pred, "score": score, "entropy": entropy, "rejected": rejected})


def train(docs: DataFrame) -> dict[str, CharModel]:
    """Models of all languages of the rows whose crc32(doc_id) mod 5 is not 0.

    At most 2^HASH_BITS rows per language reach the driver.
    """
    rows = docs.select("doc_id", "text", "lang").where(crc_mod("doc_id", 5) != 0)
    counts = gram_counts(rows).toPandas()
    return {lang: CharModel(part) for lang, part in counts.groupby("lang") if part["n"].sum()}


def identify_column(models: dict[str, CharModel], text: Column) -> Column:
    """struct(lang_pred, score, entropy, rejected) of each text."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(models)

    @F.pandas_udf("struct<lang_pred: string, score: double, entropy: double, rejected: boolean>")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Identifier(shared.value)
        for texts in batches:
            yield own.judge(texts.tolist())
        own = None
        release()

    return identify(text)


def identify(docs: DataFrame, models: dict[str, CharModel]) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, entropy, rejected."""
    found = docs.select("doc_id", identify_column(models, F.col("text")).alias("found"))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                        "found.lang_pred", "found.score", "found.entropy", "found.rejected")


def clean(docs: DataFrame, models: dict[str, CharModel]) -> DataFrame:
    """``docs`` without the rejected rows; all columns are kept."""
    return docs.where(~identify_column(models, docs["text"]).getField("rejected"))
