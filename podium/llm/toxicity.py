"""Toxicity scores by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic texts and unlabelled texts. Its risk is the class-prior
corrected estimate  pi * E_P[l(f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)]); where the second part
would be negative it is clipped, so it cannot be driven down by overfitting. The bias is then
set so that the mean score of the unlabelled texts is the prior, as it must be. The prior is the
share of toxic texts among all distinct labelled training texts, an aggregate over the tables.

Features of a text are its distinct words and the beginnings of words, hashed into
``FEATURES`` bins. Fitting uses a bounded sample of training rows (about ``POSITIVES`` and
``UNLABELLED`` rows, picked by hash as they are read), of which near copies are left out, as
copies of one text would make all its words look telling. Bins keep weight zero unless they are
at least ``LIFT`` times as telling as a word that only toxic texts hold, beyond chance. Every row is scored on its whole
text in the tasks that read it; the model is one array of ``FEATURES`` floats.

Defined cases: a null or empty text scores as a text without words; without any positive
training row all rows get the prior; a document with several labels counts as toxic if one
says so; repeated rows score alike; an empty table gives no rows; other columns are kept out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import PieceTable, blocks, crc_mod, release, releasing

FEATURES = 1 << 18
POSITIVES, UNLABELLED = 4000, 8000
PREFIXES = (3, 4, 5)
LIFT = 0.5  # of 1 / prior, the ratio for a word that only toxic texts hold
THRESHOLD = 0.3
STEPS, RATE, DECAY = 400, 0.05, 1e-4
_WORD = re.compile(r"[^\W\d_]+")


def _bins(pieces: list[str]) -> list[list[int]]:
    out = []
    for piece in pieces:
        bins = []
        for word in _WORD.findall(piece):
            names = {word + "$"} | {word[:n] for n in PREFIXES if len(word) >= n}
            bins += [xxhash.xxh3_64_intdigest(x) % FEATURES for x in names]
        out.append(bins)
    return out


def _words(text: str) -> list[str]:
    return list(set(text.lower().split()))


def features(texts: list[str | None], pieces: PieceTable) -> Iterator[tuple[np.ndarray, ...]]:
    """(bins, row numbers, counts) per block of texts."""
    for part, rows in blocks(texts):
        values, counts = pieces.flat([_words(x) for x in part])
        yield values, np.asarray(rows, np.int64), counts


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None], pieces: PieceTable) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        for bins, rows, counts in features(texts, pieces):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[bins], dtype=np.float64)])
            ends = np.cumsum(counts)
            np.add.at(total, rows, sums[ends] - sums[ends - counts])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _signature(text: str) -> list[int]:
    """Lowest hashes of the 5-word runs of a text under four salts."""
    words = text.lower().split()
    runs = {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(r) for r in runs), np.uint64, len(runs))
    return [int((hashes * np.uint64(m) >> np.uint64(1)).min()) for m in _SALTS]


_SALTS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _share(n: int, total: int, *columns: str) -> Column:
    """Rows whose hash falls in a share of the hashes that holds about ``n`` of ``total`` rows."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < F.lit(-(-n * (1 << 40) // max(n, total, 1)))


def _sample(rows: DataFrame, n: int) -> list[np.ndarray]:
    """Distinct bins of ``rows`` (some ``n``, picked by hash; those of the lowest hashes), without
    rows that share a signature part with an earlier one. The tasks that read a text make its
    bins; only these reach the driver."""
    def to_bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = PieceTable(_bins, np.int32)
        for batch in batches:
            found = [np.zeros(0, np.int32)] * len(batch)
            for bins, owner, counts in features(batch["text"].tolist(), pieces):
                for i, part in zip(owner, np.split(bins, np.cumsum(counts)[:-1])):
                    found[i] = np.union1d(found[i], part).astype(np.int32)
            yield pd.DataFrame({"hash": batch["hash"], "bins": [x.tobytes() for x in found],
                                "signature": [_signature(x or "") for x in batch["text"]]})

    picked = (rows.select(F.xxhash64("doc_id", "text").alias("hash"), "text")
              .mapInPandas(releasing(to_bins), "hash long, bins binary, signature array<long>"))
    seen: set[tuple[int, int]] = set()
    kept = []
    for row in sorted(picked.collect(), key=lambda r: (r["hash"], r["bins"]))[:n]:
        parts = set(enumerate(row["signature"]))
        if not parts & seen:
            kept.append(np.frombuffer(row["bins"], np.int32))
        seen |= parts
    return kept


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of ``docs`` and ``labels`` whose crc32(doc_id) mod 4 is not 2."""
    known = (labels.where(crc_mod("doc_id", 4) != 2).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    rows = docs.select("doc_id", "text").where(crc_mod("doc_id", 4) != 2)
    texts = rows.select("doc_id", F.xxhash64("text").alias("text_key")).join(known, "doc_id")
    sums = texts.groupBy("text_key").agg(F.max("label").alias("label"), F.sum("label").alias("toxic")).agg(
        F.avg("label").alias("prior"), F.sum("toxic").alias("toxic")).first()
    prior = min(max(sums["prior"] or 0.0, 1e-3), 0.9)
    # at most about POSITIVES ids, so their broadcast is bounded and no text is shuffled
    ids = texts.where("label = 1").select("doc_id").where(_share(POSITIVES, sums["toxic"] or 0, "doc_id")).distinct()
    toxic = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    positive = _sample(toxic, POSITIVES)
    unlabelled = _sample(rows.where(_share(UNLABELLED, rows.count(), "doc_id", "text")), UNLABELLED)
    bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(np.zeros(FEATURES, np.float32), bias)
    return fit(positive, unlabelled, prior)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Non-negative risk minimisation of a linear model over presence features (Adam)."""
    n_p, n_u = len(positive), len(unlabelled)
    in_p = np.bincount(np.concatenate(positive), minlength=FEATURES)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=FEATURES)
    # chance of so many toxic texts with a bin at its rate in all texts (Poisson tail), held
    # against the number of bins that are tried
    k, expected = np.maximum(in_p, 1), n_p * (in_u + 0.5) / n_u
    tail = k * np.log(expected / k) + k - expected - 0.5 * np.log(2 * np.pi * k)
    tried = max(1, np.count_nonzero(in_p + in_u >= 3))
    used = (in_p / n_p > LIFT / prior * in_u / n_u) & (in_p > expected) & (tail < -np.log(tried))
    rows = [x[used[x]] for x in positive + unlabelled]
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), np.fromiter(map(len, rows), np.int64, len(rows)))
    weights, bias = np.zeros(FEATURES), np.log(prior / (1 - prior))
    moment, square = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for step in range(1, STEPS + 1):
        f = bias + np.bincount(owner, weights[flat], len(rows))
        chance = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        p, u = chance[:n_p], chance[n_p:]
        # logistic loss: l(f) = log(1 + e^-f), l(-f) = log(1 + e^f)
        negative = np.logaddexp(0, f[n_p:]).mean() - prior * np.logaddexp(0, f[:n_p]).mean()
        slope = np.zeros(len(rows))
        slope[:n_p] = prior * (p - 1) / n_p
        if negative > 0:  # else the clipped part is flat
            slope[:n_p] -= prior * p / n_p
            slope[n_p:] = u / n_u
        grad = np.append(np.bincount(flat, slope[owner], FEATURES) + DECAY * weights, slope.sum())
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        move = RATE * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        weights = np.where(used, weights - move[:-1], 0.0)
        bias -= move[-1]
    return Model(weights.astype(np.float32), _calibrated(
        np.bincount(owner, weights[flat], len(rows))[n_p:], prior))


def _calibrated(raw: np.ndarray, prior: float) -> float:
    """The bias at which the mean score of the unlabelled texts is the class prior."""
    low, high = -40.0 - raw.max(), 40.0 - raw.min()
    for _ in range(80):
        middle = (low + high) / 2
        if (1 / (1 + np.exp(-np.clip(raw + middle, -30, 30)))).mean() > prior:
            high = middle
        else:
            low = middle
    return float(low)


def score_column(model: Model, text: Column) -> Column:
    """Score of each text; the model travels once per executor."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, pieces = Model(*shared.value), PieceTable(_bins, np.int32)
        for texts in batches:
            yield pd.Series(own.scores(texts.tolist(), pieces))
        pieces = None
        release()

    return score(text)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    return (docs.select("doc_id", "text")
            .select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                    score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows predicted to be toxic; all columns are kept."""
    return docs.where(score_column(model, docs["text"]) < THRESHOLD)
