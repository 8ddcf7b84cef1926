"""Toxicity by a linear classifier over character n-grams.

A document's features are the character n-grams of its distinct lower-cased words
(each with a space on both sides), hashed into buckets; a feature's value is the
number of distinct words that hold it. Values are scaled by the naive Bayes log
ratio of the bucket's shares in toxic and other documents; a logistic regression
on the scaled values gives the weights. Buckets whose shares do not differ
significantly get ratio 0, so that long texts gather no noise. The sample's values in
all other buckets come to the driver in packed pieces, 8 bytes a value.

The model is a table of ``2 ** BITS`` weights. As it is linear, a word's score is
the sum of its n-grams' weights, and a text's the sum over its distinct words.

Rows: null and empty texts have no features and score the intercept. Without
labelled rows of both classes, or in an empty table, the model is a constant, the
smoothed share of class 1. A score equal to the threshold is predicted 1. Very long texts
are scored whole. Repeated rows score alike; other columns stay, and an output column
replaces one of the same name.
"""

import math
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm import samples
from roadstream.llm.store import small_batches, stored

BITS = 18
SIZES = (3, 4, 5)
ROWS_PER_CLASS = 5000  # bound of the labelled sample
MIN_Z = 2.5
PIECE = 1 << 20  # values that are unpacked at a time
PENALTY = 1.0
SLICE = 100
KEPT_WORDS = 200_000  # kept word scores of a worker, about 25 MB


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float


def buckets(word: str) -> list[int]:
    """Buckets of the word's character n-grams."""
    padded, mask = f" {word} ", (1 << BITS) - 1
    return [
        crc32(padded[i : i + n].encode()) & mask
        for n in SIZES
        for i in range(len(padded) - n + 1)
    ]


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte, from the polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def word_scores(words: list[str], weights: np.ndarray) -> list[float]:
    """Sum of the weights of each word's buckets, of all ASCII words by array operations."""
    plain = [w for w in words if w.isascii()]
    data = np.frombuffer("".join([f" {w} " for w in plain]).encode() + bytes(SIZES[-1]), np.uint8)
    sizes = np.array([len(w) + 2 for w in plain], np.int64)
    owner = np.repeat(np.arange(len(plain)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))
    sums, crc = np.zeros(len(plain)), np.full(len(owner), 0xFFFFFFFF, np.uint32)
    for n in range(1, SIZES[-1] + 1):
        crc = CRC[(crc ^ data[n - 1 : n - 1 + len(owner)]) & 255] ^ (crc >> np.uint32(8))
        if n in SIZES:
            whole = left >= n
            at = ~crc[whole] & np.uint32((1 << BITS) - 1)
            sums += np.bincount(owner[whole], weights[at], len(plain))
    found = dict(zip(plain, sums.tolist(), strict=True))
    return [found[w] if w in found else float(weights[buckets(w)].sum()) for w in words]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text, ascending, and their values."""
    found = [b for word in set((text or "").lower().split()) for b in buckets(word)]
    return np.unique(np.array(found, np.int64), return_counts=True)


def _document_counts(sample: DataFrame) -> np.ndarray:
    """Documents of each class (rows 0, 1) that hold each bucket."""

    def partial(batches):
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, label in zip(
                batch.column("text").to_pylist(), batch.column("_label").to_pylist(), strict=True
            ):
                total[label, features(text)[0]] += 1
        at = np.flatnonzero(total.any(axis=0))
        columns = [at, total[0, at], total[1, at]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["b", "n0", "n1"])

    parts = sample.select("text", "_label").mapInArrow(partial, "b long, n0 long, n1 long")
    rows = parts.groupBy("b").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    counts = np.zeros((2, 1 << BITS))
    counts[0, rows.b], counts[1, rows.b] = rows.n0, rows.n1
    return counts


def log_ratios(counts: np.ndarray, rows: tuple[int, int]) -> np.ndarray:
    """Naive Bayes log ratio of each bucket; 0 where the shares hardly differ."""
    share = (counts + 1) / (np.array(rows)[:, None] + 2)
    spread = np.sqrt(((1 - share) / (share * (np.array(rows)[:, None] + 2))).sum(axis=0))
    ratio = np.log(share[1] / share[0])
    return np.where(np.abs(ratio) / spread >= MIN_Z, ratio, 0.0)


@dataclass(frozen=True)
class Piece:
    """Some rows of the sample: chosen buckets of each, columns and values row by row."""

    sizes: np.ndarray
    column: np.ndarray
    value: np.ndarray
    label: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def _selected_rows(sample: DataFrame, chosen: np.ndarray) -> list[Piece]:
    """The sample's values in the chosen buckets; a partition at a time comes over."""
    shared = sample.sparkSession.sparkContext.broadcast(chosen)

    def packed(held):
        columns, values, labels = zip(*held, strict=True)
        made = [[len(c) for c in columns], np.concatenate(columns), np.concatenate(values), labels]
        return pa.RecordBatch.from_arrays(
            [pa.array([np.asarray(x, np.int32).tobytes()], pa.binary()) for x in made],
            ["sizes", "column", "value", "label"],
        )

    def rows(batches):
        place = np.full(1 << BITS, -1, np.int32)
        place[shared.value] = np.arange(len(shared.value))
        held, size = [], 0
        for batch in batches:
            for text, label in zip(
                batch.column("text").to_pylist(), batch.column("_label").to_pylist(), strict=True
            ):
                found, count = features(text)
                column = place[found]
                held.append((column[column >= 0], count[column >= 0], label))
                size += len(held[-1][0])
                if size >= PIECE:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    schema = "sizes binary, column binary, value binary, label binary"
    parts = sample.select("text", "_label").mapInArrow(rows, schema)
    return [
        Piece(*(np.frombuffer(x, np.int32) for x in row)) for row in parts.toLocalIterator()
    ]


def logistic(pieces: list[Piece], scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression, by accelerated descent.

    A column's values are multiplied by its ``scale``.
    """
    width, label = len(scale), np.concatenate([p.label for p in pieces]).astype(float)
    upto = np.cumsum([len(p.label) for p in pieces])[:-1]
    weights, intercept = np.zeros(width), 0.0
    ahead, ahead_b = weights.copy(), 0.0

    def sums(by_column, power=1):
        """Of each row: its values to a power, times their columns' numbers."""
        return np.concatenate([
            np.bincount(p.rows(), p.value.astype(float) ** power * by_column[p.column], len(p.label))
            for p in pieces
        ])

    def slopes(error):
        total = np.zeros(width)
        for p, own in zip(pieces, np.split(error, upto), strict=True):
            total += np.bincount(p.column, p.value * own[p.rows()], width)
        return total * scale

    norms = sums(scale**2, 2) + 1
    step = 4 / (norms.max() * len(label)) if len(label) else 0.0
    step = max(step, 4 / (norms.mean() * len(label) * 8))

    def loss(w, score):
        fit = np.logaddexp(0, np.where(label > 0, -score, score)).sum()
        return fit + PENALTY / 2 * (w @ w)

    # Scores are linear in the weights: those of the point ahead follow from two others.
    score = ahead_score = np.zeros(len(label))
    last = loss(weights, score)
    momentum = 1.0
    for _ in range(400):
        error = 1 / (1 + np.exp(-np.clip(ahead_score, -50, 50))) - label
        slope = slopes(error) + PENALTY * ahead
        new, new_b = ahead - step * slope, ahead_b - step * error.sum()
        new_score = sums(new * scale) + new_b
        now = loss(new, new_score)
        if now > last:  # overshot: shorter steps, from the last point, without momentum
            step, momentum, ahead, ahead_b = step / 2, 1.0, weights.copy(), intercept
            ahead_score = score
            continue
        grown = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        further = (momentum - 1) / grown
        ahead = new + further * (new - weights)
        ahead_b = new_b + further * (new_b - intercept)
        ahead_score = new_score + further * (new_score - score)
        weights, intercept, score, last, momentum = new, new_b, new_score, now, grown
    return weights, intercept


def fit(
    docs: DataFrame,
    labels: DataFrame,
    trains_on: Column,
    label: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
) -> Model:
    """Model from labelled documents for whose ids ``trains_on`` holds."""
    small_batches(docs.sparkSession)
    known = samples.class_labels(labels, label).filter(trains_on)
    none, some = samples.class_counts(known)
    sample = stored(samples.labelled_sample(docs, known, rows_per_class))
    count = sample.groupBy("_label").count().toPandas().set_index("_label")["count"]
    rows = (int(count.get(0, 0)), int(count.get(1, 0)))
    weights = np.zeros(1 << BITS)
    prior = math.log((some + 1) / (none + 1))
    if not all(rows):
        return Model(weights, prior)
    ratio = log_ratios(_document_counts(sample), rows)
    chosen = np.flatnonzero(ratio)
    own, intercept = logistic(_selected_rows(sample, chosen), ratio[chosen])
    weights[chosen] = own * ratio[chosen]
    # The sample has other class shares than the labelled rows.
    return Model(weights, intercept + prior - math.log(rows[1] / rows[0]))


def score(text: Column | str, model: Model, df: DataFrame) -> Column:
    """Probability of class 1; the weights (2 MB) are broadcast."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(
        {"weights": model.weights, "intercept": model.intercept}
    )

    @F.arrow_udf("double")
    def score_udf(texts: pa.Array) -> pa.Array:
        tables = shared.value
        known, weights = tables.setdefault("kept_words", {}), tables["weights"]
        out = []
        for begin in range(0, len(texts), SLICE):
            if len(known) > KEPT_WORDS:
                known.clear()
            own = [
                set((text or "").lower().split())
                for text in texts.slice(begin, SLICE).to_pylist()
            ]
            fresh = [w for w in set().union(*own) if w not in known]
            known.update(zip(fresh, word_scores(fresh, weights), strict=True))
            out += [math.fsum([known[w] for w in words]) for words in own]
        out = np.array(out) + tables["intercept"]
        return pa.array(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return score_udf(text)


def classify(
    df: DataFrame, model: Model, text: str = "text", threshold: float = 0.3
) -> DataFrame:
    """Adds ``score`` and ``predicted`` (1: toxic)."""
    scored = df.withColumn("score", score(text, model, df))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
