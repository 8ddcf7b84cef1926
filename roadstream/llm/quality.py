"""Quality by a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins. Cyclic boosting visits the features in
turn; each visit fits a shallow tree over the feature's bins to the remaining
error and adds a small part of it to the feature's lookup table. Then the pairs
with the strongest joint error get tables over coarser bins in the same way. A
score is the sum of one table entry per feature and pair.

Rows: null and empty texts have feature values of 0 words and score like any
other, very long ones are read whole. Without labelled rows of both classes, or in an
empty table, the model is a constant, the smoothed share of class 1. A score equal to
the threshold is predicted 1. Repeated rows score alike; other columns stay, and an
output column replaces one of the same name.
"""

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm import samples
from roadstream.llm.store import small_batches

ROWS_PER_CLASS = 10_000  # bound of the labelled sample
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
SLICE = 256

FEATURES = (
    "words", "word_length", "longest_word", "distinct_words", "top_word", "repeated_words",
    "distinct_triples", "short_words", "lines", "line_words", "distinct_lines",
    "capitals", "digits", "symbols", "stops", "exclamations", "pipes", "beyond_ascii",
    "capital_words", "ended_lines",
)

# Classes of bytes: 1 capital, 2 digit, 3 symbol, 4 stop, 5 exclamation, 6 pipe, 7 beyond ASCII.
BYTE_CLASS = np.zeros(256, np.uint8)
BYTE_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
BYTE_CLASS[list(b"0123456789")] = 2
BYTE_CLASS[list(b"#$%&*+/<=>@[\\]^_`{}~")] = 3
BYTE_CLASS[list(b".,;:?")] = 4
BYTE_CLASS[list(b"!")] = 5
BYTE_CLASS[list(b"|")] = 6
BYTE_CLASS[128:] = 7


def features(text: str | None) -> list[float]:
    """The values of ``FEATURES``."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, n_lines = max(1, len(words)), max(1, len(lines))
    lengths = list(map(len, words))
    seen = Counter(words)
    triples = max(1, len(words) - 2)
    raw = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(BYTE_CLASS[raw], minlength=8) / max(1, len(raw))
    return [
        math.log1p(len(words)),
        sum(lengths) / n,
        math.log1p(max(lengths, default=0)),
        len(seen) / n,
        max(seen.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(zip(words, words[1:], words[2:], strict=False))) / triples,
        sum(k <= 2 for k in lengths) / n,
        math.log1p(len(lines)),
        math.log1p(n / n_lines),
        len(set(lines)) / n_lines,
        *kinds[1:].tolist(),
        sum(map(str.isupper, words)) / n,
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / n_lines,
    ]


def feature_column(text: Column | str) -> Column:
    """The features of a text column as an array of floats."""

    @F.arrow_udf("array<float>")
    def features_udf(texts: pa.Array) -> pa.Array:
        done = []
        for i in range(0, len(texts), SLICE):
            done += [features(t) for t in texts.slice(i, SLICE).to_pylist()]
        return pa.array(done, pa.list_(pa.float32()))

    return features_udf(text)


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)  # of each feature's bins
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin to coarse bin
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row of features."""
        total = np.full(len(values), self.intercept)
        if self.tables and len(values):
            bins = binned(values, self.edges)
            for j, table in enumerate(self.tables):
                total += table[bins[j]]
            for (i, j), table in self.pairs.items():
                total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def binned(values: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
    return [np.searchsorted(e, values[:, j], side="right") for j, e in enumerate(edges)]


def shallow_tree(slope: np.ndarray, weight: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Best Newton step per bin with at most ``leaves`` runs of bins."""
    cuts, add = [0, len(slope)], 1.0
    s, w = np.concatenate([[0], np.cumsum(slope)]), np.concatenate([[0], np.cumsum(weight)])

    def gain(a, b):
        return (s[b] - s[a]) ** 2 / (w[b] - w[a] + add)

    for _ in range(leaves - 1):
        best = (1e-12, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                at = np.arange(a + 1, b)
                won = gain(a, at) + gain(at, b) - gain(a, b)
                k = int(np.argmax(won))
                best = max(best, (float(won[k]), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    step = np.empty(len(slope))
    for a, b in zip(cuts, cuts[1:], strict=False):
        step[a:b] = (s[b] - s[a]) / (w[b] - w[a] + add)
    return step


def _pair_step(slope: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton step over the four quarters of the best cross-shaped cut of a grid."""
    add = 1.0
    s = np.pad(slope.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    w = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    def quarters(x):
        one = x[1:-1, 1:-1]
        top, side, whole = x[1:-1, -1:], x[-1:, 1:-1], x[-1, -1]
        return np.stack([one, top - one, side - one, whole - top - side + one])

    qs, qw = quarters(s), quarters(w)
    won = (qs**2 / (qw + add)).sum(0)
    i, j = np.unravel_index(int(np.argmax(won)), won.shape)
    values = qs[:, i, j] / (qw[:, i, j] + add)
    step = np.empty_like(slope)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :] = values[0], values[1]
    step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = values[2], values[3]
    return step


def boost(values: np.ndarray, label: np.ndarray, intercept: float) -> Model:
    """Cyclic boosting of the tables of single features, then of pairs."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(v, quantiles)) for v in values.T]
    bins = binned(values, edges)
    sizes = [len(e) + 1 for e in edges]
    tables = [np.zeros(k) for k in sizes]
    total = np.full(len(label), intercept)

    def errors():
        p = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
        return label - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(tables):
            if sizes[j] > 1:
                slope, weight = errors()
                step = RATE * shallow_tree(
                    np.bincount(bins[j], slope, sizes[j]), np.bincount(bins[j], weight, sizes[j])
                )
                table += step
                total += step[bins[j]]
    coarse = [np.arange(k) * PAIR_BINS // k for k in sizes]
    cells, shape = {}, (PAIR_BINS, PAIR_BINS)
    slope, weight = errors()
    strength = {}
    for i in range(len(edges)):
        for j in range(i + 1, len(edges)):
            cell = coarse[i][bins[i]] * PAIR_BINS + coarse[j][bins[j]]
            s = np.bincount(cell, slope, PAIR_BINS**2)
            w = np.bincount(cell, weight, PAIR_BINS**2)
            strength[i, j] = float((s**2 / (w + 1)).sum())
            cells[i, j] = cell
    chosen = sorted(strength, key=lambda p: (-strength[p], p))[:PAIRS]
    pairs = {p: np.zeros(shape) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for p, table in pairs.items():
            slope, weight = errors()
            step = RATE * _pair_step(
                np.bincount(cells[p], slope, PAIR_BINS**2).reshape(shape),
                np.bincount(cells[p], weight, PAIR_BINS**2).reshape(shape),
            )
            table += step
            total += step.ravel()[cells[p]]
    return Model(intercept, edges, tables, coarse, pairs)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    trains_on: Column,
    label: str = "quality",
    rows_per_class: int = ROWS_PER_CLASS,
) -> Model:
    """Model from labelled documents for whose ids ``trains_on`` holds."""
    small_batches(docs.sparkSession)
    known = samples.class_labels(labels, label).filter(trains_on)
    counts = samples.class_counts(known)
    sample = samples.labelled_sample(docs, known, rows_per_class)
    rows = sample.select(feature_column("text").alias("x"), "_label").toPandas()
    target = rows["_label"].to_numpy(float)
    prior = math.log((counts[1] + 1) / (counts[0] + 1))
    if not 0 < target.sum() < len(target):
        return Model(prior)
    own = math.log(target.sum() / (len(target) - target.sum()))
    model = boost(np.stack(rows.x).astype(float), target, own)
    model.intercept += prior - own  # the sample has other class shares
    return model


def score(text: Column | str, model: Model, df: DataFrame) -> Column:
    """Probability of class 1; the tables (a few KB) are broadcast."""
    parts = (model.intercept, model.edges, model.tables, model.coarse, model.pairs)
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(parts)

    @F.arrow_udf("double")
    def score_udf(texts: pa.Array) -> pa.Array:
        own = Model(*shared.value)
        done = [np.empty(0)]
        for i in range(0, len(texts), SLICE):
            values = [features(t) for t in texts.slice(i, SLICE).to_pylist()]
            done.append(own.score(np.array(values, np.float32).astype(float)))
        return pa.array(np.concatenate(done))

    return score_udf(text)


def classify(
    df: DataFrame, model: Model, text: str = "text", threshold: float = 0.3
) -> DataFrame:
    """Adds ``score`` and ``predicted`` (1: good)."""
    scored = df.withColumn("score", score(text, model, df))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
