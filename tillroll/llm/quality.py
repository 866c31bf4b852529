"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text gives a fixed number of statistics of its characters, words and lines,
transformed to be roughly bell-shaped. Each class's covariance is shrunk towards
the pooled one and that towards its diagonal; its Cholesky factor is kept with its
inverse, and the difference of the classes' log densities, from Mahalanobis
distances by the factors, is the evidence. A logistic curve fitted to the training
rows' evidence turns it into a score.

Products over rows go through ``einsum``: a driver that has started a JVM is a forked
process, and threaded linear algebra on large arrays may wait forever in one.

Fitting takes at most ``max_rows`` labelled documents, the first by seeded hash of
their id; scoring is one pass over every whole text, with nothing shuffled.

Defined results: null and empty texts give the statistics of an empty text and are
scored; labels of null or absent documents aren't used, of an id with several
labels the highest counts; without labels of both classes every score is the
training rows' mean label, or 0.5. Other columns pass through, and result names
replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import prepare_workers, read_table, reserved, text_remainder

#: Labelled documents that a model is fitted on at most.
MAX_ROWS = 20_000
#: Weight of the pooled covariance in each class's, and of the diagonal in the pooled one.
TO_POOLED, TO_DIAGONAL = 0.1, 0.1
#: Evidence beyond this counts as this much.
MOST_EVIDENCE = 60.0

#: Byte classes that are counted.
_BYTES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:",
    "loud": b"!?",
    "bar": b"|\t<>{}[]",
    "symbol": b"*&%$#@^~=+\\/_`\"'()-",
    "space": b" \n\r\x0b\x0c",
    "other": bytes(range(128, 256)),
}
_CLASS_OF = np.zeros((256, len(_BYTES)), dtype=np.int64)
for _k, _members in enumerate(_BYTES.values()):
    _CLASS_OF[list(_members), _k] = 1
STATISTICS = (*_BYTES, "length", "words_per_line", "word_length", "long_words", "distinct", "repeated", "top_line", "symbol_words")


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text."""
    data = (text or "").encode()
    size = len(data)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _CLASS_OF
    shares = np.sqrt(counts / max(size, 1)).tolist()
    words = data.split()
    n = len(words)
    lines = data.split(b"\n")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    # Distinct words grow with the root of the length or faster: set in proportion.
    distinct = len(set(words)) / max(n, 1) ** 0.8
    return [
        *shares,
        float(np.log1p(n)),
        float(np.log1p(n / len(lines))),
        float(np.log1p(lengths.mean())) if n else 0.0,
        float(np.sqrt((lengths > 15).mean())) if n else 0.0,
        float(np.log(distinct + 0.01)),
        float(np.sqrt(repeated / max(n - 1, 1))),
        float(np.sqrt(1 - len(set(lines)) / len(lines))),
        float(np.sqrt((counts[6] + counts[5] + counts[4]) / max(n, 1))),
    ]


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances, and the calibration."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    slope: float
    offset: float
    constant: float | None = None

    def __post_init__(self) -> None:
        self.inverses = np.linalg.solve(self.factors, np.broadcast_to(np.eye(self.factors.shape[-1]), self.factors.shape))

    def evidence(self, rows: np.ndarray) -> np.ndarray:
        """Log density under class 1 less that under class 0."""
        rows = (rows - self.centre) / self.scale
        density = []
        for mean, inverse, constant in zip(self.means, self.inverses, self.constants):
            solved = np.einsum("ij,nj->ni", inverse, rows - mean)
            density.append(constant - 0.5 * (solved**2).sum(axis=1))
        return np.clip(density[1] - density[0], -MOST_EVIDENCE, MOST_EVIDENCE)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        return 1 / (1 + np.exp(-(self.slope * self.evidence(rows) + self.offset)))


def fit(rows: np.ndarray, labels: np.ndarray, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Discriminant:
    d = rows.shape[1] if rows.ndim == 2 else len(STATISTICS)
    blank = [np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), np.zeros(d), np.ones(d), 1.0, 0.0]
    if len(set(labels.tolist())) < 2:
        return Discriminant(*blank, constant=float(labels.mean()) if len(labels) else 0.5)
    centre, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    z = (rows - centre) / scale
    groups = [z[labels == c] for c in (0, 1)]
    means = np.stack([g.mean(axis=0) for g in groups])
    scatter = [np.einsum("ni,nj->ij", g - m, g - m) for g, m in zip(groups, means)]
    pooled = sum(scatter) / max(len(z) - 2, 1)
    pooled = (1 - to_diagonal) * pooled + to_diagonal * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
    factors = []
    for s, g in zip(scatter, groups):
        weight = to_pooled + (1 - to_pooled) * d / (d + len(g))
        factors.append(np.linalg.cholesky((1 - weight) * s / len(g) + weight * pooled))
    constants = np.array([-np.log(np.diag(f)).sum() for f in factors])
    model = Discriminant(means, np.stack(factors), constants, centre, scale, 1.0, 0.0)
    model.slope, model.offset = logistic(model.evidence(rows), labels)
    return model


def logistic(evidence: np.ndarray, labels: np.ndarray, balance: float = 0.0, ridge: float = 1.0, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of P(label 1), by Newton's method; the slope stays above 0.

    ``balance``: 0 takes rows as they are, 1 lets both classes weigh the same.
    """
    x = np.column_stack([evidence, np.ones_like(evidence)])
    # Platt's targets keep the curve finite where the classes don't overlap.
    n1, n0 = labels.sum(), (1 - labels).sum()
    y = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, len(labels) / (2 * n1), len(labels) / (2 * n0)) ** balance
    w = np.array([0.0, 0.0])
    penalty = np.diag([ridge, 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(w[0] * evidence + w[1], -500, 500)))
        gradient = np.einsum("ni,n->i", x, weight * (p - y)) + penalty @ w
        step = np.linalg.solve(np.einsum("ni,nj,n->ij", x, x, weight * p * (1 - p) + 1e-9) + penalty, gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def sampled_labels(labels: DataFrame, label: str, use: Column, max_rows: int, seed: int = 7) -> DataFrame:
    """At most ``max_rows`` ids with their label, the first by hash of the id."""
    known = labels.where(use & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("__label"))
    return known.groupBy("doc_id").agg(F.max("__label").alias("__label")).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_rows)


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by __statistics, an array of doubles."""
    prepare_workers(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name != text]
    width = len(kept)
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([statistics(t) for t in batch.column(width).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(width)], made], names=[f.name for f in kept] + ["__statistics"])

    return source.mapInArrow(run, T.StructType([*kept, T.StructField("__statistics", T.ArrayType(T.DoubleType()))]))


def fit_quality(docs: DataFrame, labels: DataFrame, use: Column, label: str = "quality", text: str = "text", max_rows: int = MAX_ROWS) -> Discriminant:
    """Fit on labelled documents for which ``use``, over columns of ``labels``, holds."""
    chosen = sampled_labels(labels, label, use, max_rows)
    joined = docs.select("doc_id", F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    rows = with_statistics(joined, "text").groupBy("doc_id", "__label").agg(F.min("__statistics").alias("x")).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows], dtype=float)
    return fit(x, np.array([r["__label"] for r in rows], dtype=int))


def score_quality(df: DataFrame, model: Discriminant, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score`` to each row of ``df``."""
    prepare_workers(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name.lower() != score.lower()]
    width = len(kept)
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias(reserved(df, "text")["text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t) for t in batch.column(width).to_pylist()], dtype=float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(width)], pa.array(model.score(rows), pa.float64())], names=[f.name for f in kept] + [score])

    return source.mapInArrow(run, T.StructType([*kept, T.StructField(score, T.DoubleType())]))


#: Ids of which a fold of this many is held out, and which of them; the least score of label 1.
FOLDS, HELD_OUT, LEAST = 4, 2, 0.7


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels, text_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    scored = score_quality(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(text_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted"))
