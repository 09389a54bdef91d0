"""Quality scores from document statistics: random Fourier features, ridge regression, isotonic calibration.

Statistics of a text (shares of kinds of characters, word and line lengths, repetition, entropy) are standardised and
mapped to random cosines, whose inner products approximate a Gaussian kernel. Each partition sums its part of the
normal equations by fold; as these add up, leaving a fold out is a subtraction, and its rows get scores from weights
that never saw them. A monotone step function, fitted on those scores, turns scores into probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.llm.common import checkpointed, fold, likely, sample_by_hash, slices, texts

FOLDS = 5
BINS = 1000
_KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:", b"!", b"?", b"|", b"#$%&*@~^", b"<>{}[]()/\\=+_", bytes(range(128, 256))]


def statistics(text: str) -> list[float]:
    """Statistics of a text; those of the empty text are zero."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    words, lines = text.split(), text.split("\n")
    m = max(1, len(words))
    share = counts[counts > 0] / n
    again = sum(map(eq, words, words[1:])) / m
    return [
        *(counts[list(kind)].sum() / n for kind in _KINDS),
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / m / 10, len(set(words)) / m, again,
        len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)), float(-(share * np.log2(share)).sum()) if len(raw) else 0.0,
    ]


WIDTH = len(_KINDS) + 8


def with_statistics(docs: DataFrame, *others: str) -> DataFrame:
    """The named columns of ``docs`` and ``stats``; null text counts as empty."""
    schema = docs.select(*others).schema.add("stats", ArrayType(DoubleType()))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                stats = pa.array([statistics(t) for t in texts(part)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), stats], [*others, "stats"])

    return docs.select("text", *others).mapInArrow(run, schema)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray  # by fold left out; the last: none left out
    steps: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -6, 6)
        return np.hstack([np.cos(z @ self.waves + self.phases) * np.sqrt(2 / len(self.phases)), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray, left_out: int = FOLDS) -> np.ndarray:
        return self.features(stats) @ self.weights[left_out]

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), *self.steps)


def matrix(batch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing function of least weighted squared error: pooled neighbours, joined by lines."""
    blocks: list[list[float]] = []
    for xi, yi, ni in zip(x, y, n):
        blocks.append([xi * ni, yi * ni, ni])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([a / c for a, _, c in blocks]), np.clip([b / c for _, b, c in blocks], 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str, sample: int = 50_000, waves: int = 256, ridge: float = 1e-3, seed: int = 4) -> Model | None:
    """Learn from documents (doc_id, text) and their labels (doc_id, label 0 or 1); None if no document has one.

    Bounds: about ``sample`` labels, chosen by the id's hash, and ``waves`` random features. Null labels are left out, of
    labels that repeat an id the larger counts. Texts become statistics where they are, and only those are shuffled.
    """
    known = one_label(labels, label).select("doc_id", F.col(label).cast("double").alias("y"))
    chosen = checkpointed(sample_by_hash(known, "doc_id", sample, known.count(), seed))
    stats = with_statistics(likely(docs.select("doc_id", "text"), "doc_id", chosen), "doc_id")
    rows = checkpointed(stats.join(chosen, "doc_id").select(fold(F.col("doc_id"), FOLDS).cast("int").alias("fold"), "y", "stats"))
    one = rows.agg(F.count("*"), *(f(F.col("stats")[k]) for f in (F.avg, F.stddev_pop) for k in range(WIDTH))).first()
    if not one[0]:
        return None
    random = np.random.default_rng(seed)
    mean, spread = np.array(one[1 : 1 + WIDTH], float), np.maximum(np.array(one[1 + WIDTH :], float), 1e-6)
    size = waves + 1
    model = Model(mean, spread, random.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, waves)), random.uniform(0, 2 * np.pi, waves), np.zeros((FOLDS + 1, size)), (np.array([0.0]), np.array([0.5])))

    def equations(batches):
        sums = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            z, y, f = model.features(matrix(batch)), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for k in np.unique(f):
                own = z[f == k]
                sums[k] += own.T @ np.hstack([own, y[f == k, None]])
        some = [k for k in range(FOLDS) if sums[k, -1, -2]]
        at = [(k, i) for k in some for i in range(size)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in at], pa.int32()), pa.array([i for _, i in at], pa.int32()), pa.array([sums[k, i] for k, i in at], pa.list_(pa.float64()))], ["fold", "i", "part"]
        )

    def add(table):
        parts = table.column("part").combine_chunks().flatten().to_numpy().reshape(-1, size + 1).sum(axis=0)
        return pa.Table.from_pydict({"fold": table.column("fold")[:1], "i": table.column("i")[:1], "part": pa.array([parts], pa.list_(pa.float64()))})

    schema = "fold int, i int, part array<double>"
    sums = np.zeros((FOLDS, size, size + 1))
    for r in rows.mapInArrow(equations, schema).groupBy("fold", "i").applyInArrow(add, schema).collect():  # folds x features
        sums[r.fold, r.i] = r.part
    whole = sums.sum(axis=0)
    for k in range(FOLDS + 1):
        left = whole - (sums[k] if k < FOLDS else 0)
        count = max(1.0, left[-1, -2])
        model.weights[k] = np.linalg.solve(left[:, :-1] + ridge * count * np.eye(size) / waves, left[:, -1])

    def unseen(batches):
        for batch in batches:
            stats, f = matrix(batch), batch.column("fold").to_numpy()
            raw = np.zeros(len(f))
            for k in np.unique(f):
                raw[f == k] = model.raw(stats[f == k], k)
            yield pa.RecordBatch.from_arrays([pa.array(np.round(np.clip(raw, -1, 2) * BINS).astype(np.int32)), batch.column("y")], ["bin", "y"])

    bins = rows.mapInArrow(unseen, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()  # 3 x BINS at most
    model.steps = isotonic(*(np.array([getattr(r, c) for r in bins], float) for c in ("bin", "y", "n")))
    model.steps = (model.steps[0] / BINS, model.steps[1])
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score of every row; 0.5 without a model. Null text counts as empty; other columns are not looked at."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                stats = np.array([statistics(t) for t in texts(part)]).reshape(-1, WIDTH)
                score = model.score(stats) if model else np.full(len(stats), 0.5)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and its label: the larger one where rows repeat; null ids and labels are left out."""
    return labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))


def assess(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """Learn ``quality`` outside the held-out fold and score every document: doc_id, held_out, score, predicted."""
    open_ = fold(F.col("doc_id")) != 0
    scored = predict(docs, fit(docs.where(open_), labels.where(open_), "quality", **bounds))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
