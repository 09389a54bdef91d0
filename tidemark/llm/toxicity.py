"""Toxicity from confirmed examples and unlabelled text: non-negative positive-unlabelled learning.

A document is the set of its words; a word counts by itself and by its beginnings. Linear classifiers are trained with
numpy, each in a task of its own, on the positives and a share of the unlabelled documents, by the risk

    prior * loss(positives as positive) + max(0, loss(unlabelled as negative) - prior * loss(positives as negative))

whose second term, the negatives' loss, would go below zero by fitting positives among the unlabelled; where it does,
the step is taken against it. The classifiers' margins are averaged.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, fold, likely, sample_by_hash, slices, texts
from tidemark.llm.quality import one_label

_WORD = re.compile(r"[^\W\d_]+")
CACHED_WORDS = 400_000
BEGINNINGS = (4, 5, 6, 7, 8)


def units(word: str) -> list[str]:
    """What a word counts as: itself, marked as whole, and its beginnings."""
    return [f"{word} ", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


def word_set(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class Model:
    weights: dict[str, float]
    bias: float


def train(positive: list[list[int]], unlabelled: list[list[int]], width: int, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of least non-negative risk under the sigmoid loss, by Adam over all rows."""

    def flat(rows):
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([f for r in rows for f in r], np.int64)

    rows_p, at_p = flat(positive)
    rows_u, at_u = flat(unlabelled)
    w = np.zeros(width + 1)
    w[-1] = -1.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def slope(rows, at, size, by_row):
        g = np.bincount(at, by_row[rows], minlength=width + 1)
        g[-1] = by_row.sum()
        return g / max(1, size)

    for step in range(1, steps + 1):
        p = sigmoid(np.bincount(rows_p, w[at_p], minlength=len(positive)) + w[-1])
        u = sigmoid(np.bincount(rows_u, w[at_u], minlength=len(unlabelled)) + w[-1])
        negative = u.mean() - prior * p.mean()
        as_positive = slope(rows_p, at_p, len(p), -p * (1 - p))
        as_negative = slope(rows_u, at_u, len(u), u * (1 - u)) - prior * slope(rows_p, at_p, len(p), p * (1 - p))
        g = prior * as_positive + as_negative if negative >= 0 else -as_negative
        g[:-1] += decay * prior * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, positives: int = 10_000, unlabelled: int = 16_000, width: int = 8_192, bags: int = 4, prior: float | None = None) -> Model | None:
    """Learn from documents with toxic = 1 and from documents as they are; None if none is toxic.

    Bounds: about so many ``positives`` and ``unlabelled`` documents, chosen by the id's hash; the ``width`` units that
    speak most for the positives. ``prior``, the share of toxic documents, is that among the labels if not given.
    """
    known = one_label(labels, "toxic").where("toxic in (0, 1)")
    counts = known.agg(F.count("*"), F.sum("toxic")).first()
    if not counts[1]:
        return None
    prior = prior if prior is not None else min(0.9, max(0.001, counts[1] / counts[0]))
    base = docs.select("doc_id", "text")
    chosen = sample_by_hash(known.where("toxic = 1").select("doc_id"), "doc_id", positives, counts[1], 6)
    plain = sample_by_hash(base, "doc_id", unlabelled, base.count(), 66)
    chosen = checkpointed(chosen)
    rows = likely(base, "doc_id", chosen).join(chosen, "doc_id").withColumn("positive", F.lit(True)).unionByName(plain.withColumn("positive", F.lit(False)))

    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                found = [list(dict.fromkeys(u for w in sorted(word_set(t)) for u in units(w))) for t in texts(part)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("positive"), pa.array(found, pa.list_(pa.string()))], ["doc_id", "positive", "units"])

    rows = checkpointed(rows.mapInArrow(cut, "doc_id long, positive boolean, units array<string>"))
    sizes = {r.positive: r.n for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return None
    seen = rows.select("positive", F.explode("units").alias("unit")).groupBy("unit").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
    share_p, share_u = F.col("p") / n_p, (F.col("u") + 0.5) / n_u
    worth = (share_p - share_u) / F.sqrt(share_u)
    best = seen.where((F.col("p") >= 3) & (share_p > 1.5 * share_u)).orderBy(worth.desc(), "unit").limit(width)
    names = [r.unit for r in best.collect()]  # ``width`` names
    if not names:
        return None
    number = {u: i for i, u in enumerate(names)}

    def numbered(batches):
        for batch in batches:
            ids = [[number[u] for u in row if u in number] for row in batch.column("units").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("positive"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "positive", "ids"])

    small = rows.mapInArrow(numbered, "doc_id long, positive boolean, ids array<int>")
    every = F.array(*(F.lit(b) for b in range(bags)))
    own = F.array(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(bags)).cast("int"))
    small = small.withColumn("bag", F.explode(F.when(F.col("positive"), every).otherwise(own)))

    def learn(table):
        rows = table.to_pydict()
        p = [i for i, y in zip(rows["ids"], rows["positive"]) if y]
        u = [i for i, y in zip(rows["ids"], rows["positive"]) if not y]
        w, bias = train(p, u, len(names), prior) if p and u else (np.zeros(len(names)), 0.0)
        return pa.Table.from_pydict({"used": [bool(p and u)], "bias": [bias], "weights": pa.array([w], pa.list_(pa.float64()))})

    learned = small.groupBy("bag").applyInArrow(learn, "used boolean, bias double, weights array<double>").where("used").collect()  # one row a bag
    if not learned:
        return None
    w = np.mean([r.weights for r in learned], axis=0)
    return Model({u: float(x) for u, x in zip(names, w) if x}, float(np.mean([r.bias for r in learned])))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score of every row: the averaged margin as a probability; 0 without a model. Null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by ``width``

    def run(batches):
        model = shared.value
        known: dict[str, float] = {}
        for batch in batches:
            for part in slices(batch):
                scores = []
                for text in texts(part):
                    if model is None:
                        scores.append(0.0)
                        continue
                    if len(known) > CACHED_WORDS:
                        known.clear()
                    margin = model.bias
                    words = word_set(text)
                    have = list(map(known.get, words))
                    if None in have:
                        for at, w in enumerate(words):
                            if have[at] is None:
                                have[at] = known[w] = sum(model.weights.get(u, 0.0) for u in units(w))
                    margin += sum(sorted(x for x in have if x))  # in one order, whatever the set's
                    scores.append(float(1 / (1 + np.exp(-np.clip(margin, -30, 30)))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def assess(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **bounds) -> DataFrame:
    """Learn ``toxic`` outside the held-out fold and score every document: doc_id, held_out, score, predicted.

    One row per row, repeated ones too; without toxic examples every score is 0.
    """
    open_ = fold(F.col("doc_id")) != 0
    scored = predict(docs, fit(docs.where(open_), labels.where(open_), **bounds))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
