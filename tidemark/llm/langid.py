"""Language of a document: known words by their log frequency, unknown ones by ever shorter character n-grams.

A word is a letter with the letters and combining marks that follow it. A word of the model scores its log frequency in
each language. A word that no language knows is cut, over its whole length, into n-grams of the longest order; what is
unknown there is cut into the next shorter ones, and so on down to letters. Every language has the same quotas of
documents and units, so one that nearly all texts are written in leaves a rare one its words and its name.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, lean, slices, texts
from tidemark.llm.ranks import kept



def _class(*kinds: str) -> str:
    """The characters of these general categories as ranges for a character class."""
    out, start = [], None
    for c in range(0x110001):
        inside = c < 0x110000 and unicodedata.category(chr(c)) in kinds
        if inside and start is None:
            start = c
        if not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


# ``\w`` also takes numbers that are no digits, such as fractions and numerals in circles.
_LETTER = rf"[^\W\d_{_class('Nl', 'No')}]"
_MARK = f"[{_class('Mn', 'Mc', 'Me')}]"
_WORD = re.compile(f"{_LETTER}+(?:{_MARK}+{_LETTER}*)*")
# Below U+0300 the only such numbers and marks are these; without them and what is beyond, a plain class does the same.
_FEW = "".join(chr(c) for c in range(0x300) if unicodedata.category(chr(c)) in ("Nl", "No", "Mn", "Mc", "Me"))
_BEYOND = re.compile(f"[{_FEW}\u0300-\U0010ffff]")
_PLAIN_WORD = re.compile(r"[^\W\d_]+")
CACHED_WORDS = 300_000


def words_of(text: str) -> list[str]:
    return (_PLAIN_WORD if text.isascii() or not _BEYOND.search(text) else _WORD).findall(text)


@dataclass
class Model:
    """languages; for each order (0: whole words, n: n-grams) the log frequencies of its units by language, and those
    of a unit seen nowhere."""

    languages: list[str]
    tables: dict[int, dict[str, np.ndarray]]
    floors: dict[int, np.ndarray]
    orders: tuple[int, ...]


def grams(unit: str, n: int) -> list[str]:
    return [unit[i : i + n] for i in range(max(1, len(unit) - n + 1))]


def padded(word: str) -> str:
    return f" {word} "


def _quota(labelled: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` rows of each language, chosen by the hash of the id; all of a language that has fewer."""
    sizes = kept(labelled.groupBy("lang").agg(F.count("*").alias("_all")), "languages")
    share = F.lit(float(1 << 30)) * F.least(F.lit(1.0), F.lit(float(sample)) / F.col("_all"))
    return labelled.join(sizes, "lang").where(F.pmod(F.xxhash64(F.lit(9), F.col("doc_id")), F.lit(1 << 30)) < share).drop("_all")


def fit(docs: DataFrame, orders: tuple[int, ...] = (5, 4, 3, 2, 1), sample: int = 5_000, units: int = 7_500, least: int = 2) -> Model:
    """Count words and n-grams by language over the labelled rows given.

    Bounds of the model, as for any classifier here: about ``sample`` labelled documents of each language, chosen by
    hash, and of each order as many units as ``units`` for each language, those that are most frequent in some language
    by their share of it. Rows without text or lang are left out. Counts are shares of a language, so a common one is no
    likelier than a rare one.
    """
    labelled = _quota(docs.where("lang is not null and text is not null").select("doc_id", "text", "lang"), sample)

    def count(batches):
        held: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(texts(batch), batch.column("lang").to_pylist()):
                held.setdefault(lang, Counter()).update(words_of(text.lower()))
        for lang, words in held.items():
            tables = {0: words}
            for n in orders:
                tables[n] = Counter()
                for w, c in words.items():
                    for g in grams(padded(w), n):
                        tables[n][g] += c
            for n, table in tables.items():
                names = list(table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names)), pa.array([n] * len(names), pa.int32()), pa.array(names, pa.string()), pa.array([table[u] for u in names], pa.int64())],
                    ["lang", "level", "unit", "n"],
                )

    counted = labelled.mapInArrow(lean(count), "lang string, level int, unit string, n long").groupBy("lang", "level", "unit").agg(F.sum("n").alias("n"))
    counted = kept(counted, "units")
    totals: dict[tuple[str, int], int] = {(r.lang, r.level): r.n for r in counted.groupBy("lang", "level").agg(F.sum("n").alias("n")).collect()}
    languages = sorted({lang for lang, _ in totals})
    tables: dict[int, dict[str, np.ndarray]] = {}
    floors: dict[int, np.ndarray] = {}
    sizes = kept(counted.groupBy("lang", "level").agg(F.sum("n").alias("whole")), "sizes")
    for level in (0, *orders):
        shares = counted.where((F.col("level") == level) & (F.col("n") >= least)).join(sizes, ["lang", "level"]).withColumn("share", F.col("n") / F.col("whole"))
        by_unit = shares.groupBy("unit").agg(F.max("share").alias("best"), F.collect_list(F.struct("lang", "n")).alias("by"))
        rows = by_unit.orderBy(F.desc("best"), "unit").limit(units * len(languages)).collect()  # the model's size
        size = np.array([max(1, totals.get((lang, level), 0)) for lang in languages], float)
        # One floor for all, or a language of few texts would seem likelier wherever nothing is known.
        least_share = 0.5 / size.max() if len(size) else 1.0
        floors[level] = np.log(np.full(len(languages), least_share))
        table = tables[level] = {}
        for r in rows:
            n = np.zeros(len(languages))
            for x in r.by:
                n[languages.index(x.lang)] = x.n
            table[r.unit] = np.log(np.maximum(n / size, least_share))
    return Model(languages, tables, floors, orders)


class Rows:
    """Numbered rows of scores by name, kept until there are too many."""

    def __init__(self, width: int, kept: int):
        self.width, self.kept = width, kept
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.table = np.zeros((1024, self.width))

    def add(self, rows: np.ndarray, names: list[str]) -> None:
        start = len(self.ids)
        while start + len(names) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[start : start + len(names)] = rows
        self.ids.update(zip(names, range(start, start + len(names))))


class Scorer:
    """Scores of words and of n-grams of the longest order, kept for those met."""

    def __init__(self, model: Model):
        self.model = model
        self.words = Rows(len(model.languages), CACHED_WORDS)
        self.grams = Rows(len(model.languages), CACHED_WORDS)
        self.met = [dict(model.tables[n]) for n in model.orders[1:]]

    def unit(self, unit: str, level: int) -> np.ndarray:
        """Log frequencies of an n-gram; an unknown one takes the mean of the shorter ones in it."""
        n, orders = self.model.orders[level], self.model.orders
        met = self.met[level - 1] if level else self.model.tables[n]
        found = met.get(unit)
        if found is None and level + 1 == len(orders):
            found = self.model.floors[n]
        if found is None:
            parts = [self.unit(p, level + 1) for p in grams(unit, orders[level + 1])]
            found = sum(parts) / len(parts)
            if level:
                met[unit] = found
        return found

    def _learn(self, words: list[str]) -> None:
        """Score words that are new here: from the model if it has them, else by the mean of their n-grams."""
        known, n, ids = self.model.tables[0], self.model.orders[0], self.grams.ids
        if have := [w for w in words if w in known]:
            self.words.add(np.array([known[w] for w in have]), have)
        unseen = [w for w in words if w not in known]
        if not unseen:
            return
        if len(ids) > self.grams.kept:
            self.grams.clear()
            self.met = [dict(self.model.tables[n]) for n in self.model.orders[1:]]
            ids = self.grams.ids
        cut = [grams(padded(w), n) for w in unseen]
        new = [g for g in dict.fromkeys(g for c in cut for g in c) if g not in ids]
        if new:
            self.grams.add(np.array([self.unit(g, 0) for g in new]), new)
        rows = self.grams.table[[ids[g] for c in cut for g in c]]
        sizes = np.array([len(c) for c in cut])
        self.words.add(np.add.reduceat(rows, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None], unseen)

    def sums(self, words: list[str]) -> np.ndarray:
        """Summed log frequencies of the words, by language."""
        if len(self.words.ids) > self.words.kept:
            self.words.clear()
        ids = list(map(self.words.ids.get, words))
        if None in ids:
            self._learn(list(dict.fromkeys(w for w, i in zip(words, ids) if i is None)))
            ids = list(map(self.words.ids.get, words))
        return self.words.table[ids].sum(axis=0)


def judge(model: Model, scorer: Scorer, text: str) -> tuple[str, float]:
    """The likeliest language and its share against the others, from the mean over at most 20 words' weight.

    `und` and 0 where there is no letter or the model knows no language. Ties go to the language first in order.
    """
    words = words_of(text.lower())
    if not words or not model.languages:
        return "und", 0.0
    logs = scorer.sums(words) / len(words) * min(len(words), 20)
    shares = np.exp(logs - logs.max())
    return model.languages[int(shares.argmax())], float(shares.max() / shares.sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row; see ``judge``. Null text has no letter. Other columns are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by ``units`` of each order and language

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch):
                named, scores = zip(*(judge(shared.value, scorer, t) for t in texts(part)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(named, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, **bounds) -> DataFrame:
    """Learn from the documents' own ``lang`` outside the held-out fold and predict all of them.

    doc_id, held_out, lang_pred, score; one row per row. Without labelled rows every prediction is `und`.
    """
    model = fit(docs.where(fold(F.col("doc_id")) != 0), **bounds)
    return predict(docs, model).select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least_score: float = 0.5, **bounds) -> DataFrame:
    """The documents whose language is recognised with at least ``least_score``, all columns as they came.

    Documents without any letter go, and those that no language fits clearly; if nothing is labelled, only the former.
    """
    model = fit(docs.where(fold(F.col("doc_id")) != 0), **bounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch):
                if shared.value.languages:
                    keep = [score >= least_score for _, score in (judge(shared.value, scorer, t) for t in texts(part))]
                else:
                    keep = [bool(_WORD.search(t)) for t in texts(part)]
                yield part.filter(pa.array(keep, pa.bool_()))

    inner = docs.toDF(*["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    return inner.mapInArrow(lean(run), inner.schema).toDF(*docs.columns)
