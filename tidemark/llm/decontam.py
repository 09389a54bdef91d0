"""Benchmark passages in documents, also with other numbers, names and units.

Texts become templates: numbers, units and capitalised words inside a sentence turn into typed placeholders, other
words are lower-cased, punctuation goes. Windows of template words are hashed and hash-joined with the benchmark's.
A window of hardly any plain words, such as a row of numbers, is no template: it only matches as it stands. Matches on
one diagonal (document place minus item place) belong together, and so do those on diagonals near to each other, as words
put in or left out move the rest. There the values in slots decide: values must meet one to one, one benchmark value
always the same value in the document and the other way round, or the windows where they have changed do not count. What
counts must be enough of the item's windows, or a passage of 13 words or so as it stands.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, lean, slices, texts

_TOKEN = re.compile(r"[.!?:\n]|[^\W\d_]+|\d+(?:[.,]\d+)*|[%€$£°]")
# Scripts without spaces: each letter counts as a word.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]")
_LETTERS = re.compile(rf"[.!?:\n]|(?=[^\W\d_]){_UNSPACED.pattern}|(?:(?!{_UNSPACED.pattern})[^\W\d_])+|\d+(?:[.,]\d+)*|[%€$£°]")
# Units of measure and currency that count as one kind of slot.
UNITS = frozenset(
    "% € $ £ ° mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound "
    "pounds ounce ounces ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years mph kmh hz khz mhz ghz w kw v volt volts watt watts dollar dollars euro euros cent cents percent"
    .split()
)
MARK, WORD, NAME, NUMBER, UNIT = range(5)
SLOTS = {NAME: "<name>", NUMBER: "<number>", UNIT: "<unit>"}
#: Bits of the filter that goes before the join; its size does not depend on the benchmark's.
FILTER_BITS = 1 << 22
CACHED_WORDS = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _digest(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 7)


class Templates:
    """Texts as arrays of template words' hashes; words' kinds and hashes are kept for those met."""

    def __init__(self):
        self.slot = {k: np.uint64(_digest(v)) for k, v in SLOTS.items()}
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.names: list[str] = []
        self.kind_table, self.hash_table, self.literal_table = np.zeros(1024, np.int8), np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)

    def _learn(self, token: str) -> int:
        low = token.lower()
        if token in ".!?:\n":
            kind = MARK
        elif token[0].isdecimal():
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = NAME if len(token) > 1 and token[0].isupper() and token[1:].islower() else WORD
        at = self.ids[token] = len(self.names)
        if at == len(self.kind_table):
            self.kind_table, self.hash_table, self.literal_table = (np.concatenate([t, np.zeros_like(t)]) for t in (self.kind_table, self.hash_table, self.literal_table))
        self.names.append(low)
        self.literal_table[at] = own = _digest(low)
        self.kind_table[at], self.hash_table[at] = kind, self.slot[kind] if kind in (NUMBER, UNIT) else own
        return at

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words' numbers, kinds with names only inside sentences, hashes with names as slots, hashes without).

        The hashes of the words as they stand are ``literal_table[ids]``.
        """
        if len(self.names) > CACHED_WORDS:
            self.clear()
        tokens = (_LETTERS if not text.isascii() and _UNSPACED.search(text) else _TOKEN).findall(text)
        found = list(map(self.ids.get, tokens))
        if None in found:
            found = [self.ids[t] if t in self.ids else self._learn(t) for t in tokens]
        ids = np.array(found, np.int64)
        kinds = self.kind_table[ids]
        starts = np.ones(len(ids), bool)
        starts[1:] = kinds[:-1] == MARK
        kinds[starts & (kinds == NAME)] = WORD
        keep = kinds != MARK
        ids, kinds = ids[keep], kinds[keep]
        plain = self.hash_table[ids]
        return ids, kinds, np.where(kinds == NAME, self.slot[NAME], plain), plain

    def slots(self, ids: np.ndarray, kinds: np.ndarray, named: bool | None) -> list[str]:
        """kind:value of each slot among the words given; names only where they are slots, None: none is."""
        if named is None:
            return []
        return [f"{k}:{self.names[i]}" for i, k in zip(ids.tolist(), kinds.tolist()) if k != WORD and (named or k != NAME)]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` template words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + hashes[k : k + n]
    return out ^ (out >> np.uint64(29))


_WINDOW = "hash long, place long, size int, slots array<string>"


def _emit(names: list[str], columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


#: Of eight words in a window so many must be no slots.
PLAIN = 3
_AS_IT_STANDS = np.uint64(0x5851F42D4C957F2D)


def _ways(kinds: np.ndarray, named: np.ndarray, plain: np.ndarray, literal: np.ndarray, size: int) -> list[tuple[bool | None, np.ndarray, np.ndarray]]:
    """(names are slots or not, None: nothing is; places, hashes by place) of the windows.

    First those with names as slots, then those that differ with names as words, each with enough plain words; of the
    rest, as it stands.
    """
    if len(kinds) < size:
        return []
    need = max(2, size * PLAIN // 8)

    def words(which: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(which)])
        return upto[size:] - upto[:-size]

    first, bare = windows(named, size), words(kinds == WORD) >= need
    out = [(True, np.flatnonzero(bare), first)]
    spoken = bare
    if (kinds == NAME).any():
        second, spoken = windows(plain, size), words((kinds == WORD) | (kinds == NAME)) >= need
        out.append((False, np.flatnonzero((first != second) & spoken), second))
    if not spoken.all():
        out.append((None, np.flatnonzero(~spoken), windows(literal, size) ^ _AS_IT_STANDS))
    return out


def benchmark_windows(benchmark: DataFrame, size: int, least: int) -> DataFrame:
    """item_id, hash, place, size, slots; an item shorter than ``size`` words, and of ``least`` at least, is one window."""

    def run(batches):
        cut = Templates()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for item, text in zip(batch.column("item_id").to_pylist(), texts(batch)):
                ids, kinds, named, plain = cut.of(text)
                own = min(size, len(ids))
                if item is None or own < least:
                    continue
                for as_slots, places, hashes in _ways(kinds, named, plain, cut.literal_table[ids], own):
                    for at, h in zip(places.tolist(), hashes[places].view(np.int64).tolist()):
                        for column, v in zip(out, (item, h, at, own, cut.slots(ids[at : at + own], kinds[at : at + own], as_slots))):
                            column.append(v)
            yield _emit(["item_id", "hash", "place", "size", "slots"], out)

    return benchmark.select("item_id", "text").mapInArrow(lean(run), "item_id long, " + _WINDOW)


def document_windows(docs: DataFrame, wanted: bytes, sizes: list[int]) -> DataFrame:
    """doc_id, hash, place, size, slots of the windows whose hash may be in the benchmark, by the filter ``wanted``."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)  # FILTER_BITS / 8 bytes

    def run(batches):
        cut, bits = Templates(), np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in slices(batch):
                out: list[list] = [[], [], [], [], []]
                for doc, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                    ids, kinds, named, plain = cut.of(text)
                    literal = cut.literal_table[ids]
                    for size in sizes:
                        for as_slots, places, hashes in _ways(kinds, named, plain, literal, size):
                            own = hashes[places]
                            low = (own & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                            hit = np.flatnonzero(bits[low >> 3] >> (low & 7).astype(np.uint8) & 1)
                            for at, h in zip(places[hit].tolist(), own[hit].view(np.int64).tolist()):
                                for column, v in zip(out, (doc, h, at, size, cut.slots(ids[at : at + size], kinds[at : at + size], as_slots))):
                                    column.append(v)
                yield _emit(["doc_id", "hash", "place", "size", "slots"], out)

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, " + _WINDOW)


def contaminations(docs: DataFrame, benchmark: DataFrame, size: int = 8, share: float = 0.5, least: int = 5, passage: int = 6) -> DataFrame:
    """One row per (doc_id, item_id) where the document holds the item.

    matched and windows: different windows of the item found on the best diagonal, or on diagonals at most ``size`` and
    half of the item's windows apart from the next, and all it has; changed: slots whose value differs (0 for a plain
    copy). A window does not count if a value in it has changed that meets several values there, or whose new value does.
    Needed are ``share`` of
    the item's windows, or ``passage`` windows with nothing changed. Items below ``least`` template words are not looked
    for, as they stand in any text; null and empty texts hold nothing; repeated rows count once; rows without id have
    none to be named by. Other columns are not looked at.
    """
    items = checkpointed(benchmark_windows(benchmark, size, least).distinct())
    low = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = items.select(F.shiftright(low, 5).alias("at"), F.expr("1L << cast(hash & 31 as int)").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    wanted = np.zeros(FILTER_BITS // 32, "<u4")
    for r in words.collect():  # FILTER_BITS / 32 rows at most
        wanted[r.at] = r.bits
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # 1 to ``size``
    found = document_windows(docs.where("doc_id is not null and text is not null"), wanted.tobytes(), sizes)
    whole = items.groupBy("item_id").agg(F.count_distinct("place").alias("windows"))
    there = items.join(whole, "item_id").select("item_id", "hash", "size", "windows", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    matches = found.join(there, ["hash", "size"]).select("doc_id", "item_id", "windows", "item_place", (F.col("place") - F.col("item_place")).alias("shift"), "slots", "item_slots")
    matches = checkpointed(matches.distinct())
    order = Window.partitionBy("doc_id", "item_id").orderBy("shift")  # an item's diagonals in one document
    apart = F.col("shift") - F.lag("shift").over(order) > F.least(F.lit(size), F.floor(F.col("windows") / 2))
    near = matches.select("doc_id", "item_id", "windows", "shift").distinct().withColumn("first", F.when(F.coalesce(apart, F.lit(True)), F.col("shift")))
    near = near.select("doc_id", "item_id", "shift", F.max("first").over(order).alias("near"))
    group = ["doc_id", "item_id", "wide", "at"]
    ways = F.inline(F.array(F.struct(F.lit(False).alias("wide"), F.col("shift").alias("at")), F.struct(F.lit(True).alias("wide"), F.col("near").alias("at"))))
    placed = matches.join(near, ["doc_id", "item_id", "shift"]).select("doc_id", "item_id", "windows", "item_place", F.arrays_zip("slots", "item_slots").alias("met"), ways)
    met = placed.select(*group, F.explode("met").alias("x")).select(*group, F.col("x.item_slots").alias("a"), F.col("x.slots").alias("b"))
    several = lambda one, other: met.groupBy(*group, one).agg(F.min(other).alias("low"), F.max(other).alias("high")).where("low <> high").select(*group, F.lit(one).alias("side"), F.col(one).alias("value"))
    mixed = several("a", "b").union(several("b", "a")).groupBy(*group).agg(  # an item's own slots, and what they meet
        F.collect_list(F.when(F.col("side") == "a", F.col("value"))).alias("mixed_a"), F.collect_list(F.when(F.col("side") == "b", F.col("value"))).alias("mixed_b")
    )
    changed = F.filter("met", lambda x: x["slots"] != x["item_slots"])
    altered, into = F.transform(changed, lambda x: x["item_slots"]), F.transform(changed, lambda x: x["slots"])
    none = F.array().cast("array<string>")
    counted = placed.join(mixed, group, "left").select(*group, "windows", "item_place", altered.alias("altered"), into.alias("into"), F.coalesce("mixed_a", none).alias("mixed_a"), F.coalesce("mixed_b", none).alias("mixed_b"))
    counted = counted.where(~F.arrays_overlap("altered", "mixed_a") & ~F.arrays_overlap("into", "mixed_b"))
    told = counted.groupBy(*group).agg(
        F.count_distinct("item_place").alias("matched"),
        F.count_distinct(F.when(F.size("altered") == 0, F.col("item_place"))).alias("same"),
        F.max("windows").alias("windows"),
        F.size(F.array_distinct(F.flatten(F.collect_set("altered")))).alias("changed"),
    )
    told = told.where((F.col("matched") >= F.greatest(F.lit(1), F.ceil(F.col("windows") * share))) | (F.col("same") >= passage))
    best = F.max(F.struct("matched", (-F.col("changed")).cast("long").alias("same"), "windows")).alias("x")
    return told.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.matched", "x.windows", (-F.col("x.same")).alias("changed"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they came, whatever their names; those without doc_id stay."""
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    gone = contaminations(docs.select("doc_id", "text"), benchmark, **how).select(F.col("doc_id").alias("gone")).distinct()
    return inner.join(gone, F.col(f"c{docs.columns.index('doc_id')}") == F.col("gone"), "left_anti").toDF(*docs.columns)
