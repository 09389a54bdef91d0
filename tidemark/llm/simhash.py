"""SimHash fingerprints and groups of documents whose fingerprints are close, by the generalised pigeonhole principle.

Fingerprints at most ``distance`` bits apart are found by cutting the 64 bits into parts with a threshold each: if the
thresholds add up to distance - parts + 1, any such pair is within its threshold in some part. Bits that vary together
share a part, so that its few values do not weaken the others, and dynamic programming gives each part the threshold
at which the estimated number of candidates over all parts is least; a part may be left out (threshold -1).

``keep_one``, the pipeline's stage, links documents by the exact similarity of their word shingles. Candidates are those
with close fingerprints, by the same parts and thresholds, and beyond that distance those that share a MinHash band.
"""

from __future__ import annotations

import itertools
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, lean, likely, slices, texts
from tidemark.llm.decontam import windows
from tidemark.llm.graph import components
from tidemark.llm.line_dedup import linked, verified_sets

BITS = 64
#: MinHash bands of ``keep_one``: of pairs with similarity 0.8 about 3 in a million share none.
BANDS, ROWS = 24, 4
CACHED_WORDS = 400_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, shingle: int = 3) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; a text without words has fingerprint 0."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[shingle - 1 :].tolist() or [len(joined)]
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    return majority(np.array([digest(joined[a:b]) for a, b in zip(starts, ends)], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of some hashes: a bit is set if it is set in over half of them."""
    set_in = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        piece = hashes[part : part + (1 << 16)]
        set_in += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed 64-bit number. Null text counts as empty. One row per row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                prints = np.array([fingerprint(t) for t in texts(part)], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, fp long")


def bit_statistics(prints: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Share of ones of each bit, and the bits' absolute correlations, over all rows; partition sums meet by bit."""

    def run(batches):
        ones = np.zeros((BITS, BITS), np.int64)
        n = 0
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float64)
            ones += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        pairs = [*itertools.product(range(BITS), repeat=2)] if n else []
        i, j = zip(*pairs) if pairs else ((), ())
        both = ones.ravel() if n else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(both), pa.array(np.full(len(both), n))], ["i", "j", "both", "n"]
        )

    summed = prints.select("fp").mapInArrow(lean(run), "i int, j int, both long, n long").groupBy("i", "j").agg(F.sum("both").alias("both"), F.sum("n").alias("n"))
    share, count = np.full((BITS, BITS), 0.25), 0
    for r in summed.collect():  # 64 x 64 rows
        share[r.i, r.j], count = r.both / r.n, r.n
    if not count:
        return np.full(BITS, 0.5), np.eye(BITS)
    p = share.diagonal().copy()
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return p, np.abs(share - np.outer(p, p)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into parts of equal width: each part starts from the bit left and takes what correlates most."""
    left, out = set(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        part = [min(left, key=lambda b: (-max((correlation[b, c] for c in left if c != b), default=0), b))]
        left.discard(part[0])
        while len(part) < width:
            part.append(best := min(left, key=lambda b: (-sum(correlation[b, c] for c in part), b)))
            left.discard(best)
        out.append(sorted(part))
    return out


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds of least cost that add up to distance - parts + 1. costs[i][t + 1]: candidates of part i at threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for held, (cost, chosen) in best.items():
            for t in range(-1, distance + 1):
                option = (cost + part[t + 1], [*chosen, t])
                if held + t not in step or option < step[held + t]:
                    step[held + t] = option
        best = step
    return best[distance - len(costs) + 1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def value_of(fp: str, bits: list[int]) -> Column:
    """The fingerprint with all other bits cleared."""
    return F.col(fp).bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def plan(prints: DataFrame, distance: int) -> tuple[list[list[int]], list[int]]:
    """Parts and thresholds with the fewest estimated candidate pairs.

    For each number of parts the pairs that agree in a part are counted exactly over all fingerprints (equal values,
    summed by value); pairs and probes at larger thresholds follow from the bits' shares.
    """
    p, correlation = bit_statistics(prints)
    odds = np.minimum((2 * p * (1 - p)) / np.maximum(1 - 2 * p * (1 - p), 1e-9), 1.0)  # that one bit differs, to that it agrees
    layouts = [group_bits(correlation, m) for m in range(2, distance + 3)]
    flat = [(m, i, bits) for m, layout in enumerate(layouts) for i, bits in enumerate(layout)]
    tagged = prints.select(F.explode(F.array(*(F.struct(F.lit(k).alias("k"), value_of("fp", bits).alias("v")) for k, (_, _, bits) in enumerate(flat)))).alias("x"))
    sizes = tagged.groupBy("x.k", "x.v").agg(F.count("*").alias("n")).groupBy("k").agg(F.sum(F.expr("cast(n as double) * (n - 1) / 2")).alias("pairs"), F.sum("n").alias("rows"))
    seen = {r.k: (r.pairs, r.rows) for r in sizes.collect()}  # one row for each part of each layout
    best = None
    for m, layout in enumerate(layouts):
        costs = []
        for k, bits in ((k, bits) for k, (of, _, bits) in enumerate(flat) if of == m):
            pairs, rows = seen.get(k, (0.0, 1))  # without rows the fewest probes are the plan
            row = [0.0]
            for t in range(distance + 1):
                ways = [float(sum(np.prod(odds[list(c)]) for c in itertools.combinations(bits, r))) if r < 3 else 1e9 for r in range(t + 1)]
                probes = sum(_choose(len(bits), r) for r in range(t + 1))
                row.append(pairs * sum(ways) + 20.0 * rows * probes)
            costs.append(row)
        cost, thresholds = allocate(costs, distance)
        if best is None or cost < best[0]:
            best = (cost, layout, thresholds)
    return best[1], best[2]


def _choose(n: int, r: int) -> int:
    return len(list(itertools.combinations(range(n), r)))


def _flips(bits: list[int], t: int) -> list[int]:
    """Masks that change at most ``t`` of the bits, as signed numbers."""
    masks = (sum(1 << b for b in c) for r in range(t + 1) for c in itertools.combinations(bits, r))
    return [_signed(m) for m in masks]


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """a, b: all pairs a < b of the distinct fingerprints ``fp`` that differ in 1 to ``distance`` bits."""
    layout, thresholds = plan(prints, distance)
    kept = [(k, bits, t) for k, (bits, t) in enumerate(zip(layout, thresholds)) if t >= 0]
    struct = lambda k, v: F.struct(F.lit(k).alias("part"), v.alias("value"))
    index = prints.select(F.explode(F.array(*(struct(k, value_of("fp", bits)) for k, bits, _ in kept))).alias("x"), F.col("fp").alias("b"))
    probe = prints.select(
        F.explode(F.array(*(struct(k, value_of("fp", bits).bitwiseXOR(F.lit(m))) for k, bits, t in kept for m in _flips(bits, t)))).alias("x"),
        F.col("fp").alias("a"),
    )
    probe = probe.select("x.part", "x.value", "a")
    index = index.select("x.part", "x.value", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    on = (probe.part == index.part) & (probe.value == index.value) & (F.col("a") < F.col("b")) & close
    return probe.join(index, on).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, distance: int = 2) -> DataFrame:
    """doc_id, ``fp`` and ``component_id``: the smallest doc_id that is reachable by links, itself included.

    Equal fingerprints are one class, so copies are never expanded into pairs. Null and empty texts have fingerprint 0
    and link like any other. Rows that repeat a doc_id come out repeated; a null doc_id is never a component's name
    unless nothing else is in it. Other columns are not looked at; an empty table gives no rows.
    """
    prints = checkpointed(fingerprints(docs))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(classes.select("fp"), distance))
    classes = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(roots, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: str, shingle: int, known: dict[bytes, int]) -> np.ndarray:
    """The hashes of a text's different word shingles, in order; one of all words if they are fewer. known: words met."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(known) > CACHED_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w, 42)
    hashes = np.array([known[w] for w in words], dtype=np.uint64)
    return np.unique(_mixed(windows(hashes, min(shingle, len(words))))) if words else hashes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def place_of(hashes: np.ndarray) -> int:
    """One signed 64-bit number for a set of hashes."""
    total = _mixed(hashes + np.uint64(1)).sum(dtype=np.uint64, keepdims=True)
    return int(_mixed(total + np.uint64(len(hashes))).view(np.int64)[0])


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key of each band of MinHashes; sets of Jaccard similarity s share a band's key with probability s^ROWS."""
    seeds = _mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))[:, None]
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[at : at + 1024] ^ seeds) * (seeds | np.uint64(1))).min(axis=1))
    keys = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        keys = _mixed(keys + least[r::ROWS])
    return keys


def shingle_classes(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, ``place`` (a hash of the text's shingle set), its fingerprint and bands' keys; texts without words have no keys."""

    def run(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch):
                places, prints, keys = [], [], []
                for text in texts(part):
                    hashes = shingle_set(text, shingle, known)
                    places.append(place_of(hashes))
                    prints.append(_signed(majority(hashes)))
                    keys.append(band_keys(hashes).view(np.int64) if len(hashes) else [])
                columns = [part.column("doc_id"), pa.array(places, pa.int64()), pa.array(prints, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "fp", "keys"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, place long, fp long, keys array<long>")


def fingerprint_bands(classes: DataFrame, distance: int) -> DataFrame:
    """place, key and ``sketch``, the fingerprint, of classes (place, fp): within ``distance`` bits two share a key."""
    layout, thresholds = plan(classes.select("fp").distinct(), distance)
    keys = [F.xxhash64(F.lit(k), value_of("fp", bits).bitwiseXOR(F.lit(m))) for k, (bits, t) in enumerate(zip(layout, thresholds)) for m in _flips(bits, t)]
    return classes.select("place", F.explode(F.array(*keys)).alias("key"), F.col("fp").alias("sketch"))


def _shingle_sets(docs: DataFrame, places: DataFrame, named: DataFrame, shingle: int) -> DataFrame:
    """place, ``raw`` (the set) and n, one row for each of the places given; named: doc_id and place of each document."""

    def run(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, 1_000_000):
                sets = [shingle_set(t, shingle, known) for t in texts(part)]
                columns = [pa.array([place_of(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["place", "raw"])

    one = named.join(places, "place", "left_semi").groupBy("place").agg(F.min("doc_id").alias("doc_id"))
    found = likely(docs.select("doc_id", "text"), "doc_id", checkpointed(one)).select("text").mapInArrow(lean(run), "place long, raw array<long>")
    return checkpointed(found.join(places, "place", "left_semi").dropDuplicates(["place"]))


def keep_one(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, distance: int = 3) -> DataFrame:
    """The document with the smallest doc_id of each group, all columns as they came.

    Documents whose sets of ``shingle``-word shingles have at least this Jaccard similarity are linked, and groups are
    what links reach; texts that differ only in ASCII case or white space, and those without words, are equal. Every link is
    verified on the whole sets. Candidates are all pairs whose fingerprints differ in at most ``distance`` bits. At
    similarity 0.8 some 10 of the 64 bits differ, and parts that let 16 pass hold 7 of 100 pairs of random bits; so
    pairs further apart, which fingerprints would lose, are those that share a band of MinHashes. Of rows that repeat a kept doc_id one
    stays. Documents without doc_id have no group and stay.
    """
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own = F.col(f"c{docs.columns.index('doc_id')}")
    known = docs.select("doc_id", "text").where("doc_id is not null")
    rows = checkpointed(shingle_classes(known, shingle))
    named = rows.select("doc_id", "place").distinct()
    classes = checkpointed(rows.dropDuplicates(["place"]).select("place", "fp", "keys").where(F.size("keys") > 0))
    close = lambda a, b: F.coalesce(F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance, F.lit(True))
    bands = classes.select("place", F.explode("keys").alias("key"), F.lit(None).cast("long").alias("sketch"))
    bands = fingerprint_bands(classes.select("place", "fp"), distance).union(bands)
    found = linked(bands, lambda places: _shingle_sets(known, checkpointed(places), named, shingle), similarity, verified_sets, near=close)
    roots = named.join(found.withColumnRenamed("node", "place"), "place", "left").select("doc_id", F.coalesce("component", "place").alias("root"))
    chosen = roots.groupBy("root").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    one_each = inner.join(chosen, own == F.col("doc_id"), "left_semi").dropDuplicates([f"c{docs.columns.index('doc_id')}"])
    return one_each.unionByName(inner.where(own.isNull())).toDF(*docs.columns)
