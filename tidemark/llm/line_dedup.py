"""Fuzzy line deduplication: MinHash of character shingles, banding, exact verification, components.

Lines are compared in lower case with runs of other characters than letters and digits as one space; a line without any
is compared as it stands, without the white space around it. Blank lines are left alone. Equal lines are one class,
named by a 64-bit hash. A line's shingles are the windows of ``WIDTH`` characters at every position, a shorter line's the
whole line. Lines of some length get a one-permutation MinHash: the shingles' hashes fall into bins, the least of each
bin counts, and an empty bin borrows from the next. In short lines too many bins would be empty, so they get one
permutation per value; lines about the border get both, so that similar lines always have one kind in common. Bands of
values are keys, and classes that share a key are candidates. Candidates are verified by the exact Jaccard similarity of
their shingle sets, verified links are united by star contraction, and of every component the line that comes first
(by doc_id, then place) stays.

Large groups are never expanded into pairs: a bucket's classes are compared with its first and its last class, and then
only those with each other that these links have not united. Before texts are fetched, sketches of two bits per value are
compared, which leaves out nearly all that meet by chance. Before pairs get their texts they must pass an exact bound: each
shingle flips one of 64 times ``WORDS`` bits, and the sets of two lines differ in no fewer shingles than these bits.

Signatures and shingle sets are computed with numpy over whole batches of lines: one row per character, as DataFrame
functions alone need it, took more than three times the CPU time and disk that there is (figures in the README).
Everything else is joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, likely, slices, texts
from tidemark.llm.graph import components
from tidemark.llm.ranks import kept

#: Characters of a shingle.
WIDTH = 5
#: By arithmetic, pairs of similarity 0.8 share no band's key in 1 of 200 cases, of 0.85 in 1 of 1,600.
BANDS, ROWS = 10, 4
BINS = BANDS * ROWS
#: Different shingles from which on a line has a one-permutation signature, and below which it has the other one; at
#: similarity 0.8 the smaller of two sets has four fifths of the larger one's size or more.
LONG, SHORT = 100, 125
#: Characters that are hashed at once; a longer line is taken in pieces.
CHARS = 1_000_000
_HASH_BITS = 44
_LOW = np.uint64((1 << _HASH_BITS) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PAD = WIDTH - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


_WORD, _POINT = np.uint32(1 << 24), np.uint32((1 << 24) - 1)


def _kinds(points: Iterable[int]) -> np.ndarray:
    """Of each code point: the first character of its lower case, and the bit ``_WORD`` if it is a letter or digit."""
    return np.array([ord(chr(c).lower()[0]) | (int(_WORD) if chr(c).isalnum() else 0) for c in points], np.uint32)


@lru_cache(1)
def _table() -> np.ndarray:
    return _kinds(range(1 << 16))


class Lines:
    """The lines of some texts in normal form, as one array of code points.

    ``codes`` holds the lines that have letters or digits, each followed by ``_PAD`` zeros; ``lengths`` are theirs.
    ``owner`` and ``pos`` tell the text and the place of each, then those of the lines in ``bare``: lines that are not
    blank and have none, without the white space around them.
    """

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = _table()[np.minimum(codes, 0xFFFF)]
        beyond = np.flatnonzero(codes > 0xFFFF)
        if len(beyond):
            found, back = np.unique(codes[beyond], return_inverse=True)
            points[beyond] = _kinds(found.tolist())[back]
        word = points >= _WORD
        points &= _POINT
        ends = np.flatnonzero(codes == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        # Of a run of other characters one space is left, where words of the same line stand before and behind it.
        heads = np.flatnonzero(begins)
        many = np.diff(np.searchsorted(heads, np.append(starts, len(codes))))
        worded = many > 0
        inner = np.ones(len(heads), bool)
        inner[(np.cumsum(many) - many)[worded]] = False
        spaces = heads[inner] - 1
        word[spaces] = True
        points[spaces] = 32
        numbers = np.flatnonzero(worded)
        self.lengths = np.add.reduceat(word, starts, dtype=np.int64)[numbers]
        self.codes = np.zeros(int(self.lengths.sum()) + _PAD * len(numbers), np.uint32)
        filled = np.ones(len(self.codes), bool)
        tails = np.cumsum(self.lengths + _PAD)
        for k in range(1, _PAD + 1):
            filled[tails - k] = False
        self.codes[filled] = points[word]
        others = [(k, joined[starts[k] : ends[k]].strip()) for k in np.flatnonzero(~worded & (ends > starts)).tolist()]
        self.bare = [line for _, line in others if line]
        numbers = np.concatenate([numbers, np.array([k for k, line in others if line], np.int64)])
        first = np.concatenate([[0], np.cumsum([t.count("\n") + 1 for t in texts])])
        self.owner = np.searchsorted(first, numbers, side="right") - 1
        self.pos = numbers - first[self.owner]

    def texts(self) -> list[str]:
        """The normal forms, first those with letters or digits."""
        whole = self.codes.tobytes().decode("utf-32-le", "surrogatepass")
        ends = np.cumsum(self.lengths + _PAD) - _PAD
        return [whole[a:b] for a, b in zip((ends - self.lengths).tolist(), ends.tolist())] + self.bare


def normal_lines(text: str) -> list[tuple[int, str, bool]]:
    """(place, normal form, whether it has letters or digits) of every line of the text that is not blank."""
    lines = Lines([text])
    n = len(lines.lengths)
    return sorted((pos, line, i < n) for i, (pos, line) in enumerate(zip(lines.pos.tolist(), lines.texts())))


def _coded(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(("\0" * _PAD).join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.fromiter(map(len, lines), np.int64, len(lines))


def window_hashes(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line's index, hash) of all windows of lines that stand in ``codes``, each followed by ``_PAD`` zeros."""
    n = len(codes) - _PAD
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    wide = codes.astype(np.uint64)
    hashes = wide[:n].copy()
    for k in range(1, WIDTH):
        hashes *= _BASE
        hashes += wide[k : k + n]
    # Of a line and its zeros the last windows reach into the zeros; a short line keeps its first one.
    spans = lengths + _PAD
    counts = np.maximum(lengths - _PAD, 1)
    ends = np.cumsum(spans)
    keep = np.ones(ends[-1], bool)
    outside = np.repeat(ends - spans + counts, spans - counts)
    inner = np.arange(len(outside)) - np.repeat(np.cumsum(spans - counts) - (spans - counts), spans - counts)
    keep[outside + inner] = False
    return np.repeat(np.arange(len(lengths)), counts), _mixed(hashes[keep[:n]])


def _numbered(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    index, hashes = window_hashes(codes, lengths)
    return _distinct((index.astype(np.uint64) << np.uint64(_HASH_BITS)) | (hashes >> np.uint64(64 - _HASH_BITS)))


def shingles(lines: list[str]) -> np.ndarray:
    """Sorted distinct numbers, a line's index above ``_HASH_BITS`` bits of a shingle's hash."""
    return _numbered(*_coded(lines))


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def shingles_of_long(line: str) -> np.ndarray:
    """``shingles`` of one line of any length, with memory by its different shingles."""
    found = np.zeros(0, np.uint64)
    for at in range(0, max(1, len(line) - WIDTH + 1), CHARS):
        found = _distinct(np.concatenate([found, shingles([line[at : at + CHARS + WIDTH - 1]])]))
    return found


def _signed(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a number for the line's windows, sorted distinct numbers as by ``shingles``, how many by line)."""
    n = len(lengths)
    index, hashes = window_hashes(codes, lengths)
    heads = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
    # Lines of the same windows, each as often, are equal or as similar as lines can be: one class.
    nodes = _mixed(np.add.reduceat(hashes, heads) + lengths.astype(np.uint64) * _BASE)
    keys = _distinct((index.astype(np.uint64) << np.uint64(_HASH_BITS)) | (hashes >> np.uint64(64 - _HASH_BITS)))
    return nodes, keys, np.bincount((keys >> np.uint64(_HASH_BITS)).astype(np.int64), minlength=n)


def _signed_long(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_signed`` for one line of any length, with memory by its different shingles."""
    n, total, found = len(codes) - _PAD, np.zeros(1, np.uint64), np.zeros(0, np.uint64)
    for at in range(0, max(1, n - _PAD), CHARS):
        part = codes[at : at + CHARS + _PAD] if at + CHARS + _PAD < n else codes[at:n]
        _, hashes = window_hashes(np.concatenate([part, np.zeros(_PAD, codes.dtype)]), np.array([len(part)]))
        total += hashes.sum(dtype=np.uint64)
        found = _distinct(np.concatenate([found, hashes >> np.uint64(64 - _HASH_BITS)]))
    return _mixed(total + np.array([n], np.uint64) * _BASE), found, np.array([len(found)])


def _stretches(codes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, codes) of stretches of lines, none of more characters than ``CHARS`` unless it is one line."""
    ends = np.cumsum(lengths + _PAD)
    start = 0
    while start < len(lengths):
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, min(int(np.searchsorted(ends, base + CHARS, side="right")), start + (1 << 18)))
        yield start, stop, codes[base : ends[stop - 1]]
        start = stop


def _one_permutation(index: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """The least hash of each bin by line; an empty bin takes the next filled one's, mixed with the distance."""
    bins = (hashes * np.uint64(BINS)) >> np.uint64(_HASH_BITS)
    place = index * BINS + bins.astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    least, filled = np.zeros(n * BINS, np.uint64), np.zeros(n * BINS, bool)
    least[place[heads]], filled[place[heads]] = hashes[heads], True
    least, filled = least.reshape(n, BINS), filled.reshape(n, BINS)
    ahead = np.where(np.concatenate([filled, filled], axis=1), np.arange(2 * BINS), 2 * BINS)
    ahead = np.minimum.accumulate(ahead[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    steps = (ahead - np.arange(BINS)).astype(np.uint64)
    return np.take_along_axis(least, ahead % BINS, axis=1) + steps * _BASE


def _permutations(hashes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The least value of each permutation by line; ``heads``: where the lines' hashes begin."""
    odd = _mixed(np.arange(1, BINS + 1, dtype=np.uint64)) | np.uint64(1)
    wide = _mixed(hashes)
    return np.stack([np.minimum.reduceat(_mixed(wide * m), heads) for m in odd], axis=1)


def _band_keys(values: np.ndarray, kind: int) -> np.ndarray:
    """One key per band: the band's number above 32 bits of a hash of its values."""
    bands = np.arange(BANDS, dtype=np.uint64) + np.uint64(kind * BANDS)
    keys = np.broadcast_to(bands, (len(values), BANDS))
    for r in range(ROWS):
        keys = _mixed(keys * _BASE + values[:, r::ROWS][:, :BANDS])
    return ((bands << np.uint64(32)) | (keys >> np.uint64(32))).view(np.int64)


def _sketch(values: np.ndarray) -> np.ndarray:
    """Two bits of each of the first 32 values as one number; of similar sets most of them agree."""
    return ((values[:, :32] & np.uint64(3)) << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64).view(np.int64)


def signatures(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, kinds, keys, sketches) of the lines.

    Kinds: bit 0 for the signature of long lines, bit 1 for that of short ones; keys: ``BANDS`` for each, one sketch too,
    one line's after the other's.
    """
    nodes, bits, flat, sketches = [], [], [], []
    for start, stop, part in _stretches(codes, lengths):
        own, keys, sizes = _signed_long(part) if stop == start + 1 and len(part) > 2 * CHARS else _signed(part, lengths[start:stop])
        hashes = keys & _LOW
        kinds = [sizes >= LONG, sizes < SHORT]
        both = kinds[0].astype(np.int64) + kinds[1]
        begin = np.cumsum(both) - both
        out, sketch = np.zeros((int(both.sum()), BANDS), np.int64), np.zeros(int(both.sum()), np.int64)
        for kind, chosen in enumerate(kinds):
            rows = np.flatnonzero(chosen)
            if not len(rows):
                continue
            mine = hashes[np.repeat(chosen, sizes)]
            if kind == 0:
                values = _one_permutation(np.repeat(np.arange(len(rows)), sizes[rows]), mine, len(rows))
            else:
                values = _permutations(mine, np.cumsum(sizes[rows]) - sizes[rows])
            at = begin[rows] + (kinds[0][rows] if kind else 0)
            out[at], sketch[at] = _band_keys(values, kind), _sketch(values)
        nodes.append(own)
        bits.append(kinds[0].astype(np.int8) + 2 * kinds[1].astype(np.int8))
        flat.append(out.ravel())
        sketches.append(sketch)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(nodes, np.uint64), join(bits, np.int8), join(flat, np.int64), join(sketches, np.int64)


def band_keys(lines: list[str]) -> list[np.ndarray]:
    """The keys of each line."""
    _, kinds, keys, _ = signatures(*_coded(lines))
    return np.split(keys, np.cumsum((kinds % 2 + kinds // 2).astype(np.int64) * BANDS)[:-1])


def similarities(left: list[str], right: list[str]) -> np.ndarray:
    """The exact Jaccard similarity of the shingle sets of each pair."""
    out, start, held = [], 0, 0
    for i in range(len(left) + 1):
        size = len(left[i]) + len(right[i]) if i < len(left) else 0
        if i > start and (i == len(left) or held + size > CHARS):
            a, b = (shingles(part) if held <= 2 * CHARS or i - start > 1 else shingles_of_long(part[0]) for part in (left[start:i], right[start:i]))
            both = np.sort(np.concatenate([a, b]))
            count = lambda keys: np.bincount((keys >> np.uint64(_HASH_BITS)).astype(np.int64), minlength=i - start)  # noqa: B023, E731
            common = count(both[1:][both[1:] == both[:-1]])
            out.append(common / (count(both) - common))
            start, held = i, 0
        held += size
    return np.concatenate(out) if out else np.zeros(0)


#: Words of the bits that a line's shingles flip.
WORDS = 8


def flipped(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(different shingles, ``WORDS`` words of bits) of each line; each shingle flips one bit."""
    sizes, words, start, held = [], [], 0, 0
    for i in range(len(lines) + 1):
        size = len(lines[i]) if i < len(lines) else 0
        if i > start and (i == len(lines) or held + size > CHARS or i - start == 4096):
            part, n = lines[start:i], i - start
            keys = shingles(part) if held <= CHARS or n > 1 else shingles_of_long(part[0])
            index = (keys >> np.uint64(_HASH_BITS)).astype(np.int64)
            bits = np.bincount(index * (64 * WORDS) + (keys & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=n * 64 * WORDS) & 1
            sizes.append(np.bincount(index, minlength=n))
            words.append(np.packbits(bits.astype(np.uint8).reshape(n, -1), axis=1).view(np.int64))
            start, held = i, 0
        held += size
    return (np.concatenate(sizes), np.concatenate(words)) if sizes else (np.zeros(0, np.int64), np.zeros((0, WORDS), np.int64))


def line_bits(sets: DataFrame) -> DataFrame:
    """place, ``size`` and words ``w0``, ``w1``, ... of lines given by their normal form ``raw``."""

    def run(batches):
        for batch in batches:
            sizes, words = flipped([raw.decode("utf-8", "surrogatepass") for raw in batch.column("raw").to_pylist()])
            columns = [batch.column("place"), pa.array(sizes), *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(WORDS))]
            yield pa.RecordBatch.from_arrays(columns, ["place", "size", *_words()])

    return sets.select("place", "raw").mapInArrow(lean(run), f"place long, size long, {', '.join(f'{w} long' for w in _words())}")


def _words() -> list[str]:
    return [f"w{i}" for i in range(WORDS)]


def _named(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_hash"), "text")


def lines_of(docs: DataFrame) -> DataFrame:
    """doc, text_hash, pos, node, kinds, keys and sketches of every line that is not blank.

    Keys are the lower 32 bits of band keys, ``signed_bands`` completes them. Rows without doc_id or text have no lines.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, 500_000):
                lines = Lines(texts(part))
                nodes, kinds, keys, sketches = signatures(lines.codes, lines.lengths)
                bare = np.array([xxhash.xxh3_64_intdigest(b.encode("utf-8", "surrogatepass"), 1) for b in lines.bare], np.uint64)
                kinds = np.concatenate([kinds, np.zeros(len(bare), np.int8)])
                ends = np.concatenate([[0], np.cumsum(kinds % 2 + kinds // 2, dtype=np.int32)]).astype(np.int32)
                taken = pa.array(lines.owner)
                columns = [part.column("doc").take(taken), part.column("text_hash").take(taken), pa.array(lines.pos, pa.int32()), pa.array(np.concatenate([nodes, bare]).view(np.int64))]
                low = keys.astype(np.uint32).view(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends * np.int32(BANDS)), pa.array(low)), pa.ListArray.from_arrays(pa.array(ends), pa.array(sketches))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(kinds), *lists], ["doc", "text_hash", "pos", "node", "kinds", "keys", "sketches"])

    return _named(docs).mapInArrow(lean(run), "doc long, text_hash long, pos int, node long, kinds byte, keys array<int>, sketches array<long>")


def signed_bands(lines: DataFrame) -> DataFrame:
    """place (the node), key and sketch of each band of the lines."""
    each = lines.select("node", "kinds", "sketches", F.posexplode("keys").alias("i", "low"))
    band = F.col("i") + F.when(F.col("kinds") == 2, BANDS).otherwise(0)
    key = F.shiftleft(band.cast("long"), 32).bitwiseOR(F.col("low").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    return each.select(F.col("node").alias("place"), key.alias("key"), F.get("sketches", F.floor(F.col("i") / BANDS).cast("int")).alias("sketch"))


def raw_lines(named: DataFrame) -> DataFrame:
    """doc, text_hash, pos and ``raw``, the normal form, of the lines that have letters or digits."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 500_000):
                lines = Lines(texts(part))
                n = len(lines.lengths)
                taken = pa.array(lines.owner[:n])
                raw = pa.array([line.encode("utf-8", "surrogatepass") for line in lines.texts()[:n]], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc").take(taken), part.column("text_hash").take(taken), pa.array(lines.pos[:n], pa.int32()), raw], ["doc", "text_hash", "pos", "raw"])

    return named.select("doc", "text_hash", "text").mapInArrow(lean(run), "doc long, text_hash long, pos int, raw binary")


def _place() -> Column:
    return F.struct("doc", "text_hash", "pos")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """place (the node) and ``raw``, the normal form, of the nodes wanted (node, place of its first line)."""
    at, both = F.xxhash64("doc", "text_hash", "pos"), F.xxhash64("doc", "text_hash")
    named = kept(wanted.select("node", "place.*").select("node", at.alias("at"), both.alias("both")), "wanted")
    some = likely(_named(docs).withColumn("both", both), "both", named.select("both"))
    rows = raw_lines(some).select(at.alias("at"), "raw")
    return kept(likely(rows, "at", named.select("at")).join(named, "at").dropDuplicates(["node"]).select(F.col("node").alias("place"), "raw"), "texts")


def _paired(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    own = lambda k: sets.select(F.col("place").alias(k), F.col("raw").alias(f"raw_{k}"))
    return pairs.join(own("a"), "a").join(own("b"), "b")


def verified_sets(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b of places whose sets ``raw`` (arrays without repeats) have at least this Jaccard similarity."""
    n_a, n_b = F.size("raw_a"), F.size("raw_b")
    both = _paired(pairs, sets).where(F.least(n_a, n_b) >= similarity * F.greatest(n_a, n_b) - 1e-9)
    common = F.size(F.array_intersect("raw_a", "raw_b"))
    return both.where(common * (1 + similarity) >= similarity * (n_a + n_b) - 1e-9).select("a", "b")


def verified_lines(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The same where ``raw`` is a line's normal form."""

    def run(batches):
        for batch in batches:
            left, right = ([raw.decode("utf-8", "surrogatepass") for raw in batch.column(c).to_pylist()] for c in ("raw_a", "raw_b"))
            alike = similarities(left, right) >= similarity - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(alike)) for c in ("a", "b")], ["a", "b"])

    return _paired(pairs, sets).mapInArrow(lean(run), "a long, b long")


#: Of the 32 cells of two sketches so many must agree: at similarity 0.8 some 27 do, and 1 pair of 10,000 has fewer.
AGREEING = 19


def _agree(a: str, b: str) -> Column:
    x = F.col(a).bitwiseXOR(F.col(b))
    differing = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return differing <= 32 - AGREEING


#: A large bucket's places are dealt to blocks of about so many.
BLOCK = 1024


def _between(together: DataFrame, found: DataFrame, near: Callable[[str, str], Column] | None) -> DataFrame:
    """a, b: the pairs within buckets, without their first and last places, that are in different components by now.

    Places of the bucket's most frequent component are never compared with each other, so a large group of near copies
    gives no pairs. The others meet all of the bucket's places, block by block.
    """
    inner = together.where("place <> first and place <> last").drop("first", "last")
    inner = inner.join(found.withColumnRenamed("node", "place"), "place", "left").withColumn("component", F.coalesce("component", "place"))
    inner = kept(inner, "inner")
    sizes = inner.groupBy("key", "component").agg(F.count("*").alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("kinds")).where("kinds > 1")
    most = kept(most.select("key", F.col("most.component").alias("most"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "most")
    split = kept(likely(inner, "key", most.select("key")).join(most, "key"), "split")
    sketch = ["sketch"] if near else []
    left = split.where("component <> most").select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("place").alias("a"), F.col("component").alias("own"), *sketch)
    right = split.select("key", F.pmod(F.xxhash64("place"), "blocks").cast("int").alias("block"), F.col("place").alias("b"), "component", "most", *[F.col(c).alias("its") for c in sketch])
    pairs = left.join(right, ["key", "block"]).where("own <> component and (a < b or component = most)")
    if near:
        pairs = pairs.where(near("sketch", "its"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _possible(pairs: DataFrame, bits: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b whose bits do not rule this similarity out: their sets differ in no fewer shingles than bits."""
    its = bits.toDF(*["b" if c == "place" else f"its_{c}" for c in bits.columns])
    both = pairs.join(bits.withColumnRenamed("place", "a"), "a").join(its, "b")
    differing = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"its_{w}"))) for w in _words()), F.lit(0))
    sizes = F.col("size") + F.col("its_size")
    # Sets of this similarity differ in sizes * (1 - similarity) / (1 + similarity) shingles at most.
    least = F.greatest(differing.cast("long"), F.abs(F.col("size") - F.col("its_size")))
    return both.where(least * (1 + similarity) <= sizes * (1 - similarity) + 1e-6).select("a", "b")


def linked(
    bands: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    similarity: float,
    verify: Callable[[DataFrame, DataFrame, float], DataFrame],
    near: Callable[[str, str], Column] | None = None,
    bits_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """node, component for the places that are linked with others; bands: place and key, rows may repeat.

    Places that share a key are a bucket. Each is compared with the bucket's first and last one, which joins large groups
    of near copies; then all pairs of a bucket that are not in one component yet are compared, so that no link within a
    bucket changes the components any more. With ``near`` bands have a ``sketch``, and pairs whose sketches are not near
    are left out first; with ``bits_of`` (as ``line_bits``) those whose bits rule the similarity out, too, which leaves
    out no link. Pairs whose sets have at least this similarity are linked. sets_of: place and ``raw`` of the places
    given, one row each; verify: the pairs a, b that are similar.
    """
    shared = bands.groupBy("key").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    shared = kept(shared, "shared")
    together = kept(likely(bands, "key", shared.select("key")).join(shared, "key").distinct(), "together")
    pairs = []
    for pivot in ("first", "last"):
        others = together.where(F.col("place") != F.col(pivot))
        if near:
            its = together.where(F.col("place") == F.col(pivot)).select("key", F.col("sketch").alias("its"))
            others = others.join(its, "key").where(near("sketch", "its"))
        pairs.append(others.select(F.least("place", pivot).alias("a"), F.greatest("place", pivot).alias("b")))
    pairs = kept(pairs[0].union(pairs[1]).distinct(), "pairs")
    places = lambda pairs: pairs.select(F.col("a").alias("place")).union(pairs.select("b")).distinct()

    def alike(pairs):
        sets = sets_of(places(pairs))
        if bits_of:
            pairs = kept(_possible(pairs, kept(bits_of(sets), "bits"), similarity), "possible")
        return kept(verify(pairs, sets, similarity), "links")

    found = kept(components(alike(pairs)), "linked")
    more = kept(_between(together, found, near).join(pairs, ["a", "b"], "left_anti"), "pairs")
    if more.isEmpty():
        return found
    links = alike(more)
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))


def duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc, text_hash and pos of the lines that repeat an earlier one nearly or wholly."""
    lines = kept(lines_of(docs), "lines")
    firsts = kept(lines.groupBy("node").agg(F.min(_place()).alias("place"), F.max(_place()).alias("last")), "firsts")
    wanted = lambda places: places.withColumnRenamed("place", "node").join(firsts.select("node", "place"), "node")
    found = kept(linked(signed_bands(lines), lambda places: _texts(docs, wanted(places)), similarity, verified_lines, near=_agree, bits_of=line_bits), "found")
    stays = found.join(firsts, "node").groupBy("component").agg(F.min(F.struct("place", "node")).alias("first"))
    gone = found.join(stays, "component").where(F.col("first.node") != F.col("node")).select("node", F.lit(True).alias("gone"))
    touched = firsts.join(gone, "node", "left").where("gone or place <> last").select("node", F.when(F.col("gone").isNull(), F.col("place")).alias("stays"))
    touched = kept(touched, "touched")
    return likely(lines.select("doc", "text_hash", "pos", "node"), "node", touched.select("node")).join(touched, "node").where(F.col("stays").isNull() | (F.col("stays") != _place())).select("doc", "text_hash", "pos")


def _without(docs: DataFrame, similarity: float) -> DataFrame:
    """Columns c0, c1, ... of the documents with the shorter text, and how many lines there were and went."""
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    both = lambda rows: rows.withColumn("both", F.xxhash64("doc", "text_hash"))
    named = both(inner.withColumns({"doc": doc.cast("long"), "text_hash": F.xxhash64(text)}))
    removed = duplicates(docs.select("doc_id", "text"), similarity).groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("gone"))  # a document's own lines
    removed = both(kept(removed, "removed"))
    # Documents that lose nothing are not moved.
    touched = likely(named, "both", removed.select("both")).join(removed.drop("both"), ["doc", "text_hash"], "left")
    same = likely(named, "both", removed.select("both"), inside=False).withColumn("gone", F.lit(None).cast("array<int>"))
    every = F.split(text, "\n", -1)
    left = F.array_join(F.filter(every, lambda line, i: ~F.array_contains("gone", i)), "\n")
    at = docs.columns.index("text")
    columns = [F.when(F.col("gone").isNull(), text).otherwise(left).alias(f"c{i}") if i == at else F.col(f"c{i}") for i in range(len(docs.columns))]
    lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(every)).cast("long").alias("lines")
    gone = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("removed")
    return touched.unionByName(same).select(*columns, lines, gone)


def dedup_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The documents, all columns as they came, with ``text`` without lines that repeat an earlier one nearly or wholly.

    Also the columns _lines and _removed, how many lines there were and went; they come last and replace columns of those
    names. Blank lines, and documents without id or text, stay as they are; null stays null and empty stays empty. Rows
    that repeat both id and text get the same result; no rows give no rows.
    """
    own = [c for c in docs.columns if c not in ("_lines", "_removed")]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    return _without(docs, similarity).toDF(*own, "_lines", "_removed")


def without_repeated_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``dedup_lines`` with the columns of ``docs`` only, whatever their names."""
    return _without(docs, similarity).drop("lines", "removed").toDF(*docs.columns)
