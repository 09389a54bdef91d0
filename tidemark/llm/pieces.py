"""SentencePiece encoding, decoding, and distinct sampled segmentations of whole texts.

No piece of the model holds a space mark after another character, so a text falls into chunks (space marks and what
follows) that are segmented independently; each distinct chunk of a slice is encoded and given a lattice once.

Sampling is Gumbel top-k without replacement over all segmentations of the text. Every segmentation has a Gumbel-perturbed
log probability; the search goes best-first over sets of segmentations, each with the exact maximum of its perturbed
values as priority. A set is popped, its best segmentation emitted, and the rest divided in two: what leaves the emitted
one after the arc at which it left the set's own path, and what is left of the set. What leaves a path stays one set; at
which arc is drawn when it is popped, by the masses. A part's maximum is a Gumbel variable at the part's log mass, truncated
at the parent's. So the order of emission is that of the perturbed values, and no segmentation comes twice. The priority of
the first set not popped is the threshold from which inclusion probabilities follow. All draws come from the row's key.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import lean, slices, texts

MARK = "▁"
_CHUNK = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
CACHED_CHARACTERS, SLICE = 1_000_000, 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def counted(x: np.ndarray, counter) -> np.ndarray:
    """The mixed bits ``x`` mixed with a counter."""
    return mix(x + _BASE * (np.asarray(counter, np.uint64) + np.uint64(1)))


def share(x: np.ndarray) -> np.ndarray:
    """Mixed bits as numbers in (0, 1)."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


def uniform(key: np.ndarray, *counters) -> np.ndarray:
    """A number in (0, 1) for each key and counters."""
    x = mix(key)
    for c in counters:
        x = counted(x, c)
    return share(x)


def uniform_one(key: int, *counters: int) -> float:
    """The same for one key, by plain numbers."""
    full = (1 << 64) - 1

    def mixed(x: int) -> int:
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & full
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & full
        return x ^ (x >> 31)

    x = mixed(key)
    for c in counters:
        x = mixed((x + int(_BASE) * (c + 1)) & full)
    return ((x >> 12) + 0.5) / 2.0**52


class Numbers:
    """A table from 64-bit hashes to numbers of -1 or more, for whole arrays: open addressing, a quarter full at most."""

    def __init__(self, held: dict[int, int]):
        bits = (4 * len(held)).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.held = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -2, np.int32)
        for h, number in held.items():
            at = (h * int(_BASE) & (1 << 64) - 1) >> (64 - bits)
            while self.held[at] != -2:
                at = (at + 1) & self.mask
            self.keys[at], self.held[at] = h, number

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers; -2 for hashes that are not held."""
        at = ((hashes * _BASE) >> self.shift).astype(np.int32)
        found = self.held[at]
        other = np.flatnonzero((found != -2) & (self.keys[at] != hashes))
        while len(other):
            at[other] = (at[other] + 1) & self.mask
            found[other] = self.held[at[other]]
            other = other[(found[other] != -2) & (self.keys[at[other]] != hashes[other])]
        return found


class Pieces:
    """The model's pieces with their weights: a power law in the rank, as for words in text, to the power ``theta``."""

    def __init__(self, path: str, theta: float):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.get_piece_size()
        self.text = [m.id_to_piece(i) for i in range(size)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if m.is_byte(i)}
        usual = [i for i in range(size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        ranks = {i: r for r, i in enumerate(sorted(usual, key=lambda i: (-m.get_score(i), i)))}
        self.weight = np.full(size + 1, -theta * np.log(size + 2.0))
        self.weight[usual] = [-theta * np.log(ranks[i] + 2.0) for i in usual]
        self.ascii = np.array([self.byte[b] for b in range(128)], np.int64)
        self.space = m.piece_to_id(MARK)
        by_length: dict[int, dict[int, int]] = {}
        for i in usual:
            h = 0
            for n, c in enumerate(self.text[i], 1):
                h = (h * int(_BASE) + ord(c)) & (1 << 64) - 1
                by_length.setdefault(n, {}).setdefault(h, -1)
            by_length[len(self.text[i])][h] = i
        #: By length: hashes of pieces and of their beginnings, with the piece or -1.
        self.tables = [Numbers(by_length[n]) for n in range(1, max(by_length) + 1)]

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """The library's encoding of each chunk; the library puts the first mark back."""
        found = self.model.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        return [ids or [self.space] for ids in found]

    def spell(self, ids: list[int]) -> str:
        """The text of the pieces, without the space that the model puts before every text."""
        return self.model.decode(ids)


class Lattice:
    """The segmentation lattices of some chunks side by side: nodes between characters, arcs for pieces.

    A character that is no piece has one arc, for its bytes. Arcs are in order of their start; ``log_p`` is an arc's
    log probability among those from its start, from weights summed backwards over all ways to the chunk's end.
    """

    def __init__(self, pieces: Pieces, chunks: list[str]):
        self.pieces = pieces
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        self.codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes.astype(np.uint64)
        last = np.repeat(np.cumsum(lengths).astype(np.int32), lengths)  # where each character's chunk ends
        self.first = np.cumsum(lengths) - lengths
        starts, ranks, lengths, ids = [], [], [], []
        at, h = np.arange(len(codes), dtype=np.int32), np.zeros(len(codes), np.uint64)
        degree = np.zeros(len(codes), np.int32)

        def put(nodes, length, own):
            starts.append(nodes)
            ranks.append(degree[nodes])
            lengths.append(length)
            ids.append(own)
            degree[nodes] += 1

        for n, table in enumerate(pieces.tables, 1):
            inside = at + n <= last[at]
            at, h = at[inside], h[inside]
            if not len(at):
                break
            h = h * _BASE + codes[at + n - 1]
            own = table.get(h)
            known = own > -2
            at, h, own = at[known], h[known], own[known]
            whole = own >= 0
            put(at[whole], n, own[whole])
            if n == 1:  # characters that are no piece go by bytes
                other = np.flatnonzero(degree == 0)
                put(other, 1, np.where(codes[other] < 128, pieces.ascii[np.minimum(codes[other], 127).astype(np.int64)], -1))
        self.last = last
        self.ptr = np.concatenate([[0], np.cumsum(degree)]).astype(np.int32)
        self.start, self.end, self.id = np.zeros((3, self.ptr[-1]), np.int32)
        for nodes, rank, length, own in zip(starts, ranks, lengths, ids):  # in order of start, then of end
            to = self.ptr[nodes] + rank
            self.start[to], self.end[to], self.id[to] = nodes, nodes + length, own
        weight = pieces.weight[self.id]
        # backward: nodes by distance from their chunk's end
        beta = np.zeros(len(codes) + 1)
        distance = (last - np.arange(len(codes), dtype=np.int32))[self.start]
        by = np.argsort(distance.astype(np.min_scalar_type(int(distance.max()))) if len(distance) else distance, kind="stable")
        cuts = np.searchsorted(distance[by], np.arange(1, (distance.max() if len(by) else 0) + 2))
        inner = np.where(self.end == last[self.start], -1, self.end) if len(by) else self.end
        total = np.zeros(len(by))
        for a, b in zip(cuts[:-1], cuts[1:]):
            arcs = by[a:b]
            value = weight[arcs] + np.where(inner[arcs] < 0, 0.0, beta[inner[arcs]])
            heads = np.flatnonzero(np.r_[True, np.diff(self.start[arcs]) != 0])
            summed = np.logaddexp.reduceat(value, heads)
            beta[self.start[arcs[heads]]] = summed
            total[arcs] = value
        self.log_p = np.minimum(total - beta[self.start], 0.0) if len(by) else total
        p = np.exp(self.log_p)
        self.upto = p.copy()  # shares summed within a node, so that draws depend on the node's arcs alone
        degree = np.diff(self.ptr)
        nodes = np.flatnonzero(degree > 1)
        for d in range(1, int(degree.max()) if len(degree) else 0):
            at = self.ptr[nodes] + d
            self.upto[at] += self.upto[at - 1]
            nodes = nodes[degree[nodes] > d + 1]

    def log_rest(self, arcs: np.ndarray) -> np.ndarray:
        """Log probability of the other arcs from where each arc starts; a node's only arc leaves nothing."""
        node = self.start[arcs]
        rest = np.log(np.maximum(1 - np.exp(self.log_p[arcs]), 1e-300))
        return np.where(self.ptr[node + 1] - self.ptr[node] == 1, -np.inf, rest)

    def grow(self, chunks: list[str]) -> None:
        """Put the lattices of more chunks after those that are here; these stay as they are."""
        more, nodes, arcs = Lattice(self.pieces, chunks), len(self.codes), len(self.start)
        for name, by in (("codes", 0), ("last", nodes), ("first", nodes), ("start", nodes), ("end", nodes), ("id", 0), ("log_p", 0), ("upto", 0)):
            own = getattr(more, name)
            setattr(self, name, np.concatenate([getattr(self, name), own + own.dtype.type(by) if by else own]))
        self.ptr = np.concatenate([self.ptr[:-1], more.ptr + np.int32(arcs)])

    def step(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An arc from each node, drawn by ``u``."""
        arc, last = self.ptr[node], self.ptr[node + 1] - 1
        beyond = np.flatnonzero((arc < last) & (self.upto[arc] <= u))
        while len(beyond):
            arc[beyond] += 1
            now = arc[beyond]
            beyond = beyond[(now < last[beyond]) & (self.upto[now] <= u[beyond])]
        return arc

    def walk(self, node: np.ndarray, key: np.ndarray, place: np.ndarray, path: int) -> tuple[np.ndarray, np.ndarray]:
        """(arcs, how many of each): a way drawn from each node to its chunk's end; ``place``: the chunk's in its text."""
        alive, count = np.arange(len(node)), np.zeros(len(node), np.int64)
        bits = counted(counted(mix(key), path), place)
        steps = []
        while len(alive):
            arc = self.step(node, share(counted(bits, len(steps))))
            steps.append((alive, arc))
            node = self.end[arc]
            going = node != self.last[self.start[arc]]
            count[alive] += 1
            alive, node, bits = alive[going], node[going], bits[going]
        out = np.zeros(count.sum(), np.int64)
        first = np.cumsum(count) - count
        for n, (who, arc) in enumerate(steps):
            out[first[who] + n] = arc
        return out, count

    def ids(self, arcs: np.ndarray) -> np.ndarray:
        """The arcs' piece numbers; bytes for characters that are no piece."""
        ids = self.id[arcs]
        if (ids >= 0).all():
            return ids
        out: list[int] = []
        for i, a in zip(ids.tolist(), arcs.tolist()):
            out += [i] if i >= 0 else [self.pieces.byte[b] for b in chr(int(self.codes[self.start[a]])).encode("utf-8", "surrogatepass")]
        return np.array(out, np.int64)


class Search:
    """Gumbel top-k for one text: paths emitted so far, and of each the open set of segmentations that leave it."""

    def __init__(self, lattice: Lattice, key: int):
        self.lattice, self.key = lattice, key
        self.paths: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []  # arcs of each chunk
        self.values: list[float] = []
        self.log_p: list[float] = []
        self.before: list[np.ndarray] = []
        self.mass: list[np.ndarray] = []  # log mass of what leaves the path at each arc
        self.open: list[float] = []  # priorities
        self.left_out: dict[tuple[int, int], list[int]] = {}

    def emit(self, path: np.ndarray, counts: np.ndarray, value: float, since: int, own: np.ndarray, rest: np.ndarray) -> None:
        """Take a path, with its arcs' log p and ``log_rest``; its set begins at the arc after place ``since``."""
        before = np.cumsum(own) - own
        mass = before + rest
        mass[: since + 1] = -np.inf
        self.paths.append(path)
        self.counts.append(counts)
        self.values.append(value)
        self.log_p.append(float(own.sum()))
        self.before.append(before)
        self.mass.append(mass)
        self.open.append(self.priority(len(self.paths) - 1, value, 1000 + len(self.paths)))

    def priority(self, r: int, bound: float, draw: int) -> float:
        """A draw of the greatest perturbed value in the set of path r: Gumbel at its log mass, at most ``bound``."""
        most = self.mass[r].max(initial=-np.inf)
        if most == -np.inf:
            return -np.inf
        total = float(most) + math.log(np.exp(self.mass[r] - most).sum())
        return total - math.log(math.exp(min(total - bound, 700.0)) - math.log(uniform_one(self.key, draw, r)))

    def best(self) -> tuple[float, int]:
        """(priority, path) of the open set that comes next; -inf if there is none."""
        return max(zip(self.open, range(len(self.open))), default=(-np.inf, -1))

    def leave(self, value: float, r: int) -> tuple[int, int]:
        """(place, arc) at which a new path leaves path r; what is left of the set keeps a priority."""
        lat, n, mass = self.lattice, len(self.paths), self.mass[r]
        chances = np.exp(mass - mass.max()).cumsum()
        j = int(np.searchsorted(chances, uniform_one(self.key, 2000 + n, 0) * chances[-1], side="right"))
        own = int(self.paths[r][j])
        low, high = (int(x) for x in lat.ptr[lat.start[own] : lat.start[own] + 2])
        out = self.left_out.setdefault((r, j), [own])
        logs = lat.log_p[low:high].copy()
        logs[[a - low for a in out]] = -np.inf
        chances = np.exp(logs - logs.max()).cumsum()
        at = int(np.searchsorted(chances, uniform_one(self.key, 2000 + n, 1) * chances[-1], side="right"))
        out.append(low + at)
        logs[at] = -np.inf
        mass[j] = self.before[r][j] + np.logaddexp.reduce(logs)
        self.open[r] = self.priority(r, value, 3000 + n)
        return j, low + at


class Chunks:
    """Encodings and lattices of the chunks met, kept until they hold too many characters."""

    def __init__(self, pieces: Pieces, kept: int = CACHED_CHARACTERS):
        self.pieces, self.kept = pieces, kept
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.lattice = Lattice(self.pieces, [])
        self.size = self.first = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def take(self, rows: list[list[str]]) -> list[np.ndarray]:
        """The rows' chunks by number; new ones are encoded and given a lattice."""
        if len(self.lattice.codes) > self.kept:
            self.clear()
        new = list(dict.fromkeys(filterfalse(self.number.__contains__, chain.from_iterable(rows))))
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            best = self.pieces.encode(new)
            size = np.fromiter(map(len, best), np.int64, len(best))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(best), np.int32, int(size.sum()))])
            self.lattice.grow(new)
        return [np.fromiter(map(self.number.__getitem__, r), np.int64, len(r)) for r in rows]

    def encoded(self, row: np.ndarray) -> np.ndarray:
        n = self.size[row]
        return self.flat[np.repeat(self.first[row] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def sample(lattice: Lattice, rows: list[np.ndarray], keys: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each row (numbers of its chunks): up to k segmentations (arcs, log p, perturbed log p, inclusion probability)."""
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    key = np.repeat(keys, sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bounds = np.r_[0, np.cumsum(sizes)]
    searches = [Search(lattice, int(x)) for x in keys]
    for n in range(k):
        going = []  # what each search leaves: path and place, the arc taken, the chunk's number and its arcs so far
        nodes, walked = [], []  # where ways are drawn from, and for which occurrences of chunks
        for s, a, b in zip(searches, bounds[:-1].tolist(), bounds[1:].tolist()):
            if n == 0:
                going.append((s, -math.log(-math.log(uniform_one(s.key, 999))), -1, -1, -1, 0, 0, b - a))
                nodes.append(lattice.first[flat[a:b]])
                walked.append(np.arange(a, b))
                continue
            value, r = s.best()
            if value == -np.inf:
                continue
            j, arc = s.leave(value, r)
            upto = np.cumsum(s.counts[r])
            chunk = int(np.searchsorted(upto, j, side="right"))
            head = lattice.end[arc : arc + 1]  # the way to the end of the chunk that was left, if that is not there yet
            head = head[head != lattice.last[lattice.start[arc]]]
            more = a + chunk + 1 - len(head)
            nodes += [head, lattice.first[flat[a + chunk + 1 : b]]]
            walked.append(np.arange(more, b))
            going.append((s, value, r, j, arc, chunk, j - (int(upto[chunk - 1]) if chunk else 0) + 1, b - more))
        if not going:
            break
        walked = np.concatenate(walked)
        arcs, count = lattice.walk(np.concatenate(nodes), key[walked], place[walked], n)
        ends, at, paths, counts = np.r_[0, np.cumsum(count)].tolist(), 0, [], []
        for s, _, r, j, arc, chunk, own, size in going:
            path, more = arcs[ends[at] : ends[at + size]], count[at : at + size]
            if n:
                path = np.concatenate([s.paths[r][:j], [arc], path])
                whole = len(s.counts[r]) - chunk  # chunks from the one that was left on
                more = np.concatenate([s.counts[r][:chunk], np.zeros(whole - size, np.int64), more])
                more[chunk] += own
            paths.append(path)
            counts.append(more)
            at += size
        every = np.concatenate(paths)
        logs, rest = lattice.log_p[every], lattice.log_rest(every)
        at = 0
        for (s, value, _, j, *_), path, more in zip(going, paths, counts):
            s.emit(path, more, value, j, logs[at : at + len(path)], rest[at : at + len(path)])
            at += len(path)
    out = []
    for s in searches:
        threshold = s.best()[0]
        inclusion = lambda log_p: float(-np.expm1(-np.exp(min(log_p - threshold, 700.0)))) if threshold > -np.inf else 1.0  # noqa: B023, E731
        out.append([(path, log_p, float(value), inclusion(log_p)) for path, log_p, value in zip(s.paths, s.log_p, s.values)])
    return out


@lru_cache(2)
def pieces_of(path: str, theta: float) -> Pieces:
    return Pieces(path, theta)


_SAMPLE = pa.struct([("ids", pa.list_(pa.int32())), ("log_p", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64())])
SCHEMA = "doc_id long, n_pieces long, round_trip boolean, ids array<int>, samples array<struct<ids: array<int>, log_p: double, perturbed: double, inclusion: double>>"


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)))


def encode(docs: DataFrame, path: str, k: int = 2, theta: float = 1.0, seed: int = 10) -> DataFrame:
    """Whole texts as pieces: doc_id, n_pieces, round_trip, ids, samples.

    ``ids`` is the library's encoding, without begin and end marks; ``round_trip`` tells whether decoding it gives the
    text back (a text that holds the space mark itself does not). ``samples`` are up to k distinct segmentations in
    order of their perturbed log probability, with log probability and inclusion probability; fewer if the text has no
    more. Null text counts as empty: no pieces, and no segmentation but the empty one. Draws depend on doc_id (null:
    as 0) and ``seed`` only, so repeated rows get the same. Other columns are not looked at.
    """

    def run(batches):
        pieces = pieces_of(path, theta)
        met = Chunks(pieces)
        for batch in batches:
            for part in slices(batch, SLICE):
                rows = texts(part)
                cut = met.take([pieces.chunks(t) for t in rows])
                encoded = [met.encoded(r) for r in cut]
                spelt = pieces.model.decode([e.tolist() for e in encoded], num_threads=1) if encoded else []
                trip = [s == t for s, t in zip(spelt, rows)]
                keys = mix(np.array([d or 0 for d in part.column("doc_id").to_pylist()], np.int64).view(np.uint64) + np.array([seed], np.uint64) * _BASE)
                lattice = met.lattice
                found = sample(lattice, cut, keys, k)
                every = [s for f in found for s in f]
                inner = pa.StructArray.from_arrays(
                    [_lists([lattice.ids(s[0]) for s in every]), *(pa.array([s[i] for s in every], pa.float64()) for i in (1, 2, 3))], fields=list(_SAMPLE)
                )
                offsets = pa.array(np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(e) for e in encoded], pa.int64()), pa.array(trip), _lists(encoded), pa.ListArray.from_arrays(offsets, inner)],
                    ["doc_id", "n_pieces", "round_trip", "ids", "samples"],
                )

    return docs.select("doc_id", "text").mapInArrow(lean(run), SCHEMA)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """doc_id and ``text`` of each row's pieces; null for null, empty for none. Other columns are not looked at."""

    def run(batches):
        pieces = pieces_of(path, 1.0)
        for batch in batches:
            spelt = [None if i is None else pieces.spell(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spelt, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("doc_id", f"{ids} as ids").mapInArrow(lean(run), "doc_id long, text string")
