"""Near-duplicate vectors by cosine: PCA-ordered tiled comparison with early stop.

Unit vectors are rotated to principal axes, so that the leading coordinates hold most of their length. Rows are dealt
to tiles along the first axis; two tiles whose ranges lie further apart there than linked vectors can be are never
compared. Within a pair of tiles the products of the leading coordinates come first; what the rest can add is at most
the product of the suffix norms, and pairs that cannot reach the threshold any more are left before the next stretch.

Equal vectors are one class. A pair of tiles gives back, per class, how many vectors it links there and the first
vector of its component within the pair: never the links themselves, which a large group has a square number of.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed
from tidemark.llm.graph import components

STRETCH = 16
ROWS_AT_ONCE = 512
#: Pairs this close to the threshold are decided by the vectors as they came.
DOUBT = 1e-9
#: More than single precision can err by in a product of some twenty coordinates of unit vectors.
SINGLE = 1e-4


def usable(column: str = "embedding"):
    """Is the vector there, with finite components only, one of them not zero?"""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    x = F.col(column)
    return F.coalesce(x.isNotNull() & F.forall(x, finite) & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """Usable vectors of one dimension, an Arrow column, as the rows of a matrix without an object for each number."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([p.flatten().to_numpy(zero_copy_only=False) for p in parts]).astype(float).reshape(len(column), -1)


def matrices(batch, column: str = "embedding") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, which rows, their vectors) of a batch."""
    lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        yield d, at, matrix(batch.column(column).take(pa.array(at)))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rotations(classes: DataFrame) -> dict[int, np.ndarray]:
    """By dimension: the principal axes of all unit vectors, by falling spread."""

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in matrices(batch):
                x = unit(x)
                sums[d] = sums.get(d, 0) + x.T @ x
        at = [(d, i) for d in sums for i in range(d)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in at], pa.int32()), pa.array([i for _, i in at], pa.int32()), pa.array([sums[d][i] for d, i in at], pa.list_(pa.float64()))], ["dim", "i", "part"]
        )

    schema = "dim int, i int, part array<double>"
    parts = classes.select("embedding").mapInArrow(moments, schema)
    cells = parts.select("dim", "i", F.posexplode("part").alias("j", "x")).groupBy("dim", "i", "j").agg(F.sum("x").alias("x")).collect()  # dim x dim
    found = {}
    for d in {c.dim for c in cells}:
        m = np.zeros((d, d))
        for c in cells:
            if c.dim == d:
                m[c.i, c.j] = c.x
        found[d] = np.linalg.eigh((m + m.T) / 2)[1][:, ::-1]
    return found


def linked(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b with cosine of at least ``threshold``. a, b: rotated unit vectors; x, y: the same not rotated."""
    d = a.shape[1]
    cuts = [*range(0, d, STRETCH), d]
    rest_a = [np.linalg.norm(a[:, c:], axis=1) for c in cuts[1:]]
    rest_b = [np.linalg.norm(b[:, c:], axis=1) for c in cuts[1:]]
    out_r, out_c = [], []
    # With the suffix norm as one more coordinate a single product of the leading ones is the bound. Single precision
    # is enough for it: what it lets pass is computed anew.
    head_a = np.concatenate([a[:, : cuts[1]], rest_a[0][:, None]], axis=1).astype(np.float32)
    head_b = np.ascontiguousarray(np.concatenate([b[:, : cuts[1]], rest_b[0][:, None]], axis=1).astype(np.float32).T)
    for top in range(0, len(a), ROWS_AT_ONCE):
        part = a[top : top + ROWS_AT_ONCE]
        # Places in the flat product: over two dimensions ``nonzero`` takes several times as long.
        r, c = np.divmod(np.flatnonzero(head_a[top : top + ROWS_AT_ONCE] @ head_b >= np.float32(threshold - SINGLE)), len(b))
        value = np.zeros(len(r))
        for k in range(len(cuts) - 1):
            if not len(r):
                break
            value = value + np.concatenate([np.einsum("ij,ij->i", part[r[s : s + 65536], cuts[k] : cuts[k + 1]], b[c[s : s + 65536], cuts[k] : cuts[k + 1]]) for s in range(0, len(r), 65536)])
            alive = value + rest_a[k][top + r] * rest_b[k][c] >= threshold - DOUBT
            r, c, value = r[alive], c[alive], value[alive]
        sure = value >= threshold + DOUBT
        near = np.flatnonzero(~sure)
        if len(near):
            sure[near] = np.einsum("ij,ij->i", x[top + r[near]], y[c[near]]) >= threshold
        out_r.append(top + r[sure])
        out_c.append(c[sure])
    return np.concatenate(out_r), np.concatenate(out_c)


def first_of_each(n: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 with edges r, c: the smallest node of each one's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[r], label[c])
        new = label.copy()
        np.minimum.at(new, label[r], low)
        np.minimum.at(new, label[c], low)
        new = np.minimum(new, label)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            return label
        label = new


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, tile: int = 4096) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per vector.

    n_links: other vectors with cosine >= ``threshold``, equal ones too; component_id: the smallest vec_id reachable by
    links; kept: whether that is the vector's own. A vector that is null, empty, zero or holds a null or non-finite
    component links with nothing, nor do vectors of different dimension. Rows that repeat wholly count once; rows that
    repeat an id with another vector are vectors of their own. Other columns are not looked at; no rows give no rows.
    """
    rows = checkpointed(embeddings.select("vec_id", "embedding").distinct().withColumn("ok", usable()))
    good = rows.where("ok")
    classes = checkpointed(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")))
    axes = rotations(classes)
    shared = classes.sparkSession.sparkContext.broadcast(axes)  # dim x dim for each dimension

    def place(batches):
        for batch in batches:
            dims, first = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for d, at, x in matrices(batch):
                dims[at], first[at] = d, unit(x) @ shared.value[d][:, 0]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rep", "size", "embedding")), pa.array(dims), pa.array(first)], ["rep", "size", "embedding", "dim", "first"])

    kind = dict(classes.dtypes)["embedding"]
    placed = classes.mapInArrow(place, f"rep long, size long, embedding {kind}, dim int, first double")
    # equal first coordinates are told apart by the id's hash, so that no tile grows beyond its share
    placed = checkpointed(placed.withColumn("first", F.col("first") + F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) * 1e-16))
    counts = {r.dim: r.n for r in placed.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    cuts = {}
    for d, n in counts.items():
        shares = [k / (-(-n // tile)) for k in range(1, -(-n // tile))]
        cuts[d] = placed.where(F.col("dim") == d).agg(F.percentile_approx("first", shares, 10_000).alias("c")).first().c if shares else []  # one number for each tile
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    tiling = classes.sparkSession.sparkContext.broadcast({d: np.array(c, float) for d, c in cuts.items()})

    def deal(batches):
        for batch in batches:
            at, lows, highs, sides = [], [], [], []
            for i, (d, v) in enumerate(zip(batch.column("dim").to_pylist(), batch.column("first").to_pylist())):
                c = tiling.value[d]
                own = int(np.searchsorted(c, v, side="right"))
                low = int(np.searchsorted(c, (c[own - 1] if own else v) - reach, side="left")) if own else 0
                last = int(np.searchsorted(c, (c[own] if own < len(c) else v) + reach, side="right"))
                for other in range(low, last + 1):
                    at.append(i)
                    lows.append(min(own, other))
                    highs.append(max(own, other))
                    sides.append(own > other)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x).take(taken) for x in ("rep", "size", "embedding", "dim")), pa.array(lows, pa.int32()), pa.array(highs, pa.int32()), pa.array(sides, pa.bool_())],
                ["rep", "size", "embedding", "dim", "low", "high", "second"],
            )

    dealt = placed.mapInArrow(deal, f"rep long, size long, embedding {kind}, dim int, low int, high int, second boolean")

    def compare(table):
        table = table.combine_chunks()
        rep, size = table.column("rep").to_numpy(), table.column("size").to_numpy()
        x = unit(matrix(table.column("embedding")))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        second = table.column("second").to_numpy().astype(bool)
        order = np.argsort(rep, kind="stable")
        rep, size, x, second = rep[order], size[order], x[order], second[order]
        rotated = x @ shared.value[x.shape[1]]
        one = np.flatnonzero(~second)
        two = one if low == high else np.flatnonzero(second)
        r, c = linked(rotated[one], rotated[two], x[one], x[two], threshold) if len(two) else (np.zeros(0, int), np.zeros(0, int))
        r, c = one[r], two[c]
        if low == high:
            r, c = r[r < c], c[r < c]
        links = np.bincount(r, size[c], len(rep)) + np.bincount(c, size[r], len(rep))
        some = np.flatnonzero(links)
        first = first_of_each(len(rep), r, c)
        return pa.Table.from_pydict({"rep": rep[some], "links": links[some].astype(np.int64), "root": rep[first[some]]})

    parts = checkpointed(dealt.groupBy("dim", "low", "high").applyInArrow(compare, "rep long, links long, root long"))
    found = components(parts.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = parts.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.join(links, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("embedding", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked_rows = good.select("vec_id", "embedding").join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
