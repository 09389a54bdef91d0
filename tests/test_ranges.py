"""The range core against brute force, with buckets small enough to be crossed."""

import random

import pytest

from tidemark.operators import ordering as od
from tidemark.operators import ranges as rg

SCHEMA = "topic string, partition int, offset long"
RANGES = "topic string, partition int, start_offset long, end_offset long"
FLOORS = "topic string, partition int, next_offset long"


@pytest.fixture(autouse=True)
def small_buckets(monkeypatch):
    monkeypatch.setattr(rg, "BUCKET_BITS", 5)


def gaps_of(offsets, floor):
    found, expected = [], floor
    for o in sorted({o for o in offsets if o >= floor}):
        if o > expected:
            found.append((expected, o - 1))
        expected = o + 1
    return found


def frontier_of(offsets, floor):
    present, n = set(offsets), floor
    while n in present:
        n += 1
    return n


def runs_of(offsets):
    runs = []
    for o in sorted(set(offsets)):
        if runs and runs[-1][1] == o - 1:
            runs[-1][1] = o
        else:
            runs.append([o, o])
    return [tuple(r) for r in runs]


def by_key(df, *columns):
    found = {}
    for r in df.collect():
        found.setdefault(r.partition, []).append(tuple(r[c] for c in columns))
    return {k: sorted(v) for k, v in found.items()}


LOGS = {
    0: random.Random(1).sample(range(900), 700) + [3, 3, 3, 500],
    1: list(range(400)),
    2: [50, 51, 64, 127, 128, 100_000, 10**12],
    3: list(range(0, 300, 2)),
    4: [0],
    5: [63, 64, 65],
}


def test_points_against_brute_force(spark):
    df = spark.createDataFrame([("t", p, o) for p, os in LOGS.items() for o in os], SCHEMA)
    floors = {1: 399, 2: 51, 3: 1000, 4: 0, 9: 17}
    fl = spark.createDataFrame([("t", p, n) for p, n in floors.items()], FLOORS)
    points = rg.offsets_to_ranges(df)

    assert by_key(rg.gaps_in(points, disjoint=True), "start_offset", "end_offset") == {
        p: gaps_of(os, 0) for p, os in LOGS.items() if gaps_of(os, 0)
    }
    assert by_key(rg.gaps_in(points, fl, disjoint=True), "start_offset", "end_offset") == {
        p: g for p, os in LOGS.items() if (g := gaps_of(os, floors.get(p, 0)))
    }
    assert by_key(rg.frontier_of(points, fl, disjoint=True), "next_offset") == {
        p: [(frontier_of(LOGS.get(p, []), floors.get(p, 0)),)] for p in LOGS.keys() | floors.keys()
    }
    assert by_key(rg.merge_ranges(points, disjoint=True), "start_offset", "end_offset") == {
        p: runs_of(os) for p, os in LOGS.items()
    }


def test_overlapping_ranges_against_brute_force(spark):
    rng = random.Random(5)
    ranges = {p: [(s, s + rng.choice([0, 0, 1, 5, 40, 200])) for s in (rng.randrange(600) for _ in range(60))]
              for p in range(6)}
    ranges[6] = [(0, 10**10), (5, 6), (10**10 + 1, 10**10 + 5)]
    df = spark.createDataFrame([("t", p, s, e) for p, rs in ranges.items() for s, e in rs], RANGES)
    small = {p: [o for s, e in rs for o in range(s, e + 1)] for p, rs in ranges.items() if p < 6}
    floors = {p: 20 * p for p in range(6)}
    fl = spark.createDataFrame([("t", p, n) for p, n in floors.items()], FLOORS)
    got = by_key(rg.gaps_in(df, fl), "start_offset", "end_offset")
    assert got == {p: g for p, os in small.items() if (g := gaps_of(os, floors[p]))}
    got = by_key(rg.frontier_of(df, fl), "next_offset")
    assert got.pop(6) == [(10**10 + 6,)]
    assert got == {p: [(frontier_of(os, floors[p]),)] for p, os in small.items()}
    got = by_key(rg.disjoint_parts(df.where("partition < 6")), "start_offset", "end_offset")
    assert {p: sorted(o for s, e in rs for o in range(s, e + 1)) for p, rs in got.items()} == {
        p: sorted(set(os)) for p, os in small.items()
    }
    got = by_key(rg.merge_ranges(df), "start_offset", "end_offset")
    assert got.pop(6) == [(0, 10**10 + 5)]
    assert got == {p: runs_of(os) for p, os in small.items()}


def test_wide_range_explodes_in_chunks(spark):
    df = spark.createDataFrame([("t", 0, 5, 5000), ("t", 1, 7, 7)], RANGES)
    exploded = rg.explode_ranges(df, chunk_bits=5)
    assert by_key(exploded, "offset") == {0: [(o,) for o in range(5, 5001)], 1: [(7,)]}


def test_latest_per_offset_with_given_words(spark):
    rows = [("t", 0, o, t, f"p{t}") for o in range(200) for t in ((1, 2) if o in (3, 150) else (1,))]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp int, payload string")
    want = sorted({r[2]: r for r in sorted(rows, key=lambda r: r[3])}.values())
    parts = [rg.pack_offsets(df.where("timestamp = 1")), rg.pack_offsets(df.where("timestamp = 2"))]
    assert sorted(map(tuple, od.latest_per_offset(df).collect())) == want
    assert sorted(map(tuple, od.latest_per_offset(df, words=rg.merge_words(*parts)).collect())) == want

def test_hot_key_window_is_split_by_bucket(spark):
    """The plan must not window over a whole log partition."""
    df = spark.range(10).selectExpr("'t' as topic", "0 as partition", "id as offset")
    plan = rg.frontier_of(rg.offsets_to_ranges(df), disjoint=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    scan_side = [line for line in plan.splitlines() if "partial_bit_or" in line]
    assert scan_side  # offsets are combined before the shuffle


def test_word_unpacking_bit_by_bit(spark):
    rng = random.Random(3)
    words = [-1, 1, -2, 5, 2**62, 3 << 61, -(2**62), 2**63 - 1, -(2**63), -(2**63) + 1]
    words += [rng.getrandbits(64) - 2**63 for _ in range(200)]
    df = spark.createDataFrame([("t", 0, i, w) for i, w in enumerate(words)], "topic string, partition int, word long, bits long")
    got = {}
    for r in rg.unpack_ranges(df).collect():
        got.setdefault(r.start_offset >> 6, []).append((r.start_offset & 63, r.end_offset & 63))
    for i, w in enumerate(words):
        assert sorted(got[i]) == runs_of([b for b in range(64) if w >> b & 1])
