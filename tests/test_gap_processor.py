"""The stateful steps on random arrivals, with their state kept in plain Python."""

import random

import numpy as np
import pandas as pd
import pytest

from tidemark.streaming import gap_processor as gp


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class List:
    def __init__(self):
        self.rows, self.calls = [], 0

    def get(self):
        self.calls += 1
        return iter(list(self.rows))

    def appendList(self, rows):
        self.calls += 1
        self.rows += rows

    def clear(self):
        self.rows = []


class Handle:
    def __init__(self):
        self.values, self.list, self.timers = {}, List(), set()

    def getValueState(self, name, _):
        return self.values.setdefault(name, Value())

    def getListState(self, *_):
        return self.list

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Now:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def records(rows):
    """Input of step 3 for ``(offset, ts, payload)`` rows of one chunk."""
    offsets = [r[0] for r in rows]
    return pd.DataFrame({"topic": ["t"] * len(rows), "partition": [0] * len(rows), "kind": ["record"] * len(rows), "offset": offsets, "end_offset": offsets,
                         "ts_us": pd.array([r[1] for r in rows], dtype="Int64"), "payload": [r[2] for r in rows]})


class Chain:
    """Steps 1 to 3 for one key, as the engine would run them in each micro-batch."""

    def __init__(self, timeout, bits, rng):
        self.bits, self.rng, self.handle = bits, rng, Handle()
        self.first = gp.FrontierProcessor(timeout, bits)
        self.first.init(self.handle)
        self.buckets, self.out = {}, []

    def bucket(self, b):
        if b not in self.buckets:
            step, handle = gp.BucketProcessor(), Handle()
            step.init(handle)
            self.buckets[b] = (step, handle)
        return self.buckets[b]

    def batch(self, chunks, now):
        told = []
        if chunks:
            packed = list(gp.pack(iter([records(c)[["topic", "partition", "offset"]] for c in chunks])))
            told += list(self.first.handleInputRows(("t", 0), iter(packed), Now(now)))
        for at in sorted(t for t in self.handle.timers if t <= now):
            self.handle.timers.discard(at)
            told += list(self.first.handleExpiredTimer(("t", 0), Now(now), None))
        routed = [f.assign(bucket=f["offset"] // 2**self.bits) for f in map(records, chunks)] + told
        rows = pd.concat(routed, ignore_index=True) if routed else pd.DataFrame({"bucket": []})
        for b, part in rows.groupby("bucket"):
            step, _ = self.bucket(int(b))
            part = part.sample(frac=1, random_state=self.rng.randrange(10**6))  # the engine promises no order
            cut = self.rng.randint(0, len(part))
            for frame in step.handleInputRows(("t", 0, b), iter([p for p in (part.iloc[:cut], part.iloc[cut:]) if len(p)]), Now(now)):
                self.out.extend(frame[["kind", "offset", "end_offset", "ts_us", "payload"]].itertuples(index=False))

    def waiting(self):
        return {o for _, h in self.buckets.values() for c in h.list.rows for o in c[0]}


@pytest.mark.parametrize("seed", range(60))
def test_random_arrivals(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(gp, "_CHUNK_ROWS", rng.choice([1, 3, 1000]))
    timeout = rng.choice([0, 100])
    chain = Chain(timeout, rng.choice([6, 16]), rng)
    now, arrived, newest, lates = 0, set(), {}, set()
    for batch in range(rng.randint(1, 8)):
        now += rng.choice([1, 60, 150])
        done = chain.first._load()[0]
        some = lambda: (rng.choice([rng.randrange(25), rng.randrange(60, 140)]), rng.choice([None, 1, 2]), rng.choice([None, "a", "b", f"c{batch}"]))
        chunks = [[some() for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(0, 4))]
        for o in {r[0] for c in chunks for r in c}:
            arrived.add(o)
            copies = [r for c in chunks for r in c if r[0] == o]
            best = max(copies, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
            (lates.add((batch, o)) if o < done else newest.update({o: best}))
        chain.batch(chunks, now)
        expected, since, starts, ends = chain.first._load()
        waiting = {o for s, e in zip(starts, ends) for o in range(s, e + 1)}
        assert chain.waiting() == waiting and all(o > expected for o in waiting)
        assert (since is None) == (not starts) and len(chain.handle.timers) <= 1
        assert since is None or since + timeout in chain.handle.timers
        reached = 0  # records and gaps tile the offsets
        for r in sorted((r for r in chain.out if r.kind != "late"), key=lambda r: r.offset):
            assert r.offset == reached
            reached = r.end_offset + 1
        assert reached == expected
    got = {r.offset: (r.offset, None if pd.isna(r.ts_us) else r.ts_us, r.payload) for r in chain.out if r.kind == "record"}
    assert sum(r.kind == "record" for r in chain.out) == len(got)
    gaps = {o for r in chain.out if r.kind == "gap" for o in range(r.offset, r.end_offset + 1)}
    assert set(got) | waiting == arrived - gaps
    assert all(row == newest[o] for o, row in got.items())
    assert sum(r.kind == "late" for r in chain.out) == len(lates)


def test_state_is_touched_per_chunk_and_left_empty():
    chain = Chain(1000, 16, random.Random(1))
    for n in range(5):
        chain.batch([[(o, 1, "x") for o in range(1 + n * 10_000, 1 + (n + 1) * 10_000)]], n)
    _, handle = chain.buckets[0]
    assert len(handle.list.rows) == 15 and handle.list.calls == 5
    chain.batch([[(0, 1, "x")]], 9)
    assert [r.offset for r in chain.out] == list(range(50_001)) and handle.list.rows == [] and not handle.values["least"].exists()


def test_pack_and_unpack():
    rng = np.random.default_rng(3)
    for _ in range(50):
        offsets = rng.integers(0, 500, 40)
        frame = pd.DataFrame({"topic": rng.choice(["a", "b"], 40), "partition": rng.integers(0, 2, 40), "offset": offsets})
        packed = pd.concat(gp.pack(iter([frame, frame.iloc[:0]])))
        for key, part in packed.groupby(["topic", "partition"]):
            mine = frame[(frame["topic"] == key[0]) & (frame["partition"] == key[1])]
            assert gp.unpack(part["word"].to_numpy(), part["bits"].to_numpy()).tolist() == sorted(set(mine["offset"]))
        assert len(packed) <= 4 * 8


def test_negative_timeout_is_refused():
    with pytest.raises(ValueError):
        gp.FrontierProcessor(-1)
