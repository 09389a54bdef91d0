"""Offset order on a stream, with state in the state store and timeouts that fire without input.

Three steps, none of which brings the records of a key together:

1. Offsets are packed where the records are: one bitmap per 64 offsets.
2. One stateful step per (topic, partition) sees these bitmaps only. It keeps what
   is expected next and the ranges that wait, skips gaps that have waited long
   enough, and tells each *bucket* of 2^16 offsets up to where it may release.
3. One stateful step per (topic, partition, bucket) keeps the payloads that wait,
   in chunks, and lets go of what step 2 has cleared.

Both stateful steps run in the same micro-batch, so a record in order is not
delayed. A key with a third of all rows is spread over its buckets; what meets in
one task for it is a 64th of its rows, without payloads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ordering import in_a_log
from ..schemas import DEFAULT_GAP_TIMEOUT_SECONDS, KEY

ORDERED = "topic string, partition int, kind string, offset bigint, end_offset bigint, ts_us bigint, payload string"
#: What goes into step 3: records, and orders and gaps from step 2. An order's offsets are the expected one before
#: the step and after it.
_ROUTED = "topic string, partition int, bucket bigint, kind string, offset bigint, end_offset bigint, ts_us bigint, payload string"
_PACKED = "topic string, partition int, word bigint, bits bigint"
BUCKET_BITS = 16
_CHUNK_ROWS = 4_096


def add_to_ranges(starts: list[int], ends: list[int], offsets: np.ndarray) -> tuple[list[int], list[int]]:
    """Sorted disjoint ranges with the sorted offsets added."""
    if len(offsets) == 0:
        return starts, ends
    cuts = np.flatnonzero(np.diff(offsets) > 1) + 1
    runs = [(int(r[0]), int(r[-1])) for r in np.split(offsets, cuts)]
    merged: list[list[int]] = []
    for s, e in sorted(list(zip(starts, ends)) + runs):
        if merged and s <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return [m[0] for m in merged], [m[1] for m in merged]


def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``topic, partition, offset`` as one row per 64 offsets that came together."""
    for part in parts:
        if part.empty:
            continue
        offsets = part["offset"].to_numpy(np.int64)
        frame = pd.DataFrame({"topic": part["topic"], "partition": part["partition"], "word": offsets >> 6, "bits": np.uint64(1) << (offsets & 63).astype(np.uint64)})
        packed = frame.groupby(["topic", "partition", "word"], sort=False)["bits"].agg(lambda b: np.bitwise_or.reduce(b.to_numpy())).reset_index()
        packed["bits"] = packed["bits"].to_numpy(np.uint64).view(np.int64)
        yield packed.astype({"partition": "int32"})


def unpack(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The distinct offsets of packed words, sorted."""
    octets = np.ascontiguousarray(bits.astype(np.int64)).view(np.uint8).reshape(-1, 8)
    present = np.unpackbits(octets, axis=1, bitorder="little").astype(bool)
    return np.unique((words.astype(np.int64)[:, None] * 64 + np.arange(64))[present])


class FrontierProcessor(StatefulProcessor):
    """Step 2: from bitmaps to orders and gaps.

    The wait belongs to the offset that is missing now: each time the expected
    offset moves and later records still wait, a new full wait starts.
    """

    def __init__(self, timeout_ms: int, bucket_bits: int = BUCKET_BITS):
        if timeout_ms < 0:
            raise ValueError("timeout_ms must not be negative")
        self.timeout_ms, self.bucket_bits = timeout_ms, bucket_bits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.position = handle.getValueState("position", "expected bigint, gap_since bigint, starts array<bigint>, ends array<bigint>")

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.position.update((int(initialState["next_offset"].iloc[0]), None, [], []))

    def _load(self):
        if not self.position.exists():
            return 0, None, [], []
        expected, since, starts, ends = self.position.get()
        return expected, since, list(starts), list(ends)

    def _rows(self, key, rows: list[tuple]) -> pd.DataFrame:
        buckets, kinds, offsets, ends = zip(*rows)
        n = len(rows)
        return pd.DataFrame({
            "topic": [key[0]] * n, "partition": np.full(n, key[1], dtype="int32"), "bucket": np.asarray(buckets, dtype="int64"),
            "kind": kinds, "offset": np.asarray(offsets, dtype="int64"), "end_offset": np.asarray(ends, dtype="int64"),
            "ts_us": pd.array([None] * n, dtype="Int64"), "payload": [None] * n,
        })

    def _told(self, key, before: int, after: int, buckets: set[int], passed: list[tuple[int, int]], gaps: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        """Gaps, and an order to each bucket that got records or holds some that are cleared now."""
        for s, e in passed:
            buckets.update(range(s >> self.bucket_bits, (e >> self.bucket_bits) + 1))
        rows = [(s >> self.bucket_bits, "gap", s, e) for s, e in gaps] + [(b, "order", before, after) for b in sorted(buckets)]
        for low in range(0, len(rows), _CHUNK_ROWS):
            yield self._rows(key, rows[low : low + _CHUNK_ROWS])

    def _rearm(self, old_since, since) -> None:
        if old_since is not None:
            self.handle.deleteTimer(old_since + self.timeout_ms)
        if since is not None:
            self.handle.registerTimer(since + self.timeout_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before, since, starts, ends = self._load()
        expected, buckets = before, set()
        for chunk in rows:
            words = chunk["word"].to_numpy(np.int64)
            buckets.update(np.unique(words >> (self.bucket_bits - 6)).tolist())
            offsets = unpack(words, chunk["bits"].to_numpy(np.int64))
            starts, ends = add_to_ranges(starts, ends, offsets[offsets >= before])
        passed, gaps = [], []
        while starts and (starts[0] == expected or self.timeout_ms == 0):
            if starts[0] > expected:
                gaps.append((expected, starts[0] - 1))
            passed.append((starts[0], ends[0]))
            expected, starts, ends = ends[0] + 1, starts[1:], ends[1:]
        waiting = None
        if starts:
            waiting = since if since is not None and expected == before else timerValues.getCurrentProcessingTimeInMs()
        if waiting != since:
            self._rearm(since, waiting)
        self.position.update((expected, waiting, starts, ends))
        yield from self._told(key, before, expected, buckets, passed, gaps)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before, since, starts, ends = self._load()
        now = timerValues.getCurrentProcessingTimeInMs()
        if not starts or since is None or now - since < self.timeout_ms:
            return
        gap, passed = (before, starts[0] - 1), (starts[0], ends[0])
        expected, starts, ends = ends[0] + 1, starts[1:], ends[1:]
        waiting = now if starts else None
        if waiting is not None:
            self.handle.registerTimer(waiting + self.timeout_ms)
        self.position.update((expected, waiting, starts, ends))
        yield from self._told(key, before, expected, set(), [passed], [gap])


def best_copies(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per offset, sorted: of copies the later one, then the larger payload; a missing value is least."""
    ranked = rows.assign(_ts=rows["ts_us"].notna(), _payload=rows["payload"].notna(), _text=rows["payload"].fillna(""))
    ranked = ranked.sort_values(["offset", "_ts", "ts_us", "_payload", "_text"], kind="stable")
    return ranked.drop_duplicates("offset", keep="last")[list(rows.columns)].reset_index(drop=True)


class BucketProcessor(StatefulProcessor):
    """Step 3: keeps records of one bucket until they are cleared; a newer micro-batch's copy replaces an older one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Chunks in order of arrival; only their least offset is looked at while nothing is cleared.
        self.chunks = handle.getListState("chunks", "offsets array<bigint>, ts array<bigint>, payloads array<string>")
        self.least = handle.getValueState("least", "offset bigint")

    def close(self) -> None:
        pass

    def _keep(self, rows: pd.DataFrame) -> None:
        chunks = []
        for low in range(0, len(rows), _CHUNK_ROWS):
            part = rows.iloc[low : low + _CHUNK_ROWS]
            ts = [None if pd.isna(t) else int(t) for t in part["ts_us"]]
            chunks.append(([int(o) for o in part["offset"]], ts, [None if pd.isna(p) else p for p in part["payload"]]))
        if chunks:
            self.chunks.appendList(chunks)
            least = int(rows["offset"].min())
            self.least.update((min(least, self.least.get()[0]) if self.least.exists() else least,))

    def _take(self) -> pd.DataFrame:
        """All that is kept, as one row per offset; the state is empty afterwards."""
        parts = [pd.DataFrame({"offset": c[0], "ts_us": pd.array(list(c[1]), dtype="Int64"), "payload": list(c[2])}) for c in self.chunks.get()]
        self.chunks.clear()
        self.least.clear()
        rows = pd.concat(parts, ignore_index=True)
        return rows.sort_values("offset", kind="stable").drop_duplicates("offset", keep="last")

    def _out(self, key, kind: str, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for low in range(0, len(rows), _CHUNK_ROWS):
            part = rows.iloc[low : low + _CHUNK_ROWS]
            n = len(part)
            end = part["end_offset"] if kind == "gap" else part["offset"]
            yield pd.DataFrame({
                "topic": [key[0]] * n, "partition": np.full(n, key[1], dtype="int32"), "kind": [kind] * n,
                "offset": part["offset"].to_numpy("int64"), "end_offset": end.to_numpy("int64"),
                "ts_us": pd.array(part["ts_us"], dtype="Int64"), "payload": [None if pd.isna(p) else p for p in part["payload"]],
            })

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came, before, after = None, None, None
        for chunk in rows:
            yield from self._out(key, "gap", chunk[chunk["kind"] == "gap"])
            orders = chunk[chunk["kind"] == "order"]
            if len(orders):
                before = min(int(orders["offset"].min()), 2**63 - 1 if before is None else before)
                after = max(int(orders["end_offset"].max()), -1 if after is None else after)
            fresh = chunk.loc[chunk["kind"] == "record", ["offset", "ts_us", "payload"]].astype({"ts_us": "Int64"})
            if len(fresh):
                # No more rows are held than the bucket has offsets, however many copies come.
                came = best_copies(fresh if came is None else pd.concat([came, fresh], ignore_index=True))
        if before is None:
            return  # gaps only; every record comes with an order
        if came is None:
            came = pd.DataFrame({"offset": np.array([], "int64"), "ts_us": pd.array([], dtype="Int64"), "payload": []})
        yield from self._out(key, "late", came[came["offset"] < before])
        came = came[came["offset"] >= before]
        if self.least.exists() and self.least.get()[0] < after:
            came = pd.concat([self._take(), came], ignore_index=True).sort_values("offset", kind="stable").drop_duplicates("offset", keep="last")
        yield from self._out(key, "record", came[came["offset"] < after])
        self._keep(came[came["offset"] >= after])


def order_stream(
    envelopes: DataFrame, checkpoint: DataFrame | None = None, timeout_s: float = DEFAULT_GAP_TIMEOUT_SECONDS, bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Streaming envelopes as tagged rows ``kind`` in record, gap, late.

    ``checkpoint`` seeds the expected offset per key. Needs the RocksDB state
    store. A gap row spans ``offset .. end_offset`` and has no payload. Of several
    copies of an offset that wait, the newest micro-batch's counts, and within one
    the later timestamp, then the larger payload. A late offset is given once per
    micro-batch. Rows of one bucket come in order of offsets; a bucket is 2^``bucket_bits`` offsets.
    """
    ts = F.unix_micros(F.col("timestamp").cast("timestamp")) if "timestamp" in envelopes.columns else F.lit(None)
    log = in_a_log(envelopes)
    seed = None if checkpoint is None else checkpoint.select(*KEY, "next_offset").groupBy(*KEY)
    told = log.select(*KEY, "offset").mapInPandas(pack, _PACKED).groupBy(*KEY).transformWithStateInPandas(
        FrontierProcessor(int(timeout_s * 1000), bucket_bits), _ROUTED, "Append", "ProcessingTime", initialState=seed
    )
    records = log.select(
        *KEY, F.expr(f"shiftright(offset, {bucket_bits})").alias("bucket"), F.lit("record").alias("kind"), "offset",
        F.col("offset").alias("end_offset"), ts.cast("bigint").alias("ts_us"), "payload",
    )
    ordered = records.unionByName(told).groupBy(*KEY, "bucket").transformWithStateInPandas(
        BucketProcessor(), ORDERED, "Append", "ProcessingTime"
    )
    return ordered.withColumn("timestamp", F.timestamp_micros("ts_us")).drop("ts_us")
