"""Live queries over a JSON file log. They are polled with a deadline, since a
query with processing-time timers never runs out of batches."""

import json
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.envelope import to_envelope
from tidemark.sources.generator import random_records, tick_stream
from tidemark.sources.log import LogSpec, read_log, write_log
from tidemark.streaming.gap_processor import add_to_ranges, order_stream
from tidemark.streaming.ingest import Ingest
from tidemark.streaming.progress import ProgressLog


def drop_file(folder, name, offsets, topic="t", partition=0):
    """Make one file appear in the log at once."""
    lines = [
        json.dumps({"topic": topic, "partition": partition, "offset": o, "timestamp": "2024-01-01T00:00:00Z",
                    "key": str(o), "value": f"v{o}"}) for o in offsets
    ]
    hidden = os.path.join(folder, f".{name}")
    with open(hidden, "w") as f:
        f.write("\n".join(lines))
    os.rename(hidden, os.path.join(folder, f"{name}.json"))


def wait_for(condition, seconds=90):
    deadline = time.time() + seconds
    while time.time() < deadline:
        if condition():
            return
        time.sleep(0.5)
    pytest.fail("the stream did not get there in time")


@pytest.fixture
def log_dir(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    return str(folder)


def start(spark, log_dir, name, checkpoint=None, timeout_s=3):
    records = read_log(spark, LogSpec("json", log_dir, options={"maxFilesPerTrigger": "1"}), streaming=True)
    ordered = order_stream(to_envelope(records, keep=("timestamp",)), checkpoint, timeout_s)
    query = ordered.writeStream.format("memory").queryName(name).trigger(processingTime="1 second").start()

    def rows(kind, topic="t"):
        found = spark.table(name).where(f"kind = '{kind}' and topic = '{topic}'").select("offset", "end_offset").collect()
        return [(r.offset, r.end_offset) if kind == "gap" else r.offset for r in found]

    return query, rows


def test_gap_times_out_resolves_and_late_records_are_tagged(spark, log_dir):
    seed = spark.createDataFrame([("seeded", 0, 100)], "topic string, partition int, next_offset long")
    drop_file(log_dir, "a", [0, 4, 6])
    drop_file(log_dir, "b", [0, 2, 1, 3], topic="full")
    drop_file(log_dir, "c", [99, 100, 101], topic="seeded")
    query, rows = start(spark, log_dir, "ordered", seed)
    try:
        wait_for(lambda: rows("record") == [0, 4, 6])
        assert rows("gap") == [(1, 3), (5, 5)]
        wait_for(lambda: len(rows("record", "seeded")) == 2)
        assert rows("record", "full") == [0, 1, 2, 3] and rows("gap", "full") == []
        assert rows("record", "seeded") == [100, 101] and rows("late", "seeded") == [99]
        drop_file(log_dir, "d", [2, 7])
        wait_for(lambda: rows("record") == [0, 4, 6, 7] and rows("late") == [2])
        assert spark.table("ordered").where("kind = 'record' and topic = 't' and offset = 7").first().payload == "v7"
    finally:
        query.stop()


def test_gap_filled_in_time_is_not_declared(spark, log_dir):
    drop_file(log_dir, "a", [0, 2, 3, 6])
    query, rows = start(spark, log_dir, "resolved", timeout_s=60)
    try:
        wait_for(lambda: rows("record") == [0])
        drop_file(log_dir, "b", [1, 5])
        wait_for(lambda: rows("record") == [0, 1, 2, 3])
        drop_file(log_dir, "c", [4])
        wait_for(lambda: rows("record") == [0, 1, 2, 3, 4, 5, 6])
        assert rows("gap") == []
    finally:
        query.stop()


def test_a_hot_key_spreads_over_buckets(spark, log_dir, tmp_path):
    """Two thirds of all records belong to one key; its rows leave the operator in several tasks, in order per bucket."""
    hot = [o for o in range(1200) if o != 5]
    random.Random(4).shuffle(hot)
    drop_file(log_dir, "a", hot[:800])
    drop_file(log_dir, "b", hot[800:] + [3, 3, 3])
    for p in range(6):
        drop_file(log_dir, f"c{p}", range(100), topic="cold", partition=p)
    seen, source = [], read_log(spark, LogSpec("json", log_dir), streaming=True)
    ordered = order_stream(to_envelope(source, keep=("timestamp",)), timeout_s=2, bucket_bits=7)
    placed = ordered.select("topic", "kind", "offset", "end_offset", F.spark_partition_id().alias("task"))
    query = placed.writeStream.foreachBatch(lambda df, n: seen.extend(df.collect())).start()
    try:
        wait_for(lambda: sum(r.kind == "record" for r in seen) == 1199 + 600)
    finally:
        query.stop()
    mine = [r for r in seen if r.topic == "t" and r.kind == "record"]
    assert sorted(r.offset for r in mine) == sorted(hot) and len({r.task for r in mine}) > 1
    assert [(r.offset, r.end_offset) for r in seen if r.kind == "gap"] == [(5, 5)]
    for bucket in range(10):
        inside = [r.offset for r in mine if r.offset // 128 == bucket]
        assert inside == sorted(inside)


def test_live_ingest_with_heartbeat_and_restart(spark, log_dir, tmp_path):
    drop_file(log_dir, "a", [0, 1, 3])
    flow = Ingest(spark, str(tmp_path / "flow"), "live", gap_timeout_s=2, commit_interval_s=0)
    progress = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(progress)
    query = flow.start(LogSpec("json", log_dir), str(tmp_path / "query"), trigger_s=1)
    try:
        # The log stays silent: only the heartbeat lets the gap at 2 time out.
        wait_for(lambda: [r.next_offset for r in flow.checkpoint.current().collect()] == [4], seconds=150)
        wait_for(lambda: progress.flush() or progress.rows(query).count() > 1, seconds=30)
    finally:
        query.stop()
        spark.streams.removeListener(progress)
    told = progress.rows(query)
    assert told.agg(F.sum(F.col("observed")["arrivals.records"])).first()[0] == 3
    spent = {r.phase: r for r in progress.latencies(query).collect()}
    assert 0 < spent["triggerExecution"].ms_min <= spent["triggerExecution"].ms_p99 <= spent["triggerExecution"].ms_max
    counted = flow.commits.metrics().agg(F.sum("offsets_contiguously_acked"), F.sum("handled_offsets_seen")).first()
    assert tuple(counted) == (4, 4) and flow.commits.updates().agg(F.sum("checkpoint_update_success")).first()[0] >= 1

    drop_file(log_dir, "b", [4])
    again = Ingest(spark, str(tmp_path / "flow"), "live2", commit_interval_s=0)
    query = again.start(LogSpec("json", log_dir), str(tmp_path / "query2"), trigger_s=1)
    try:
        wait_for(lambda: [r.next_offset for r in again.checkpoint.current().collect()] == [5], seconds=150)
    finally:
        query.stop()
    offsets = again.raw_table().select("run_id", F.col("__metadata._meta_kafka_offset").alias("o")).collect()
    assert sorted((r.run_id, r.o) for r in offsets) == [("live", 0), ("live", 1), ("live", 3), ("live2", 4)]


def test_a_new_run_on_segments_needs_no_partition_counts(spark, tmp_path):
    spec = LogSpec("segments", str(tmp_path / "log"), topics=("a",))

    def append(*rows):
        layout = "topic string, partition int, offset long, timestamp timestamp, key string, value string"
        write_log(spark.createDataFrame([(t, p, o, None, "k", f"v{o}") for t, p, os_ in rows for o in os_], layout), spec)

    def run(name, want):
        flow = Ingest(spark, str(tmp_path / "flow"), name, gap_timeout_s=60, commit_interval_s=0)
        query = flow.start(spec, str(tmp_path / f"query-{name}"), trigger_s=1)
        try:
            wait_for(lambda: {r.partition: r.next_offset for r in flow.checkpoint.current().collect()} == want, seconds=150)
        finally:
            query.stop()
        found = flow.raw_table().where(F.col("run_id") == name).select("__metadata.*").collect()
        return sorted((r["_meta_kafka_partition"], r["_meta_kafka_offset"]) for r in found)

    append(("a", 0, range(4)), ("other", 0, range(3)))
    assert run("one", {0: 4}) == [(0, o) for o in range(4)]
    append(("a", 0, [4, 5]), ("a", 3, [0, 1]))
    assert run("two", {0: 6, 3: 2}) == [(0, 4), (0, 5), (3, 0), (3, 1)]


def test_generated_stream_reaches_a_file_log(spark, tmp_path):
    spec = LogSpec("json", str(tmp_path / "log"))
    query = write_log(random_records(tick_stream(spark, 5), 3), spec, str(tmp_path / "query"), topic="random")
    try:
        wait_for(lambda: any(p.name.endswith(".json") and p.stat().st_size for p in (tmp_path / "log").glob("*")))
    finally:
        query.stop()
    rows = spark.read.json(spec.path).collect()
    assert rows and len(rows) % 3 == 0 and {r.topic for r in rows} == {"random"}
    message = json.loads(rows[0].value)
    assert message["id"] == rows[0].key and 0 <= message["value"] < 1 and message["timestamp"].endswith("Z")


def test_run_helpers_against_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(200):
        old = np.unique(rng.integers(0, 60, rng.integers(0, 20)))
        new = np.unique(rng.integers(0, 60, rng.integers(0, 20)))
        starts, ends = add_to_ranges(*add_to_ranges([], [], old), new)
        covered = [o for s, e in zip(starts, ends) for o in range(s, e + 1)]
        assert covered == sorted(set(old.tolist()) | set(new.tolist()))
        assert all(s > e + 1 for s, e in zip(starts[1:], ends))
