"""End to end with a clock set by the test.

Scenarios run side by side as topics of one flow, so a few batches cover all.
"""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.replay import account
from tidemark.schemas import KEY, LOG_RECORD
from tidemark.sources.tables import read_table
from tidemark.streaming.ingest import Ingest

SEC = 1000
MIN = 60 * SEC


class Run:
    def __init__(self, spark, root, run_id="r1", **kw):
        self.spark, self.now, self.batch = spark, 1_700_000_000_000, -1
        kw.setdefault("commit_interval_s", 0)
        self.flow = Ingest(spark, root, run_id, clock=lambda: self.now, **kw)

    def feed(self, arrivals, after=0, invalid=()):
        """One micro-batch: ``{(topic, partition): offsets}``."""
        self.now += after
        self.batch += 1
        rows = [
            (t, p, o, None, f"key-{o}", '{"errorMessage":"bad"}' if (t, o) in invalid else f"payload-{o}")
            for (t, p), offsets in arrivals.items() for o in offsets
        ]
        self.flow.process(self.spark.createDataFrame(rows, LOG_RECORD), self.batch)
        return self

    def next(self):
        return {(r.topic, r.partition): r.next_offset for r in self.flow.checkpoint.current().collect()}

    def raw(self):
        found = {}
        for r in self.flow.raw_table().select("kafka_topic", F.col("__metadata._meta_kafka_offset").alias("o")).collect():
            found.setdefault(r.kafka_topic, []).append(r.o)
        return {t: sorted(o) for t, o in found.items()}

    def table(self, table, *columns):
        layout = "topic string, missing_offset long, last_missing_offset long, offset long"
        rows = read_table(self.spark, table.path, StructType.fromDDL(layout)).select(*columns).collect()
        return sorted(tuple(r) for r in rows)

    def refused(self):
        return sorted(tuple(r) for r in self.flow.quarantine_table().select("kafka_topic", "error").collect())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "flow")


def test_scenarios(spark, root):
    refused = {"boom": F.expr("topic = 'failed' and offset = 1 or topic = 'gap_failed' and offset = 2")}
    run = Run(spark, root, rules=refused)
    run.feed(
        {
            ("success", 0): [0, 1],
            ("failed", 0): [0, 1, 2],
            ("gap", 0): [0, 2],
            ("gap_failed", 0): [0, 2],
            ("invalid", 0): [0, 1, 2],
            ("resolved", 0): [2, 0],
            ("wide", 0): [0, 4],
            ("two", 0): [0, 2, 4],
            ("double", 0): [0, 2],
            ("many", 0): [0, 1, 2],
            ("many", 1): [0, 5],
            ("head", 0): [50],
        },
        invalid={("invalid", 1)},
    )
    first = run.next()
    assert first[("success", 0)] == 2 and first[("failed", 0)] == 3 and first[("invalid", 0)] == 3
    assert first[("gap", 0)] == first[("gap_failed", 0)] == first[("resolved", 0)] == 1
    assert (first[("many", 0)], first[("many", 1)]) == (3, 1)
    assert ("head", 0) not in first  # nothing handled yet

    run.feed({("resolved", 0): [1], ("double", 0): [2, 2, 1]}, after=30 * SEC)
    outcome = {r.topic: r for r in run.flow.batch_metrics(1).collect()}
    assert outcome["resolved"].gap_resolved_before_timeout == 1 and outcome["wide"].gap_detected == 0
    assert run.next()[("resolved", 0)] == 3 and run.next()[("double", 0)] == 3 and run.next()[("gap", 0)] == 1

    run.feed({("double", 0): [1, 3]}, after=5 * MIN)
    third = run.next()
    metrics = {r.topic: r for r in run.flow.batch_metrics(2).where("partition = 0").collect()}
    assert (metrics["gap"].gap_timeout_skip, metrics["gap"].offsets_gap, metrics["gap"].offsets_written) == (1, 1, 1)
    assert metrics["gap"].offsets_contiguously_acked == 2 and metrics["gap"].offsets_pending_commit == 0
    assert metrics["success"].contiguous_advance_size == 0 and metrics["double"].offsets_written == 1
    assert third[("gap", 0)] == third[("gap_failed", 0)] == 3 and third[("wide", 0)] == 5
    assert third[("two", 0)] == 3  # the second gap starts a wait of its own
    assert third[("head", 0)] == 51

    run.feed({("wide", 0): [2, 5]}, after=6 * MIN)
    last = run.next()
    assert last[("two", 0)] == 5 and last[("wide", 0)] == 6 and last[("double", 0)] == 4

    told = {(r.batch_id, r.topic): r for r in run.flow.commits.metrics().where("partition = 0").collect()}
    assert told[0, "success"].offsets_contiguously_acked == 2 and told[0, "success"].checkpoint_update_success == 1
    assert (told[2, "gap"].handled_offsets_seen, told[2, "gap"].commit_timer_fired, told[1, "gap"].commit_timer_armed) == (2, 1, 0)
    assert (told[1, "resolved"].offsets_contiguously_acked, told[2, "head"].handled_offsets_seen) == (2, 51)
    assert (0, "head") not in told  # nothing of it was handled yet
    assert not any(r.no_progress_buffered or r.checkpoint_update_failure or r.stale_offsets_ignored for r in told.values())

    raw = run.raw()
    assert raw["success"] == [0, 1] and raw["failed"] == [0, 2] and raw["gap_failed"] == [0]
    assert raw["invalid"] == [0, 2] and raw["resolved"] == [0, 1, 2] and raw["double"] == [0, 1, 2, 3]
    assert raw["wide"] == [0, 4, 5] and raw["two"] == [0, 2, 4] and raw["head"] == [50]
    assert run.table(run.flow.gaps, "topic", "missing_offset", "last_missing_offset") == [
        ("gap", 1, 1), ("gap_failed", 1, 1), ("head", 0, 49), ("many", 1, 4), ("two", 1, 1), ("two", 3, 3), ("wide", 1, 3),
    ]
    assert run.table(run.flow.late, "topic", "offset") == [("double", 1), ("wide", 2)]
    assert run.refused() == [("failed", "boom"), ("gap_failed", "boom")]


def test_zero_timeout_declares_all_gaps_at_once(spark, root):
    run = Run(spark, root, gap_timeout_s=0).feed({("t", 0): [3, 7]})
    assert run.next() == {("t", 0): 8} and run.raw() == {"t": [3, 7]}
    assert run.table(run.flow.gaps, "missing_offset", "last_missing_offset") == [(0, 2), (4, 6)]


def test_replayed_batch_changes_nothing_and_a_new_run_resumes(spark, root):
    run = Run(spark, root).feed({("t", 0): [0, 1]}).feed({("t", 0): [2, 4]})
    before = (run.raw(), run.next())
    assert before == ({"t": [0, 1, 2]}, {("t", 0): 3})
    run.batch -= 1
    run.feed({("t", 0): [2, 4]}, after=5 * SEC)
    assert (run.raw(), run.next()) == before

    run.batch = -1
    run.feed({("t", 0): [0, 1]})  # even the first batch, although its commit stands
    assert (run.raw(), run.next()) == before

    second = Run(spark, root, run_id="r2")
    second.feed({("t", 0): [0, 1, 2, 3, 4]})  # the log is read again from its start
    assert second.raw() == {"t": [0, 1, 2, 3, 4]} and second.next() == {("t", 0): 5}


def test_commits_wait_for_the_topic_interval_and_rows_go_to_its_table(spark, root):
    routing = spark.createDataFrame(
        [("a", "ds", None, 10), ("b", "ds", "tb", None)],
        "topic string, dataset string, table string, commit_interval_seconds long",
    )
    run = Run(spark, root, routing=routing, commit_interval_s=60)
    run.feed({("a", 0): [1], ("b", 0): [0], ("unrouted", 0): [0]})
    assert run.next() == {}
    run.feed({("a", 0): [0, 2]}, after=SEC)
    run.feed({}, after=15 * SEC)
    assert run.next() == {("a", 0): 3}
    run.feed({}, after=60 * SEC)
    assert run.next() == {("a", 0): 3, ("b", 0): 1} and run.flow.checkpoint.entries().count() == 2
    found = {(r.kafka_topic, r.destination) for r in run.flow.raw_table().collect()}
    assert found == {("a", "ds.KAFKA_RAW_MESSAGE"), ("b", "ds.tb")}


def test_state_matches_batch_formula_on_any_arrival_order(spark, root):
    offsets = [o for o in range(40) if o not in (7, 8, 21)]
    orders = [offsets[::-1], offsets[1::2] + offsets[::2]]
    run = Run(spark, root, gap_timeout_s=0)
    run.feed({(f"order{i}", 0): order for i, order in enumerate(orders)})
    rows = [(f"order{i}", 0, o, None, None, "x") for i in range(len(orders)) for o in offsets]
    batch = account(spark.createDataFrame(rows, LOG_RECORD))
    assert run.next() == {(r.topic, r.partition): r.next_offset for r in batch.frontier.select(*KEY, "next_offset").collect()}
    declared = {(r.topic, r.start_offset, r.end_offset) for r in batch.gaps.collect()}
    assert set(run.table(run.flow.gaps, "topic", "missing_offset", "last_missing_offset")) == declared


@pytest.mark.parametrize("metadata", ["flat", "none"])
def test_an_older_table_loses_no_offset(spark, root, metadata):
    """The table was made without nested metadata; a newer flow goes on writing to it."""
    flat = [{"name": f, "type": t, "mode": "NULLABLE"} for f, t in (("_meta_kafka_topic", "STRING"), ("_meta_kafka_partition", "INTEGER"), ("_meta_kafka_offset", "INTEGER"))]
    older = [{"name": "raw_message", "type": "STRING", "mode": "REQUIRED"}] + (flat if metadata == "flat" else [])
    Run(spark, root, run_id="old", fields=older)
    run = Run(spark, root, run_id="new").feed({("t", 0): [0, 1, 3, 2], ("u", 1): [0]}, invalid={("t", 1)})
    assert run.next() == {("t", 0): 4, ("u", 1): 1}
    rows = run.flow.raw_table()
    assert set(rows.columns) == {f["name"] for f in older} | {"version", "destination", "ingest_date", "run_id", "batch_id"} and rows.count() == 4
    if metadata == "flat":
        assert sorted((r["_meta_kafka_topic"], r["_meta_kafka_offset"]) for r in rows.collect()) == [("t", 0), ("t", 2), ("t", 3), ("u", 0)]


def test_files_stay_few_and_no_staged_file_is_opened_in_vain(spark, root, monkeypatch):
    """Behind an open gap batches stage their records; none of them is read again until the gap closes."""
    run = Run(spark, root, gap_timeout_s=10_000, compact_every=3)
    opened = []
    read = run.flow.staged.read_overlapping
    monkeypatch.setattr(run.flow.staged, "read_overlapping", lambda *a: (lambda df: opened.append(len(df.inputFiles())) or df)(read(*a)))
    for n in range(5):
        run.feed({("t", 0): range(1 + n * 3, 4 + n * 3), ("free", 0): range(n * 2, n * 2 + 2)})
    assert opened == [0] * 4 and run.next() == {("free", 0): 10}
    assert run.flow.raw.entries().select("file").distinct().count() <= 6
    run.feed({("t", 0): [0]})
    assert opened[-1] >= 5 and run.next() == {("free", 0): 10, ("t", 0): 16}
    assert run.raw() == {"free": list(range(10)), "t": list(range(16))}
