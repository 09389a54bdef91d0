"""The commit stage step by step, with counters told by hand."""

import pytest

from tidemark.schemas import KEY
from tidemark.sources.checkpoint import CheckpointLog
from tidemark.streaming.commit_flow import COUNTERS, CommitFlow

SEC = 1000


class Stage:
    def __init__(self, spark, root, interval_s=1, seed=(), run_id="r"):
        self.spark, self.now, self.n, self.interval = spark, 1_000_000, -1, interval_s * SEC
        self.store = CheckpointLog(spark, f"{root}/checkpoint")
        self.flow = CommitFlow(spark, root, run_id, self.store)
        self.flow.begin(spark.createDataFrame(list(seed), "topic string, partition int, next_offset long"))

    def step(self, handled, after=0, **kw):
        """``handled``: (topic, partition, offset) or (topic, partition, start, end); returns counters by key, without zeros."""
        self.now, self.n = self.now + after * SEC, self.n + 1
        rows = [(h[0], h[1], h[2], h[-1]) for h in handled]
        came = self.spark.createDataFrame(rows, "topic string, partition int, start_offset long, end_offset long")
        totals = self.flow.process(came, self.n, self.now, self.interval, **kw)
        rows = self.flow.state(self.n).collect()
        assert totals == {c: sum(r[c] for r in rows) for c in COUNTERS}
        return {(r.topic, r.partition): {c: r[c] for c in COUNTERS if r[c]} for r in rows}

    def stored(self):
        return {(r.topic, r.partition): r.next_offset for r in self.store.current().collect()}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "flow")


def test_out_of_order_offsets_are_committed_once(spark, root):
    stage, key = Stage(spark, root), ("test", 0)
    assert stage.step([("test", 0, 1)]) == {key: {"handled_offsets_seen": 1, "no_progress_buffered": 1, "buffered_state_size": 1}}
    assert stage.step([("test", 0, 0), ("test", 0, 2)], after=1) == {
        key: {"handled_offsets_seen": 2, "offsets_contiguously_acked": 3, "pending_ack_updated": 1, "commit_timer_armed": 1}
    }
    assert stage.stored() == {}
    assert stage.step([], after=2) == {key: {"commit_timer_fired": 1, "checkpoint_commit_attempted": 1}}
    assert stage.stored() == {key: 3} and stage.step([], after=9) == {key: {}}
    told = stage.flow.metrics().where("batch_id = 2").first()
    assert (told.checkpoint_update_requested, told.checkpoint_update_success, told.checkpoint_update_failure) == (1, 1, 0)
    tried = stage.flow.updates().collect()
    assert [(r.batch_id, r.checkpoint_update_requested, r.checkpoint_update_success) for r in tried] == [(2, 1, 1)]
    assert tried[0].checkpoint_update_dispatch_latency_ms > 0
    spread = stage.flow.distributions().first()
    assert (spread.contiguous_advance_size_count, spread.contiguous_advance_size_p50, spread.contiguous_advance_size_max) == (1, 3, 3)
    assert (spread.buffered_state_size_count, spread.buffered_state_size_min, spread.buffered_state_size_p99, spread.buffered_state_size_sum) == (4, 0, 1, 1)
    spent = stage.flow.update_latency().first()
    assert spent.checkpoint_update_dispatch_latency_ms_count == 1 and spent.checkpoint_update_dispatch_latency_ms_p50 == tried[0].checkpoint_update_dispatch_latency_ms


def test_stale_repeated_and_keyless_offsets(spark, root):
    stage, key = Stage(spark, root, interval_s=0, seed=[("test", 0, 2)]), ("test", 0)
    got = stage.step([("test", 0, 0), ("test", 0, 1), ("test", 0, 2), ("test", 0, 2), ("test", 0, 9), (None, 0, 3), ("test", None, 3), ("test", 0, None)])
    assert got == {
        key: {"handled_offsets_seen": 5, "stale_offsets_ignored": 2, "no_progress_buffered": 1, "offsets_contiguously_acked": 1, "pending_ack_updated": 1,
              "commit_timer_armed": 1, "commit_timer_fired": 1, "checkpoint_commit_attempted": 1, "buffered_state_size": 1},
        (None, None): {"handled_offsets_seen": 3, "invalid_partition_keys_dropped": 3},
    }
    assert stage.stored() == {key: 3}
    assert stage.step([("test", 0, 3, 8), ("test", 0, 9)])[key]["offsets_contiguously_acked"] == 7
    assert stage.stored() == {key: 10}


def test_a_wait_that_ends_with_nothing_to_commit(spark, root):
    stage, key = Stage(spark, root, interval_s=5), ("test", 0)
    assert stage.step([("test", 0, 0, 4)])[key]["commit_timer_armed"] == 1
    ahead = spark.createDataFrame([("test", 0, 99)], "topic string, partition int, last_acked long")
    stage.store.append(ahead, "other", stage.now)
    assert stage.step([], after=5) == {key: {"commit_timer_fired": 1, "commit_timer_fired_without_pending_ack": 1}}
    assert stage.stored() == {key: 100} and stage.flow.updates().count() == 0
    assert stage.step([("test", 0, 5)], after=1)[key] == {"handled_offsets_seen": 1, "offsets_contiguously_acked": 1, "pending_ack_updated": 1}


def test_a_failed_update_is_noted_and_raised(spark, root, monkeypatch):
    stage = Stage(spark, root, interval_s=0)

    def refuse(*_, **__):
        raise OSError("store is away")

    monkeypatch.setattr(stage.store, "append", refuse)
    with pytest.raises(OSError):
        stage.step([("test", 0, 0)])
    monkeypatch.undo()
    stage.n -= 1
    assert stage.step([("test", 0, 0)])[("test", 0)]["checkpoint_commit_attempted"] == 1  # the batch again
    tried = sorted((r.checkpoint_update_requested, r.checkpoint_update_success, r.checkpoint_update_failure) for r in stage.flow.updates().collect())
    assert tried == [(1, 0, 1), (1, 1, 0)] and stage.stored() == {("test", 0): 1}
    told = stage.flow.metrics().first()
    assert (told.checkpoint_update_requested, told.checkpoint_update_success, told.checkpoint_update_failure) == (2, 1, 1)


def test_intervals_of_topics_and_disjoint_input(spark, root):
    stage = Stage(spark, root, interval_s=60, seed=[("a", 0, 10)])
    own = spark.createDataFrame([("b", 5000.0)], "topic string, interval_ms double")
    stage.step([("a", 0, 10, 12), ("b", 0, 0, 3), ("b", 1, 7, 9)], intervals=own, disjoint=True)
    got = stage.step([("b", 1, 0, 6)], after=6, intervals=own, disjoint=True)
    assert got[("b", 0)]["commit_timer_fired"] == 1 and "commit_timer_fired" not in got[("a", 0)]
    assert got[("b", 1)] == {"handled_offsets_seen": 7, "offsets_contiguously_acked": 10, "pending_ack_updated": 1, "commit_timer_armed": 1}
    assert stage.stored() == {("b", 0): 4}
    assert {(r.topic, r.partition): r.frontier for r in stage.flow.state(1).select(*KEY, "frontier").collect()} == {("a", 0): 13, ("b", 0): 4, ("b", 1): 10}


def test_an_unknown_batch_is_refused(spark, root):
    with pytest.raises(FileNotFoundError):
        Stage(spark, root).flow.state(5)
