"""The commit stage as a step per batch: handled offsets in, checkpoint and counters out.

State is one row per key and the ranges of handled offsets beyond its frontier.
A step computes both anew from packed ranges, so it costs by ranges and keys,
not by offsets, and a hot key is spread by offset. The one row per key that a
step writes holds its counters too; their totals are observed in the same pass,
and they decide whether the store has to be updated.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import frontier as fr
from ..operators.metrics import distribution, sketched
from ..operators.ranges import floor_ranges, merge_ranges
from ..operators.sizes import Cached, with_known_size
from ..schemas import KEY, OFFSET_RANGE
from ..sources.checkpoint import CheckpointLog
from ..sources.shared import read_or_empty
from ..sources.tables import BatchTable, read_table

_ADDRESS = OFFSET_RANGE.fields[:2]

#: What a step counts for each key. Offsets count as often as they came.
COUNTERS = (
    "handled_offsets_seen",  # all that came
    "invalid_partition_keys_dropped",  # rows without topic, partition or offset, on a row without a key
    "stale_offsets_ignored",  # below the frontier before the step
    "no_progress_buffered",  # beyond the frontier after it
    "offsets_contiguously_acked",  # how far the frontier moved
    "pending_ack_updated",  # 1 if it moved
    "commit_timer_armed",  # 1 if the key began to wait for its commit
    "commit_timer_fired",  # 1 if that wait was over
    "commit_timer_fired_without_pending_ack",  # 1 if the store had as much by then
    "checkpoint_commit_attempted",
    "buffered_state_size",  # distinct offsets that wait beyond the frontier
)

STEP = T.StructType([
    *_ADDRESS,
    T.StructField("frontier", T.LongType()),
    T.StructField("committed_next", T.LongType()),
    T.StructField("pending_since_ms", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in COUNTERS],
])

#: One row per attempt to update the store; the counts are keys.
UPDATE = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("checkpoint_update_requested", T.LongType()),
    T.StructField("checkpoint_update_success", T.LongType()),
    T.StructField("checkpoint_update_failure", T.LongType()),
    T.StructField("checkpoint_update_dispatch_latency_ms", T.LongType()),
])

_END = 2**63 - 2


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _or_zero(name: str) -> Column:
    return F.coalesce(name, _zero())


def _within(low: Column, high: Column) -> Column:
    """How many offsets of a range lie in ``low .. high - 1``."""
    return F.greatest(F.least("end_offset", high - 1) - F.greatest("start_offset", low) + 1, _zero())


class CommitFlow:
    """The commit stage of one run below ``root``."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, checkpoint: CheckpointLog, job_id: str = "tidemark"):
        self.spark, self.run_id, self.checkpoint, self.job_id = spark, run_id, checkpoint, job_id
        self.steps = BatchTable(f"{root}/state/commit", run_id)
        self.open = BatchTable(f"{root}/state/open", run_id)
        self.updates_path = f"{root}/checkpoint_updates"

    def begin(self, floors: DataFrame) -> None:
        """Write the state before the first batch from ``topic, partition, next_offset``, unless it is there."""
        if self.steps.read_batch(self.spark, -1, STEP) is None:
            nothing = [_zero().alias(c) for c in COUNTERS]
            known = [F.col("next_offset").alias("frontier"), F.col("next_offset").alias("committed_next")]
            never = F.lit(None).cast("bigint").alias("pending_since_ms")
            self.open.write(self.spark.createDataFrame([], OFFSET_RANGE), -1)
            self.steps.write(floors.select(*KEY, *known, never, *nothing), -1)

    def state(self, batch_id: int) -> DataFrame:
        """One row per key after a batch, with the counters of its step."""
        found = self.steps.read_batch(self.spark, batch_id, STEP)
        if found is None:
            raise FileNotFoundError(f"no state of batch {batch_id} in run {self.run_id}: start a new run_id")
        return found

    def metrics(self) -> DataFrame:
        """Counters of all steps of this run: one row per batch and key, with what the store made of its commits."""
        rows = read_table(self.spark, self.steps.path, STEP).where((F.col("run_id") == self.run_id) & (F.col("batch_id") >= 0))
        tried = self.updates().where(F.col("run_id") == self.run_id).groupBy("batch_id").agg(
            F.count("*").alias("requested"), F.count_if(F.col("checkpoint_update_success") > 0).alias("success"), F.count_if(F.col("checkpoint_update_failure") > 0).alias("failure")
        )
        told = [(F.col("checkpoint_commit_attempted") * _or_zero(c)).alias(f"checkpoint_update_{c}") for c in ("requested", "success", "failure")]
        return rows.join(tried, "batch_id", "left").select("batch_id", *KEY, *COUNTERS, *told)

    def updates(self) -> DataFrame:
        """All attempts to update the store, failed ones too."""
        return read_or_empty(self.spark, self.updates_path, UPDATE)

    def distributions(self) -> DataFrame:
        """Per key: how far steps moved its frontier, and how many offsets waited beyond it after each step."""
        rows = self.metrics().where("topic is not null")
        moved = distribution(sketched(rows.where("offsets_contiguously_acked > 0"), "offsets_contiguously_acked"), "contiguous_advance_size")
        return distribution(sketched(rows, "buffered_state_size"), "buffered_state_size").join(moved, KEY, "left")

    def update_latency(self) -> DataFrame:
        """How long updates of the store took, over all attempts of all runs."""
        timed = self.updates().withColumn("store", F.lit(self.checkpoint.path))
        return distribution(sketched(timed, "checkpoint_update_dispatch_latency_ms", ("store",)), "checkpoint_update_dispatch_latency_ms", ("store",))

    def process(
        self, handled: DataFrame, batch_id: int, now_ms: int, interval_ms: float, intervals: DataFrame | None = None,
        disjoint: bool = False,
    ) -> dict[str, int]:
        """One step over ``topic, partition, start_offset, end_offset``; returns its totals.

        Ranges may repeat offsets; rows without a key or an offset are counted and left out. ``disjoint`` says that
        no offset comes twice, ever. A key waits ``interval_ms`` from the move of its frontier to its commit, or as
        long as ``intervals`` (``topic, interval_ms``) says for its topic.
        """
        with Cached() as cached:
            return self._process(handled, batch_id, now_ms, interval_ms, intervals, disjoint, cached)

    def _frontier(self, known: DataFrame, waiting: DataFrame, before: DataFrame, disjoint: bool, cached: Cached) -> DataFrame:
        """``topic, partition, next_offset`` of every key after the step.

        Of disjoint ranges, a key whose widths add up to the distance from its frontier to its last offset has no
        hole. Only if some key's do not, ranges are put in order.
        """
        floors = before.select(*KEY, F.col("frontier").alias("next_offset"))
        ranges = known.unionByName(waiting)
        if disjoint:
            summed = cached(
                ranges.unionByName(floor_ranges(floors)).groupBy(*KEY).agg(
                    F.sum(F.col("end_offset") - F.col("start_offset") + 1).alias("n"), (F.max("end_offset") + 1).alias("next_offset")
                )
            )
            if summed.where("n <> next_offset").isEmpty():
                return summed.drop("n")
        return fr.commit_frontier(ranges, floors).select(*KEY, "next_offset")

    def _process(
        self, handled: DataFrame, batch_id: int, now_ms: int, interval_ms: float, intervals: DataFrame | None,
        disjoint: bool, cached: Cached,
    ) -> dict[str, int]:
        before = self.state(batch_id - 1).where("topic is not null").select(*KEY, "frontier", "committed_next", "pending_since_ms")
        waiting = self.open.read_batch(self.spark, batch_id - 1, OFFSET_RANGE)
        valid = F.expr("topic is not null and partition is not null and start_offset is not null and end_offset is not null")
        came = cached(handled.select(*[F.when(valid, F.col(c)).alias(c) for c in OFFSET_RANGE.fieldNames()]))
        known = came.where("topic is not null")

        frontier = self._frontier(known, waiting, before, disjoint, cached)
        marks = with_known_size(
            frontier.join(before, KEY, "left").select(*KEY, _or_zero("frontier").alias("was"), F.col("next_offset").alias("now"), _or_zero("committed_next").alias("committed_next"), "pending_since_ms")
        )
        # ``marks`` has one row per key and a known size, so ranges are not shuffled to meet it.
        counted = came.join(marks.select(*KEY, "was", "now"), KEY, "left").groupBy(*KEY).agg(
            F.sum(F.when(F.col("topic").isNull(), 1).otherwise(_within(_zero(), F.lit(_END)))).alias("handled_offsets_seen"),
            F.count_if(F.col("topic").isNull()).alias("invalid_partition_keys_dropped"),
            F.sum(_within(_zero(), F.col("was"))).alias("stale_offsets_ignored"),
            F.sum(_within(F.col("now"), F.lit(_END))).alias("no_progress_buffered"),
        )
        beyond = fr.buffered_handled(known.unionByName(waiting), marks.select(*KEY, F.col("now").alias("next_offset")), sized=True)
        self.open.write(merge_ranges(beyond.select(*OFFSET_RANGE.fieldNames()), disjoint), batch_id)
        held = self.open.read_batch(self.spark, batch_id, OFFSET_RANGE).groupBy(*KEY).agg(
            F.sum(F.col("end_offset") - F.col("start_offset") + 1).alias("buffered_state_size")
        )

        observed = Observation()
        step = self._timed(marks, now_ms, interval_ms, intervals)
        step = step.join(held, KEY, "left").join(counted.where("topic is not null"), KEY, "left")
        keyless = counted.where("topic is null")
        rows = step.unionByName(keyless, allowMissingColumns=True).select(*KEY, "frontier", "committed_next", "pending_since_ms", *[_or_zero(c).alias(c) for c in COUNTERS])
        self.steps.write(rows.observe(observed, *[F.coalesce(F.sum(c), _zero()).alias(c) for c in COUNTERS]), batch_id)
        totals = dict(observed.get)
        if totals["checkpoint_commit_attempted"]:
            due = self.state(batch_id).where("checkpoint_commit_attempted > 0").select(*KEY, (F.col("frontier") - 1).alias("last_acked"))
            self._update(due, batch_id, now_ms, totals["checkpoint_commit_attempted"])
        return totals

    def _timed(self, marks: DataFrame, now_ms: int, interval_ms: float, intervals: DataFrame | None) -> DataFrame:
        """The keys with their waits for a commit, and what becomes of them now."""
        stored = self.checkpoint.current().select(*KEY, F.col("next_offset").alias("stored"))
        own = F.lit(None).cast("double")
        if intervals is not None:
            marks = marks.join(intervals.select("topic", F.col("interval_ms").alias("own_ms")), "topic", "left")
            own = F.col("own_ms")
        now, flag = F.lit(now_ms).cast("bigint"), lambda c: c.cast("bigint")
        since = F.when(F.col("now") > F.col("committed_next"), F.coalesce("pending_since_ms", now))
        fired = F.coalesce(now - F.col("since") >= F.coalesce(own, F.lit(interval_ms)), F.lit(False))
        ahead = F.col("now") > _or_zero("stored")
        return marks.withColumn("since", since).withColumn("fired", fired).join(stored, KEY, "left").select(
            *KEY,
            F.col("now").alias("frontier"),
            F.when(F.col("fired"), F.greatest("now", _or_zero("stored"))).otherwise(F.col("committed_next")).alias("committed_next"),
            F.when(~F.col("fired"), F.col("since")).alias("pending_since_ms"),
            (F.col("now") - F.col("was")).alias("offsets_contiguously_acked"),
            flag(F.col("now") > F.col("was")).alias("pending_ack_updated"),
            flag(F.col("pending_since_ms").isNull() & F.col("since").isNotNull()).alias("commit_timer_armed"),
            flag(F.col("fired")).alias("commit_timer_fired"),
            flag(F.col("fired") & ~ahead).alias("commit_timer_fired_without_pending_ack"),
            flag(F.col("fired") & ahead).alias("checkpoint_commit_attempted"),
        )

    def _update(self, acked: DataFrame, batch_id: int, now_ms: int, keys: int) -> None:
        """Commit to the store and note the attempt; a failed one is raised after it is noted."""
        started, done = time.perf_counter(), 0
        try:
            self.checkpoint.append(acked, self.job_id, now_ms, tag=f"{self.run_id}-{batch_id}")
            done = keys
        finally:
            took = int((time.perf_counter() - started) * 1000)
            row = [(self.run_id, batch_id, keys, done, keys - done, took)]
            self.spark.createDataFrame(row, UPDATE).write.mode("append").parquet(self.updates_path)
