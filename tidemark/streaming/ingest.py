"""Continuous ingestion: log to raw table, with quarantine, audit and checkpoint.

One ``foreachBatch`` step per trigger. Every output of a batch goes to the
directory of that batch and replaces a failed attempt; state is read from the
previous batch's directory and written to this one's, so a lost executor or a
restarted driver repeats the step from durable input. The order of writes is
data first, then handled offsets, then the checkpoint, so a crash can only
repeat records, not lose them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import handled as hd
from ..operators import metrics as mt
from ..operators.conform import check, fit
from ..operators.evolution import RecordedSchema, with_flat_metadata
from ..operators.envelope import is_valid, to_envelope, to_raw_rows
from ..operators.ordering import gap_audit, in_a_log
from ..operators.ranges import merge_words, pack_offsets, unpack_ranges
from ..operators.routing import one_route_per_topic, with_route
from ..operators.schema_defs import RAW_MESSAGE_FIELDS, struct_type
from ..operators.sizes import Cached, with_known_size
from ..schemas import (
    DEFAULT_COMMIT_INTERVAL_SECONDS,
    DEFAULT_GAP_TIMEOUT_SECONDS,
    DEFAULT_TABLE,
    DEFAULT_WINDOW_SECONDS,
    HANDLED_RANGE,
    INVALID_KEYWORD,
    KEY,
    LOG_RECORD,
    OFFSET_RANGE,
    RAW_METADATA,
)
from ..sources.checkpoint import CheckpointLog
from ..sources.log import LogSpec, read_log, resume, starting_offsets
from ..sources.manifest import FLAT_ADDRESS, RAW_ADDRESS, PublishedTable
from ..sources.tables import BatchTable, with_ingest_date
from ..sources.versions import Versions
from . import micro_order as mo
from .commit_flow import CommitFlow

_KEY_FIELDS = OFFSET_RANGE.fields[:2]

KEY_STATE = T.StructType([
    *_KEY_FIELDS, T.StructField("next_offset", T.LongType()), T.StructField("gap_since_ms", T.LongType()),
])

STAGED = T.StructType([
    *_KEY_FIELDS,
    T.StructField("offset", T.LongType()),
    T.StructField("payload", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

LATE = T.StructType(STAGED.fields)


def _clock() -> int:
    return int(time.time() * 1000)


@dataclass
class Ingest:
    """One run of the flow. A new run gets a new ``run_id``."""

    spark: SparkSession
    root: str
    run_id: str
    job_id: str = "tidemark"
    gap_timeout_s: float = DEFAULT_GAP_TIMEOUT_SECONDS
    commit_interval_s: float = DEFAULT_COMMIT_INTERVAL_SECONDS
    routing: DataFrame | None = None
    fields: list[dict] = field(default_factory=lambda: RAW_MESSAGE_FIELDS)
    rules: dict[str, Column] = field(default_factory=dict)
    keyword: str = INVALID_KEYWORD
    clock: Callable[[], int] = _clock
    compact_every: int | None = 50

    def __post_init__(self) -> None:
        self.checkpoint = CheckpointLog(self.spark, f"{self.root}/checkpoint")
        self.commits = CommitFlow(self.spark, self.root, self.run_id, self.checkpoint, self.job_id)
        # An older table keeps the schema it was made with. Without metadata in it, its files do not tell what they hold.
        self.layout = RecordedSchema(self.spark, f"{self.root}/raw").of(struct_type(self.fields))
        names = self.layout.fieldNames()
        address = RAW_ADDRESS if RAW_METADATA in names else FLAT_ADDRESS if set(FLAT_ADDRESS) <= set(names) else None
        self.raw = PublishedTable(self.spark, f"{self.root}/raw", self.run_id, address)
        self.quarantine = PublishedTable(self.spark, f"{self.root}/quarantine", self.run_id, RAW_ADDRESS)
        self.staged = PublishedTable(self.spark, f"{self.root}/staged", self.run_id)
        self.instants = Versions(self.spark, f"{self.root}/state/instants/run_id={self.run_id}")
        self.gaps = self._table("gap_audit")
        self.late = self._table("late")
        self.handled = self._table("handled")
        self.keys = self._table("state/keys")
        self.ranges = self._table("state/ranges")
        self.decisions = self._table("state/decisions")
        self._routes = self._intervals = None
        if self.routing is not None:
            own = F.when(F.col("commit_interval_seconds") > 0, F.col("commit_interval_seconds") * 1000.0)
            routes = one_route_per_topic(with_route(self.routing)).select("topic", "destination", own.alias("interval_ms"))
            self._routes = with_known_size(routes)
            self._intervals = self._routes.select("topic", "interval_ms")

    def _table(self, name: str) -> BatchTable:
        return BatchTable(f"{self.root}/{name}", self.run_id)

    # State

    def _state(self, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Keys and waiting ranges after ``batch_id``; for -1 those of the start of the run."""
        keys = self.keys.read_batch(self.spark, batch_id, KEY_STATE)
        if keys is None and batch_id >= 0:
            raise FileNotFoundError(f"no state of batch {batch_id} in run {self.run_id}: start a new run_id")
        if keys is None:
            # Kept as a batch of its own: a retry of batch 0 must not start from
            # what its first attempt committed.
            start = self.checkpoint.current().select(*KEY, "next_offset", F.lit(None).cast("bigint").alias("gap_since_ms"))
            self.ranges.write(self.spark.createDataFrame([], OFFSET_RANGE), batch_id)
            self.keys.write(start, batch_id)
            keys = self.keys.read_batch(self.spark, batch_id, KEY_STATE)
        self.commits.begin(self.keys.read_batch(self.spark, -1, KEY_STATE))
        return keys, self.ranges.read_batch(self.spark, batch_id, OFFSET_RANGE)

    def _instant(self, batch_id: int) -> int:
        """The time of a batch: that of its first attempt, so a repeated one writes equal rows."""
        if not self.instants.has(batch_id):
            self.instants.put(batch_id, {"now_ms": self.clock()})
        return self.instants.get(batch_id)["now_ms"]

    # One batch

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` step."""
        with Cached() as cached:
            self._process(batch, batch_id, cached)

    def _process(self, batch: DataFrame, batch_id: int, cached: Cached) -> None:
        now = self._instant(batch_id)
        arrivals = to_envelope(batch.where("topic is not null"), keep=("timestamp",))
        if self._routes is not None:
            arrivals = arrivals.join(self._routes.select("topic"), "topic")
        arrivals = in_a_log(arrivals)
        arrivals = cached(arrivals.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
        keys, waiting = self._state(batch_id - 1)
        some_wait = not waiting.isEmpty()
        words = cached(pack_offsets(arrivals))
        fresh = cached(unpack_ranges(words))

        decided, all_gaps = mo.decide(fresh, waiting if some_wait else None, keys, now, int(self.gap_timeout_s * 1000), cached)
        self.decisions.write(decided, batch_id)
        decisions = self.decisions.read_batch(self.spark, batch_id, mo.DECISION)
        found = decisions.agg(
            F.bool_or(F.col("gap_since_ms").isNotNull()).alias("waits"),
            F.bool_or(F.col("skipped") > 0).alias("skips"),
        ).first()
        arrived = arrivals.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if some_wait:
            # Of all that was ever staged, only files that hold offsets released now are opened.
            moved = decisions.where("expected > expected_before").select(
                *KEY, F.col("expected_before").alias("start_offset"), (F.col("expected") - 1).alias("end_offset")
            )
            again = self.staged.read_overlapping(moved, STAGED).where(F.col("batch_id") < batch_id).drop("run_id")
            arrived, words = arrived.unionByName(again), merge_words(words, pack_offsets(again))
        tagged = cached(self._sink(mo.released(arrived, decisions, words), now))
        handled = self._write_rows(tagged, batch_id, now)
        late = mo.late(arrivals, decisions)
        if not late.isEmpty():
            self.late.write(late.select(*LATE.fieldNames()), batch_id)
        if found.skips:
            gaps = mo.declared(all_gaps, decisions)
            self.gaps.write(gap_audit(gaps, int(self.gap_timeout_s * 1000)), batch_id)
            handled = hd.merge_handled(handled, hd.gap_ranges_handled(gaps))
        # Written and rejected rows count as handled only now that both writes are done.
        self.handled.write(handled, batch_id)

        still = self.spark.createDataFrame([], OFFSET_RANGE)
        if found.waits:
            # Below what was expected before this batch nothing is read again, not even if the batch is repeated.
            floors = decisions.select(*KEY, F.col("expected_before").alias("next_offset"))
            self.staged.write(mo.held_back(arrivals, decisions).select(*STAGED.fieldNames()), batch_id, floors=floors)
            still = mo.still_waiting(fresh, waiting, decisions)
        self.ranges.write(still.select(*OFFSET_RANGE.fieldNames()), batch_id)
        done = self.handled.read_batch(self.spark, batch_id, HANDLED_RANGE).select(*OFFSET_RANGE.fieldNames())
        self.commits.process(done, batch_id, now, self.commit_interval_s * 1000, self._intervals, disjoint=True)
        self.keys.write(decisions.select(*KEY, F.col("expected").alias("next_offset"), "gap_since_ms"), batch_id)
        self._tidy(batch_id)

    def _tidy(self, batch_id: int) -> None:
        """Fewer files for batches that cannot be repeated any more."""
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.raw.compact(self.layout, batch_id - 1, ("destination", "ingest_date"))
            self.quarantine.compact(self._bad_layout(), batch_id - 1, ("destination", "ingest_date"))

    def _bad_layout(self) -> T.StructType:
        return T.StructType(struct_type(RAW_MESSAGE_FIELDS).fields + [T.StructField("error", T.StringType())])

    def _sink(self, in_order: DataFrame, now: int) -> DataFrame:
        """Raw rows of all released records with ``reason`` and ``error``."""
        broken = {n: f"_rule_{i}" for i, n in enumerate(self.rules)}
        marked = in_order.select(
            "*", is_valid(self.keyword).alias("_valid"), *[c.alias(broken[n]) for n, c in self.rules.items()]
        )
        rows = to_raw_rows(marked, now, keep=(*KEY, "offset", "_valid", *broken.values()))
        checked = check(with_flat_metadata(rows, self.layout), self.layout, {n: F.col(c) for n, c in broken.items()})
        reason = F.when(~F.col("_valid"), "dropped").when(F.col("error").isNotNull(), "rejected").otherwise("written")
        tagged = checked.withColumn("reason", reason).drop("_valid", *broken.values())
        if self._routes is None:
            return tagged.withColumn("destination", F.lit(DEFAULT_TABLE))
        return tagged.join(self._routes.select("topic", "destination"), "topic")

    def _write_rows(self, tagged: DataFrame, batch_id: int, now: int) -> DataFrame:
        """Write the rows that fit and those that don't; what is handled is what the published files hold."""
        into = ("destination", "ingest_date")
        ok = fit(tagged.where("reason = 'written'"), self.layout, keep=("destination",))
        written = self.raw.write(with_ingest_date(ok, now), batch_id, into)
        bad = tagged.where("reason = 'rejected'").select(*self._bad_layout().fieldNames(), "destination")
        told = [(written, "written")]
        if not bad.isEmpty():
            told.append((self.quarantine.write(with_ingest_date(bad, now), batch_id, into), "rejected"))
        if self.raw.address is None:
            return hd.handled_ranges(tagged)
        held = [entries.where("start_offset is not null").select(*OFFSET_RANGE.fieldNames(), F.lit(r).alias("reason")) for entries, r in told]
        return hd.merge_handled(hd.handled_ranges(tagged.where("reason = 'dropped'")), *held)

    # Running

    def start(
        self, log: LogSpec, query_checkpoint: str, trigger_s: float = DEFAULT_WINDOW_SECONDS,
        partitions: dict[str, int] | None = None, heartbeat: bool = True,
    ) -> StreamingQuery:
        """Run on a live log. ``query_checkpoint`` belongs to this ``run_id``.

        Reading starts where the checkpoint stood when the run began: Kafka seeks
        there, a file log is filtered. ``heartbeat`` adds an empty tick to each
        trigger, so gap timeouts and commits come due on a silent log.
        """
        begin = self._state(-1)[0].select(*KEY, "next_offset")
        if log.format == "segments":
            records = read_log(self.spark, log, streaming=True, floors=begin)
        elif log.format == "kafka" and (partitions or begin.isEmpty()):
            records = read_log(self.spark, log, streaming=True, starting=starting_offsets(begin, log.topics, partitions))
        else:
            # A file log is filtered, and so is Kafka where no counts of partitions are given.
            records = resume(read_log(self.spark, log, streaming=True), begin)
        records = records.observe("arrivals", F.count(F.lit(1)).alias("records"), F.count_if(F.col("value").isNull()).alias("without_payload"))
        if heartbeat:
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in LOG_RECORD.fields]
            beats = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            records = records.select(*LOG_RECORD.fieldNames()).unionByName(beats.select(*empty))
        return (
            records.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", query_checkpoint)
            .trigger(processingTime=f"{trigger_s} seconds")
            .start()
        )

    # Reading back

    def batch_metrics(self, batch_id: int) -> DataFrame:
        """Per key: what one batch did, from the tables it wrote."""
        done = self.handled.read_batch(self.spark, batch_id, HANDLED_RANGE)
        outcome = mt.gap_outcomes(self.decisions.read_batch(self.spark, batch_id, mo.DECISION))
        step = self.commits.state(batch_id)
        was = self.commits.state(batch_id - 1)
        return (
            outcome.join(mt.handled_by_reason(done), KEY, "left")
            .join(mt.frontier_progress(was, step), KEY, "left")
            .join(step.drop("frontier", "committed_next", "pending_since_ms", "offsets_contiguously_acked"), KEY, "left")
            .na.fill(0)
        )

    def raw_table(self) -> DataFrame:
        """All published rows, with ``destination``, ``ingest_date``, ``run_id`` and ``batch_id``."""
        return self.raw.read(self.layout, ("destination", "ingest_date"))

    def quarantine_table(self) -> DataFrame:
        """All published rows that the table refused, with their ``error``."""
        return self.quarantine.read(self._bad_layout(), ("destination", "ingest_date"))
