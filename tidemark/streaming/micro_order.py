"""Offset order for one micro-batch, as joins, windows and aggregates.

The same rules as ``gap_processor``, but state is two small tables (one row per
key, and the ranges of offsets that wait behind a gap) and the decision per key
is computed from packed offsets. Records are compared with the decision where
they are, so a hot key is never moved into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import latest_per_offset
from ..operators.ranges import floor_ranges, gaps_in, merge_ranges
from ..operators.sizes import Cached
from ..schemas import KEY, OFFSET_RANGE

DECISION = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("expected_before", T.LongType()),
    T.StructField("expected", T.LongType()),
    T.StructField("gap_since_before", T.LongType()),
    T.StructField("gap_since_ms", T.LongType()),
    T.StructField("skipped", T.LongType()),
    T.StructField("skip_until", T.LongType()),
])


def _contiguous(fresh: DataFrame, keys: DataFrame) -> DataFrame:
    """Per key: number of offsets that arrived from its floor on, and where they end.

    ``fresh`` must be disjoint: then ``n = end - expected_before`` says, without
    any ordering, that no offset is missing.
    """
    start = F.coalesce("next_offset", F.lit(0).cast("bigint"))
    width = F.greatest(F.col("end_offset") + 1 - F.greatest(F.col("start_offset"), start), F.lit(0))
    known = keys.select(*KEY, "next_offset", "gap_since_ms")
    # ``keys`` comes from files, so its size is known and the ranges stay where they are; a full outer join would
    # shuffle them by key. Keys without arrivals are added from the side of the keys.
    moved = (
        fresh.join(known, KEY, "left")
        .groupBy(*KEY, start.alias("expected_before"), F.col("gap_since_ms").alias("gap_since_before"))
        .agg(F.coalesce(F.sum(width), F.lit(0)).alias("n"), F.max("end_offset").alias("last"))
    )
    quiet = known.join(moved.select(*KEY), KEY, "left_anti").select(
        *KEY, start.alias("expected_before"), F.col("gap_since_ms").alias("gap_since_before"), F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("bigint").alias("last"),
    )
    return moved.unionByName(quiet).withColumn("end", F.greatest(F.col("last") + 1, F.col("expected_before")))


def decide(
    fresh: DataFrame, waiting: DataFrame | None, keys: DataFrame, now_ms: int, timeout_ms: int, cached: Cached
) -> tuple[DataFrame, DataFrame | None]:
    """(one decision per key, all gaps or None).

    ``fresh`` holds the disjoint offset ranges that arrived now, ``waiting`` those
    that wait behind a gap (None if nothing does); ``keys`` has ``next_offset,
    gap_since_ms``. A key releases up to its first gap. If that gap has waited for
    the timeout it is skipped and the run behind it is released too, and a next
    gap starts a wait of its own. A timeout of 0 skips all gaps at once.
    """
    if waiting is None:
        counted = cached(_contiguous(fresh, keys))
        if counted.where("n <> end - expected_before").isEmpty():
            none = F.lit(None).cast("bigint")
            return counted.select(
                *KEY, "expected_before", F.col("end").alias("expected"), "gap_since_before",
                none.alias("gap_since_ms"), F.lit(0).cast("bigint").alias("skipped"), none.alias("skip_until"),
            ), None
        waiting = fresh.where("false")
    seen = fresh.select(*KEY, "start_offset", "end_offset").unionByName(
        waiting.select(*KEY, "start_offset", "end_offset")
    )
    gaps = cached(gaps_in(seen, keys, disjoint=True))
    last = seen.unionByName(floor_ranges(keys)).groupBy(*KEY).agg(F.max("end_offset").alias("last"))
    first = gaps.groupBy(*KEY).agg(F.min("start_offset").alias("first_gap"))
    now = F.lit(now_ms).cast("bigint")
    start = F.coalesce("next_offset", F.lit(0).cast("bigint"))
    same_wait = (F.col("first_gap") == start) & F.col("gap_since_ms").isNotNull()
    since = F.when(F.col("first_gap").isNotNull(), F.when(same_wait, F.col("gap_since_ms")).otherwise(now))
    at_gap = cached(
        last.join(first, KEY, "left")
        .join(keys.select(*KEY, "next_offset", "gap_since_ms"), KEY, "left")
        .select(
            *KEY,
            start.alias("expected_before"),
            F.greatest(F.col("last") + 1, start).alias("end"),
            "first_gap",
            F.col("gap_since_ms").alias("gap_since_before"),
            since.alias("since"),
            F.coalesce(now - since >= timeout_ms, F.lit(False)).alias("skips"),
        )
    )
    second = None
    if timeout_ms > 0 and not at_gap.where("skips").isEmpty():
        # Only keys that skip a gap now need to know their next one.
        skipping = at_gap.where("skips").select(*KEY, "first_gap")
        second = (
            gaps.join(skipping, KEY).where("start_offset > first_gap")
            .groupBy(*KEY).agg(F.min("start_offset").alias("second_gap"))
        )
    known = at_gap.withColumn("second_gap", F.lit(None).cast("bigint")) if second is None else at_gap.join(
        second, KEY, "left"
    )
    # With no timeout every gap is skipped; else those that start up to the first one.
    skip_until = F.lit(2**63 - 1) if timeout_ms == 0 else F.col("first_gap") + 1
    decisions = known.select(
        *KEY,
        "expected_before",
        F.when(F.col("skips"), F.coalesce("second_gap", "end")).otherwise(F.coalesce("first_gap", "end")).alias(
            "expected"
        ),
        "gap_since_before",
        F.when(F.col("skips"), F.when(F.col("second_gap").isNotNull(), now)).otherwise(F.col("since")).alias(
            "gap_since_ms"
        ),
        F.col("skips").cast("bigint").alias("skipped"),
        F.when(F.col("skips"), skip_until).alias("skip_until"),
    )
    return decisions, gaps


def declared(gaps: DataFrame, decisions: DataFrame) -> DataFrame:
    """The gaps that the decisions skip."""
    limit = decisions.where("skipped > 0").select(*KEY, "skip_until")
    return gaps.join(limit, KEY).where("start_offset < skip_until").drop("skip_until")


def _decided(records: DataFrame, decisions: DataFrame, condition: Column) -> DataFrame:
    marks = decisions.select(*KEY, "expected_before", "expected")
    return records.join(marks, KEY).where(condition).drop("expected_before", "expected")


def late(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Arrivals below what was expected before this batch."""
    return _decided(records, decisions, F.col("offset") < F.col("expected_before"))


def released(arrived: DataFrame, decisions: DataFrame, words: DataFrame) -> DataFrame:
    """Records that are now in contiguous order, one per offset; ``words`` are the packed offsets of ``arrived``.

    ``batch_id`` tells when a record arrived: of several with one offset the
    newest arrival wins, then the later timestamp, then the payload.
    """
    ready = (F.col("offset") >= F.col("expected_before")) & (F.col("offset") < F.col("expected"))
    return latest_per_offset(_decided(arrived, decisions, ready), ("batch_id", "timestamp", "payload"), words)


def held_back(arrivals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Arrivals that wait behind a gap."""
    return _decided(arrivals, decisions, F.col("offset") >= F.col("expected"))


def still_waiting(fresh: DataFrame, waiting: DataFrame, decisions: DataFrame) -> DataFrame:
    """Ranges that wait after this batch."""
    marks = decisions.select(*KEY, "expected")
    ranges = fresh.select(*OFFSET_RANGE.fieldNames()).unionByName(waiting)
    beyond = ranges.join(marks, KEY).where("end_offset >= expected")
    return merge_ranges(beyond.withColumn("start_offset", F.greatest("start_offset", "expected")), disjoint=True)
