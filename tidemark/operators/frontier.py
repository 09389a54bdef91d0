"""The commit frontier: up to where every offset of a key is handled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import KEY
from .ranges import disjoint_parts, explode_ranges, frontier_of
from .sizes import with_known_size


def commit_frontier(
    handled: DataFrame, checkpoint: DataFrame | None = None, with_last: bool = False, disjoint: bool = False
) -> DataFrame:
    """``topic, partition, next_offset, last_acked`` over handled ranges.

    Starts at the checkpoint (0 without one), never falls below it, and stops at
    the first offset that nothing handled yet. ``with_last`` adds
    ``last_covered``, the largest handled offset; ``disjoint`` as in ``with_reach``.
    """
    more = ["last_covered"] if with_last else []
    return frontier_of(handled, checkpoint, disjoint).select(
        *KEY, "next_offset", (F.col("next_offset") - 1).alias("last_acked"), *more
    )


def stale_handled(handled: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Parts of handled ranges that lie below the checkpoint."""
    floor = with_known_size(checkpoint.select(*KEY, F.col("next_offset").alias("_floor")))
    return (
        handled.join(floor, KEY)
        .where("start_offset < _floor")
        .withColumn("end_offset", F.least("end_offset", F.col("_floor") - 1))
        .drop("_floor")
    )


def buffered_handled(handled: DataFrame, frontier: DataFrame, sized: bool = False) -> DataFrame:
    """Handled ranges beyond the frontier: seen, but not committable yet.

    ``sized`` says that ``frontier`` comes from files, so that Spark knows its size already.
    """
    frontier = frontier if sized else with_known_size(frontier.select(*KEY, "next_offset"))
    stop = frontier.select(*KEY, F.col("next_offset").alias("_next"))
    return (
        handled.join(stop, KEY, "left")
        .where("end_offset >= coalesce(_next, 0)")
        .withColumn("start_offset", F.greatest("start_offset", F.coalesce("_next", F.lit(0).cast("bigint"))))
        .drop("_next")
    )


def buffered_offsets(handled: DataFrame, frontier: DataFrame, disjoint: bool = False) -> DataFrame:
    """Distinct offsets of ``buffered_handled``; ``disjoint`` as in ``with_reach``."""
    beyond = buffered_handled(handled, frontier).select(*KEY, "start_offset", "end_offset")
    return explode_ranges(disjoint_parts(beyond, disjoint))


def pending_acks(frontier: DataFrame, previous: DataFrame, now_ms: int | Column) -> DataFrame:
    """Add ``committed_next`` and ``pending_since_ms`` to the frontier.

    ``previous`` holds both per key from the last step. A key starts to wait when
    its frontier first passes what is committed, and keeps only its newest value.
    """
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    last = previous.select(
        *KEY, F.col("committed_next").alias("_committed"), F.col("pending_since_ms").alias("_since")
    )
    return (
        frontier.join(last, KEY, "left")
        .withColumn("committed_next", F.coalesce("_committed", F.lit(0).cast("bigint")))
        .withColumn(
            "pending_since_ms",
            F.when(F.col("next_offset") > F.col("committed_next"), F.coalesce("_since", now.cast("bigint"))),
        )
        .drop("_committed", "_since")
    )


def is_due(now_ms: int | Column, interval_ms: Column) -> Column:
    """True for a pending key that has waited for its commit interval."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return F.coalesce(now - F.col("pending_since_ms") >= interval_ms, F.lit(False))
