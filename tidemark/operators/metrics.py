"""Counts that tell whether the flow advances, as grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import DEFAULT_WINDOW_SECONDS, KEY
from .sizes import with_known_size


def tumbling_counts(
    df: DataFrame, ts: str = "timestamp", width: str = f"{DEFAULT_WINDOW_SECONDS} seconds", keys: tuple[str, ...] = ()
) -> DataFrame:
    """Rows per tumbling window of ``ts`` and ``keys``; also valid on a stream."""
    return (
        df.groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), *keys, "n")
    )


def event_time_counts(
    stream: DataFrame, ts: str = "timestamp", width: str = f"{DEFAULT_WINDOW_SECONDS} seconds", keys: tuple[str, ...] = (),
    lateness: str = "1 minute",
) -> DataFrame:
    """``tumbling_counts`` of a stream, each window once, when it is complete.

    A window is complete when a record has come that is ``lateness`` newer than its end; its state is dropped then, so
    state holds open windows only. Records of complete windows are left out; the query's progress counts them
    (``rows_dropped_by_watermark``, after records of one window and task were added up).
    """
    return tumbling_counts(stream.withWatermark(ts, lateness), ts, width, keys)


def gap_metrics(ordered: DataFrame) -> DataFrame:
    """Per key: skipped gaps, missing offsets, late and released records.

    ``ordered`` is tagged output: ``kind`` in record, gap, late; a gap row spans
    ``offset .. end_offset``.
    """
    is_gap = F.col("kind") == "gap"
    return ordered.groupBy(*KEY).agg(
        F.count_if(F.col("kind") == "record").alias("records_released"),
        F.count_if(is_gap).alias("gap_timeout_skip"),
        F.coalesce(F.sum(F.when(is_gap, F.col("end_offset") - F.col("offset") + 1)), F.lit(0).cast("bigint")).alias(
            "offsets_missing"
        ),
        F.count_if(F.col("kind") == "late").alias("late_after_skip"),
    )


def gap_outcomes(decisions: DataFrame) -> DataFrame:
    """Per key: gaps opened, closed without a skip, and skipped in one step.

    ``decisions`` tells per key when its open gap began before and after the step
    (NULL without one) and whether a gap was ``skipped``.
    """
    had, has = F.col("gap_since_before").isNotNull(), F.col("gap_since_ms").isNotNull()
    skipped = F.col("skipped") > 0
    return decisions.select(
        *KEY,
        (~had & (has | skipped)).cast("bigint").alias("gap_detected"),
        (had & ~has & ~skipped).cast("bigint").alias("gap_resolved_before_timeout"),
        F.col("skipped").alias("gap_timeout_skip"),
        (F.col("expected") - F.col("expected_before")).alias("contiguous_advance_size"),
    )


def handled_by_reason(handled: DataFrame) -> DataFrame:
    """Per key: handled offsets of each path."""
    def count(reason: str) -> Column:
        found = F.sum(F.when(F.col("reason") == reason, _width()))
        return F.coalesce(found, F.lit(0).cast("bigint")).alias(f"offsets_{reason}")

    return handled.groupBy(*KEY).agg(*[count(r) for r in ("written", "rejected", "dropped", "gap")])


def frontier_progress(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per key: offsets acknowledged and committed between two key states, and the lag of the commit."""
    was = before.select(*KEY, F.col("frontier").alias("_frontier"), F.col("committed_next").alias("_committed"))
    zero = F.lit(0).cast("bigint")
    return after.join(was, KEY, "left").select(
        *KEY,
        (F.col("frontier") - F.coalesce("_frontier", zero)).alias("offsets_contiguously_acked"),
        (F.col("committed_next") - F.coalesce("_committed", zero)).alias("offsets_committed"),
        (F.col("frontier") - F.col("committed_next")).alias("offsets_pending_commit"),
    )


def step_latencies(query: StreamingQuery) -> list[dict]:
    """Durations of the recent steps of a live query, in milliseconds by phase."""
    return [{"batch_id": p["batchId"], **p["durationMs"]} for p in query.recentProgress]


def _width() -> Column:
    return F.col("end_offset") - F.col("start_offset") + 1


def commit_metrics(handled: DataFrame, checkpoint: DataFrame, frontier: DataFrame) -> DataFrame:
    """Per key: handled offsets seen, stale ones, contiguously acknowledged ones.

    ``handled`` may repeat offsets; each occurrence counts as seen, and as stale
    if it lies below the checkpoint.
    """
    floor = with_known_size(checkpoint.select(*KEY, F.col("next_offset").alias("_floor")))
    ahead = frontier.select(*KEY, "next_offset")
    # Join after the aggregate: only one row per key meets the frontier.
    seen = (
        handled.join(floor, KEY, "left")
        .withColumn("_floor", F.coalesce("_floor", F.lit(0).cast("bigint")))
        .groupBy(*KEY, "_floor")
        .agg(
            F.sum(_width()).alias("handled_offsets_seen"),
            F.sum(
                F.greatest(F.least("end_offset", F.col("_floor") - 1) - F.col("start_offset") + 1, F.lit(0))
            ).alias("stale_offsets_ignored"),
            F.max("end_offset").alias("_last"),
        )
    )
    return seen.join(ahead, KEY).select(
        *KEY,
        "handled_offsets_seen",
        "stale_offsets_ignored",
        (F.col("next_offset") - F.col("_floor")).alias("offsets_contiguously_acked"),
        F.greatest(F.col("_last") + 1 - F.col("next_offset"), F.lit(0)).cast("bigint").alias("offsets_past_frontier"),
    )


def key_validity(df: DataFrame, parsed_topic: str = "topic") -> DataFrame:
    """Rows seen and rows whose text key was malformed."""
    return df.agg(
        F.count(F.lit(1)).alias("handled_offsets_seen"),
        F.count_if(F.col(parsed_topic).isNull()).alias("invalid_partition_keys_dropped"),
    )


#: Items that a sketch keeps exactly; beyond, ranks are off by about 1 / K of all items.
SKETCH_K = 2048


def sketched(values: DataFrame, value: str, by: tuple[str, ...] = tuple(KEY)) -> DataFrame:
    """``by, count, min, max, sum, sketch`` of a column: a row of some kilobytes, however many values."""
    v = F.col(value)
    return values.groupBy(*by).agg(
        F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.sum(v).alias("total"),
        F.kll_sketch_agg_bigint(v, SKETCH_K).alias("sketch"),
    )


def merged(sketches: DataFrame, by: tuple[str, ...] = tuple(KEY)) -> DataFrame:
    """Distributions of several batches as one."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("total").alias("total"),
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"),
    )


def distribution(sketches: DataFrame, name: str, by: tuple[str, ...] = tuple(KEY)) -> DataFrame:
    """``by, <name>_count, _min, _max, _sum, _p50, _p99`` of sketched values; exact up to ``SKETCH_K`` values."""
    at = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"{name}_{p}") for q, p in ((0.5, "p50"), (0.99, "p99"))]
    return sketches.select(*by, *[F.col(c).alias(f"{name}_{n}") for c, n in (("n", "count"), ("least", "min"), ("most", "max"), ("total", "sum"))], *at)


def advances(commits: DataFrame, order: str) -> DataFrame:
    """Commits that moved their key forward, with the ``advance`` of each; commits of a key are in ``order``."""
    earlier = Window.partitionBy(*KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    moved = F.col("last_acked") - F.coalesce(F.max("last_acked").over(earlier), F.lit(-1))
    return commits.withColumn("advance", moved.cast("bigint")).where("advance > 0")
