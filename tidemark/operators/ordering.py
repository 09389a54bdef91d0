"""Contiguous order and gaps over a bounded log (batch form).

The streaming form of the same rules is in ``streaming``. Here every gap counts
as timed out once the log has been read, so each record above its key's floor is
released, in offset order per key, and each missing range is declared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_GAP_TIMEOUT_SECONDS, KEY
from .ranges import WORD_BITS, explode_ranges, frontier_of, gaps_in, merge_ranges, offsets_to_ranges, pack_offsets
from .sizes import with_known_size

def with_expected(df: DataFrame, floors: DataFrame | None) -> DataFrame:
    """Add ``expected``: the key's next wanted offset, 0 without a checkpoint."""
    if floors is None:
        return df.withColumn("expected", F.lit(0).cast("bigint"))
    known = with_known_size(floors.select(*KEY, F.col("next_offset").alias("_next")))
    expected = F.coalesce("_next", F.lit(0).cast("bigint")).alias("expected")
    return df.join(known, KEY, "left").select(*df.columns, expected)


def at_or_above(df: DataFrame, floors: DataFrame | None) -> DataFrame:
    """Records not yet committed."""
    return with_expected(df, floors).where("offset >= expected").drop("expected")


def late_records(df: DataFrame, floors: DataFrame | None) -> DataFrame:
    """Records below their key's floor: replayed or late, never released again."""
    return with_expected(df, floors).where("offset < expected")


def _keep_last(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    # max(struct) combines before the shuffle, so copies of one offset never
    # meet in one group.
    rest = [c for c in df.columns if c not in (*KEY, "offset", *order)]
    return (
        df.groupBy(*KEY, "offset")
        .agg(F.max(F.struct(*order, *rest)).alias("_last"))
        .select(*KEY, "offset", "_last.*")
        .select(*df.columns)
    )


def in_a_log(df: DataFrame) -> DataFrame:
    """Records that have a place in a log; without topic, partition or offset there is nothing to order."""
    return df.where("topic is not null and partition is not null and offset is not null")


def latest_per_offset(df: DataFrame, order: tuple[str, ...] = ("timestamp", "payload"), words: DataFrame | None = None) -> DataFrame:
    """One record per offset: the last by ``order``. Records without a place in a log are left out.

    Which offsets may repeat is known before any payload moves: ``words`` (``pack_offsets`` of the same records, made
    here unless given) tells for each 64 offsets whether more records came than offsets. Only records of such words
    are shuffled. The table of these words is written first, so Spark knows its size: it is broadcast while small and
    joined by shuffle beyond, and where it is empty the second half of the plan is dropped at run time.
    """
    df = in_a_log(df)
    order = tuple(c for c in order if c in df.columns)
    words = pack_offsets(df) if words is None else words
    repeated = with_known_size(words.where("n > bit_count(bits)").select(*KEY, F.col("word").alias("_word")))
    marked = df.withColumn("_word", F.expr(f"shiftright(offset, {WORD_BITS})"))
    once = marked.join(repeated, [*KEY, "_word"], "left_anti").drop("_word")
    again = marked.join(repeated, [*KEY, "_word"], "left_semi").drop("_word")
    return once.unionByName(_keep_last(again, order))


def contiguous_records(df: DataFrame, floors: DataFrame | None = None) -> DataFrame:
    """Everything that is released once all gaps have timed out."""
    return latest_per_offset(at_or_above(df, floors))


def contiguous_prefix(df: DataFrame, floors: DataFrame | None = None) -> DataFrame:
    """Records released before the first gap of their key."""
    if floors is not None:
        floors = with_known_size(floors.select(*KEY, "next_offset"))
    stop = frontier_of(offsets_to_ranges(df), floors, disjoint=True).select(*KEY, F.col("next_offset").alias("_stop"))
    reached = with_known_size(stop)
    ready = with_expected(df, floors).join(reached, KEY).where("offset >= expected and offset < _stop")
    return latest_per_offset(ready.drop("expected", "_stop"))


def in_offset_order(df: DataFrame) -> DataFrame:
    """Total order by key and offset; range partitioning also splits a hot key."""
    return df.orderBy(*KEY, "offset")


def gap_ranges(df: DataFrame, floors: DataFrame | None = None) -> DataFrame:
    """Missing offsets per key as ranges."""
    return gaps_in(offsets_to_ranges(df), floors, disjoint=True)


def gap_missing_offsets(gaps: DataFrame) -> DataFrame:
    """One row per missing offset."""
    return explode_ranges(gaps.select(*KEY, "start_offset", "end_offset"))


def gap_first_missing(gaps: DataFrame) -> DataFrame:
    """Only the first offset of each gap."""
    return gaps.select(*KEY, F.col("start_offset").alias("offset"))


def gap_audit(gaps: DataFrame, timeout_ms: int | Column = DEFAULT_GAP_TIMEOUT_SECONDS * 1000) -> DataFrame:
    """Audit rows: what was skipped, where reading goes on, after which wait."""
    timeout_ms = timeout_ms if isinstance(timeout_ms, Column) else F.lit(timeout_ms)
    return gaps.select(
        *KEY,
        F.col("start_offset").alias("missing_offset"),
        F.col("end_offset").alias("last_missing_offset"),
        (F.col("end_offset") + 1).alias("next_available_offset"),
        (F.col("end_offset") - F.col("start_offset") + 1).alias("missing_count"),
        timeout_ms.cast("bigint").alias("timeout_ms"),
    )


def contiguous_runs(df: DataFrame) -> DataFrame:
    """Maximal runs of present offsets with their length."""
    return merge_ranges(offsets_to_ranges(df), disjoint=True).withColumn(
        "run_length", F.col("end_offset") - F.col("start_offset") + 1
    )
