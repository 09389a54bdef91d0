"""Contiguity over offset ranges, without a task that sees a whole partition.

The question behind ordering, gap detection and commit is always the same: for
each range, how far does everything before it reach? A window per
(topic, partition) would answer it in one task per log partition, so the scan
is split in two levels:

1. inside a *bucket* of 2^20 consecutive offsets, a window over at most 2^20
   distinct starts;
2. across buckets, a window over one summary row per bucket, whose result (the
   *carry*) is joined back.

Single offsets are first packed into 64-bit words with ``bit_or``. That is a
plain hash aggregate, so it combines before the shuffle, removes duplicates
and shrinks a dense log up to 64 times.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KEY

WORD_BITS = 6
BUCKET_BITS = 20


def pack_offsets(df: DataFrame, offset: Column | str = "offset", by: tuple[str, ...] = ()) -> DataFrame:
    """Offsets packed to one row per 64: ``topic, partition, *by, word, bits, n``.

    ``n`` counts input rows, so ``n > bit_count(bits)`` marks words that hold
    some offset more than once.
    """
    offset = F.col(offset) if isinstance(offset, str) else offset
    return (
        df.select(*KEY, *by, offset.alias("o"))
        .where("topic is not null and partition is not null and o is not null")
        .groupBy(*KEY, *by, F.expr(f"shiftright(o, {WORD_BITS})").alias("word"))
        .agg(
            F.expr("bit_or(shiftleft(1L, cast(o & 63 as int)))").alias("bits"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def merge_words(*parts: DataFrame) -> DataFrame:
    """Packed offsets of several sets of records as those of all of them."""
    return reduce(DataFrame.unionByName, parts).groupBy(*KEY, "word").agg(F.expr("bit_or(bits)").alias("bits"), F.sum("n").alias("n"))


def unpack_ranges(words: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Maximal runs inside each packed word, as ``start_offset .. end_offset``."""
    # A run starts (ends) at a set bit whose lower (upper) neighbour is not set.
    # A full word is one run from bit 0; the others try each position.
    tried = words.select(
        *KEY, *by,
        F.expr(f"shiftleft(word, {WORD_BITS})").alias("base"),
        F.expr("bits & ~shiftleft(bits, 1)").alias("starts"),
        F.expr("bits & ~shiftrightunsigned(bits, 1)").alias("ends"),
        F.explode(F.expr("if(bits = -1L, array(0), sequence(0, 63))")).alias("i"),
    ).where("getbit(starts, i) = 1")
    # Trailing zeros of the ends from bit i on: the length of the run minus one.
    # The sign bit is masked, as its negation would overflow; nothing else set means bit 63.
    ends = "(shiftrightunsigned(ends, i) & 9223372036854775807L)"
    length = f"if({ends} = 0, 63, bit_count(({ends} & -{ends}) - 1))"
    return tried.select(
        *KEY, *by, F.expr("base + i").alias("start_offset"), F.expr(f"base + i + {length}").alias("end_offset")
    )


def offsets_to_ranges(df: DataFrame, offset: Column | str = "offset", by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct offsets as disjoint ranges (not yet merged across words).

    ``by`` names columns that are kept apart, such as a reason; ranges of
    different values may then overlap.
    """
    return unpack_ranges(pack_offsets(df, offset, by), by)


def floor_ranges(floors: DataFrame) -> DataFrame:
    """``topic, partition, next_offset`` as "all before it is done": ``0 .. next_offset - 1``.

    With these among the input ranges, nothing below a key's floor can show as
    missing, and no join with the floors is needed. Keys without one start at 0.
    """
    return floors.select(
        *KEY, F.lit(0).cast("bigint").alias("start_offset"), (F.col("next_offset") - 1).alias("end_offset")
    )


def _bucket() -> Column:
    return F.expr(f"shiftright(start_offset, {BUCKET_BITS})")


def _by_bucket(ranges: DataFrame) -> DataFrame:
    # The explicit repartition matters: a hash on (topic, partition) alone would
    # also satisfy the window below and put a hot key into one task. Both users
    # of the result need the same columns, so Spark runs this exchange once.
    return (
        ranges.select(*KEY, "start_offset", "end_offset")
        .where("topic is not null and partition is not null and start_offset is not null")
        .repartition(*KEY, _bucket())
    )


def _carry(buckets: DataFrame, value: str, name: str) -> DataFrame:
    """Running maximum of ``value`` over the buckets before each bucket."""
    before = Window.partitionBy(*KEY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return buckets.select(*KEY, "bucket", F.max(value).over(before).alias(name))


def with_reach(ranges: DataFrame, disjoint: bool = False) -> DataFrame:
    """Add ``reach``: the largest end among the key's ranges that sort earlier by start.

    NULL on a key's first range. Ranges may overlap. Ranges with one start are
    first reduced to the longest, which bounds a bucket by its distinct starts;
    ``disjoint`` skips that step where a start is known to repeat a few times at
    most, as in the union of a few sets of disjoint ranges.
    """
    if not disjoint:
        ranges = ranges.groupBy(*KEY, "start_offset").agg(F.max("end_offset").alias("end_offset"))
    spread = _by_bucket(ranges)
    inside = (
        Window.partitionBy(*KEY, _bucket()).orderBy("start_offset").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = spread.select("*", _bucket().alias("bucket"), F.max("end_offset").over(inside).alias("in_bucket"))
    buckets = spread.groupBy(*KEY, _bucket().alias("bucket")).agg(F.max("end_offset").alias("bucket_end"))
    return local.join(_carry(buckets, "bucket_end", "carry"), [*KEY, "bucket"], "left").select(
        *KEY, "bucket", "start_offset", "end_offset", F.expr("greatest(in_bucket, carry)").alias("reach")
    )


def _first_missing() -> Column:
    return F.coalesce(F.col("reach"), F.lit(-1).cast("bigint")) + 1


def _with_floors(ranges: DataFrame, floors: DataFrame | None) -> DataFrame:
    ranges = ranges.select(*KEY, "start_offset", "end_offset")
    return ranges if floors is None else ranges.unionByName(floor_ranges(floors))


def gaps_in(ranges: DataFrame, floors: DataFrame | None = None, disjoint: bool = False) -> DataFrame:
    """Missing ranges between each key's floor and its largest offset."""
    return with_reach(_with_floors(ranges, floors), disjoint).where(
        F.col("start_offset") > _first_missing()
    ).select(*KEY, _first_missing().alias("start_offset"), (F.col("start_offset") - 1).alias("end_offset"))


def frontier_of(ranges: DataFrame, floors: DataFrame | None = None, disjoint: bool = False) -> DataFrame:
    """First offset per key, from its floor on, that no range covers: ``next_offset``.

    ``last_covered`` is the key's largest covered offset, at or beyond the frontier
    only where something waits behind a hole.
    """
    return (
        with_reach(_with_floors(ranges, floors), disjoint)
        .groupBy(*KEY)
        .agg(
            F.min(F.when(F.col("start_offset") > _first_missing(), _first_missing())).alias("first_gap"),
            F.max("end_offset").alias("last_covered"),
        )
        .select(*KEY, F.coalesce("first_gap", F.col("last_covered") + 1).alias("next_offset"), "last_covered")
    )


def disjoint_parts(ranges: DataFrame, disjoint: bool = False) -> DataFrame:
    """The same offsets as non-overlapping ranges: each keeps what no earlier one covers.

    Cheaper than ``merge_ranges``, as runs are not joined across ranges.
    """
    return (
        with_reach(ranges, disjoint)
        .where("reach is null or end_offset > reach")
        .select(*KEY, F.expr("greatest(start_offset, reach + 1)").alias("start_offset"), "end_offset")
    )


def merge_ranges(ranges: DataFrame, disjoint: bool = False) -> DataFrame:
    """Maximal contiguous runs: overlapping and adjacent ranges become one."""
    reached = with_reach(ranges, disjoint)
    opens = F.when(F.col("reach").isNull() | (F.col("start_offset") > F.col("reach") + 1), F.col("start_offset"))
    reached = reached.withColumn("opens", opens)
    upto = (
        Window.partitionBy(*KEY, "bucket").orderBy("start_offset").rowsBetween(Window.unboundedPreceding, 0)
    )
    local = reached.withColumn("run_in_bucket", F.max("opens").over(upto))
    buckets = reached.groupBy(*KEY, "bucket").agg(F.max("opens").alias("last_open"))
    return (
        local.join(_carry(buckets, "last_open", "carry"), [*KEY, "bucket"], "left")
        .groupBy(*KEY, F.coalesce("run_in_bucket", "carry").alias("start_offset"))
        .agg(F.max("end_offset").alias("end_offset"))
    )


def cut_ranges(ranges: DataFrame, bits: int) -> DataFrame:
    """Ranges cut at multiples of ``2^bits``; other columns are repeated."""
    rest = [c for c in ranges.columns if c not in ("start_offset", "end_offset")]
    pieces = F.explode(F.expr(f"sequence(shiftright(start_offset, {bits}), shiftright(end_offset, {bits}))"))
    return ranges.select(*rest, "start_offset", "end_offset", pieces.alias("piece")).select(
        *rest,
        F.expr(f"greatest(start_offset, shiftleft(piece, {bits}))").alias("start_offset"),
        F.expr(f"least(end_offset, shiftleft(piece + 1, {bits}) - 1)").alias("end_offset"),
    )


def explode_ranges(ranges: DataFrame, name: str = "offset", chunk_bits: int = 16) -> DataFrame:
    """One row per offset of each range; other columns are repeated.

    Wide ranges are first cut in two steps and the pieces spread over the cluster,
    so no task and no array has to hold a wide range.
    """
    rest = [c for c in ranges.columns if c not in ("start_offset", "end_offset")]
    pieces = cut_ranges(cut_ranges(ranges, 2 * chunk_bits), chunk_bits).repartition(*KEY, "start_offset")
    return pieces.select(*rest, F.explode(F.expr("sequence(start_offset, end_offset)")).alias(name))
