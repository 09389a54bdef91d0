"""Places of rows within their groups, without a task that sees a whole group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import scratch_path, written


def kept(df: DataFrame, name: str) -> DataFrame:
    """A copy in the shared folder: computed once, without lineage, its size known to Spark when it plans a join."""
    return written(df, scratch_path(df.sparkSession, name))


def joined(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """The join on equal ``columns`` in which null equals null; each of them comes out once."""
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns])
    return left.join(other, equal, how).drop(*[f"_right_{c}" for c in columns])


def ranked(rows: DataFrame, groups: list[str], order: list[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """``rows`` with their place from 0 in ascending ``order`` within their group, and the group's number of rows.

    Rows are dealt out by ranges of (groups, order) and sorted there, so a group of any size lies in consecutive
    partitions. A row's place is its place in its partition plus the number of the group's rows in partitions before,
    which a window sums over one row for each group and partition. Nulls sort first, null groups are groups. Rows that
    are equal in ``order`` keep the order in which they were read, which also splits them between partitions. ``rows``
    is written once and read for this; so is the sorted copy, so that a lost executor changes no place.
    """
    base = kept(rows.withColumn("_read", F.monotonically_increasing_id()), "unsorted")
    keys = [*groups, *order, "_read"]
    spread = base.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_read")
    placed = kept(spread.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "sorted")
    parts = placed.groupBy(*groups, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *groups, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("_total")
    )
    starts = kept(starts, "starts")
    return joined(placed, starts, [*groups, "_part"]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(rank), F.col("_total").alias(total))
