"""The external checkpoint: commits under agreed numbers, read by maximum.

A commit writes its rows under a fresh name and then takes the next version
number (``versions``). The current value of a key is the largest one, so it moves
forward whatever the order of writers, and a writer that lost the race for a
number simply takes the next. Every ``SNAPSHOT_EVERY`` commits a writer sums up
all before it in one row per key and offers that as the next version; if a commit
came in between, the offer is void. Readers take the last snapshot and what
follows, so their cost does not depend on how many commits there ever were.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizes import with_known_size
from ..schemas import CHECKPOINT, KEY
from .versions import Versions


def checkpoint_rows(acked: DataFrame, job_id: str, now_ms: int | Column) -> DataFrame:
    """Checkpoint rows from ``topic, partition, last_acked``."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return acked.select(
        *KEY,
        (F.col("last_acked") + 1).alias("next_offset"),
        "last_acked",
        now.cast("bigint").alias("updated_at_ms"),
        F.lit(job_id).alias("updated_by"),
    )


def current_of(entries: DataFrame) -> DataFrame:
    """The row with the largest ``next_offset`` per key."""
    rest = [f.name for f in CHECKPOINT.fields if f.name not in (*KEY, "next_offset")]
    return (
        entries.groupBy(*KEY)
        .agg(F.max(F.struct("next_offset", "updated_at_ms", *[c for c in rest if c != "updated_at_ms"])).alias("_top"))
        .select(*KEY, "_top.*")
        .select(*CHECKPOINT.fieldNames())
    )


def lookup(current: DataFrame, keys: DataFrame) -> DataFrame:
    """``keys`` with their ``next_offset``; 0 without a checkpoint."""
    known = with_known_size(current.select(*KEY, "next_offset"))
    return keys.join(known, KEY, "left").withColumn("next_offset", F.coalesce("next_offset", F.lit(0).cast("bigint")))


def topic_offsets(current: DataFrame, topic: str) -> DataFrame:
    """``partition, next_offset`` of one topic; empty if it has none."""
    return current.where(F.col("topic") == topic).select("partition", "next_offset")


#: Commits that a reader meets at most, besides those of writers that lost a race for the snapshot.
SNAPSHOT_EVERY = 16


class CheckpointLog:
    """The checkpoint table at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, f"{self.path}/versions")

    def _rows(self, tail: list[tuple[int, dict]]) -> DataFrame:
        paths = [f"{self.path}/{d['rows']}" for _, d in tail]
        if not paths:
            return self.spark.createDataFrame([], CHECKPOINT)
        return self.spark.read.schema(CHECKPOINT).parquet(*paths)

    def entries(self) -> DataFrame:
        """The last snapshot and the commits since."""
        return self._rows(self.versions.tail())

    def current(self) -> DataFrame:
        return current_of(self.entries())

    def lookup(self, keys: DataFrame) -> DataFrame:
        return lookup(self.current(), keys)

    def topic_offsets(self, topic: str) -> DataFrame:
        return topic_offsets(current_of(self.entries().where(F.col("topic") == topic)), topic)

    def _written(self, rows: DataFrame) -> str:
        name = f"rows/{uuid.uuid4().hex}"
        rows.select(*CHECKPOINT.fieldNames()).write.parquet(f"{self.path}/{name}")
        return name

    def append(self, acked: DataFrame, job_id: str, now_ms: int, tag: str | None = None) -> None:
        """Append ``topic, partition, last_acked``; a failed write raises.

        A commit whose ``tag`` is among the last ones is there already.
        """
        tail = self.versions.tail()
        if tag is not None and any(d.get("tag") == tag for _, d in tail):
            return
        self.versions.append({"rows": self._written(checkpoint_rows(acked, job_id, now_ms)), "tag": tag})
        if len(tail) >= SNAPSHOT_EVERY:
            self.summed_up()

    def summed_up(self) -> bool:
        """Offer one row per key as the next version; False if a commit came in between."""
        tail = self.versions.tail()
        if not tail:
            return False
        name = self._written(current_of(self._rows(tail)))
        return self.versions.put(tail[-1][0] + 1, {"rows": name, "whole": True})

    def compacted(self, path: str) -> CheckpointLog:
        """A new log at ``path`` that holds only the current rows."""
        other = CheckpointLog(self.spark, path)
        other.versions.append({"rows": other._written(self.current()), "whole": True})
        return other
