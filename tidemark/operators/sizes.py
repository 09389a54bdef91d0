"""Small tables of known size, so that Spark itself decides what to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.shared import scratch_path, written


def with_known_size(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Of a computed table Spark knows the size only after the other side of a join
    has been shuffled. Of files it knows it at planning: below
    ``spark.sql.autoBroadcastJoinThreshold`` it broadcasts them, above it joins
    by shuffle, where AQE splits a hot key. Meant for tables of one row per key.
    """
    if df.isStreaming:
        return df
    return written(df, scratch_path(df.sparkSession, "sized"))


class Cached:
    """Cache for the frames of one step; leaving the ``with`` block frees them all."""

    def __init__(self) -> None:
        self._frames: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self._frames.append(df.persist())
        return self._frames[-1]

    def __enter__(self) -> Cached:
        return self

    def __exit__(self, *_: object) -> None:
        for df in self._frames:
            df.unpersist()
