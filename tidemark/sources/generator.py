"""Records made at a given rate, to feed a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import format_message, iso_now
from ..schemas import DEFAULT_RECORDS_PER_TICK, DEFAULT_TICKS_PER_SECOND

_SEED_MODULUS = 1000003


def _positive(name: str, value: int | None, default: int) -> int:
    value = default if value is None else value
    if value <= 0:
        raise ValueError(f"{name} must be greater than 0")
    return value


def ticks_per_second(value: int | None = None) -> int:
    return _positive("ticks per second", value, DEFAULT_TICKS_PER_SECOND)


def records_per_tick(value: int | None = None) -> int:
    return _positive("records per tick", value, DEFAULT_RECORDS_PER_TICK)


def tick_stream(spark: SparkSession, rate: int | None = None) -> DataFrame:
    """A stream of ``tick`` numbers from 0 at ``rate`` per second."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", ticks_per_second(rate)).load()
    return ticks.select(F.col("value").alias("tick"))


def random_records(ticks: DataFrame, per_tick: int | None = None) -> DataFrame:
    """``per_tick`` random ``key, value`` records for each row of ``ticks`` (batch or stream)."""
    n = records_per_tick(per_tick)
    return (
        ticks.select(F.explode(F.sequence(F.lit(1), F.lit(n))))
        .select(F.uuid().alias("key"), F.rand().alias("u"))
        .select("key", format_message("key", iso_now(), "u").alias("value"))
    )


def seeded_records(ticks: DataFrame, per_tick: int | None = None) -> DataFrame:
    """Like ``random_records``, but a function of ``tick, instant`` alone: equal on each run.

    ``instant`` is the message time as text.
    """
    n = records_per_tick(per_tick)
    number = F.col("tick") * n + F.col("i")
    return (
        ticks.select("tick", "instant", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
        .select("instant", number.cast("bigint").alias("record_no"))
        .select(
            "record_no",
            F.md5(F.col("record_no").cast("string")).alias("key"),
            "instant",
            ((F.col("record_no") * 7919 % _SEED_MODULUS) / F.lit(float(_SEED_MODULUS))).alias("u"),
        )
        .select("record_no", "key", format_message("key", "instant", "u").alias("value"))
    )
