"""Row-wise steps between the log and the raw table (no shuffle in any of them)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import partition_key
from ..schemas import (
    INVALID_KEYWORD,
    KEY,
    META_OFFSET,
    META_PARTITION,
    META_TOPIC,
    RAW_MESSAGE,
    RAW_METADATA,
    RAW_TOPIC,
    VERSION,
)


def to_envelope(log: DataFrame, topic: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Log records as ``topic, partition, offset, payload``.

    ``topic`` sets the configured topic name instead of the record's own;
    ``keep`` names further log columns to carry along.
    """
    return log.select(
        (F.lit(topic) if topic is not None else F.col("topic")).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("value").alias("payload"),
        *keep,
    )


def with_partition_key(df: DataFrame) -> DataFrame:
    """Add the text key ``topic:partition``."""
    return df.withColumn("partition_key", partition_key())


def is_valid(keyword: str = INVALID_KEYWORD) -> Column:
    """A payload is invalid when it contains the keyword; a NULL payload is valid."""
    return ~F.coalesce(F.col("payload").contains(keyword), F.lit(False))


def split_valid(df: DataFrame, keyword: str = INVALID_KEYWORD) -> tuple[DataFrame, DataFrame]:
    """(valid envelopes, offsets of the dropped ones)."""
    return df.where(is_valid(keyword)), df.where(~is_valid(keyword)).select(*KEY, "offset")


def to_raw_rows(
    df: DataFrame, version_ms: int | Column, topic: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Envelopes as raw-table rows; a pure map.

    ``version_ms`` is one value for the whole batch, so a replay writes equal rows.
    ``keep`` carries further columns along.
    """
    topic = F.lit(topic) if topic is not None else F.col("topic")
    version = version_ms if isinstance(version_ms, Column) else F.lit(version_ms)
    return df.select(
        F.col("payload").alias(RAW_MESSAGE),
        topic.alias(RAW_TOPIC),
        F.struct(
            topic.alias(META_TOPIC),
            F.col("partition").cast("bigint").alias(META_PARTITION),
            F.col("offset").alias(META_OFFSET),
        ).alias(RAW_METADATA),
        version.cast("bigint").alias(VERSION),
        *keep,
    )
