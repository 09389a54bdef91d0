"""From written, rejected, dropped and missing offsets to one handled stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank, parse_partition_key, strict_int, strict_long
from ..schemas import HANDLED_RANGE, KEY, META_OFFSET, META_PARTITION, META_TOPIC, RAW_METADATA
from .ranges import offsets_to_ranges


def _nested_or_flat(rows: DataFrame, field: str) -> Column:
    """The field of the nested metadata if the row has that struct, else the flat column.

    The choice is made per row: an existing but incomplete struct is not
    completed from the flat columns.
    """
    flat = F.col(field).cast("string") if field in rows.columns else F.lit(None).cast("string")
    if RAW_METADATA not in rows.columns:
        return flat
    meta_fields = rows.schema[RAW_METADATA].dataType.fieldNames()
    nested = F.col(RAW_METADATA)[field].cast("string") if field in meta_fields else F.lit(None).cast("string")
    return F.when(F.col(RAW_METADATA).isNotNull(), nested).otherwise(flat)


def extract_handled(rows: DataFrame) -> DataFrame:
    """``topic, partition, offset`` of each raw-table row; all NULL where unreadable."""
    read = F.struct(
        _nested_or_flat(rows, META_TOPIC).alias("topic"),
        strict_int(_nested_or_flat(rows, META_PARTITION)).alias("partition"),
        strict_long(_nested_or_flat(rows, META_OFFSET)).alias("offset"),
    )
    # As a list of at most one element each field is parsed once per row, where
    # filters on plain columns would repeat the parsing for every use.
    readable = F.filter(
        F.array(read), lambda h: h["topic"].isNotNull() & h["partition"].isNotNull() & h["offset"].isNotNull()
    )
    return rows.select(F.inline_outer(readable))


def drop_invalid_handled(handled: DataFrame) -> DataFrame:
    """Keep rows that name a topic, a partition and an offset."""
    return handled.where(~is_blank("topic") & F.col("partition").isNotNull() & F.col("offset").isNotNull())


def parse_keyed(df: DataFrame, key: str = "partition_key") -> DataFrame:
    """Replace the text key by typed ``topic, partition``; NULL where it is malformed."""
    parsed = df.withColumn("_ref", parse_partition_key(key))
    return parsed.select("_ref.topic", "_ref.partition", *[c for c in df.columns if c != key])


def merge_handled(*parts: DataFrame) -> DataFrame:
    """Union of handled streams with equal columns."""
    return reduce(DataFrame.unionByName, parts)


def handled_ranges(df: DataFrame) -> DataFrame:
    """Handled offsets with a ``reason`` as ranges per reason, in one pass."""
    return offsets_to_ranges(df, by=("reason",)).select(*HANDLED_RANGE.fieldNames())


def gap_ranges_handled(gaps: DataFrame) -> DataFrame:
    """Declared gaps as handled ranges."""
    return gaps.select(*KEY, "start_offset", "end_offset", F.lit("gap").alias("reason"))


def point_ranges(df: DataFrame) -> DataFrame:
    """Handled offsets as ranges of one, each occurrence kept."""
    return df.select(*KEY, F.col("offset").alias("start_offset"), F.col("offset").alias("end_offset"), "reason")


def handled_from_sink(written: DataFrame, rejected: DataFrame) -> DataFrame:
    """Offsets of written and rejected rows alike, with the path in ``reason``."""
    def path(rows: DataFrame, reason: str) -> DataFrame:
        return drop_invalid_handled(extract_handled(rows)).withColumn("reason", F.lit(reason))

    return merge_handled(path(written, "written"), path(rejected, "rejected"))
