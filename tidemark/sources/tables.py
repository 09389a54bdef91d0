"""Replay-safe tables: each batch owns a directory and overwrites it when retried.

Layout: ``table/run_id=R/batch_id=N/[ingest_date=D/…]``. The date sits below the
batch, so a retry after midnight still replaces its first attempt. Readers get
``run_id``, ``batch_id`` and ``ingest_date`` as partition columns and prune on
them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class BatchTable:
    """A table written in whole batches."""

    path: str
    run_id: str

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/run_id={self.run_id}/batch_id={batch_id}"

    def write(self, df: DataFrame, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
        """Write the batch; the same ``batch_id`` again replaces it."""
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.batch_path(batch_id))

    def read_batch(self, spark: SparkSession, batch_id: int, schema: T.StructType) -> DataFrame | None:
        """One batch, or None if it was never written to the end."""
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{self.batch_path(batch_id)}/_SUCCESS")
        if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
            return None
        return spark.read.schema(schema).parquet(self.batch_path(batch_id))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches of all runs; empty before the first write."""
    layout = T.StructType(
        schema.fields
        + [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
    )
    try:
        return spark.read.schema(layout).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def with_ingest_date(df: DataFrame, now_ms: int | Column) -> DataFrame:
    """Add the day, in UTC, on which the batch is written."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(now / F.lit(86_400_000)).cast("int"))
    return df.withColumn("ingest_date", day)


def compact(spark: SparkSession, table: BatchTable, schema: T.StructType, upto: int, into: str) -> DataFrame:
    """Rewrite the batches up to ``upto`` of one run into fewer files at ``into``.

    ``destination`` and ``ingest_date`` stay partitions; a rebalance by them sizes the files and splits what is too large.
    """
    done = read_table(spark, table.path, schema).where(
        (F.col("run_id") == table.run_id) & (F.col("batch_id") <= upto)
    )
    kept = [c for c in ("destination", "ingest_date") if c in done.columns]
    done.hint("rebalance", *kept).write.mode("overwrite").partitionBy(*kept).parquet(into)
    return spark.read.schema(done.schema).parquet(into)
