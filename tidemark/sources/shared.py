"""Where jobs may write intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a
    cluster a missing setting is an error.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {_SETTING} to a folder shared by all executors")
    return _local_dir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table at ``path``, or an empty one if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and continue from the files: durable, with no lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
