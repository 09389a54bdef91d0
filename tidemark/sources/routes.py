"""The routing table: topic to destination, from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOPIC_CONFIGS = "topicConfigs array<map<string, string>>"

# Property names of a route in the JSON file.
_NAMED = {
    "topicName": "topic",
    "datasetName": "dataset",
    "tableName": "table",
    "checkpointCommitIntervalSeconds": "commit_interval_seconds",
}


def parse_routes(df: DataFrame, text: str) -> DataFrame:
    """Routes from a column of JSON documents ``{"topicConfigs": [{…}, …]}``.

    ``position`` is a route's place in its document. Properties without a column
    of their own are kept in the map ``extra``.
    """
    config = F.posexplode(F.from_json(text, _TOPIC_CONFIGS)["topicConfigs"]).alias("position", "c")
    named = [F.col("c")[prop].alias(name) for prop, name in _NAMED.items()]
    known = list(_NAMED)
    return df.select(config).select(
        *named, F.map_filter("c", lambda k, _: ~k.isin(known)).alias("extra"), "position"
    ).withColumn("commit_interval_seconds", F.col("commit_interval_seconds").try_cast("bigint"))


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    """Routes from one or more JSON files."""
    return parse_routes(spark.read.text(path, wholetext=True), "value")
