"""Topic routing: one stream over all topics, joined with the routing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank
from ..schemas import DEFAULT_COMMIT_INTERVAL_SECONDS, DEFAULT_TABLE
from .sizes import with_known_size


def split_names(names: str) -> list[str]:
    """Comma-separated names, trimmed, blanks left out."""
    return [n.strip() for n in names.split(",") if n.strip()]


def routing_scan(routing: DataFrame, names: str) -> DataFrame:
    """Routes of the configured topics (exact names)."""
    return routing.where(F.col("topic").isin(split_names(names)))


def routing_lookup(routing: DataFrame, name: str | Column, substring: bool = False) -> DataFrame:
    """The route for one topic name: none or one row.

    ``substring`` also takes routes whose topic occurs in the name. Of several the first counts, by the place in the
    file (``position``) where the routes were read from one, then by topic.
    """
    name = name if isinstance(name, Column) else F.lit(name)
    found = routing.where(name.contains(F.col("topic")) if substring else F.col("topic") == name)
    return found.orderBy(*[c for c in ("position", "topic") if c in routing.columns]).limit(1)


def destination(default_table: str = DEFAULT_TABLE) -> Column:
    """``dataset.table`` with the default for a missing or blank table name."""
    return F.concat_ws(".", F.col("dataset"), F.when(is_blank("table"), F.lit(default_table)).otherwise(F.col("table")))


def commit_interval(default_seconds: int | str | None = DEFAULT_COMMIT_INTERVAL_SECONDS) -> Column:
    """The topic's own interval if positive, else the given default.

    A default that is not a number falls back to the built-in one.
    """
    try:
        default = int(default_seconds)
    except (TypeError, ValueError):
        default = DEFAULT_COMMIT_INTERVAL_SECONDS
    own = F.col("commit_interval_seconds")
    return F.when(own > 0, own).otherwise(F.lit(default).cast("bigint"))


def with_route(routing: DataFrame, default_seconds: int | str | None = DEFAULT_COMMIT_INTERVAL_SECONDS) -> DataFrame:
    """Routing rows with ``destination`` and ``interval_seconds`` resolved."""
    return routing.withColumn("destination", destination()).withColumn(
        "interval_seconds", commit_interval(default_seconds)
    )


def one_route_per_topic(routing: DataFrame) -> DataFrame:
    """``routing``, refused if a topic has two routes: each record would be written twice."""
    twice = routing.groupBy("topic").count().where("count > 1").select("topic").take(5)
    if twice:
        raise ValueError(f"topics with more than one route: {', '.join(sorted(str(r.topic) for r in twice))}")
    return routing


def route_records(records: DataFrame, routing: DataFrame) -> DataFrame:
    """Records of routed topics with their destination; others are left out.

    Spark broadcasts the routing table if its known size allows, so the records
    are not shuffled; beyond that it joins by shuffle with skew handling.
    """
    routes = with_known_size(routing.select("topic", destination().alias("destination")))
    return records.join(one_route_per_topic(routes), "topic")
