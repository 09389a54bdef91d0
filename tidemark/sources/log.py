"""Reading and writing the log, as a batch or a stream.

Kafka is one format among others: ``segments`` (module ``segments``) is a log of
published files that starts at a checkpoint by itself; plain file logs in parquet
or JSON carry the same columns (``schemas.LOG_RECORD``).
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import at_or_above
from ..schemas import KEY, LOG_RECORD
from .segments import append_segments, read_segments

DEFAULT_PROTOCOL = "SASL_SSL"
EARLIEST = -2


def bootstrap_servers(brokers: str) -> str:
    """Broker list without URI schemes and trailing slashes."""
    if not brokers or not brokers.strip():
        raise ValueError("broker list is blank")
    hosts = [re.sub(r"^.+?://|/$", "", b.strip()) for b in brokers.split(",") if b.strip()]
    return ",".join(hosts)


def security_protocol(brokers: str | None) -> str:
    """The scheme of the first broker that has one, else SASL_SSL."""
    schemes = (re.match(r"\s*(.+?)://", b) for b in (brokers or "").split(","))
    return next((m.group(1).strip().upper() for m in schemes if m), DEFAULT_PROTOCOL)


@dataclass(frozen=True)
class LogSpec:
    """Where a log is. ``format`` is kafka, segments, parquet or json; ``path`` for the file formats.

    ``max_offsets_per_trigger`` bounds a Kafka micro-batch, so a backlog is worked off in steps; None lifts it.
    """

    format: str = "parquet"
    path: str | None = None
    brokers: str | None = None
    topics: tuple[str, ...] = ()
    username: str | None = None
    password: str | None = None
    group_id: str | None = None
    client_id: str | None = None
    max_offsets_per_trigger: int | None = 50_000_000
    options: dict[str, str] = field(default_factory=dict)


def _quoted(value: str | None) -> str:
    """Text as a quoted value of a login configuration."""
    return '"' + (value or "").replace("\\", "\\\\").replace('"', '\\"') + '"'


def kafka_connection(spec: LogSpec) -> dict[str, str]:
    """Connection options shared by Kafka source and sink."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers(spec.brokers or ""),
        "kafka.security.protocol": security_protocol(spec.brokers),
        "kafka.client.dns.lookup": "use_all_dns_ips",
    }
    if options["kafka.security.protocol"].startswith("SASL"):
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options["kafka.sasl.mechanism"] = "PLAIN"
        user, password = _quoted(spec.username), _quoted(spec.password)
        options["kafka.sasl.jaas.config"] = f"{login} required username={user} password={password};"
    if spec.client_id:
        options["kafka.client.id"] = spec.client_id
    return options


def kafka_read_options(spec: LogSpec, starting: str = "earliest") -> dict[str, str]:
    """Source options. Offsets are kept by Spark and the checkpoint table, so
    nothing is committed to the broker, and data lost to retention must not
    stop the query: it shows as a gap instead."""
    options = kafka_connection(spec) | {
        "subscribe": ",".join(spec.topics),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        "kafka.session.timeout.ms": "45000",
    }
    if spec.group_id:
        options["kafka.group.id"] = spec.group_id
    if spec.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(spec.max_offsets_per_trigger)
    return options | spec.options


def starting_offsets(current: DataFrame, topics: tuple[str, ...], partitions: dict[str, int] | None = None) -> str:
    """The ``startingOffsets`` JSON for the current checkpoint rows.

    The source wants it as one text, so it passes through the driver; its size is
    one number per log partition. ``partitions`` gives the partition count per
    topic, so that partitions without a checkpoint start at the earliest offset.
    The source wants every partition of every topic once offsets are named, so
    with any checkpoint the counts of all topics must be given; where they are not
    known, read from the earliest offset and leave out what is committed (``resume``).
    """
    rows = current.where(F.col("topic").isin(list(topics))).select(*KEY, "next_offset")
    found: dict[str, dict[str, int]] = {
        t: {str(p): EARLIEST for p in range((partitions or {}).get(t, 0))} for t in topics
    }
    for r in rows.toLocalIterator():
        found[r.topic][str(r.partition)] = r.next_offset
    unknown = [t for t in topics if t not in (partitions or {})]
    if any(found.values()) and unknown:
        raise ValueError(f"partition counts are needed to resume: {', '.join(unknown)}")
    found = {t: ps for t, ps in found.items() if ps}
    return json.dumps(found, sort_keys=True) if found else "earliest"


def read_log(
    spark: SparkSession, spec: LogSpec, streaming: bool = False, starting: str = "earliest", floors: DataFrame | None = None
) -> DataFrame:
    """The log as a DataFrame of ``LOG_RECORD`` columns.

    ``starting`` is Kafka's starting offsets; ``floors`` (``topic, partition, next_offset``) are those of a segment log.
    """
    if spec.format == "segments":
        return read_segments(spark, spec.path, streaming, floors, spec.topics, spec.options)
    reader = spark.readStream if streaming else spark.read
    if spec.format == "kafka":
        raw = reader.format("kafka").options(**kafka_read_options(spec, starting)).load()
        return raw.select(
            "topic", "partition", "offset", "timestamp",
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        )
    log = reader.format(spec.format).schema(LOG_RECORD).options(**spec.options).load(spec.path)
    return log.where(F.col("topic").isin(list(spec.topics))) if spec.topics else log


def resume(log: DataFrame, current: DataFrame) -> DataFrame:
    """The part of a log that is not committed yet, where the source itself cannot start there."""
    return at_or_above(log, current)


def write_log(records: DataFrame, spec: LogSpec, checkpoint: str | None = None, topic: str | None = None):
    """Write ``key, value`` records to the log; a streaming input returns its writer's query.

    ``topic`` sets one topic for all; else the records have a ``topic`` column.
    """
    if topic is not None:
        records = records.withColumn("topic", F.lit(topic))
    if spec.format == "segments":
        if not records.isStreaming:
            return append_segments(records, spec.path)
        run = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex
        step = records.writeStream.foreachBatch(lambda batch, n: append_segments(batch, spec.path, run, n))
        return step.option("checkpointLocation", checkpoint).start()
    if spec.format == "kafka":
        records = records.select("topic", F.col("key").cast("string"), F.col("value").cast("string"))
        options = kafka_connection(spec) | {"kafka.acks": "all"} | spec.options
    else:
        options = {"path": spec.path, **spec.options}
    if records.isStreaming:
        return (
            records.writeStream.format(spec.format).options(**options)
            .option("checkpointLocation", checkpoint).outputMode("append").start()
        )
    return records.write.format(spec.format).options(**options).mode("append").save()
