"""Logs over the given tables.

Each is a narrow projection, so reading one costs a scan and nothing else.
``events`` becomes a log of five partitions of which partition 0 holds a third
of all records; ids are consecutive, so offsets per partition are too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KEY
from ..sources.routes import parse_routes

VERSION_MS = 1_700_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full log; some payloads invalid, some NULL."""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.expr("""case when event_id % 3 = 0 then 0 when event_id % 6 = 1 then 1
                       when event_id % 6 = 2 then 2 when event_id % 6 = 4 then 3 else 4 end""").alias("partition"),
        F.expr("case when event_id % 3 = 0 then event_id div 3 else event_id div 6 end").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").cast("string").alias("key"),
        F.expr("""case when event_type = 'error' and event_id % 5 = 0
                       then concat('{"errorMessage":"e', cast(event_id as string), '"}')
                       when event_id % 101 = 0 then cast(null as string)
                       else concat('{"type":"', event_type, '","props":', props, '}') end""").alias("value"),
    )


def observed(log: DataFrame) -> DataFrame:
    """The log with holes one and three offsets wide."""
    return log.where("offset % 97 <> 41 and offset % 89 not in (10, 11, 12)")


def redelivered(log: DataFrame) -> DataFrame:
    """All records, some delivered a second time, a second later."""
    copies = F.explode(F.expr("if(offset % 50 = 0, array(0, 1), array(0))")).alias("copy")
    return log.select("*", copies).withColumn("timestamp", F.expr("timestamp + make_dt_interval(0, 0, 0, copy)")).drop("copy")


def arrivals(log: DataFrame) -> DataFrame:
    """A log in which records are missing, and some came twice."""
    return redelivered(observed(log))


def wide_ranges(log: DataFrame) -> DataFrame:
    """Each observed offset as a range of 2^14: a log over many buckets of the range core."""
    return observed(log).select(*KEY, F.expr("offset << 14").alias("start_offset"), F.expr("(offset << 14) + 16383").alias("end_offset"))


def wide_seed(log: DataFrame) -> DataFrame:
    return checkpoint_seed(log).withColumn("next_offset", F.expr("next_offset << 14"))


#: Steps in which the log's records become handled, and the time between two of them.
STEPS = 2
STEP_MS = 40_000


def handled_steps(log: DataFrame) -> DataFrame:
    """Every offset with the ``step`` in which it is handled: the log in halves, one in ten a step later than its
    neighbours, and copies once more a step later. A few rows have no key."""
    n = log.count()
    late = F.expr("if(offset % 10 = 7, 1, 0)")
    part = F.floor(F.col("key").cast("bigint") * F.lit(STEPS) / F.lit(n)).cast("int")
    again = F.explode(F.expr("if(offset % 50 = 0, array(0, 1), array(0))")).alias("again")
    steps = log.select("topic", "partition", "offset", (F.least(part, F.lit(STEPS - 1)) + late).alias("step"), again)
    topic = F.when((F.col("offset") % 500 == 250) & (F.col("again") == 1), F.lit(None)).otherwise(F.col("topic"))
    return steps.select(topic.alias("topic"), "partition", F.col("offset").alias("start_offset"), F.col("offset").alias("end_offset"), (F.col("step") + F.col("again")).alias("step"))


def checkpoint_seed(log: DataFrame) -> DataFrame:
    """Next wanted offsets; partition 4 has none."""
    return log.where("partition < 4").groupBy(*KEY).agg(
        F.any_value(F.expr("cast(case partition when 0 then 0 when 1 then 100 else 10 end as bigint)")).alias(
            "next_offset"
        )
    )


def commit_entries(log: DataFrame) -> DataFrame:
    """A history of commits: per key and hour, the largest offset of its records was acknowledged."""
    hours = log.groupBy(*KEY, F.window("timestamp", "1 hour").alias("w")).agg(F.max("offset").alias("last_acked"))
    return hours.select(
        *KEY,
        (F.col("last_acked") + 1).alias("next_offset"),
        "last_acked",
        (F.lit(VERSION_MS) + F.col("last_acked")).alias("updated_at_ms"),
        F.concat(F.lit("job-"), (F.col("last_acked") % 7).cast("string")).alias("updated_by"),
        F.col("w.start").alias("hour"),
    )


def raw_row_variants(log: DataFrame) -> DataFrame:
    """Raw-table rows of all ages: nested, flat, incomplete and unreadable metadata."""
    event = F.col("key").cast("bigint")
    nested = F.struct(
        F.when(event % 13 != 12, F.col("topic")).alias("_meta_kafka_topic"),
        F.when(event % 12 == 0, F.concat(F.lit(" "), F.col("partition").cast("string")))
        .when(event % 12 == 1, F.concat(F.lit("+"), F.col("partition").cast("string")))
        .when(event % 8 != 4, F.col("partition").cast("string"))
        .alias("_meta_kafka_partition"),
        F.col("offset").cast("string").alias("_meta_kafka_offset"),
    )
    return log.select(
        F.col("value").alias("raw_message"),
        F.when(event % 4 < 2, nested).alias("__metadata"),
        F.when(event % 17 == 16, F.lit(" ")).otherwise(F.col("topic")).alias("_meta_kafka_topic"),
        F.when(event % 5 == 2, F.concat(F.lit("x"), F.col("partition").cast("string")))
        .otherwise(F.col("partition").cast("string"))
        .alias("_meta_kafka_partition"),
        F.when(event % 11 == 6, F.lit("99999999999999999999"))
        .when(event % 7 != 3, F.col("offset").cast("string"))
        .alias("_meta_kafka_offset"),
    )


#: A table of the time before nested metadata: flat columns, no topic, and a date that newer rows do not have.
OLDER_FIELDS = [
    {"name": "raw_message", "type": "STRING", "mode": "REQUIRED"},
    {"name": "_meta_kafka_topic", "type": "STRING", "mode": "NULLABLE"},
    {"name": "_meta_kafka_partition", "type": "INTEGER", "mode": "NULLABLE"},
    {"name": "_meta_kafka_offset", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "loaded_on", "type": "DATE", "mode": "NULLABLE"},
]


def keyed_variants(log: DataFrame) -> DataFrame:
    """Text keys, well-formed and not."""
    partition = F.col("partition").cast("string")
    n = F.col("key").cast("bigint") % 9
    shapes = [
        F.concat(F.lit("events:"), partition), F.lit("events"), F.concat(F.lit(":"), partition),
        F.concat(F.lit("a:b:"), partition), F.concat(F.lit("events:x"), partition),
        F.concat(F.lit("events: "), partition), F.concat(F.lit("events:+"), partition),
        F.concat(F.lit("events:9999999999"), partition), F.concat(F.lit("  :"), partition),
    ]
    return log.select(F.coalesce(*[F.when(n == i, s) for i, s in enumerate(shapes)]).alias("partition_key"), "offset")


def loose_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as untyped text with an unknown column; some do not fit ``LOOSE_FIELDS``."""
    return table(spark, sf_dir, "events").select(
        F.expr("case when event_id % 29 = 3 then concat(cast(event_id as string), 'x') "
               "when event_id % 31 = 4 then null else cast(event_id as string) end").alias("id"),
        F.expr("if(event_id % 37 = 5, null, event_type)").alias("kind"),
        F.expr("concat(cast(user_id as string), '.5')").alias("amount"),
        F.expr("case when event_id % 41 = 6 then 'no day' when event_id % 43 = 7 then null "
               "else '2024-01-15' end").alias("day"),
        F.expr("case event_id % 3 when 0 then 'true' when 1 then 'false' "
               "else if(event_id % 47 = 8, 'maybe', 'true') end").alias("seen"),
        F.expr("named_struct('k', case when event_id % 53 = 9 then 'k' else cast(user_id as string) end, "
               "'unused', 1)").alias("meta"),
        F.col("props").alias("unknown"),
        F.col("event_id").alias("_row"),
    )


LOOSE_FIELDS = [
    {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "kind", "type": "STRING", "mode": "REQUIRED"},
    {"name": "amount", "type": "FLOAT", "mode": "NULLABLE"},
    {"name": "day", "type": "DATE", "mode": "NULLABLE"},
    {"name": "seen", "type": "BOOLEAN", "mode": "NULLABLE"},
    {"name": "absent", "type": "STRING", "mode": "NULLABLE"},
    {"name": "meta", "type": "RECORD", "mode": "NULLABLE",
     "fields": [{"name": "k", "type": "INTEGER", "mode": "NULLABLE"}]},
]


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of one topic per source."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("topic"),
        (F.col("doc_id") % 3).cast("int").alias("partition"),
        F.col("doc_id").alias("offset"),
        F.col("text").alias("payload"),
    )


def document_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One route per document source, read from JSON text; some lack table or interval."""
    number = "cast(substring(source, 4) as int)"
    text = F.expr(f"""
        concat('{{"topicConfigs":[{{"topicName":"', source, '","datasetName":"set', {number} % 4, '"',
               case {number} % 3 when 0 then concat(',"tableName":"t_', source, '"')
                                 when 1 then ',"tableName":" "' else '' end,
               case {number} % 4 when 0 then '' when 1 then ',"checkpointCommitIntervalSeconds":0'
                                 else concat(',"checkpointCommitIntervalSeconds":', 10 + {number}) end,
               ',"owner":"', min_lang, '"}}]}}')
    """)
    sources = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("lang").alias("min_lang"))
    return parse_routes(sources.select(text.alias("text")), "text")


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of many short partitions: one per conversation."""
    return table(spark, sf_dir, "conversations").select(
        F.lit("conv").alias("topic"),
        F.col("conv_id").cast("int").alias("partition"),
        F.col("turn").alias("offset"),
        F.col("text").alias("payload"),
    )
