"""Column layouts shared by all modules.

A log is addressed by the two typed columns ``topic`` and ``partition``;
offsets are 64-bit. Handled offsets travel as inclusive ranges
``start_offset .. end_offset`` so that a wide gap stays one row.
"""

from pyspark.sql import types as T

KEY = ["topic", "partition"]

LOG_RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("payload", T.StringType()),
])

OFFSET_RANGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("start_offset", T.LongType()),
    T.StructField("end_offset", T.LongType()),
])

HANDLED_RANGE = T.StructType(OFFSET_RANGE.fields + [T.StructField("reason", T.StringType())])

CHECKPOINT = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("next_offset", T.LongType()),
    T.StructField("last_acked", T.LongType()),
    T.StructField("updated_at_ms", T.LongType()),
    T.StructField("updated_by", T.StringType()),
])

ROUTING = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("commit_interval_seconds", T.LongType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

# Names of the raw table's columns, its default table name and
# the keyword that marks a payload as invalid.
RAW_MESSAGE = "raw_message"
RAW_TOPIC = "kafka_topic"
RAW_METADATA = "__metadata"
META_TOPIC = "_meta_kafka_topic"
META_PARTITION = "_meta_kafka_partition"
META_OFFSET = "_meta_kafka_offset"
VERSION = "version"
DEFAULT_TABLE = "KAFKA_RAW_MESSAGE"
INVALID_KEYWORD = "errorMessage"

# Defaults in seconds and records.
DEFAULT_WINDOW_SECONDS = 10
DEFAULT_GAP_TIMEOUT_SECONDS = 300
DEFAULT_COMMIT_INTERVAL_SECONDS = 60
DEFAULT_TICKS_PER_SECOND = 100
DEFAULT_RECORDS_PER_TICK = 10
