"""Table schemas from field definitions.

A definition is a list of dicts ``name, type, mode`` with ``fields`` for nested
records and optional ``isDerived``.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalise_name
from ..schemas import VERSION

# Type names of field definitions. RECORD nests; any other name
# and a missing one mean text.
_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "INTEGER": T.LongType(),
    "NUMERIC": T.DecimalType(38, 9),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),  # Spark's TIME type is off by default; the text is checked instead
    "DATETIME": T.TimestampNTZType(),
}

# The raw table's fields, without the version column.
RAW_MESSAGE_FIELDS: list[dict] = [
    {"name": "raw_message", "type": "STRING", "mode": "NULLABLE"},
    {"name": "kafka_topic", "type": "STRING", "mode": "NULLABLE"},
    {
        "name": "__metadata",
        "type": "RECORD",
        "mode": "NULLABLE",
        "fields": [
            {"name": "_meta_kafka_topic", "type": "STRING", "mode": "NULLABLE"},
            {"name": "_meta_kafka_partition", "type": "INTEGER", "mode": "NULLABLE"},
            {"name": "_meta_kafka_offset", "type": "INTEGER", "mode": "NULLABLE"},
        ],
    },
]

TIME_PATTERN = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9](\.[0-9]{1,6})?\z"

VERSION_FIELD = {"name": VERSION, "type": "INTEGER", "mode": "REQUIRED"}

#: One row per field; the layout used by the definition-level DataFrame operators.
FIELD_ROW = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("isDerived", T.BooleanType()),
])


def load_fields(spark: SparkSession, path: str) -> list[dict]:
    """Field definitions from a JSON file; a missing one, or one that isn't JSON, gives none."""
    try:
        text = spark.read.text(path, wholetext=True).first()
        fields = json.loads(text["value"]) if text else []
    except json.JSONDecodeError:
        return []
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return fields if isinstance(fields, list) else []


def spark_type(type_name: str | None, mode: str | None = None) -> T.DataType:
    """Spark type of a scalar definition; REPEATED gives an array."""
    scalar = _TYPES.get((type_name or "").strip().upper(), T.StringType())
    return T.ArrayType(scalar) if mode == "REPEATED" else scalar


def _struct_field(field: dict, recursive: bool) -> T.StructField:
    mode = field.get("mode")
    data_type: T.DataType
    if recursive and field.get("type") == "RECORD":
        data_type = struct_type(field.get("fields") or [], with_version=False)
        if mode == "REPEATED":
            data_type = T.ArrayType(data_type)
    else:
        data_type = spark_type(field.get("type"), mode)
    is_time = (field.get("type") or "").strip().upper() == "TIME" and mode != "REPEATED"
    return T.StructField(
        field["name"], data_type, nullable=mode != "REQUIRED", metadata={"pattern": TIME_PATTERN} if is_time else None
    )


def struct_type(fields: list[dict], with_version: bool = True, recursive: bool = True) -> T.StructType:
    """StructType of the definitions, with the required version column at the end."""
    all_fields = [f for f in fields or [] if f] + ([VERSION_FIELD] if with_version else [])
    return T.StructType([_struct_field(f, recursive) for f in all_fields])


def raw_projection(df: DataFrame, fields: list[dict], with_version: bool = True) -> DataFrame:
    """Every defined field as text, then the version; absent ones are NULL."""
    def text(name: str):
        if name not in df.columns:
            return F.lit(None).cast("string").alias(name)
        nested = isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType))
        return (F.to_json(name) if nested else F.col(name).cast("string")).alias(name)

    version = [F.col(VERSION).cast("bigint").alias(VERSION)] if with_version else []
    return df.select(*[text(f["name"]) for f in fields], *version)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Columns renamed to names a table accepts."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def default_fields(names: list[str], normalise: bool = False) -> list[dict]:
    """Nullable text definitions for plain names, such as ``df.columns``."""
    return [
        {"name": normalise_name(n) if normalise else n, "type": "STRING", "mode": "NULLABLE"} for n in names
    ]


def default_string_schema(names: list[str], normalise: bool = True) -> T.StructType:
    """All-text nullable StructType for plain names."""
    return struct_type(default_fields(names, normalise), with_version=False)


def fields_of_json(df: DataFrame, column: str) -> DataFrame:
    """Default definitions of all keys that occur in a column of JSON objects."""
    return (
        df.select(F.explode(F.json_object_keys(column)).alias("_key"))
        .distinct()
        .select(
            normalise_name(F.col("_key")).alias("name"), F.lit("STRING").alias("type"), F.lit("NULLABLE").alias("mode")
        )
        .distinct()
    )


def field_stats(fields: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Number of fields and of those that are not derived, per ``keys``."""
    return fields.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("field_count"),
        F.count_if(~F.coalesce("isDerived", F.lit(False))).alias("actual_field_count"),
    )


def field_names(fields: list[dict]) -> list[str]:
    return [f["name"] for f in fields]


def actual_field_count(fields: list[dict]) -> int:
    """Fields that are not derived from others."""
    return sum(not f.get("isDerived", False) for f in fields)
