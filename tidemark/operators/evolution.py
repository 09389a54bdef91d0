"""Writing rows of a newer schema to a table that was made with an older one.

An existing table keeps the schema it was made with. Rows are cut to it, field by
field: what the table does not know is dropped, what only the table knows becomes
NULL, and rows are refused where that, or the type, is not possible. The offsets
of all rows are known beforehand, so none is lost whatever the table keeps; where
it has no nested metadata but the flat columns of older tables, those are filled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import META_OFFSET, META_PARTITION, META_TOPIC, RAW_METADATA
from ..sources.versions import Versions
from .conform import conform

_FLAT = (META_TOPIC, META_PARTITION, META_OFFSET)


@dataclass(frozen=True)
class Decision:
    """What becomes of a field: kept, cast, dropped, null, moved or refused."""

    field: str
    decision: str
    reason: str


def compare(declared: T.StructType, recorded: T.StructType, path: str = "") -> list[Decision]:
    """One decision per field of either schema, in the order of the declared one, then the table's own.

    ``refused`` means that no row can be written: the table requires a field that rows do not have. A cast decides
    row by row.
    """
    have, found = {f.name: f for f in recorded.fields}, []
    for f in declared.fields:
        name, there = path + f.name, have.get(f.name)
        if there is None:
            moved = not path and f.name == RAW_METADATA and set(_FLAT) <= set(have)
            found.append(Decision(name, "moved", "to the flat columns") if moved else Decision(name, "dropped", "not in the table"))
        elif isinstance(f.dataType, T.StructType) and isinstance(there.dataType, T.StructType):
            found += compare(f.dataType, there.dataType, f"{name}.")
        elif f.dataType != there.dataType:
            found.append(Decision(name, "cast", f"{f.dataType.simpleString()} to {there.dataType.simpleString()}"))
        else:
            found.append(Decision(name, "kept", "same type"))
    filled = set(_FLAT) if not path and RAW_METADATA in declared.fieldNames() else set()
    for f in recorded.fields:
        if f.name not in declared.fieldNames() and f.name not in filled:
            found.append(Decision(path + f.name, "null" if f.nullable else "refused", "not in the rows" if f.nullable else "required, not in the rows"))
    return found


def with_flat_metadata(rows: DataFrame, recorded: T.StructType) -> DataFrame:
    """``rows`` with the flat metadata columns that the table has and the rows only nest."""
    if RAW_METADATA not in rows.columns:
        return rows
    nested = rows.schema[RAW_METADATA].dataType.fieldNames()
    flat = {f: F.col(RAW_METADATA)[f] for f in _FLAT if f in recorded.fieldNames() and f not in rows.columns and f in nested}
    return rows.withColumns(flat) if flat else rows


def fit_existing(
    rows: DataFrame, recorded: T.StructType, rules: dict[str, Column] | None = None, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows as the table takes them, rows it refuses with ``error``)."""
    return conform(with_flat_metadata(rows, recorded), recorded, rules, keep)


class RecordedSchema:
    """The schema that a table was made with, kept beside it; the first writer records it."""

    def __init__(self, spark: SparkSession, path: str):
        self.versions = Versions(spark, f"{path.rstrip('/')}/_schema")

    def of(self, declared: T.StructType) -> T.StructType:
        """The table's schema; ``declared`` for a new table, which is made with it."""
        if not self.versions.has(0):
            self.versions.put(0, declared.jsonValue())
        return T.StructType.fromJson(self.versions.get(0))
