"""Make rows fit a table schema, and set apart those that cannot.

Unknown columns are left out, missing nullable ones become NULL. A row that
lacks a required value, at any depth, or holds one that cannot be read as the
table's type without losing some of it, is rejected with the reasons in
``error``. All in one projection: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strict_long

_ROW, _ERROR = "_row", "error"


def _fields(t: T.DataType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in t.fields}


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _scalar(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the scalar ``want``; NULL where it has no such value, or only one that loses some of it."""
    if isinstance(have, _NESTED):
        return F.to_json(value) if isinstance(want, T.StringType) else F.lit(None).cast(want)
    read = value.try_cast(want)
    if isinstance(want, T.LongType):
        if isinstance(have, T.StringType):
            return strict_long(value)
        if isinstance(have, (T.FractionalType, T.DecimalType)):
            return F.when(F.floor(value) == value, read)
    if isinstance(want, T.DecimalType) and isinstance(have, T.StringType):
        return F.when(~value.rlike(rf"\.[0-9]{{{want.scale}}}[0-9]*[1-9]"), read)
    if isinstance(want, T.DateType):
        if isinstance(have, T.StringType):
            return F.when(value.rlike(r"^\s*[0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2}\s*\z"), read)
        if isinstance(have, (T.TimestampType, T.TimestampNTZType)):
            return F.when(read.cast(have) == value, read)
    return read


def _cast(value: Column, have: T.DataType | None, want: T.DataType) -> Column:
    if have is None:
        return F.lit(None).cast(want)
    if have == want:
        return value
    if isinstance(want, T.StructType):
        if not isinstance(have, T.StructType):
            return F.lit(None).cast(want)
        known = _fields(have)
        parts = [_cast(value[f.name] if f.name in known else F.lit(None), known.get(f.name), f.dataType).alias(f.name)
                 for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType):
        if not isinstance(have, T.ArrayType):
            return F.lit(None).cast(want)
        return F.transform(value, lambda v: _cast(v, have.elementType, want.elementType))
    return _scalar(value, have, want)


#: What can be wrong with a value, and how to say it.
Check = tuple[Callable[[Column], Column], str]


def _inside(known: dict[str, T.DataType], name: str, fails: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: v.isNotNull() & fails(v[name] if name in known else F.lit(None))


def _checks(path: str, have: T.DataType | None, want: T.StructField) -> list[Check]:
    """Checks of a field: that it is there if required, and that it can be read, at every depth."""
    found: list[Check] = []
    if not want.nullable:
        found.append((lambda v: v.isNull(), f"missing required field {path}"))
    if have is None:
        return found
    if "pattern" in want.metadata:
        fits = lambda v: F.coalesce(v.cast("string"), F.lit("")).rlike(want.metadata["pattern"])
        bad = lambda v: v.isNotNull() if isinstance(have, _NESTED) else v.isNotNull() & ~fits(v)
        return found + [(bad, f"cannot read field {path} as time")]
    to = want.dataType
    if isinstance(to, T.StructType) and isinstance(have, T.StructType):
        known = _fields(have)
        for f in to.fields:
            found += [(_inside(known, f.name, fails), text) for fails, text in _checks(f"{path}.{f.name}", known.get(f.name), f)]
        return found
    if isinstance(to, T.ArrayType) and isinstance(have, T.ArrayType) and isinstance(to.elementType, T.StructType):
        element = T.StructField("element", to.elementType)
        inner = _checks(path, have.elementType, element)
        return found + [(lambda v, fails=fails: F.coalesce(F.exists(v, fails), F.lit(False)), text) for fails, text in inner]
    if have == to:
        return found
    text = f"cannot read field {path} as {to.simpleString()}"
    if isinstance(to, T.ArrayType) and isinstance(have, T.ArrayType):
        unread = lambda v: v.isNotNull() & _cast(v, have.elementType, to.elementType).isNull()
        return found + [(lambda v: F.coalesce(F.exists(v, unread), F.lit(False)), text)]
    return found + [(lambda v: v.isNotNull() & _cast(v, have, to).isNull(), text)]


def check(df: DataFrame, schema: T.StructType, rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` plus ``error``: NULL for rows that fit, else the reasons joined by ``; ``.

    ``rules`` adds named conditions that a row must not meet.
    """
    known = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`") if f.name in known else F.lit(None)
        problems += [F.when(fails(value), F.lit(text)) for fails, text in _checks(f.name, known.get(f.name), f)]
    problems += [F.when(broken, F.lit(name)) for name, broken in (rules or {}).items()]
    if not problems:
        return df.withColumn(_ERROR, F.lit(None).cast("string"))
    return df.withColumn(_ERROR, F.nullif(F.concat_ws("; ", *problems), F.lit("")))


def fit(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to the schema's columns and types; ``keep`` carries others along."""
    known = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`") if f.name in known else F.lit(None)
        columns.append(_cast(value, known.get(f.name), f.dataType).alias(f.name))
    return df.select(*columns, *keep)


def conform(
    df: DataFrame, schema: T.StructType, rules: dict[str, Column] | None = None, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows fitting the schema, original rows that do not, with ``error``)."""
    checked = check(df, schema, rules)
    ok = fit(checked.where(F.col(_ERROR).isNull()), schema, keep)
    return ok, checked.where(F.col(_ERROR).isNotNull())
