"""Scalar column expressions. All are built-in functions, so they stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = r"^[+-]?[0-9]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partition_key(topic: Column | str = "topic", partition: Column | str = "partition") -> Column:
    """``topic:partition`` as text; NULL when either part is NULL."""
    return F.concat(_col(topic), F.lit(":"), _col(partition).cast("string"))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and whitespace-only text."""
    c = _col(c)
    return c.isNull() | c.rlike(r"^\s*\z")


def _strict(c: Column | str, to: str) -> Column:
    # A plain try_cast trims blanks; the digit guard rejects them.
    text = _col(c).cast("string")
    return F.when(text.rlike(_DIGITS), text.try_cast(to))


def strict_int(c: Column | str) -> Column:
    """32-bit integer from text made of digits and one optional sign, else NULL."""
    return _strict(c, "int")


def strict_long(c: Column | str) -> Column:
    """64-bit integer from text made of digits and one optional sign, else NULL."""
    return _strict(c, "bigint")


def parse_partition_key(c: Column | str) -> Column:
    """Struct ``(topic, partition)`` from ``topic:partition`` text.

    NULL unless the text has exactly two parts, a topic that is not blank and a
    32-bit partition number.
    """
    parts = F.split(_col(c), ":", -1)
    topic, partition = F.get(parts, F.lit(0)), strict_int(F.get(parts, F.lit(1)))
    ok = (F.size(parts) == 2) & ~is_blank(topic) & partition.isNotNull()
    return F.when(ok, F.struct(topic.alias("topic"), partition.alias("partition")))


# The characters a column name may keep, and two currency signs
# that are spelled out.
_INVALID_NAME_CHAR = "[^A-Za-z0-9€$]"
_CURRENCY_WORDS = {"€": "EURO", "$": "DOLLAR"}


def normalise_name(name: Column | str) -> Column | str:
    """Column name made safe for a table: a text in gives a text, a Column a Column."""
    if isinstance(name, str):
        out = re.sub(_INVALID_NAME_CHAR, "_", name)
        for sign, word in _CURRENCY_WORDS.items():
            out = out.replace(sign, word)
        return out.lower()
    out = F.regexp_replace(name, _INVALID_NAME_CHAR, "_")
    for sign, word in _CURRENCY_WORDS.items():
        out = F.replace(out, F.lit(sign), F.lit(word))
    return F.lower(out)


def iso_now() -> Column:
    """The current instant as ISO-8601 text in UTC."""
    utc = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since 1970 of an instant."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def utc_instant(ts: Column | str) -> Column:
    """The instant that a timestamp without time zone means if it was written in UTC, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(ts)).cast("timestamp")


def format_message(record_id: Column | str, timestamp: Column | str, value: Column | str) -> Column:
    """JSON text ``{"id":…,"timestamp":…,"value":…}`` with six decimals."""
    return F.format_string(
        '{"id":"%s","timestamp":"%s","value":%.6f}', _col(record_id), _col(timestamp), _col(value)
    )
