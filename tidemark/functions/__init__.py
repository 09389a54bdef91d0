from .columns import (
    epoch_millis,
    format_message,
    is_blank,
    iso_now,
    normalise_name,
    parse_partition_key,
    partition_key,
    strict_int,
    strict_long,
    utc_instant,
)

__all__ = [
    "epoch_millis", "format_message", "is_blank", "iso_now", "normalise_name",
    "parse_partition_key", "partition_key", "strict_int", "strict_long", "utc_instant",
]
