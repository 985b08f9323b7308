"""Column functions, all built from JVM-side expressions."""

from starmill.functions.columns import as_column
from starmill.functions.dates import (
    WEEKDAYS,
    calendar_parts,
    epoch_millis,
    epoch_seconds,
    epoch_to_date,
    parse_date,
    parse_timestamp,
    sas_day_to_date,
    sas_day_to_timestamp,
)
from starmill.functions.keys import hash_key, md5_key, row_key
from starmill.functions.numbers import as_long, rounded_decimal, share_percent
from starmill.functions.text import code_text, fallback_identifier, pair_part, upper_text

__all__ = [
    "WEEKDAYS",
    "as_column",
    "as_long",
    "calendar_parts",
    "code_text",
    "epoch_millis",
    "epoch_seconds",
    "epoch_to_date",
    "fallback_identifier",
    "hash_key",
    "md5_key",
    "pair_part",
    "parse_date",
    "parse_timestamp",
    "rounded_decimal",
    "row_key",
    "sas_day_to_date",
    "sas_day_to_timestamp",
    "share_percent",
    "upper_text",
]
