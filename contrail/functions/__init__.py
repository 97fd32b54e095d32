"""Column -> Column helpers. All are built-in Spark expressions (codegen, no UDF)."""

from contrail.functions.scalar import (
    archive_path,
    element,
    epoch_seconds,
    from_hex,
    iso_utc,
    json_int,
    round_scaled,
    safe_div,
    strict_double,
    to_hex,
    track_file_name,
)

__all__ = [
    "archive_path",
    "element",
    "epoch_seconds",
    "from_hex",
    "iso_utc",
    "json_int",
    "round_scaled",
    "safe_div",
    "strict_double",
    "to_hex",
    "track_file_name",
]
