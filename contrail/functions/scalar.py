"""Scalar helpers shared by the operators.

Each helper returns a Column built only from ``pyspark.sql.functions``, so every
expression stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def element(arr: ColumnOrName, position: int) -> Column:
    """1-based element of an array; NULL when out of range.

    ``arr[i]`` raises under ANSI for a short array, ``get`` (0-based) does not.
    """
    return F.get(_col(arr), F.lit(position - 1))


def strict_double(c: ColumnOrName) -> Column:
    """Strict ``::DOUBLE``: a non-numeric text fails the job (ANSI cast)."""
    return _col(c).cast("double")


# Fixed value: the number syntax of JSON text (a sign may be +, digits may miss on one side).
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def json_int(c: ColumnOrName) -> Column:
    """JSON scalar text -> INT the way a JSON-aware cast does it.

    ``'3025.5'`` and ``'1e3'`` become 3026 (half to even) and 1000, ``'true'`` and
    ``'false'`` 1 and 0; text such as ``'ground'`` or ``'3000d'`` (a float literal to
    Spark's cast), out-of-range numbers and NULL become NULL. A plain ``try_cast(x as
    int)`` would null every fractional value instead.
    """
    text = _col(c).cast("string")
    number = F.when(text.rlike(_NUMBER), F.rint(text.try_cast("double")).try_cast("int"))
    return F.when(text == "true", F.lit(1)).when(text == "false", F.lit(0)).otherwise(number)


def round_scaled(c: ColumnOrName, digits: int) -> Column:
    """``ROUND(x, n)`` on a DOUBLE as ``round(x * 10^n) / 10^n``.

    Spark's ``round(x, n)`` rounds the decimal expansion of the double and differs
    in the last digit for values such as 0.285; scaling by a double first gives the
    same value as the SQL engines that round in binary.
    """
    scale = float(10**digits)
    return F.round(_col(c) * F.lit(scale)) / F.lit(scale)


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Timestamp (LTZ or NTZ) -> epoch seconds as DOUBLE with microsecond precision."""
    return F.unix_micros(_col(ts).cast("timestamp")) / F.lit(1e6)


def iso_utc(epoch: ColumnOrName) -> Column:
    """Epoch seconds (DOUBLE) -> ``yyyy-MM-ddTHH:mm:ssZ``; sub-seconds are truncated.

    The literal ``Z`` is only true with a UTC session zone (``configure`` sets it).
    """
    return F.date_format(F.timestamp_seconds(_col(epoch)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def safe_div(num: ColumnOrName, den: ColumnOrName, when_zero: float | None = None) -> Column:
    """``num / den`` with a zero (or NULL) divisor replaced by ``when_zero``.

    With ``when_zero=None`` the result is NULL for a zero divisor; ANSI mode would
    otherwise raise, and a filter placed before the division is not a guarantee.
    """
    den_c = F.nullif(_col(den), F.lit(0))
    if when_zero is not None:
        den_c = F.coalesce(den_c, F.lit(float(when_zero)))
    return _col(num) / den_c


def to_hex(c: ColumnOrName) -> Column:
    """Integer id -> lower-case hex text (``11256099`` -> ``'abc123'``)."""
    return F.lower(F.hex(_col(c)))


def from_hex(c: ColumnOrName) -> Column:
    """Hex text -> BIGINT (``'abc123'`` -> 11256099)."""
    return F.conv(_col(c), 16, 10).cast("bigint")


def archive_path(day: ColumnOrName) -> Column:
    """DATE -> ``yyyy/MM/dd`` archive partition path."""
    return F.date_format(_col(day), "yyyy/MM/dd")


# Fixed value: the daily file naming convention of the trace archive.
TRACK_FILE_PREFIX = "flight-track-"
TRACK_FILE_SUFFIX = ".json"
TRACK_FILE_DATE_PATTERN = r"flight-track-(\d{4}-\d{2}-\d{2})\.json"


def track_file_name(day: ColumnOrName) -> Column:
    """DATE -> ``flight-track-yyyy-MM-dd.json``."""
    return F.concat(
        F.lit(TRACK_FILE_PREFIX), F.date_format(_col(day), "yyyy-MM-dd"), F.lit(TRACK_FILE_SUFFIX)
    )
