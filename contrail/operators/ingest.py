"""Ingest bookkeeping: expected days, what is present, missing or known empty, and
which source wins.

Model: one payload per ``(entity, day)``. A *manifest history* records every look at a
payload: ``(entity, day, status, source, seen_at)`` with status ``has_data`` or
``no_data``; the latest look per ``(entity, day)`` wins (the status cache). Files that
are present are a list of their own: a run skips a day because its file is there, not
because of its status. Every step is a join or hash aggregate keyed by ``(entity, day)``;
nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions import archive_path, track_file_name

# Cache statuses and run outcomes of the fetch script.
HAS_DATA = "has_data"
NO_DATA = "no_data"
UNKNOWN = "unknown"
OUTCOME_SKIPPED = "skipped"  # its file is present
OUTCOME_CACHED_NO_DATA = "cached_no_data"  # known empty, not fetched again
OUTCOME_PENDING = "to_fetch"  # neither
OUTCOME_DOWNLOADED = "downloaded"  # fetched with a usable payload
OUTCOME_FAILED = "failed"  # fetched without one
TOTAL = "total"
STATUSES = (NO_DATA, HAS_DATA)  # at equal times the later one wins
SOURCES = ("fallback", "primary")


def day_span(first: Column, last: Column) -> Column:
    """Every day from ``first`` to ``last``, both inclusive (array<date>)."""
    return F.sequence(first, last, F.expr("INTERVAL 1 DAY"))


def expected_days(spans: DataFrame, keys: Sequence[str] = ("entity",), first: str = "first_day",
                  last: str = "last_day") -> DataFrame:
    """One row per key and calendar day of its span, with the day's file name and
    archive path (F26, F27, F30). Rows per key are bounded by the span in days."""
    keys = list(keys)
    return (
        spans.select(*keys, F.explode(day_span(F.col(first), F.col(last))).alias("day"))
        .withColumn("day_number", F.unix_date("day"))
        .withColumn("file_name", track_file_name("day"))
        .withColumn("archive_path", archive_path("day"))
    )


def latest_status(history: DataFrame, keys: Sequence[str] = ("entity", "day")) -> DataFrame:
    """The latest look per key wins as a whole: its status and source stay together.

    Time, status and source are packed into one BIGINT (microseconds, then the places in
    ``STATUSES`` and ``SOURCES``), so one ``max`` decides: a hash aggregate with map-side
    combine and a defined winner for equal times. Statuses and sources beside the fixed
    ones count as ``NULL`` and lose ties.
    """
    keys = list(keys)
    place = lambda c, known: F.coalesce(F.array_position(F.array(*map(F.lit, known)), F.col(c)), F.lit(0))
    at = F.unix_micros(F.col("seen_at").cast("timestamp"))
    packed = at * 16 + place("status", STATUSES) * 4 + place("source", SOURCES)
    kind = history.schema["seen_at"].dataType
    best = history.groupBy(*keys).agg(F.max(packed).alias("_best"))
    code = lambda shift, known: F.get(
        F.array(*map(F.lit, known)), F.pmod(F.shiftright("_best", shift), F.lit(4)).cast("int") - 1
    )
    return best.select(
        *keys,
        code(2, STATUSES).alias("status"),
        code(0, SOURCES).alias("source"),
        F.timestamp_micros(F.shiftright("_best", 4)).cast(kind).alias("seen_at"),
    )


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """Null-safe equality of the keys (a hash or sort key like any other)."""
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[f"_{k}"])
    return same


def _renamed(df: DataFrame, keys: Sequence[str], *others: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys], *others)


def upsert(manifest: DataFrame, updates: DataFrame, keys: Sequence[str] = ("entity", "day")) -> DataFrame:
    """W7 as a table operation: an update replaces its key's entry, whatever their times.

    The cache deletes a day's line and appends the new one. Both sides may hold several
    looks per key; the latest of each side stands for it.
    """
    new, old = latest_status(updates, keys), latest_status(manifest, keys)
    other = _renamed(new, keys)
    kept = old.join(other, _same(old, other, keys), "left_anti")
    return new.unionByName(kept, allowMissingColumns=True)


def classify_days(
    expected: DataFrame, latest: DataFrame, present: DataFrame, keys: Sequence[str] = ("entity", "day")
) -> DataFrame:
    """Every expected day with its cached status (``unknown`` without an entry) and
    what a run does with it: skipped where its file is present, not fetched again where
    it is cached as empty, else fetched (also where the cache says has_data but the file
    is gone). ``present`` lists the keys of the files that are there.
    """
    keys = list(keys)
    cached = _renamed(latest.groupBy(*keys).agg(F.max("status").alias("status")), keys, "status")
    files = _renamed(present.distinct(), keys).withColumn("_present", F.lit(True))
    out = expected.join(cached, _same(expected, cached, keys), "left").drop(*[f"_{k}" for k in keys])
    out = out.join(files, _same(out, files, keys), "left").drop(*[f"_{k}" for k in keys])
    outcome = (
        F.when(F.col("_present"), F.lit(OUTCOME_SKIPPED))
        .when(F.col("status") == NO_DATA, F.lit(OUTCOME_CACHED_NO_DATA))
        .otherwise(F.lit(OUTCOME_PENDING))
    )
    return (
        out.withColumn("outcome", outcome)
        .withColumn("status", F.coalesce(F.col("status"), F.lit(UNKNOWN)))
        .drop("_present")
    )


def missing_days(
    expected: DataFrame, latest: DataFrame, present: DataFrame, keys: Sequence[str] = ("entity", "day")
) -> DataFrame:
    """Expected days that a run fetches: no file, and not known to be empty."""
    keys = list(keys)
    files = _renamed(present.distinct(), keys)
    empty = _renamed(latest.filter(F.col("status") == NO_DATA), keys)
    out = expected.join(files, _same(expected, files, keys), "left_anti")
    return out.join(empty, _same(out, empty, keys), "left_anti")


def run_outcomes(classified: DataFrame, fetched: DataFrame, keys: Sequence[str] = ("entity", "day")) -> DataFrame:
    """Outcomes after the run: a day that was to be fetched is ``downloaded`` if ``fetched``
    (keys with a usable payload from either feed, and the feed as ``source`` if it is given)
    holds it, else ``failed``. ``source`` is the feed that gave the payload, the primary one
    where both do; NULL for days that the run did not download."""
    keys = list(keys)
    feed = F.col("source") if "source" in fetched.columns else F.lit(SOURCES[-1])
    place = F.array_position(F.array(*map(F.lit, SOURCES)), feed)
    given = fetched.groupBy(*keys).agg(F.max(place).alias("_feed"))
    got = _renamed(given, keys, "_feed")
    out = classified.join(got, _same(classified, got, keys), "left").drop(*[f"_{k}" for k in keys])
    pending = F.col("outcome") == OUTCOME_PENDING
    ended = F.when(F.col("_feed").isNotNull(), F.lit(OUTCOME_DOWNLOADED)).otherwise(F.lit(OUTCOME_FAILED))
    source = F.get(F.array(*map(F.lit, SOURCES)), F.col("_feed").cast("int") - 1)
    return out.withColumns(
        {
            "source": F.when(pending, source),
            "outcome": F.when(pending, ended).otherwise(F.col("outcome")),
        }
    ).drop("_feed")


def run_updates(ended: DataFrame, seen_at) -> DataFrame:
    """What a run writes to the cache: has_data for downloaded days, with the feed that gave them,
    and no_data for failed ones, which the fallback feed was asked for last."""
    status = F.when(F.col("outcome") == OUTCOME_DOWNLOADED, F.lit(HAS_DATA)).otherwise(F.lit(NO_DATA))
    return ended.filter(F.col("outcome").isin(OUTCOME_DOWNLOADED, OUTCOME_FAILED)).select(
        "entity",
        "day",
        status.alias("status"),
        F.coalesce(F.col("source"), F.lit(SOURCES[0])).alias("source"),
        seen_at.alias("seen_at"),
    )


def outcome_counts(ended: DataFrame) -> DataFrame:
    """Days per outcome plus the total (``rollup``; the grand total is ``total``)."""
    return (
        ended.rollup("outcome")
        .agg(F.count(F.lit(1)).alias("days"))
        .select(F.coalesce(F.col("outcome"), F.lit(TOTAL)).alias("outcome"), "days")
    )


def run_status(ended: DataFrame) -> DataFrame:
    """One row: days processed, days failed and whether the run counts as failed (any did)."""
    failed = F.count_if(F.col("outcome") == OUTCOME_FAILED)
    return ended.agg(F.count(F.lit(1)).alias("processed"), failed.alias("failed")).withColumn(
        "run_failed", F.col("failed") > 0
    )


def choose_source(primary: DataFrame, fallback: DataFrame, keys: Sequence[str] = ("entity", "day")) -> DataFrame:
    """The primary payload where there is one, else the fallback payload.

    ``primary ∪ (fallback ▷ primary)`` by name; columns missing on one side are NULL.
    """
    keys = list(keys)
    first = _renamed(primary, keys)
    rest = fallback.join(first, _same(fallback, first, keys), "left_anti")
    return primary.unionByName(rest, allowMissingColumns=True)


def valid_payload(text: Column, key: str) -> Column:
    """A payload is usable when it is non-empty and contains ``key``."""
    return text.isNotNull() & (F.length(text) > 0) & text.contains(key)


def status_line(day: Column, status: Column) -> Column:
    """The status-cache text line ``yyyy-MM-dd:status``."""
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(":"), status)


def parse_status_line(line: Column) -> tuple[Column, Column]:
    """``yyyy-MM-dd:status`` -> (DATE, status); a bad date fails under ANSI."""
    return F.to_date(F.split_part(line, F.lit(":"), F.lit(1))), F.split_part(line, F.lit(":"), F.lit(2))
