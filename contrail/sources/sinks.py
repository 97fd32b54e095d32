"""Sinks: document files, point table, leg table, GeoJSON features, status-cache manifest.

A write is a full refresh (what lay there before is gone) or, with
``days_only=True``, replaces exactly the days that the frame holds. The mode is set
per write, never on the session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contrail.operators.ingest import parse_status_line, status_line


# An empty day (a file name without a date) as a folder name; as '' it would read back NULL.
_NO_DAY = "undated"


def day_folder(day: str = "flight_date") -> Column:
    """The day as a folder's name."""
    return F.when(F.col(day) == "", F.lit(_NO_DAY)).otherwise(F.col(day))


def _write_days(df: DataFrame, path: str, day: str, order: Sequence[str], columns: Sequence[str],
                days_only: bool, kind: str = "parquet") -> None:
    """``columns`` of ``df`` by day, in ``order`` (from the day on) inside and across a day's files.

    The day gets its folder's name before the sort, so the writer finds its order there and
    sorts no more.
    """
    ranged = df.withColumn(day, day_folder(day)).repartitionByRange(*order).sortWithinPartitions(*order)
    mode = "dynamic" if days_only else "static"
    writer = ranged.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(day).format(kind).save(path)


def opened_days(df: DataFrame, day: str = "flight_date") -> DataFrame:
    """Undo ``day_folder``."""
    return df.withColumn(day, F.when(F.col(day) == _NO_DAY, F.lit("")).otherwise(F.col(day)))


def write_documents(docs: DataFrame, path: str) -> None:
    """Document texts (``source_file``, ``value``; no line ends inside) as files that the trace
    readers take: a folder ``document=<source_file>`` per file, a document a line.

    A folder stands for one file; a file of many documents is written by several tasks.
    """
    parts = docs.select(F.col("source_file").alias("document"), "value")
    parts = parts.repartitionByRange("document", F.xxhash64("value"))
    parts.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("document").text(path)


def write_checked_points(points: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """Points of a lenient ``flatten`` -> (good points, bad points, their counts).

    One pass over the documents: points whose offset or position did not parse go to a folder
    of their own, and the counts are observed while they are written.
    """
    bad = F.col("time_offset").isNull() | F.col("lat").isNull() | F.col("lng").isNull()
    seen = Observation("checked points")
    flagged = points.withColumn("bad", bad).observe(
        seen, F.count_if(~F.col("bad")).alias("good"), F.count_if(F.col("bad")).alias("bad")
    )
    flagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bad").parquet(path)
    spark = points.sparkSession
    back = spark.read.schema(flagged.schema).parquet(path)
    return back.filter(~F.col("bad")).drop("bad"), back.filter("bad").drop("bad"), dict(seen.get)


def write_points(points: DataFrame, path: str, days_only: bool = False) -> None:
    """Point table partitioned by ``flight_date`` (full refresh or only its days).

    Rows are range-partitioned on ``(flight_date, entity, idx)``: each writer gets a
    contiguous slice (few files per task, sorted by track and ordinal inside), and a
    busy day or a busy track is split over several writers instead of one.
    """
    _write_days(points, path, "flight_date", ("flight_date", "entity", "idx"), points.columns, days_only)


def _point_files(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("basePath", path)
        .schema(
            "entity string, base_timestamp double, idx bigint, time_offset double, lat double, "
            "lng double, altitude_ft int, timestamp timestamp, flight_date string"
        )
        .parquet(path)
    )


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Point table back; the partition column is kept as text (not inferred as DATE)."""
    return opened_days(_point_files(spark, path))


# Fixed value: the report's columns of the point table.
REPORT_COLUMNS = ("flight_date", "lat", "lng", "altitude_ft", "timestamp")


def read_report_points(spark: SparkSession, path: str, first_day: str | None = None,
                       last_day: str | None = None) -> DataFrame:
    """The report's 5 columns of the point table, optionally for a day range.

    Only these columns are read (Parquet column pruning) and only the day folders in
    the range are listed (partition pruning on ``flight_date``).
    """
    pts = _point_files(spark, path)
    undated = F.col("flight_date") == F.lit(_NO_DAY)  # '' comes before every day
    if first_day is not None:
        pts = pts.filter((F.col("flight_date") >= F.lit(first_day)) & ~undated)
    if last_day is not None:
        pts = pts.filter((F.col("flight_date") <= F.lit(last_day)) | undated)
    return opened_days(pts).select(*REPORT_COLUMNS, "entity", "idx")


def write_legs(legs: DataFrame, path: str, days_only: bool = False) -> None:
    """The leg summary table, partitioned by ``flight_date`` (full refresh or only its days)."""
    _write_days(legs, path, "flight_date", ("flight_date", "flight_num"), legs.columns, days_only)


def read_legs(spark: SparkSession, path: str) -> DataFrame:
    """The leg table back, days as text."""
    rows = spark.read.option("basePath", path).parquet(path)
    return opened_days(rows.withColumn("flight_date", F.col("flight_date").cast("string")))


def write_features(features: DataFrame, path: str, day: str = "flight_date", days_only: bool = False) -> None:
    """One GeoJSON Feature per line, one folder per track day.

    Range-partitioned on the day and the lines' keys: few files per task, and a busy day
    is split over several writers.
    """
    order = [c for c in (day, "entity", "idx") if c in features.columns]
    lines = features.withColumn("value", F.col("geojson"))
    _write_days(lines, path, day, order, (day, "value"), days_only, "text")


# The texts around the Features of a day's collection.
COLLECTION_OPEN, COLLECTION_CLOSE = '{"type":"FeatureCollection","features":[', "]}"


def write_collections(features: DataFrame, path: str, keys: Sequence[str] = ("entity", "idx"),
                      day: str = "flight_date", days_only: bool = False) -> None:
    """A GeoJSON FeatureCollection per day: its parts, put one after another by name, are one.

    A line per Feature in the order of ``keys`` (unique in a day); the first line of a day opens
    the collection and the last one closes it. No task gathers a day: lines know that they are
    first or last from the day's least and greatest keys, joined on the whole key.
    """
    keys = list(keys)
    ends = features.groupBy(day).agg(F.min(F.struct(*keys)).alias("_a"), F.max(F.struct(*keys)).alias("_b"))
    edge = lambda end, flag: ends.select(
        F.col(day).alias(f"{flag}_d"), *[F.col(f"{end}.{k}").alias(f"{flag}_{k}") for k in keys], F.lit(True).alias(flag)
    )
    lines = features.select(day, *keys, "geojson")
    for end, flag in (("_a", "_first"), ("_b", "_final")):
        side = edge(end, flag)
        same = F.col(day).eqNullSafe(F.col(f"{flag}_d"))
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"{flag}_{k}"))
        lines = lines.join(side, same, "left")
    text = F.concat(
        F.when(F.col("_first"), F.lit(COLLECTION_OPEN)).otherwise(F.lit("")),
        "geojson",
        F.when(F.col("_final"), F.lit(COLLECTION_CLOSE)).otherwise(F.lit(",")),
    )
    lines = lines.select(day, *keys, text.alias("value"))
    _write_days(lines, path, day, (day, *keys), (day, "value"), days_only, "text")


def read_collections(spark: SparkSession, path: str, day: str = "flight_date") -> DataFrame:
    """Lines of the collections back: day, part (file name), line (rising in a part), geojson (the
    Feature), opens, closes."""
    rows = spark.read.schema(f"value string, {day} string").text(path)
    opens, closes = F.col("value").startswith(COLLECTION_OPEN), F.col("value").endswith(COLLECTION_CLOSE)
    start = F.when(opens, F.lit(len(COLLECTION_OPEN) + 1)).otherwise(F.lit(1))
    tail = F.when(closes, F.lit(len(COLLECTION_CLOSE))).otherwise(F.lit(1))
    return opened_days(rows, day).select(
        day,
        F.col("_metadata.file_name").alias("part"),
        F.monotonically_increasing_id().alias("line"),
        F.substr("value", start, F.length("value") - tail - start + 1).alias("geojson"),
        opens.alias("opens"),
        closes.alias("closes"),
    )


def write_manifest(latest: DataFrame, path: str) -> None:
    """The status cache as text lines ``yyyy-MM-dd:status``, one folder per entity (full refresh)."""
    lines = latest.select(F.col("entity").cast("string").alias("entity"), status_line(F.col("day"), F.col("status")).alias("value"))
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("entity")
    writer.text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Status-cache lines back as ``(entity, day DATE, status)``; a bad date fails (ANSI)."""
    day, status = parse_status_line(F.col("value"))
    lines = spark.read.schema("value string, entity string").text(path)
    return lines.select("entity", day.alias("day"), status.alias("status"))
