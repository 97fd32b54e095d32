"""Process each arriving day file once, and keep the legs of its days up to date.

A file-source stream over the trace folder with an ``availableNow`` trigger: every
run handles only files it has not seen (tracked in the stream checkpoint), then
stops. Each micro-batch

* flattens the valid documents and writes their points,
* keeps malformed and repeated documents in a quarantine table, and points whose offset or
  position is no number in one of their own (without it such a point stops the run),
* records one status-cache entry per document (``has_data`` for a parsed document, whose
  points are written, ``no_data`` for a malformed one) in the manifest history, whose latest
  entry per ``(entity, day)`` is the cached status (``ingest.latest_status``),
* names its touched days and computes their legs anew from the stored points.

A document replaces an earlier one of its vehicle and day, so the stored points of a day are
those of the newest batch per ``(entity, day)``; the documents are logged, since the newest one
may hold no points.

``foreachBatch`` is at-least-once: a batch can be replayed after a failure. Every
table is therefore written into its own ``ingest_batch=<id>`` partitions with
dynamic partition overwrite, so a replay replaces exactly what that batch wrote
before instead of appending it twice. The legs of a day are those of the newest batch that
touched it: a day's legs are replaced by one row in the log of touched days, written last, and
a day that has lost its legs has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.functions.scalar import TRACK_FILE_DATE_PATTERN
from contrail.operators.ingest import HAS_DATA, NO_DATA
from contrail.operators.legs import LegParams, TrackCols, leg_summary
from contrail.session import materialised
from contrail.sources.sinks import day_folder, opened_days
from contrail.sources.traces import (
    CORRUPT,
    DOCUMENT_SCHEMA,
    bad_points,
    flatten,
    good_points,
    marked_documents,
    parse_fragments,
    routed,
    stream_fragments,
)

BATCH = "ingest_batch"
ICAO_PATTERN = r'"icao"\s*:\s*"([^"]*)"'
POINT_SCHEMA = (
    "entity string, base_timestamp double, idx bigint, time_offset double, lat double, lng double, "
    "altitude_ft int, timestamp timestamp, flight_date string, ingest_batch bigint"
)

LEG_SCHEMA = (
    "entity string, flight_num bigint, takeoff_timestamp string, takeoff_lat double, takeoff_lng double, "
    "takeoff_altitude_ft int, takeoff_location string, landing_timestamp string, landing_lat double, "
    "landing_lng double, landing_altitude_ft int, landing_location string, flight_duration_minutes double, "
    "ingest_batch bigint, flight_date string"
)


def _write(df: DataFrame, path: str, partitions: list[str], order: list[str] | None = None) -> None:
    """Replace the batch's partitions. With ``order`` the writers are ranges of the day and these
    columns: few files per day, and a busy day is split over several writers."""
    stored = df
    if "flight_date" in df.columns:
        stored = df.withColumn("flight_date", day_folder("flight_date"))
    if order:
        stored = stored.repartitionByRange("flight_date", *order).sortWithinPartitions("flight_date", *order)
    (
        stored.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _track_day(source_file: str = "source_file"):
    return F.regexp_extract(source_file, TRACK_FILE_DATE_PATTERN, 1)


def process_batch(batch: DataFrame, batch_id: int, points_path: str,
                  quarantine_path: str | None = None, manifest_path: str | None = None,
                  legs_path: str | None = None, params: LegParams = LegParams(),
                  bad_points_path: str | None = None) -> None:
    """Write one micro-batch of trace documents (idempotent per ``batch_id``).

    The points are flattened once, good and bad ones together. ``legs_path`` holds three tables: ``documents`` (what a batch brought), ``legs`` and
    ``days`` (the days that a batch touched, whose legs it has written).
    """
    tag = F.lit(int(batch_id)).cast("bigint")
    marked = materialised(marked_documents(batch), "batch")
    aside = marked.filter(F.col("reason").isNotNull()).select("source_file", "icao", CORRUPT, "reason")
    alone = marked.filter(F.col("reason").isNull()).drop(CORRUPT, "reason")
    points = flatten(alone, strict=bad_points_path is None).withColumn(BATCH, tag)
    if bad_points_path:
        points = materialised(points, "points")
        _write(bad_points(points), bad_points_path, [BATCH])
        points = good_points(points)
    _write(points, points_path, ["flight_date", BATCH], ["entity", "idx"])
    if quarantine_path:
        _write(aside.withColumn(BATCH, tag), quarantine_path, [BATCH])
    if manifest_path:
        entry = lambda docs, entity, status: docs.select(
            entity.alias("entity"),
            F.to_date(F.nullif(_track_day(), F.lit(""))).alias("day"),
            F.lit(status).alias("status"),
            F.lit("primary").alias("source"),
            F.current_timestamp().alias("seen_at"),
            "source_file",
        )
        # A malformed document is cached under the id that its text still shows.
        shown = F.nullif(F.regexp_extract(F.col(CORRUPT), ICAO_PATTERN, 1), F.lit(""))
        malformed = entry(aside.filter(F.col("reason") == "malformed"), F.coalesce(F.col("icao"), shown), NO_DATA)
        entries = entry(alone, F.col("icao"), HAS_DATA).unionByName(malformed)
        _write(entries.withColumn(BATCH, tag), manifest_path, [BATCH])
    if legs_path:
        brought = alone.select(F.col("icao").alias("entity"), _track_day().alias("flight_date"))
        _write(brought.withColumn(BATCH, tag), f"{legs_path}/documents", [BATCH])
        refresh_legs(batch.sparkSession, batch_id, points_path, legs_path, params)


def current_points(spark: SparkSession, points_path: str, legs_path: str, days: list[str] | None = None) -> DataFrame:
    """Stored points of the given days (all without), of the newest document per vehicle and day."""
    points = spark.read.schema(POINT_SCHEMA).parquet(points_path)
    documents = spark.read.schema("entity string, flight_date string, ingest_batch bigint").parquet(f"{legs_path}/documents")
    if days is not None:  # day folders of the points, rows of the log
        folders = F.col("flight_date").isin(days)
        points, documents = points.filter(folders), documents.filter(folders)
    newest = documents.groupBy("entity", "flight_date").agg(F.max(BATCH).alias("_newest"))
    newest = newest.select(F.col("entity").alias("_entity"), F.col("flight_date").alias("_day"), "_newest")
    same = F.expr(f"entity <=> _entity AND flight_date <=> _day AND {BATCH} = _newest")
    kept = points.join(newest, same).drop("_entity", "_day", "_newest", BATCH)
    return opened_days(kept)


def refresh_legs(spark: SparkSession, batch_id: int, points_path: str, legs_path: str,
                 params: LegParams = LegParams()) -> None:
    """Compute the legs of the days that a batch touched from the stored points, and log the days.

    The days come to the driver (a batch touches no more days than the calendar holds) and
    prune the point table to their folders.
    """
    tag = F.lit(int(batch_id)).cast("bigint")
    documents = spark.read.schema("entity string, flight_date string, ingest_batch bigint").parquet(f"{legs_path}/documents")
    touched = documents.filter(F.col(BATCH) == batch_id).select("flight_date").distinct()
    days = [r.flight_date for r in touched.collect()]
    if not days:
        return
    legs = leg_summary(current_points(spark, points_path, legs_path, days), TrackCols(), params)
    _write(legs.withColumn(BATCH, tag), f"{legs_path}/legs", [BATCH, "flight_date"], ["entity", "flight_num"])
    _write(spark.createDataFrame([(d,) for d in days], "flight_date string").withColumn(BATCH, tag), f"{legs_path}/days", [BATCH])


def current_legs(spark: SparkSession, legs_path: str) -> DataFrame:
    """The leg table: of every day the legs that the newest batch which touched it has written."""
    days = spark.read.schema(f"flight_date string, {BATCH} bigint").parquet(f"{legs_path}/days")
    newest = days.groupBy("flight_date").agg(F.max(BATCH).alias("_newest")).withColumnRenamed("flight_date", "_day")
    legs = spark.read.schema(LEG_SCHEMA).parquet(f"{legs_path}/legs")
    kept = legs.join(newest, F.expr(f"flight_date <=> _day AND {BATCH} = _newest")).drop("_day", "_newest", BATCH)
    return opened_days(kept)


def stream_traces(
    spark: SparkSession,
    source_dir: str,
    points_path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    manifest_path: str | None = None,
    legs_path: str | None = None,
    params: LegParams = LegParams(),
    bad_points_path: str | None = None,
) -> StreamingQuery:
    """Start an availableNow run: new files -> points, quarantine, manifest entries, legs.

    Files may hold any number of documents of either shape; large ones are read by several
    tasks. ``checkpoint`` is the stream's own folder on shared storage: a later application
    that names it goes on where this one stopped.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        docs = routed(parse_fragments(batch, DOCUMENT_SCHEMA))
        process_batch(docs, batch_id, points_path, quarantine_path, manifest_path, legs_path, params, bad_points_path)

    return (
        stream_fragments(spark, source_dir)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
