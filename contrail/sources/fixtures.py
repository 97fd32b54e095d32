"""Stand-in inputs built from the driver's test tables.

These functions only shape rows of a test table into the schema an operator
expects (a point table, a nested trace document, a manifest history, two feeds).
They do none of the operators' work; the queries in ``plans`` run the library's
operators on them.

Point table (``track_points``), from ``events``:

* ``entity``   = ``user_id`` (one user is one track)
* ``idx``      = dense 1-based ordinal per entity by ``(ts, event_id)``
* ``t``        = epoch seconds of ``ts`` (microsecond precision)
* ``lat``/``lng`` = positions derived from ``event_id`` (formulas below)
* ``alt``      = ``floor(value * 100)`` feet
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions import epoch_seconds
from contrail.operators.legs import LegParams, TrackCols
from contrail.operators.ordering import ordinal, time_levels
from contrail.session import materialised

# Columns of the events-derived point table.
EVENT_TRACK = TrackCols(keys=("entity",), order="idx", time="t", base=None, lat="lat", lng="lng", alt="alt")

# Segmentation parameters for the events tracks: the reference defaults (2000 ft,
# 900 s, 50 points) would leave no leg in this data.
EVENT_LEG_PARAMS = LegParams(ground_below=1500, min_seconds=86400, min_points=3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (entity, event_id, ts, t, lat, lng, alt); the key is renamed first."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        F.col("user_id").alias("entity"),
        eid,
        F.col("ts"),
        epoch_seconds("ts").alias("t"),
        (F.lit(-26.5) + ((eid * 37) % 1600).cast("double") / F.lit(100.0)).alias("lat"),
        (F.lit(32.0) + ((eid * 53) % 900).cast("double") / F.lit(100.0)).alias("lng"),
        F.floor(F.col("value") * F.lit(100.0)).cast("int").alias("alt"),
    )


def track_points(spark: SparkSession, sf_dir: str, null_keys: bool = False) -> DataFrame:
    """Point table of all events: (entity, idx, t, lat, lng, alt).

    Numbered within the week of the event, or finer cells where a week is too full. With ``null_keys`` every seventh user's id is
    NULL: their events are one track without a key.
    """
    pos = event_positions(spark, sf_dir)
    if null_keys:
        pos = pos.withColumn("entity", F.when(F.col("entity") % 7 != 0, F.col("entity")))
    levels = [*time_levels("ts"), F.col("event_id")]
    return ordinal(pos, ["entity"], ["ts", "event_id"], levels).select("entity", "idx", "t", "lat", "lng", "alt")


# Places (``place_table``), from ``customer``: centres spread over the events' area by the
# key k. k % 5: 0 and 3 centre and tolerance only, 1 and 4 bounds only (very wide for
# k % 50 = 4), 2 centre with an altitude guard; every tenth label holds a quotation mark;
# two places share a priority.
def place_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the schema of ``operators.places`` (bounds or centre NULL by kind)."""
    k = F.col("c_custkey")
    lat = F.lit(-26.5) + ((k * 91) % 1600).cast("double") / F.lit(100.0)
    lng = F.lit(32.0) + ((k * 67) % 900).cast("double") / F.lit(100.0)
    kind = k % 5
    centre = kind.isin(0, 2, 3)
    half = F.when(k % 50 == 4, F.lit(3.0)).otherwise(F.lit(0.05))
    only = lambda cond, c: F.when(cond, c)
    return table(spark, sf_dir, "customer").select(
        F.expr("cast(c_custkey div 2 as int)").alias("priority"),
        F.concat(F.when(k % 10 == 0, F.lit("O'Place ")).otherwise(F.lit("Place ")), k.cast("string")).alias("label"),
        only(centre, lat).alias("c_lat"),
        only(centre, lng).alias("c_lng"),
        only(centre, F.when(kind == 0, F.lit(0.02)).otherwise(F.lit(0.1))).alias("tol"),
        only(~centre, lat - half).alias("lat_lo"),
        only(~centre, lat + half).alias("lat_hi"),
        only(~centre, lng - half).alias("lng_lo"),
        only(~centre, lng + half).alias("lng_hi"),
        only(kind == 2, F.lit(5000)).alias("min_alt"),
    )


# Trace documents (``trace_documents``), from ``embeddings``: one document per vector,
# one point per 4 numbers e0..e3 of the vector (i = point position from 0):
#   offset   = i * 30.5 + floor(|e0| * 100)        seconds after the base
#   lat      = e1 * 50                            lng = 40 + e2 * 10
#   altitude = 'ground' when e3 < -0.3, null when e3 < -0.25, else e3 * 20000 + 5000
#   a fifth element 'x' on even positions (ignored by the reader)
#   icao = lower hex of vec_id, base = 2024-05-01 + vec_id days, file named by that day
TRACE_BASE_EPOCH = 1714521600.0


def trace_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents (source_file, icao, timestamp, trace) as the JSON reader yields them."""
    emb = table(spark, sf_dir, "embeddings")

    def e(i, k):
        return F.get(F.col("embedding"), i * 4 + k).cast("double")

    def as_text(c):
        return c.cast("string")

    def point(i):
        alt = e(i, 3)
        alt_text = (
            F.when(alt < F.lit(-0.3), F.lit("ground"))
            .when(alt < F.lit(-0.25), F.lit(None).cast("string"))
            .otherwise(as_text(alt * F.lit(20000.0) + F.lit(5000.0)))
        )
        offset = i.cast("double") * F.lit(30.5) + F.floor(F.abs(e(i, 0)) * F.lit(100.0))
        core = F.array(as_text(offset), as_text(e(i, 1) * F.lit(50.0)),
                       as_text(F.lit(40.0) + e(i, 2) * F.lit(10.0)), alt_text)
        return F.when(i % 2 == 0, F.concat(core, F.array(F.lit("x")))).otherwise(core)

    n = F.floor(F.size("embedding") / F.lit(4)).cast("int")
    positions = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    base = F.lit(TRACE_BASE_EPOCH) + F.col("vec_id").cast("double") * F.lit(86400.0)
    return emb.select(
        F.concat(F.lit("flight-track-"), F.date_format(F.timestamp_seconds(base), "yyyy-MM-dd"),
                 F.lit(".json")).alias("source_file"),
        F.lower(F.hex("vec_id")).alias("icao"),
        base.alias("timestamp"),
        F.transform(positions, point).alias("trace"),
    )


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, day, event_type, ts) per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("entity"), F.to_date("ts").alias("day"), "event_type", "ts")


def entity_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per entity: first and last day with any event (the window to be covered)."""
    return event_days(spark, sf_dir).groupBy("entity").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


# Manifest history (``manifest_history``), from ``events``: every event is one look at
# the (entity, day) payload. Status no_data for 'error' events, else has_data; source
# primary for 'view' and 'click', else fallback; seen_at = the half day of ts, so that
# looks at equal times occur.
PRIMARY_EVENT_TYPES = ("view", "click")


def manifest_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = event_days(spark, sf_dir)
    return d.select(
        "entity",
        "day",
        F.when(F.col("event_type") == "error", F.lit("no_data")).otherwise(F.lit("has_data")).alias("status"),
        F.when(F.col("event_type").isin(*PRIMARY_EVENT_TYPES), F.lit("primary"))
        .otherwise(F.lit("fallback"))
        .alias("source"),
        F.expr("cast(date_trunc('DAY', ts) + make_dt_interval(0, 12 * int(hour(ts) >= 12)) as timestamp_ntz)").alias(
            "seen_at"
        ),
    )


def present_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, day) of the files that are there: days with a 'click' event."""
    return event_days(spark, sf_dir).filter(F.col("event_type") == "click").select("entity", "day")


def fetched_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, day, source) for which a feed gives a usable payload: days with a 'view' event; the
    feed is the primary one where the event's time is in the first half of an hour."""
    views = event_days(spark, sf_dir).filter(F.col("event_type") == "view")
    feed = F.when(F.minute("ts") < 30, F.lit("primary")).otherwise(F.lit("fallback"))
    return views.select("entity", "day", feed.alias("source"))


RUN_AT = "2024-02-01 00:00:00"  # when the run ends whose cache entries are asked for


def feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two feeds of per-(entity, day) payload summaries: primary and fallback events."""
    d = event_days(spark, sf_dir)
    is_primary = F.col("event_type").isin(*PRIMARY_EVENT_TYPES)

    def feed(rows, name):
        return rows.groupBy("entity", "day").agg(
            F.count(F.lit(1)).alias("n_points"), F.min("ts").alias("first_seen")
        ).withColumn("source", F.lit(name))

    return feed(d.filter(is_primary), "primary"), feed(d.filter(~is_primary), "fallback")


def _json_value(v):
    """A trace element (text) as JSON: numbers as they are, words quoted, null."""
    return (
        F.when(v.isNull(), F.lit("null"))
        .when(v.try_cast("double").isNull(), F.concat(F.lit('"'), v, F.lit('"')))
        .otherwise(v)
    )


def _json_document(icao, base, points):
    point_text = F.transform(
        points, lambda p: F.concat(F.lit("["), F.array_join(F.transform(p, _json_value), ", "), F.lit("]"))
    )
    return F.concat(
        F.lit('{"icao": "'), icao, F.lit('", "timestamp": '), base.cast("string"),
        F.lit(', "trace": ['), F.array_join(point_text, ", "), F.lit("]}"),
    )


# The third part of every fifth file: a document that is cut off.
BROKEN_DOCUMENT = '{"icao": "broken", "trace": [[1, 2'


def trace_file_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File texts holding two or three root objects each: the document of
    ``trace_documents`` split after its 8th point (the second part's entity gets the
    suffix ``b``, and a note that holds ``}{``); every fifth file ends in a broken one."""
    docs = trace_documents(spark, sf_dir)
    first = _json_document(F.col("icao"), F.col("timestamp"), F.slice("trace", 1, 8))
    second = _json_document(F.concat(F.col("icao"), F.lit("b")), F.col("timestamp"),
                            F.slice("trace", 9, F.greatest(F.size("trace") - 8, F.lit(0))))
    noted = F.concat(F.lit('{"note": "a } { \\" }{", '), F.substr(second, F.lit(2)))
    number = F.conv(F.col("icao"), 16, 10).cast("bigint")
    third = F.when(number % 5 == 0, F.concat(F.lit("\n"), F.lit(BROKEN_DOCUMENT))).otherwise(F.lit(""))
    return docs.select("source_file", F.concat(first, F.lit("\n"), noted, third).alias("value"))


def document_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two feeds of documents as their readers yield them: traces of the vehicles whose
    number does not divide by 3, and fallback documents of all vehicles.

    A fallback row per point: epoch second, latitude, longitude, metres (e3 * 6000 + 1500,
    rounded), track, on ground (e3 < -0.3)."""
    docs = trace_documents(spark, sf_dir)
    number = F.conv(F.col("icao"), 16, 10).cast("bigint")
    corrupt = F.lit(None).cast("string").alias("_corrupt_record")
    primary = docs.filter(number % 3 != 0).select("icao", "timestamp", "trace", corrupt, "source_file")
    emb = table(spark, sf_dir, "embeddings")
    base = F.lit(TRACE_BASE_EPOCH) + F.col("vec_id").cast("double") * F.lit(86400.0)
    e = lambda i, k: F.get(F.col("embedding"), i * 4 + k).cast("double")

    def row(i):
        at = base + i.cast("double") * F.lit(30.5)
        metres = F.round(e(i, 3) * F.lit(6000.0) + F.lit(1500.0))
        cells = (at, e(i, 1) * F.lit(50.0), F.lit(40.0) + e(i, 2) * F.lit(10.0), metres, F.lit(0.0), e(i, 3) < F.lit(-0.3))
        return F.array(*[c.cast("string") for c in cells])

    n = F.floor(F.size("embedding") / F.lit(4)).cast("int")
    positions = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    fallback = emb.select(
        F.lower(F.hex("vec_id")).alias("icao24"),
        base.alias("startTime"),
        F.transform(positions, row).alias("path"),
        corrupt,
        F.concat(F.lit("flight-track-"), F.date_format(F.timestamp_seconds(base), "yyyy-MM-dd"), F.lit(".json")).alias(
            "source_file"
        ),
    )
    return primary, fallback


def repeated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trace_documents`` in which every tenth vehicle's day has a second document."""
    docs = trace_documents(spark, sf_dir)
    return docs.union(docs.filter(F.conv(F.col("icao"), 16, 10).cast("bigint") % 10 == 0))


# Day documents (``event_documents``), from ``events``: one document per user and day, its points
# in the order of (ts, event_id): seconds from midnight, position and altitude of the point table.
# Every third user's documents have the fallback shape: epoch second, position, metres
# (event_id * 7 % 3000), track, on ground (event_id divides by 11).
EVENT_DAY_PARAMS = LegParams(ground_below=1500, min_seconds=0, min_points=1)


def event_documents(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """(source_file, user_id, icao, timestamp, trace, path) per user and day; trace or path is NULL.

    With ``faults`` the latitude of every 13th event is the text ``n/a``.
    """
    pos = event_positions(spark, sf_dir)
    day = F.to_date("ts")
    base = F.unix_date(day).cast("double") * F.lit(86400.0)
    eid = F.col("event_id")
    lat = F.col("lat").cast("string")
    if faults:
        lat = F.when(eid % 13 == 0, F.lit("n/a")).otherwise(lat)
    text = lambda c: c.cast("string")
    point = F.array(text(F.col("t") - base), lat, text(F.col("lng")), text(F.col("alt")))
    row = F.array(
        text(F.col("t")), lat, text(F.col("lng")), text((eid * 7 % 3000).cast("double")), F.lit("0.0"), text(eid % 11 == 0)
    )
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", point.alias("p"), row.alias("r"))))
    docs = pos.groupBy(F.col("entity").alias("user_id"), day.alias("day"), base.alias("timestamp")).agg(ordered.alias("o"))
    other = F.col("user_id") % 3 == 0
    return docs.select(
        F.concat(F.lit("flight-track-"), F.date_format("day", "yyyy-MM-dd"), F.lit(".json")).alias("source_file"),
        "user_id",
        F.lower(F.hex("user_id")).alias("icao"),
        "timestamp",
        F.when(~other, F.col("o.p")).alias("trace"),
        F.when(other, F.col("o.r")).alias("path"),
    )


def event_document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day documents as JSON texts (source_file, value), in the shape of their feed."""
    docs = event_documents(spark, sf_dir)
    points = lambda c: F.transform(
        c, lambda p: F.concat(F.lit("["), F.array_join(F.transform(p, _json_value), ", "), F.lit("]"))
    )
    trace = _json_document(F.col("icao"), F.col("timestamp"), F.col("trace"))
    path = F.concat(
        F.lit('{"icao24": "'), F.col("icao"), F.lit('", "startTime": '), F.col("timestamp").cast("string"),
        F.lit(', "path": ['), F.array_join(points(F.col("path")), ", "), F.lit("]}"),
    )
    return docs.select("source_file", F.coalesce(trace, path).alias("value"))


def trace_shaped(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """The day documents of all users as trace documents, as the reader yields them."""
    corrupt = F.lit(None).cast("string").alias("_corrupt_record")
    docs = event_documents(spark, sf_dir, faults)
    # The rows of a fallback document hold the same points, by the same order.
    day = lambda p: F.array((p[0].cast("double") - F.col("timestamp")).cast("string"), p[1], p[2], p[3])
    trace = F.coalesce("trace", F.transform("path", day))
    return docs.select("icao", "timestamp", trace.alias("trace"), corrupt, "source_file", "user_id")


def arriving_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The day documents as two micro-batches whose outcome is ``trace_shaped``.

    The first brings the first half only of the documents of users that divide by 2, and two
    copies of those whose number ends in 3; the second brings all of both again. The documents are
    put together once and written: every batch reads them as it would read its files.
    """
    docs = materialised(trace_shaped(spark, sf_dir), "arriving")
    user = F.col("user_id")
    half = F.slice("trace", F.lit(1), F.expr("size(trace) div 2"))
    early = docs.withColumn("trace", F.when(user % 2 == 0, half).otherwise(F.col("trace")))
    early = early.union(docs.filter(user % 10 == 3))
    late = docs.filter((user % 2 == 0) | (user % 10 == 3))
    return early.drop("user_id"), late.drop("user_id")
