"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's test tables (through the stand-in builders in
``contrail.sources.fixtures``) and runs the library's operators over all rows.
Track queries use the events point table: one user is one track, ground below
1500 ft, legs longer than 86,400 s with more than 3 points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions import archive_path, from_hex, iso_utc, json_int, to_hex, track_file_name
from contrail.operators import geometry as G
from contrail.operators import ingest as I
from contrail.operators import legs as L
from contrail.operators import places as P
from contrail.session import materialised, scratch_path
from contrail.sources import fixtures as X
from contrail.sources import keyed, sinks
from contrail.sources import traces as TR
from contrail.streaming import incremental as N

Query = Callable[[SparkSession, str], DataFrame]

C = X.EVENT_TRACK
LP = X.EVENT_LEG_PARAMS


def _points(spark, sf_dir):
    return X.track_points(spark, sf_dir)


def _point_table(spark, sf_dir, null_keys=False):
    """The point table written once (Parquet), for operators that read it in two branches."""
    return materialised(X.track_points(spark, sf_dir, null_keys), "points")


# ---------------------------------------------------------------- legs (central result)


def leg_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: segmentation, one-pass leg summary, significance filter, place labels."""
    return L.leg_summary(_points(spark, sf_dir), C, LP)


def ground_flag(spark, sf_dir):
    """Every point with its ground flag."""
    return L.flag_ground(_points(spark, sf_dir), C, LP.ground_below).select("entity", "idx", "alt", "is_ground")


def takeoff_edges(spark, sf_dir):
    """W1 + P4: LAG of the ground flag (default 1) and the takeoff edge, every point."""
    return L.mark_takeoffs(_points(spark, sf_dir), C, LP.ground_below, LP.chunk_size).select(
        "entity", "idx", "is_ground", "prev_ground", "is_takeoff"
    )


def leg_numbers(spark, sf_dir):
    """P5 + W2: airborne points with their running leg number."""
    return _numbered(spark, sf_dir).select("entity", "idx", "flight_num")


def leg_extents(spark, sf_dir):
    """Per leg min/max time and ordinal, point count (all legs)."""
    return L.summarise_points(_points(spark, sf_dir), C, LP, extents=True, endpoints=False)


def leg_endpoints(spark, sf_dir):
    """W3 + W4 as min_by / max_by: per leg first and last position (all legs)."""
    return L.summarise_points(_points(spark, sf_dir), C, LP, extents=False, endpoints=True)


def _numbered(spark, sf_dir):
    return L.number_legs(_points(spark, sf_dir), C, LP.ground_below, LP.chunk_size)


def leg_endpoints_join(spark, sf_dir):
    """Extents joined with airborne points on (track, ordinal) for both endpoints."""
    return L.endpoints_by_join(_points(spark, sf_dir), C, below=LP.ground_below, chunk_size=LP.chunk_size).select(
        "entity", "flight_num", "takeoff_idx", "landing_idx", "num_points",
        "takeoff_lat", "takeoff_lng", "takeoff_altitude", "landing_lat", "landing_lng", "landing_altitude",
    )


def first_last_per_point(spark, sf_dir):
    """W3/W4 per-point form: every airborne point with its leg's first and last
    position (FIRST_VALUE / full-frame LAST_VALUE semantics), carried over the chunks of a
    leg and joined back per chunk instead of a window over the whole leg."""
    return L.first_last_per_point(_points(spark, sf_dir), C, below=LP.ground_below, chunk_size=LP.chunk_size).select(
        "entity", "idx", "flight_num", "takeoff_lat", "takeoff_lng", "takeoff_altitude",
        "landing_lat", "landing_lng", "landing_altitude",
    )


def leg_keys_distinct(spark, sf_dir):
    """The set of legs, distinct over the chunk partials."""
    return L.leg_keys(_points(spark, sf_dir), C, LP)


def null_key_legs(spark, sf_dir):
    """A6, J1 with NULL keys: leg summary where every seventh user's id is NULL (one track)."""
    return L.leg_summary(X.track_points(spark, sf_dir, null_keys=True), C, LP)


def null_key_numbers(spark, sf_dir):
    """P5 + W2 with NULL keys: airborne points with their leg number."""
    points = X.track_points(spark, sf_dir, null_keys=True)
    return L.number_legs(points, C, LP.ground_below, LP.chunk_size).select("entity", "idx", "flight_num")


def null_key_colour(spark, sf_dir):
    """W6, P16 with NULL keys: coloured pairs where every seventh user's id is NULL."""
    points = _point_table(spark, sf_dir, null_keys=True)
    return G.coloured_pairs(points, C, LP.chunk_size).select(
        "entity", "idx", "avg_alt", "min_alt", "max_alt", "ratio", "color"
    )


def significant_legs(spark, sf_dir):
    """P6 + P7: legs lasting more than 86,400 s with more than 3 points."""
    ext = L.summarise_points(_points(spark, sf_dir), C, LP, extents=True, endpoints=False)
    return L.significant(ext, LP.min_seconds, LP.min_points).select(
        "entity", "flight_num", "takeoff_time", "landing_time", "num_points"
    )


def _all_legs(spark, sf_dir):
    return L.summarise_points(_points(spark, sf_dir), C, LP, extents=False, endpoints=True)


def takeoff_places(spark, sf_dir):
    """P8 + P10: takeoff place of every leg (unguarded rule chain)."""
    legs = _all_legs(spark, sf_dir)
    return legs.select(
        "entity", "flight_num",
        P.label("takeoff_lat", "takeoff_lng", None, P.TAKEOFF_PLACES).alias("takeoff_location"),
    )


def landing_places(spark, sf_dir):
    """Landing place of every leg (altitude-guarded rules)."""
    legs = _all_legs(spark, sf_dir)
    return legs.select(
        "entity", "flight_num", F.col("landing_altitude"),
        P.label("landing_lat", "landing_lng", "landing_altitude", P.LANDING_PLACES).alias("landing_location"),
    )


def _landings(spark, sf_dir):
    return _all_legs(spark, sf_dir).select("entity", "flight_num", "landing_lat", "landing_lng", "landing_altitude")


def places_range_join(spark, sf_dir):
    """Landing places of the rule chain through the join with a places table."""
    places = P.places_frame(spark, P.LANDING_PLACES)
    return P.label_by_join(
        _landings(spark, sf_dir), "landing_lat", "landing_lng", "landing_altitude", places, "landing_location"
    ).select("entity", "flight_num", "landing_location")


def places_grid_join(spark, sf_dir):
    """The same join with a place per customer: centres, bounds, very wide ones, guards."""
    return P.label_by_join(
        _landings(spark, sf_dir), "landing_lat", "landing_lng", "landing_altitude", X.place_table(spark, sf_dir),
        "landing_location",
    ).select("entity", "flight_num", "landing_location")


def point_total(spark, sf_dir):
    """Number of points."""
    return X.table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("total_points"))


def leg_total(spark, sf_dir):
    """Number of significant legs."""
    ext = L.summarise_points(_points(spark, sf_dir), C, LP, extents=True, endpoints=False)
    return L.significant(ext, LP.min_seconds, LP.min_points).agg(F.count(F.lit(1)).alias("total_flights"))


def report_points(spark, sf_dir):
    """The report's column subset of the point table (5 of the columns)."""
    return X.event_positions(spark, sf_dir).select("entity", "lat", "lng", "alt", iso_utc("t").alias("time_text"))


def report_legs(spark, sf_dir):
    """The leg summary ordered by track and leg."""
    return leg_summary(spark, sf_dir).orderBy("entity", "flight_num")


# ---------------------------------------------------------------- geometry


def track_altitude_range(spark, sf_dir):
    """A11 + P13: per track min and max of the positive altitudes."""
    return G.track_stats(X.event_positions(spark, sf_dir), C).select("entity", "min_alt", "max_alt")


def track_counts(spark, sf_dir):
    """Points per track."""
    return G.track_stats(X.event_positions(spark, sf_dir), C).select("entity", "num_points")


def coordinate_total(spark, sf_dir):
    """Coordinates over all tracks, summed up from the tracks' counts."""
    counts = G.track_stats(X.event_positions(spark, sf_dir), C)
    return counts.agg(F.sum("num_points").alias("total_coordinates"))


def point_pairs(spark, sf_dir):
    """Valid consecutive pairs of non-zero length."""
    pairs = G.pair_points(_points(spark, sf_dir), C, LP.chunk_size)
    return (
        pairs.withColumn("dx", F.col("next_lng") - F.col("lng"))
        .withColumn("dy", F.col("next_lat") - F.col("lat"))
        .withColumn("length", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")))
        .filter(F.col("length") > 0)
        .select("entity", "idx", "lng", "lat", "next_lng", "next_lat", "avg_alt", "length")
    )


def altitude_colour(spark, sf_dir):
    """Each valid pair's ratio in its track's range, and colour."""
    return G.coloured_pairs(_point_table(spark, sf_dir), C, LP.chunk_size).select(
        "entity", "idx", "avg_alt", "min_alt", "max_alt", "ratio", "color"
    )


def ribbon_polygons(spark, sf_dir):
    """Ribbon ring corners and extrusion sizes of every drawable pair."""
    rib = G.ribbons(G.coloured_pairs(_point_table(spark, sf_dir), C, LP.chunk_size), C)
    return rib.select(
        "entity", "idx", "color", F.col("avg_alt").alias("altitude"), "extrusion_height", "extrusion_base",
        "x0", "y0", "x1", "y1", "x2", "y2", "x3", "y3",
    )


def geojson_features(spark, sf_dir):
    """One GeoJSON Feature per ribbon, its text read back with types."""
    rib = G.ribbons(G.coloured_pairs(_point_table(spark, sf_dir), C, LP.chunk_size), C)
    lines = G.features(rib, C).select("entity", "idx", "geojson")
    return G.parsed_features(lines).drop("geojson")


def track_paths(spark, sf_dir):
    """A10: ordered track paths in bounded pieces."""
    return G.path_pieces(_points(spark, sf_dir), C, piece_size=4096)


# ---------------------------------------------------------------- flattening


def flatten_points(spark, sf_dir):
    """Nested trace documents -> typed point table."""
    docs = X.trace_documents(spark, sf_dir)
    pts = TR.flatten(docs)
    return pts.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _parsed_texts(spark, sf_dir):
    return TR.split_quarantine(TR.parse_documents(X.trace_file_texts(spark, sf_dir)))


def trace_text_flatten(spark, sf_dir):
    """File texts with several root objects each -> split, parse, flatten."""
    return TR.flatten(_parsed_texts(spark, sf_dir)[0]).drop("timestamp")


def trace_text_quarantine(spark, sf_dir):
    """The malformed parts of the same texts, kept with their file and text."""
    bad = _parsed_texts(spark, sf_dir)[1]
    return bad.select("source_file", F.col("_corrupt_record").alias("corrupt"))


def document_choice(spark, sf_dir):
    """T1, T3, P17 on documents: the trace document of a day, else the fallback feed's
    (absolute seconds and metres mapped to offsets and feet), flattened to points."""
    primary, fallback = X.document_feeds(spark, sf_dir)
    docs = I.choose_source(primary, TR.fallback_as_traces(fallback), ["icao", "source_file"])
    return TR.flatten(docs).drop("timestamp")


def one_document_per_day(spark, sf_dir):
    """Documents alone on their vehicle and day, and those set aside because they are not."""
    alone, others = TR.one_per_day(X.repeated_documents(spark, sf_dir))
    return alone.select("icao", "source_file", F.lit(True).alias("kept")).union(
        others.select("icao", "source_file", F.lit(False).alias("kept"))
    )


def _day_points(spark, sf_dir):
    """Points of the day documents (events by user and day), through the reading path."""
    docs = X.trace_shaped(spark, sf_dir).drop("user_id")
    return TR.flatten(TR.day_documents(docs)[0])


def trace_files(spark, sf_dir):
    """Documents of both shapes written as day files and read as one source."""
    path = scratch_path(spark, "trace-files")
    sinks.write_documents(X.event_document_texts(spark, sf_dir), path)
    docs, _ = TR.day_documents(TR.read_documents(spark, path))
    return TR.flatten(docs).drop("timestamp")


def checked_points(spark, sf_dir):
    """Good and bad points of documents with faults, split by one pass; the counts observed."""
    docs = X.trace_shaped(spark, sf_dir, faults=True).drop("user_id")
    points = TR.flatten(docs, strict=False).drop("timestamp")
    good, bad, seen = sinks.write_checked_points(points, scratch_path(spark, "checked-points"))
    both = good.withColumn("bad", F.lit(False)).union(bad.withColumn("bad", F.lit(True)))
    return both.withColumns({"n_good": F.lit(seen["good"]), "n_bad": F.lit(seen["bad"])}).withColumns(
        {n: F.col(n).cast("bigint") for n in ("n_good", "n_bad")}
    )


# The day range that the stored points are read for.
FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-20"


def stored_points(spark, sf_dir):
    """The point table written by day, the report's columns of a day range read."""
    path = scratch_path(spark, "point-table")
    sinks.write_points(_day_points(spark, sf_dir), path)
    return sinks.read_report_points(spark, path, FIRST_DAY, LAST_DAY).select(
        "entity", "flight_date", "idx", "lat", "lng", "altitude_ft"
    )


def stored_legs(spark, sf_dir):
    """The leg table of the day documents, written and read by day."""
    path = scratch_path(spark, "leg-table")
    legs = L.leg_summary(_day_points(spark, sf_dir), L.TrackCols(), X.EVENT_DAY_PARAMS)
    sinks.write_legs(legs, path)
    return sinks.read_legs(spark, path)


def incremental_legs(spark, sf_dir):
    """Two micro-batches and a replay; legs of touched days only are computed anew."""
    path = scratch_path(spark, "incremental")
    early, late = X.arriving_documents(spark, sf_dir)
    for batch_id, docs in ((0, early), (1, late), (1, late)):
        N.process_batch(docs, batch_id, f"{path}/points", f"{path}/aside", None, f"{path}/legs", X.EVENT_DAY_PARAMS)
    return N.current_legs(spark, f"{path}/legs")


def feature_collections(spark, sf_dir):
    """A FeatureCollection per day, written in parts and read back: Features, where it opens and closes."""
    path = scratch_path(spark, "collections")
    cols = L.TrackCols()
    features = G.features(G.ribbons(G.coloured_pairs(materialised(_day_points(spark, sf_dir), "points"), cols), cols), cols)
    sinks.write_collections(features, path)
    lines = G.parsed_features(sinks.read_collections(spark, path))
    place = F.struct("part", "line")
    return lines.groupBy("flight_date").agg(
        F.count_if(F.col("feature_type") == "Feature").alias("n_features"),
        F.count_if("opens").alias("n_opens"),
        F.count_if("closes").alias("n_closes"),
        (F.min_by("opens", place) & F.max_by("closes", place)).alias("in_place"),
        F.max("extrusion_height").alias("highest"),
        F.count_distinct("color").alias("colours"),
    )


def trace_leg_summary(spark, sf_dir):
    """Flatten + leg summary per (entity, flight_date): ground below 2000 ft (the
    reference default); legs longer than 60 s with more than 2 points, since these
    16-point documents cannot meet 900 s / 50 points."""
    docs = X.trace_documents(spark, sf_dir).withColumn("_corrupt_record", F.lit(None).cast("string"))
    pts = TR.flatten(TR.day_documents(docs)[0])
    params = L.LegParams(min_seconds=60, min_points=2)
    return L.leg_summary(pts, L.TrackCols(), params)


def embedding_values(spark, sf_dir):
    """U1 + U2 on a numeric array: one row per element with its 1-based position."""
    emb = X.table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.posexplode("embedding").alias("pos", "value")).select(
        "vec_id", (F.col("pos") + 1).cast("bigint").alias("idx"), "value"
    )


def props_int(spark, sf_dir):
    """JSON field to INT (``$.k`` of events.props)."""
    ev = X.table(spark, sf_dir, "events")
    return ev.select("event_id", json_int(F.get_json_object("props", "$.k")).alias("k"))


# ---------------------------------------------------------------- ingest bookkeeping


def _expected(spark, sf_dir):
    return I.expected_days(X.entity_spans(spark, sf_dir), ["entity"])


def _latest(spark, sf_dir):
    return I.latest_status(X.manifest_history(spark, sf_dir))


def expected_days(spark, sf_dir):
    """Every (entity, day) from first to last day, with names."""
    return _expected(spark, sf_dir)


def missing_days(spark, sf_dir):
    """Expected days that a run fetches: no file there, and not cached as empty."""
    return I.missing_days(_expected(spark, sf_dir), _latest(spark, sf_dir), X.present_files(spark, sf_dir)).select(
        "entity", "day", "file_name"
    )


def _classified(spark, sf_dir):
    return I.classify_days(_expected(spark, sf_dir), _latest(spark, sf_dir), X.present_files(spark, sf_dir))


def _ended(spark, sf_dir):
    return I.run_outcomes(_classified(spark, sf_dir), X.fetched_payloads(spark, sf_dir))


def day_status(spark, sf_dir):
    """Every expected day with its cached status and what a run does with it."""
    return _classified(spark, sf_dir).select("entity", "day", "status", "outcome")


def manifest_latest(spark, sf_dir):
    """Latest status, source and time per (entity, day)."""
    return _latest(spark, sf_dir)


def manifest_upsert(spark, sf_dir):
    """W7 as a table operation: the fallback feed's looks replace the primary feed's
    entries of their days, also where they are older."""
    hist = X.manifest_history(spark, sf_dir)
    cache = hist.filter(F.col("source") == "primary")
    updates = hist.filter(F.col("source") == "fallback")
    return I.upsert(cache, updates)


def manifest_table(spark, sf_dir):
    """The cache as a stored table: the primary feed's looks committed, the fallback feed's
    committed over them, twice, and the newest version read back."""
    path = scratch_path(spark, "manifest")
    hist = X.manifest_history(spark, sf_dir)
    fallback = hist.filter(F.col("source") == "fallback")
    keyed.create_table(spark, path)
    for looks in (hist.filter(F.col("source") == "primary"), fallback, fallback):
        keyed.upsert_table(looks, path, buckets=16)
    return keyed.read_table(spark, path, hist.schema)


def run_cache_update(spark, sf_dir):
    """What a run writes to the cache: its downloaded and failed days, by the feed that gave them."""
    return I.run_updates(_ended(spark, sf_dir), F.lit(X.RUN_AT).cast("timestamp_ntz"))


def outcome_counts(spark, sf_dir):
    """Days per outcome after the run (skipped, cached, downloaded, failed) and the total."""
    return I.outcome_counts(_ended(spark, sf_dir))


def run_status(spark, sf_dir):
    """Days processed and failed; any failed day fails the run."""
    return I.run_status(_ended(spark, sf_dir))


def source_choice(spark, sf_dir):
    """T1 + T3: per (entity, day) the primary feed's payload, else the fallback's."""
    primary, fallback = X.feeds(spark, sf_dir)
    return I.choose_source(primary, fallback).select("entity", "day", "source", "n_points", "first_seen")


def archive_paths(spark, sf_dir):
    """F26 + F30: archive path and file name of every day with events."""
    days = X.event_days(spark, sf_dir).select("day").distinct()
    return days.select("day", archive_path("day").alias("archive_path"), track_file_name("day").alias("file_name"))


def hex_ids(spark, sf_dir):
    """entity ids to hex text and back."""
    users = X.table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select("user_id", to_hex("user_id").alias("hex_id")).withColumn(
        "back", from_hex("hex_id")
    )


# Fixed values for the pages payload check: a page is a usable primary payload when it
# is English, a fallback payload when it is French, else none.
PRIMARY_KEY = 'lang="en"'
FALLBACK_KEY = 'lang="fr"'


def valid_payloads(spark, sf_dir):
    """P17 + F31: non-empty payloads containing the primary (else the fallback) key."""
    pages = X.table(spark, sf_dir, "pages")
    html = F.col("html")
    kind = (
        F.when(I.valid_payload(html, PRIMARY_KEY), F.lit("primary"))
        .when(I.valid_payload(html, FALLBACK_KEY), F.lit("fallback"))
    )
    return (
        pages.select("page_id", kind.alias("source"), I.valid_payload(html, FALLBACK_KEY).alias("is_fr"),
                     F.length(html).cast("bigint").alias("n_chars"))
        .filter(F.col("source").isNotNull())
    )


def status_lines(spark, sf_dir):
    """F29 + S11 text form: latest statuses as ``yyyy-MM-dd:status`` lines, parsed back."""
    latest = _latest(spark, sf_dir)
    line = I.status_line(F.col("day"), F.col("status"))
    day, status = I.parse_status_line(line)
    return latest.select("entity", line.alias("line"), day.alias("day"), status.alias("status"))


def queries() -> dict[str, Query]:
    return {
        "leg_summary": leg_summary,
        "ground_flag": ground_flag,
        "takeoff_edges": takeoff_edges,
        "leg_numbers": leg_numbers,
        "leg_extents": leg_extents,
        "leg_endpoints": leg_endpoints,
        "leg_endpoints_join": leg_endpoints_join,
        "first_last_per_point": first_last_per_point,
        "leg_keys_distinct": leg_keys_distinct,
        "null_key_legs": null_key_legs,
        "null_key_numbers": null_key_numbers,
        "null_key_colour": null_key_colour,
        "significant_legs": significant_legs,
        "takeoff_places": takeoff_places,
        "landing_places": landing_places,
        "places_range_join": places_range_join,
        "places_grid_join": places_grid_join,
        "point_total": point_total,
        "leg_total": leg_total,
        "report_points": report_points,
        "report_legs": report_legs,
        "track_altitude_range": track_altitude_range,
        "track_counts": track_counts,
        "coordinate_total": coordinate_total,
        "point_pairs": point_pairs,
        "altitude_colour": altitude_colour,
        "ribbon_polygons": ribbon_polygons,
        "geojson_features": geojson_features,
        "track_paths": track_paths,
        "flatten_points": flatten_points,
        "trace_text_flatten": trace_text_flatten,
        "trace_text_quarantine": trace_text_quarantine,
        "document_choice": document_choice,
        "one_document_per_day": one_document_per_day,
        "trace_files": trace_files,
        "checked_points": checked_points,
        "stored_points": stored_points,
        "stored_legs": stored_legs,
        "incremental_legs": incremental_legs,
        "feature_collections": feature_collections,
        "trace_leg_summary": trace_leg_summary,
        "embedding_values": embedding_values,
        "props_int": props_int,
        "expected_days": expected_days,
        "missing_days": missing_days,
        "day_status": day_status,
        "manifest_latest": manifest_latest,
        "manifest_upsert": manifest_upsert,
        "manifest_table": manifest_table,
        "run_cache_update": run_cache_update,
        "outcome_counts": outcome_counts,
        "run_status": run_status,
        "source_choice": source_choice,
        "archive_paths": archive_paths,
        "hex_ids": hex_ids,
        "valid_payloads": valid_payloads,
        "status_lines": status_lines,
    }
