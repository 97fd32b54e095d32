"""Leg segmentation: ground flags -> takeoff edges -> leg numbers -> leg summary.

A *leg* is a maximal run of airborne points of one track (points below the ground
threshold are "ground"). Legs are numbered 1..k per track by the running count of
takeoffs (ground -> airborne edges; a track that starts airborne starts with a
takeoff). The summary keeps, per leg, its time extent, point count and first/last
positions, then drops short legs and labels the endpoints with place rules.

All ordered steps run per ``(track, chunk)`` (see ``ordering``), so the largest
task holds ``chunk_size`` points however long one track is. The summary is one
hash aggregate with map-side partial aggregation (``min_by``/``max_by`` per column,
which stay hash-based), instead of aggregate + join back + windows + DISTINCT.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions import iso_utc, round_scaled
from contrail.operators.ordering import (
    CHUNK,
    DEFAULT_CHUNK_SIZE,
    chunk_window,
    neighbours,
    opened_keys,
    sealed_keys,
)
from contrail.operators.places import LANDING_PLACES, TAKEOFF_PLACES, Place, label
from contrail.session import materialised

# Segmentation defaults of the reference build.
# Ground below 2000 ft; a leg counts when it lasts more than 900 s and has more
# than 50 airborne points; takeoff default of LAG is 1 (start counts as ground).
GROUND_BELOW_FT = 2000
MIN_LEG_SECONDS = 900
MIN_LEG_POINTS = 50
START_ON_GROUND = 1


@dataclass(frozen=True)
class TrackCols:
    """Column names of a point table. ``keys`` identify one track."""

    keys: tuple[str, ...] = ("entity", "flight_date")
    order: str = "idx"
    time: str = "time_offset"
    base: str | None = "base_timestamp"
    lat: str = "lat"
    lng: str = "lng"
    alt: str = "altitude_ft"

    def with_(self, **kw) -> "TrackCols":
        return replace(self, **kw)


@dataclass(frozen=True)
class LegParams:
    ground_below: int = GROUND_BELOW_FT
    min_seconds: float = MIN_LEG_SECONDS
    min_points: int = MIN_LEG_POINTS
    takeoff_places: tuple[Place, ...] = TAKEOFF_PLACES
    landing_places: tuple[Place, ...] = LANDING_PLACES
    chunk_size: int = DEFAULT_CHUNK_SIZE


def flag_ground(points: DataFrame, cols: TrackCols = TrackCols(), below: int = GROUND_BELOW_FT) -> DataFrame:
    """``is_ground`` = 1 when altitude < ``below``, else 0.

    A NULL altitude compares as NULL and falls to the ELSE branch (airborne), as the
    SQL CASE does; the flattener already maps missing altitudes to 0 (ground).
    """
    return points.withColumn(
        "is_ground", F.when(F.col(cols.alt) < F.lit(below), F.lit(1)).otherwise(F.lit(0))
    )


def mark_takeoffs(
    points: DataFrame,
    cols: TrackCols = TrackCols(),
    below: int = GROUND_BELOW_FT,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
) -> DataFrame:
    """All points with ``is_ground``, ``prev_ground`` (LAG with default 1), ``is_takeoff``."""
    flagged = flag_ground(points, cols, below)
    paired = neighbours(flagged, cols.keys, ["is_ground"], cols.order, chunk_size, previous=True)
    prev = F.coalesce(F.col("prev_is_ground"), F.lit(START_ON_GROUND))
    takeoff = F.when((prev == 1) & (F.col("is_ground") == 0), F.lit(1)).otherwise(F.lit(0))
    return paired.withColumns({"prev_ground": prev, "is_takeoff": takeoff}).drop("prev_is_ground")


def local_legs(
    points: DataFrame,
    cols: TrackCols = TrackCols(),
    below: int = GROUND_BELOW_FT,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
) -> DataFrame:
    """Airborne points with ``_chunk`` and ``_local_leg``: the running takeoff count
    inside the chunk (0 = the leg continues from an earlier chunk).

    The ground filter sits between the edge detection and the running sum, as in the
    reference; ground points carry no takeoff, so the count is unchanged by it. Both
    windows share one sort on ``(keys, _chunk, order)``.
    """
    edges = mark_takeoffs(points, cols, below, chunk_size)
    airborne = edges.filter(F.col("is_ground") == 0)
    running = chunk_window(cols.keys, cols.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return airborne.withColumn("_local_leg", F.sum("is_takeoff").over(running))


def chunk_partials(
    local: DataFrame, cols: TrackCols = TrackCols(), extents: bool = True, endpoints: bool = True
) -> DataFrame:
    """Pre-aggregate every (track, chunk, local leg) before any track-level step.

    The grouping keys contain the window's partitioning ``(keys, _chunk)``, so this
    aggregate runs in place, without another shuffle. The result is written once: it is
    small (legs + chunks) and is read twice (numbering and merging). Only the values
    asked for are computed and stored.
    """
    o = cols.order
    aggs = [F.min(o).alias("_i0"), F.max(o).alias("_i1")]
    if extents:
        aggs += [F.min(cols.time).alias("_t0"), F.max(cols.time).alias("_t1"), F.count(F.lit(1)).alias("_n")]
    if endpoints:
        for name, c in (("_lat", cols.lat), ("_lng", cols.lng), ("_alt", cols.alt)):
            aggs += [F.min_by(c, o).alias(f"{name}0"), F.max_by(c, o).alias(f"{name}1")]
    part = local.groupBy(*cols.keys, *([cols.base] if cols.base else []), CHUNK, "_local_leg").agg(*aggs)
    return materialised(part, "leg-partials")


def chunk_offsets(partials: DataFrame, cols: TrackCols = TrackCols()) -> DataFrame:
    """(keys, _chunk) -> number of takeoffs in all earlier chunks of the track.

    ``partials`` is any frame with ``keys, _chunk, _local_leg`` (the chunk partials or
    the windowed points). The takeoffs of a chunk are its largest local leg number.
    One row per chunk, so the window over a track's chunks holds
    ``points / chunk_size`` rows at most.
    """
    totals = partials.groupBy(*cols.keys, CHUNK).agg(F.max("_local_leg").alias("_tk"))
    before = Window.partitionBy(*cols.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *cols.keys, CHUNK, F.coalesce(F.sum("_tk").over(before), F.lit(0)).cast("bigint").alias("_leg_offset")
    )


def _leg_number(name: str):
    return (F.col("_leg_offset") + F.col("_local_leg")).cast("bigint").alias(name)


def number_legs(
    points: DataFrame,
    cols: TrackCols = TrackCols(),
    below: int = GROUND_BELOW_FT,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    name: str = "flight_num",
) -> DataFrame:
    """Airborne points with their leg number 1..k (running takeoff count), BIGINT.

    ``leg = takeoffs in earlier chunks + local running count``. The points are evaluated once:
    their chunk-local numbers are written, the takeoffs of the chunks are counted from there
    (one row per chunk) and join back on ``(keys, _chunk)``.
    """
    sealed, keys = sealed_keys(points, cols.keys)
    safe = cols.with_(keys=tuple(keys))
    local = materialised(local_legs(sealed, safe, below, chunk_size), "local-legs")
    numbered = local.join(chunk_offsets(local, safe), [*keys, CHUNK], "inner")
    return opened_keys(numbered, keys).select(*points.columns, "is_ground", "prev_ground", "is_takeoff", _leg_number(name))


def _group_keys(cols: TrackCols, leg: str) -> list[str]:
    return [*cols.keys, *([cols.base] if cols.base else []), leg]


def merge_partials(partials: DataFrame, cols: TrackCols = TrackCols(), leg: str = "flight_num",
                   extents: bool = True, endpoints: bool = True) -> DataFrame:
    """Per leg: merge the chunk partials (min of minima, first by ordinal, ...)."""
    numbered = partials.join(chunk_offsets(partials, cols), [*cols.keys, CHUNK], "inner").withColumn(
        leg, (F.col("_leg_offset") + F.col("_local_leg")).cast("bigint")
    )
    aggs = []
    if extents:
        aggs += [
            F.min("_t0").alias("takeoff_time"),
            F.max("_t1").alias("landing_time"),
            F.min("_i0").alias("takeoff_idx"),
            F.max("_i1").alias("landing_idx"),
            F.sum("_n").alias("num_points"),
        ]
    if endpoints:
        aggs += [
            F.min_by("_lat0", "_i0").alias("takeoff_lat"),
            F.min_by("_lng0", "_i0").alias("takeoff_lng"),
            F.min_by("_alt0", "_i0").alias("takeoff_altitude"),
            F.max_by("_lat1", "_i1").alias("landing_lat"),
            F.max_by("_lng1", "_i1").alias("landing_lng"),
            F.max_by("_alt1", "_i1").alias("landing_altitude"),
        ]
    return numbered.groupBy(*_group_keys(cols, leg)).agg(*aggs)


def summarise_points(points: DataFrame, cols: TrackCols = TrackCols(), params: "LegParams" = None,
                     extents: bool = True, endpoints: bool = True) -> DataFrame:
    """Segment and summarise in one pass over the points: one row per leg."""
    params = params or LegParams()
    sealed, keys = sealed_keys(points, cols.keys)
    safe = cols.with_(keys=tuple(keys))
    local = local_legs(sealed, safe, params.ground_below, params.chunk_size)
    merged = merge_partials(chunk_partials(local, safe, extents, endpoints), safe, "flight_num", extents, endpoints)
    return opened_keys(merged, keys)


def extent_aggs(cols: TrackCols) -> list:
    """A1-A5: time extent, ordinal extent and support of a leg."""
    return [
        F.min(cols.time).alias("takeoff_time"),
        F.max(cols.time).alias("landing_time"),
        F.min(cols.order).alias("takeoff_idx"),
        F.max(cols.order).alias("landing_idx"),
        F.count(F.lit(1)).alias("num_points"),
    ]


def endpoint_aggs(cols: TrackCols) -> list:
    """W3/W4 as aggregates: first and last position by ordinal (NULLs respected)."""
    o = cols.order
    return [
        F.min_by(cols.lat, o).alias("takeoff_lat"),
        F.min_by(cols.lng, o).alias("takeoff_lng"),
        F.min_by(cols.alt, o).alias("takeoff_altitude"),
        F.max_by(cols.lat, o).alias("landing_lat"),
        F.max_by(cols.lng, o).alias("landing_lng"),
        F.max_by(cols.alt, o).alias("landing_altitude"),
    ]


def summarise(legs: DataFrame, cols: TrackCols = TrackCols(), leg: str = "flight_num",
              extents: bool = True, endpoints: bool = True) -> DataFrame:
    """Per-leg hash aggregate over numbered points (partial + final)."""
    aggs = (extent_aggs(cols) if extents else []) + (endpoint_aggs(cols) if endpoints else [])
    return legs.groupBy(*_group_keys(cols, leg)).agg(*aggs)


def significant(summary: DataFrame, min_seconds: float = MIN_LEG_SECONDS,
                min_points: int = MIN_LEG_POINTS) -> DataFrame:
    """Keep legs lasting more than ``min_seconds`` with more than ``min_points`` points."""
    return summary.filter(
        (F.col("landing_time") - F.col("takeoff_time") > F.lit(float(min_seconds)))
        & (F.col("num_points") > F.lit(min_points))
    )


def _epoch(cols: TrackCols, c: str):
    return (F.col(cols.base) + F.col(c)) if cols.base else F.col(c)


def format_summary(summary: DataFrame, cols: TrackCols = TrackCols(), params: LegParams = LegParams(),
                   leg: str = "flight_num") -> DataFrame:
    """Final report columns: ISO times, 6-dp coordinates, labels, 1-dp minutes."""
    return summary.select(
        *cols.keys,
        F.col(leg).alias("flight_num"),
        iso_utc(_epoch(cols, "takeoff_time")).alias("takeoff_timestamp"),
        round_scaled("takeoff_lat", 6).alias("takeoff_lat"),
        round_scaled("takeoff_lng", 6).alias("takeoff_lng"),
        F.coalesce(F.col("takeoff_altitude"), F.lit(0)).alias("takeoff_altitude_ft"),
        label("takeoff_lat", "takeoff_lng", "takeoff_altitude", params.takeoff_places).alias("takeoff_location"),
        iso_utc(_epoch(cols, "landing_time")).alias("landing_timestamp"),
        round_scaled("landing_lat", 6).alias("landing_lat"),
        round_scaled("landing_lng", 6).alias("landing_lng"),
        F.coalesce(F.col("landing_altitude"), F.lit(0)).alias("landing_altitude_ft"),
        label("landing_lat", "landing_lng", "landing_altitude", params.landing_places).alias("landing_location"),
        round_scaled((F.col("landing_time") - F.col("takeoff_time")) / F.lit(60.0), 1).alias(
            "flight_duration_minutes"
        ),
    )


def leg_summary(points: DataFrame, cols: TrackCols = TrackCols(), params: LegParams = LegParams()) -> DataFrame:
    """The flight summary: segmentation, one aggregate, significance filter, labels."""
    summary = significant(summarise_points(points, cols, params), params.min_seconds, params.min_points)
    return format_summary(summary, cols, params)


def leg_keys(points: DataFrame, cols: TrackCols = TrackCols(), params: LegParams = LegParams(),
             leg: str = "flight_num") -> DataFrame:
    """The set of legs (track, leg number).

    Every leg has a row in the chunk partials already, so the set is taken from them:
    distinct over legs and chunks instead of over all points.
    """
    sealed, keys = sealed_keys(points, cols.keys)
    safe = cols.with_(keys=tuple(keys))
    partials = chunk_partials(local_legs(sealed, safe, params.ground_below, params.chunk_size), safe, False, False)
    numbered = partials.join(chunk_offsets(partials, safe), [*keys, CHUNK], "inner")
    return opened_keys(numbered.select(*keys, _leg_number(leg)).distinct(), keys)


def _stored_local(points: DataFrame, cols: TrackCols, below: int, chunk_size: int) -> tuple[DataFrame, TrackCols]:
    """The chunk-local legs of the points, written once with the columns that summaries read."""
    sealed, keys = sealed_keys(points.select(*dict.fromkeys(_point_columns(cols))), cols.keys)
    safe = cols.with_(keys=tuple(keys))
    local = local_legs(sealed, safe, below, chunk_size).drop("is_ground", "prev_ground", "is_takeoff")
    return materialised(local, "local-legs"), safe


def endpoints_by_join(points: DataFrame, cols: TrackCols = TrackCols(), leg: str = "flight_num",
                      below: int = GROUND_BELOW_FT, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Leg endpoints through an inner equi-join of leg extents with airborne points.

    The points are evaluated once; their chunk-local legs are written and read by the extents
    and by both joins, each with its own columns. A leg's first and last ordinal name one
    point of its track, so the joins are on ``(keys, ordinal)``: every key matches one point
    and no leg, however long, becomes a hot join key.
    """
    local, safe = _stored_local(points, cols, below, chunk_size)
    keys = list(safe.keys)
    ext = merge_partials(chunk_partials(local, safe, True, False), safe, leg, True, False)

    def end(side: str) -> DataFrame:
        return local.select(
            *keys, F.col(cols.order).alias(f"{side}_idx"), F.col(cols.lat).alias(f"{side}_lat"),
            F.col(cols.lng).alias(f"{side}_lng"), F.col(cols.alt).alias(f"{side}_altitude"),
        )

    joined = ext.join(end("takeoff"), [*keys, "takeoff_idx"]).join(end("landing"), [*keys, "landing_idx"])
    return opened_keys(joined, keys)


def _point_columns(cols: TrackCols) -> list[str]:
    base = [cols.base] if cols.base else []
    return [*cols.keys, *base, cols.order, cols.time, cols.lat, cols.lng, cols.alt]


# Values of a leg's ends, by the name in the chunk partials.
_ENDS = {"lat": "_lat", "lng": "_lng", "altitude": "_alt"}


def carried_ends(partials: DataFrame, cols: TrackCols = TrackCols(), leg: str = "flight_num") -> DataFrame:
    """(keys, _chunk, _local_leg) -> leg number and the first and last position of the whole leg.

    A segmented scan over the small chunk table: the part of a leg in a chunk takes its first
    values from the leg's earliest part and its last values from the latest one. A leg's
    window holds a row per chunk that it crosses.
    """
    numbered = partials.join(chunk_offsets(partials, cols), [*cols.keys, CHUNK]).withColumn(leg, _leg_number(leg))
    whole = (
        Window.partitionBy(*cols.keys, leg)
        .orderBy(CHUNK)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    first = {f"takeoff_{n}": F.first(f"{c}0").over(whole) for n, c in _ENDS.items()}
    last = {f"landing_{n}": F.last(f"{c}1").over(whole) for n, c in _ENDS.items()}
    return numbered.withColumns({**first, **last}).select(*cols.keys, CHUNK, "_local_leg", leg, *first, *last)


def first_last_per_point(points: DataFrame, cols: TrackCols = TrackCols(), leg: str = "flight_num",
                         below: int = GROUND_BELOW_FT, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """W3/W4 per point: every airborne point with its leg's first and last position.

    Same rows as ``FIRST_VALUE`` over the default frame and ``LAST_VALUE`` over the full frame
    of a window per leg. The points are evaluated once; the ends of a leg's part in a chunk
    come from the chunk partials, are carried over the chunks there, and join back on
    ``(keys, _chunk, _local_leg)``: a key has at most a chunk's points, however long the leg.
    """
    local, safe = _stored_local(points, cols, below, chunk_size)
    keys = list(safe.keys)
    ends = carried_ends(chunk_partials(local, safe, False, True), safe, leg)
    found = local.select(*keys, CHUNK, "_local_leg", cols.order).join(ends, [*keys, CHUNK, "_local_leg"])
    return opened_keys(found.drop(CHUNK, "_local_leg"), keys)
