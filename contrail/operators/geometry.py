"""Track geometry for the map: consecutive pairs, altitude colour ramp, ribbons, GeoJSON.

Per track (all points, not per leg): every point is paired with the next one;
pairs with a missing, zero, NaN or negative altitude at either end are dropped;
the pair's mean altitude is normalised by the track's range of positive altitudes
and coloured; a ribbon polygon of fixed width is drawn around the segment.

Scale: pairing uses the chunk halo of ``ordering.neighbours`` (no track-wide
window). Track statistics are pre-aggregated per ``(track, chunk)`` straight from
the scan, rolled up over the track's chunks (one row per chunk) and joined on
``(keys, _chunk)``, the pairs' own partitioning, so the pairs are not reshuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions import safe_div
from contrail.operators.legs import TrackCols
from contrail.operators.ordering import CHUNK, DEFAULT_CHUNK_SIZE, chunk_of, neighbours, opened_keys, sealed_keys

# The report map's ribbon and colour ramp.
# Ribbon half-width 0.0008 degrees; ramp cut points 0.33 and 0.66, last band 0.34 wide;
# colours red rgb(255, 0, 0) -> yellow rgb(255, 255, 0) -> cyan rgb(0, 255, 255)
# -> rgb(0, 100, 255); extrusion height max(150, 0.3 * alt), base max(0, 0.3 * alt - 180).
RIBBON_WIDTH = 0.0008
RAMP_LOW = 0.33
RAMP_MID = 0.66
RAMP_HIGH_SPAN = 0.34
HEIGHT_SCALE = 0.3
MIN_HEIGHT = 150.0
BASE_DROP = 180.0


def _positive(c: Column) -> Column:
    """NULL unless a usable positive altitude (drops 0, NULL, NaN, negatives)."""
    return F.when((c > 0) & ~F.isnan(c.cast("double")), c)


def track_stats(points: DataFrame, cols: TrackCols = TrackCols()) -> DataFrame:
    """A11-A12 per track: min/max positive altitude and point count (hash aggregate)."""
    alt = _positive(F.col(cols.alt))
    return points.groupBy(*cols.keys).agg(
        F.min(alt).alias("min_alt"), F.max(alt).alias("max_alt"), F.count(F.lit(1)).alias("num_points")
    )


def chunk_track_stats(points: DataFrame, cols: TrackCols = TrackCols(),
                      chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """W6 support: track-wide min/max positive altitude on one row per (track, chunk)."""
    alt = _positive(F.col(cols.alt))
    part = points.groupBy(*cols.keys, chunk_of(cols.order, chunk_size).alias(CHUNK)).agg(
        F.min(alt).alias("_mn"), F.max(alt).alias("_mx")
    )
    track = Window.partitionBy(*cols.keys)
    return part.select(
        *cols.keys, CHUNK, F.min("_mn").over(track).alias("min_alt"), F.max("_mx").over(track).alias("max_alt")
    )


def pair_points(points: DataFrame, cols: TrackCols = TrackCols(),
                chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Valid consecutive pairs with their mean altitude.

    Output keeps ``_chunk``; columns: keys, idx, lat, lng, alt, next_lat, next_lng,
    next_alt, avg_alt (DOUBLE).
    """
    nb = neighbours(
        points.select(*cols.keys, cols.order, cols.lat, cols.lng, cols.alt),
        cols.keys, [cols.lat, cols.lng, cols.alt], cols.order, chunk_size, previous=False, following=True,
    )
    a, b = F.col(cols.alt), F.col(f"next_{cols.alt}")
    return nb.filter(_positive(a).isNotNull() & _positive(b).isNotNull()).withColumn(
        "avg_alt", (a.cast("double") + b.cast("double")) / F.lit(2.0)
    )


def altitude_ratio(avg: Column, mn: Column, mx: Column) -> Column:
    """position of ``avg`` in [mn, mx]; a zero span divides by 1."""
    span = mx.cast("double") - mn.cast("double")
    return (avg - mn.cast("double")) / F.coalesce(F.when((span != 0) & ~F.isnan(span), span), F.lit(1.0))


def colour_ramp(ratio: Column) -> Column:
    """``rgb(r, g, b)`` text for a ratio in [0, 1]."""
    def ch(x: Column) -> Column:
        return F.round(x).cast("int")

    u1 = ratio / F.lit(RAMP_LOW)
    u2 = (ratio - F.lit(RAMP_LOW)) / F.lit(RAMP_LOW)
    u3 = (ratio - F.lit(RAMP_MID)) / F.lit(RAMP_HIGH_SPAN)
    low = F.format_string("rgb(%d, %d, %d)", F.lit(255), ch(u1 * F.lit(255.0)), F.lit(0))
    mid = F.format_string(
        "rgb(%d, %d, %d)", ch(F.lit(255.0) - u2 * F.lit(255.0)), F.lit(255), ch(u2 * F.lit(255.0))
    )
    high = F.format_string("rgb(%d, %d, %d)", F.lit(0), ch(F.lit(255.0) - u3 * F.lit(155.0)), F.lit(255))
    return F.when(ratio < F.lit(RAMP_LOW), low).when(ratio < F.lit(RAMP_MID), mid).otherwise(high)


def coloured_pairs(points: DataFrame, cols: TrackCols = TrackCols(),
                   chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """W6 + ramp: every valid pair with its track's altitude range, ratio and colour."""
    sealed, keys = sealed_keys(points, cols.keys)
    safe = cols.with_(keys=tuple(keys))
    pairs = pair_points(sealed, safe, chunk_size)
    stats = chunk_track_stats(sealed, safe, chunk_size)
    out = opened_keys(pairs.join(stats, [*keys, CHUNK], "inner"), keys)
    ratio = altitude_ratio(F.col("avg_alt"), F.col("min_alt"), F.col("max_alt"))
    return out.withColumn("ratio", ratio).withColumn("color", colour_ramp(F.col("ratio")))


def ribbons(coloured: DataFrame, cols: TrackCols = TrackCols(), width: float = RIBBON_WIDTH) -> DataFrame:
    """Unit normal, closed 5-corner ring ``[lng, lat]``, extrusion sizes."""
    lat, lng = F.col(cols.lat), F.col(cols.lng)
    lat2, lng2 = F.col(f"next_{cols.lat}"), F.col(f"next_{cols.lng}")
    w = F.lit(float(width))
    dx, dy, length = F.col("dx"), F.col("dy"), F.col("length")
    with_len = (
        coloured.withColumns({"dx": lng2 - lng, "dy": lat2 - lat})
        .withColumn("length", F.sqrt(dx * dx + dy * dy))
        .filter(length > 0)
    )
    normal = with_len.withColumns({"nx": safe_div(-dy, length) * w, "ny": safe_div(dx, length) * w})
    nx, ny, avg = F.col("nx"), F.col("ny"), F.col("avg_alt")
    return normal.withColumns(
        {
            "x0": lng - nx, "y0": lat - ny,
            "x1": lng + nx, "y1": lat + ny,
            "x2": lng2 + nx, "y2": lat2 + ny,
            "x3": lng2 - nx, "y3": lat2 - ny,
            "extrusion_height": F.greatest(F.lit(MIN_HEIGHT), avg * F.lit(HEIGHT_SCALE)),
            "extrusion_base": F.greatest(F.lit(0.0), avg * F.lit(HEIGHT_SCALE) - F.lit(BASE_DROP)),
        }
    )


def ring() -> Column:
    """The closed ring as ``array<array<double>>`` from the corner columns."""
    pts = [F.array(F.col(f"x{i}"), F.col(f"y{i}")) for i in (0, 1, 2, 3, 0)]
    return F.array(*pts)


def features(rib: DataFrame, cols: TrackCols = TrackCols()) -> DataFrame:
    """One GeoJSON Feature struct per ribbon (``feature``) plus its JSON text."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.col("avg_alt").alias("altitude"),
            F.col("color").alias("color"),
            F.col("extrusion_height").alias("extrusion_height"),
            F.col("extrusion_base").alias("extrusion_base"),
        ).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring()).alias("coordinates")).alias("geometry"),
    )
    return rib.select(*cols.keys, cols.order, feature.alias("feature")).withColumn(
        "geojson", F.to_json("feature")
    )


def path_pieces(points: DataFrame, cols: TrackCols = TrackCols(), piece_size: int = 4096) -> DataFrame:
    """A10: each track's ordered path, as pieces of at most ``piece_size`` points.

    A whole track is never gathered into one row: a piece is one bounded group
    ``(keys, piece)``; its path is the positions ``lng,lat`` in full, joined by spaces,
    in ordinal order.
    """
    piece = chunk_of(cols.order, piece_size).alias("piece")
    position = F.struct(F.col(cols.order).alias("o"), F.col(cols.lng).alias("x"), F.col(cols.lat).alias("y"))
    return points.select(*cols.keys, piece, position.alias("p")).groupBy(*cols.keys, "piece").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.concat_ws(
            " ",
            F.transform(
                F.array_sort(F.collect_list("p")),
                lambda p: F.concat(p["x"].cast("string"), F.lit(","), p["y"].cast("string")),
            ),
        ).alias("path"),
    )


# What ``features`` writes, to read a Feature's text back with types.
FEATURE_SCHEMA = (
    "type string, properties struct<altitude: double, color: string, extrusion_height: double, "
    "extrusion_base: double>, geometry struct<type: string, coordinates: array<array<array<double>>>>"
)


def parsed_features(lines: DataFrame, text: str = "geojson") -> DataFrame:
    """Feature texts back to typed columns: type, properties, ring corners x0, y0 ... x4, y4."""
    parsed = lines.withColumn("_f", F.from_json(text, FEATURE_SCHEMA, {"mode": "FAILFAST"}))
    ring_of = F.col("_f.geometry.coordinates")[0]
    corners = {f"{axis}{i}": ring_of[i][k] for i in range(5) for k, axis in enumerate("xy")}
    return (
        parsed.withColumns(
            {
                "feature_type": F.col("_f.type"),
                "geometry_type": F.col("_f.geometry.type"),
                "rings": F.size("_f.geometry.coordinates"),
                "corners": F.size(ring_of),
                "altitude": F.col("_f.properties.altitude"),
                "color": F.col("_f.properties.color"),
                "extrusion_height": F.col("_f.properties.extrusion_height"),
                "extrusion_base": F.col("_f.properties.extrusion_base"),
            }
        )
        .withColumns(corners)
        .drop("_f")
    )
