"""Place labels for leg endpoints: ordered rule chains, as expressions or as a join.

A rule is an open box around a point (``|lat - c| < tol`` and ``|lng - c| < tol``) or
between bounds (``lo < lat < hi`` and ``lo < lng < hi``), optionally guarded by a
minimum altitude where a missing altitude counts as ``GUARD_DEFAULT_ALT``. The first
rule that matches wins; no match gives ``UNKNOWN``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.session import materialised

UNKNOWN = "Unknown"
GUARD_DEFAULT_ALT = 10000


@dataclass(frozen=True)
class Place:
    label: str
    lat: float | None = None  # centre (centre rules)
    lng: float | None = None
    tol: float | None = None
    lat_lo: float | None = None  # open bounds (box rules)
    lat_hi: float | None = None
    lng_lo: float | None = None
    lng_hi: float | None = None
    min_alt: int | None = None  # guard: coalesce(alt, GUARD_DEFAULT_ALT) > min_alt

    @staticmethod
    def centre(label, lat, lng, tol, min_alt=None) -> "Place":
        return Place(label, lat=lat, lng=lng, tol=tol, min_alt=min_alt)

    @staticmethod
    def box(label, lat, lng, min_alt=None) -> "Place":
        return Place(label, lat_lo=lat[0], lat_hi=lat[1], lng_lo=lng[0], lng_hi=lng[1], min_alt=min_alt)

    @property
    def is_centre(self) -> bool:
        return self.tol is not None

    def extent(self) -> tuple[float, float, float, float]:
        """Closed bounding box (lat_lo, lat_hi, lng_lo, lng_hi) of the rule."""
        if self.is_centre:
            return (self.lat - self.tol, self.lat + self.tol, self.lng - self.tol, self.lng + self.tol)
        return (self.lat_lo, self.lat_hi, self.lng_lo, self.lng_hi)


# The place rules of the report, in order of precedence.
# Takeoff: Maputo (-25.9, 32.57, tol 0.5), Pemba (-12.99, 40.52, tol 0.5),
# Afungi (-10.82, 40.53, tol 1.0).
TAKEOFF_PLACES: tuple[Place, ...] = (
    Place.centre("Maputo", -25.9, 32.57, 0.5),
    Place.centre("Pemba", -12.99, 40.52, 0.5),
    Place.centre("Afungi", -10.82, 40.53, 1.0),
)
# Landing: the same first two; Afungi (-10.82, 40.53, tol 1.0) above 3000 ft; then
# Afungi between lat -12 and -10, lng 39.5 and 41.5, above 5000 ft.
LANDING_PLACES: tuple[Place, ...] = (
    Place.centre("Maputo", -25.9, 32.57, 0.5),
    Place.centre("Pemba", -12.99, 40.52, 0.5),
    Place.centre("Afungi", -10.82, 40.53, 1.0, min_alt=3000),
    Place.box("Afungi", lat=(-12.0, -10.0), lng=(39.5, 41.5), min_alt=5000),
)


def _inside(place: Place, lat: Column, lng: Column, alt: Column) -> Column:
    """The point lies inside the rule's open box and passes its guard."""
    if place.is_centre:
        found = (F.abs(lat - F.lit(float(place.lat))) < F.lit(float(place.tol))) & (
            F.abs(lng - F.lit(float(place.lng))) < F.lit(float(place.tol))
        )
    else:
        found = (
            (lat < F.lit(float(place.lat_hi)))
            & (lat > F.lit(float(place.lat_lo)))
            & (lng > F.lit(float(place.lng_lo)))
            & (lng < F.lit(float(place.lng_hi)))
        )
    if place.min_alt is not None:
        found = found & (F.coalesce(alt, F.lit(GUARD_DEFAULT_ALT)) > F.lit(int(place.min_alt)))
    return found


def label(lat: str, lng: str, alt: str | None = None, rules: Sequence[Place] = TAKEOFF_PLACES) -> Column:
    """First matching rule's label, else ``UNKNOWN``: one CASE expression (codegen'd).

    Labels are literals, whatever characters they hold.
    """
    out = F.lit(UNKNOWN)
    alt_c = F.col(alt) if alt is not None else F.lit(None).cast("int")
    for place in reversed(rules):
        out = F.when(_inside(place, F.col(lat), F.col(lng), alt_c), F.lit(place.label)).otherwise(out)
    return out


_PLACE_SCHEMA = T.StructType(
    [
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("c_lat", T.DoubleType()),
        T.StructField("c_lng", T.DoubleType()),
        T.StructField("tol", T.DoubleType()),
        T.StructField("lat_lo", T.DoubleType()),
        T.StructField("lat_hi", T.DoubleType()),
        T.StructField("lng_lo", T.DoubleType()),
        T.StructField("lng_hi", T.DoubleType()),
        T.StructField("min_alt", T.IntegerType()),
    ]
)


def places_frame(spark: SparkSession, rules: Sequence[Place]) -> DataFrame:
    """The rule list as a places table; ``priority`` is the position in the chain."""
    rows = []
    for i, p in enumerate(rules):
        lat_lo, lat_hi, lng_lo, lng_hi = p.extent()
        rows.append(
            (
                i,
                p.label,
                None if p.lat is None else float(p.lat),
                None if p.lng is None else float(p.lng),
                None if p.tol is None else float(p.tol),
                float(lat_lo),
                float(lat_hi),
                float(lng_lo),
                float(lng_hi),
                p.min_alt,
            )
        )
    return spark.createDataFrame(rows, _PLACE_SCHEMA)


def _in_extent(lat: Column, lng: Column, prefix: str = "") -> Column:
    """The point lies inside the open box of the place whose columns have the prefix."""
    p = lambda name: F.col(f"{prefix}{name}")
    centre = p("tol").isNotNull() & (F.abs(lat - p("c_lat")) < p("tol")) & (F.abs(lng - p("c_lng")) < p("tol"))
    box = (
        p("tol").isNull() & (lat < p("lat_hi")) & (lat > p("lat_lo")) & (lng > p("lng_lo")) & (lng < p("lng_hi"))
    )
    return centre | box


def _table_match(lat: Column, lng: Column, alt: Column) -> Column:
    """The rule of the joined place (columns prefixed ``_place_``) holds for the point."""
    floor = F.col("_place_min_alt")
    guard = floor.isNull() | (F.coalesce(alt, F.lit(GUARD_DEFAULT_ALT)) > floor)
    return _in_extent(lat, lng, "_place_") & guard


# Cells of the label join are 4**k degrees wide; places wider than the largest cell
# cover four cells of it at most, places narrower than the smallest lie in up to four.
_CELL_POWERS = (-5, 5)
_CELL = ["_level", "_depth", "_gy", "_gx"]
_EPS = 1e-9  # a point within rounding distance of an edge still sees the cell

# Looked-up rows and places of a cell beyond which it is split; halvings of a cell before rows
# that lie on one spot are told apart by their number; full cells that are handed to all tasks.
CELL_BOUND = 1 << 20
PLACE_BOUND = 128
_HALVINGS = 12
MOST_BROADCAST_CELLS = 1_000_000


def _width() -> Column:
    """Width of the cell of a row's level and depth, in degrees."""
    return F.pow(F.lit(4.0), F.col("_level")) / F.pow(F.lit(2.0), F.col("_depth"))


def _touched(low: str, high: str) -> Column:
    """Numbers of the cells that an extent touches along one axis."""
    return F.explode(
        F.sequence(F.floor((F.col(low) - F.lit(_EPS)) / _width()), F.floor((F.col(high) + F.lit(_EPS)) / _width()))
    )


def place_cells(places: DataFrame) -> DataFrame:
    """Places copied into the grid cells that they touch: one to four rows each.

    A place's level is the smallest cell that is as wide as its own extent, which comes
    from its bounds or else from its centre and tolerance; so a wide place neither
    widens the cells of the others nor is copied into many.
    """
    low, high = _CELL_POWERS
    extent = places.withColumns(
        {
            "_y0": F.when(F.col("tol").isNull(), F.col("lat_lo")).otherwise(F.col("c_lat") - F.col("tol")),
            "_y1": F.when(F.col("tol").isNull(), F.col("lat_hi")).otherwise(F.col("c_lat") + F.col("tol")),
            "_x0": F.when(F.col("tol").isNull(), F.col("lng_lo")).otherwise(F.col("c_lng") - F.col("tol")),
            "_x1": F.when(F.col("tol").isNull(), F.col("lng_hi")).otherwise(F.col("c_lng") + F.col("tol")),
        }
    ).filter((F.col("_y1") >= F.col("_y0")) & (F.col("_x1") >= F.col("_x0")))
    width = F.greatest(F.col("_y1") - F.col("_y0"), F.col("_x1") - F.col("_x0"), F.lit(4.0**low))
    level = F.least(F.greatest(F.ceil(F.log2(width) / 2), F.lit(low)), F.lit(high)).cast("int")
    placed = extent.withColumn("_level", level).withColumn("_depth", F.lit(0))
    return placed.withColumn("_gy", _touched("_y0", "_y1")).withColumn("_gx", _touched("_x0", "_x1"))


_SHAPE = [c for c in _PLACE_SCHEMA.names if c not in ("priority", "label")]
_NO_GUARD = -(1 << 40)  # below every altitude


def ranked_places(places: DataFrame) -> DataFrame:
    """Places with ``_rank``, a number that rises with (priority, label): the match of least rank wins."""
    ordered = places.select(*_PLACE_SCHEMA.names).orderBy("priority", "label")
    return materialised(ordered.withColumn("_rank", F.monotonically_increasing_id()), "ranked-places")


def _quarters(cells: DataFrame) -> DataFrame:
    """Rows of place cells moved into the quarters of their cell that the place touches."""
    parent = cells.withColumns({"_py": F.col("_gy"), "_px": F.col("_gx"), "_depth": F.col("_depth") + 1})
    quarter = parent.withColumn("_gy", _touched("_y0", "_y1")).withColumn("_gx", _touched("_x0", "_x1"))
    # Only the quarters of the cell that was split: its other cells have their own rows.
    own = (F.floor(F.col("_gy") / 2) == F.col("_py")) & (F.floor(F.col("_gx") / 2) == F.col("_px"))
    return quarter.filter(own).drop("_py", "_px")


def _undominated(cells: DataFrame) -> DataFrame:
    """Place cells without the places that cannot win in their cell.

    A place whose box holds the whole cell matches every row there that passes its guard, so a
    place of higher rank whose guard is no lower never wins. Each side of a box is an interval
    of the numbers, so the box holds the cell if it holds its least and greatest corner.
    """
    edge = lambda c, step: (F.col(c).cast("double") + F.lit(float(step))) * _width()
    covers = _in_extent(edge("_gy", 0), edge("_gx", 0)) & _in_extent(edge("_gy", 1), edge("_gx", 1))
    guarded = cells.withColumn("_guard", F.coalesce(F.col("min_alt").cast("bigint"), F.lit(_NO_GUARD)))
    upto = Window.partitionBy(*_CELL).orderBy("_guard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = guarded.groupBy(*_CELL, "_guard").agg(F.min(F.when(covers, F.col("_rank"))).alias("_cover"))
    best = best.withColumn("_cover", F.min("_cover").over(upto))  # a row per guard in the cell
    can_win = F.col("_cover").isNull() | (F.col("_rank") <= F.col("_cover"))
    return guarded.join(best, [*_CELL, "_guard"]).filter(can_win).drop("_guard", "_cover")


def _split_crowded_cells(cells: DataFrame, bound: int) -> tuple[DataFrame, list[DataFrame]]:
    """(cells, tables of the cells that were split, by depth): cells of at most ``bound`` places.

    A cell with more is quartered, and each quarter keeps the places that can win there: the more
    places overlap, the better the best of those that hold all of it, so what stays does not grow
    with their number. What is still crowded after ``_HALVINGS`` stays as it is.
    """
    settled, splits = [], []
    for _ in range(_HALVINGS):
        full = cells.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bound).select(*_CELL)
        full = materialised(full, "crowded-cells")
        n = full.count()
        if not n:
            break
        splits.append(F.broadcast(full) if n <= MOST_BROADCAST_CELLS else full)
        settled.append(cells.join(splits[-1], _CELL, "left_anti"))
        cells = materialised(_undominated(_quarters(cells.join(splits[-1], _CELL, "left_semi"))), "crowded-places")
    return reduce(DataFrame.unionByName, [*settled, cells]), splits


def _deepened(look: DataFrame, splits: list[DataFrame]) -> DataFrame:
    """Looked-up rows in the cells that are left where ``splits`` were split."""
    for side in splits:
        deeper = look.join(side.withColumn("_split", F.lit(True)), _CELL, "left")
        look = deeper.withColumn("_depth", F.when(F.col("_split"), F.col("_depth") + 1).otherwise(F.col("_depth")))
        look = look.withColumn("_gy", F.floor(F.col("_y") / _width())).withColumn("_gx", F.floor(F.col("_x") / _width()))
        look = look.drop("_split")
    return look


def _split_full_cells(look: DataFrame, cells: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """(look, cells) with no cell of more than ``bound`` looked-up rows.

    A full cell is halved along both axes, its rows and places go to the quarters that they
    lie in or touch, and so on by the counts of the quarters; what is still full after
    ``_HALVINGS`` lies on one spot and is dealt over as many copies of the cell's places as its
    count asks for.
    """
    settled, settled_cells = [], []
    for depth in range(_HALVINGS + 1):
        full = look.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bound)
        full = materialised(full, "full-cells")
        n = full.count()
        # At most one row per ``bound`` looked-up rows: handed out where that is few, else joined.
        side = F.broadcast(full) if n <= MOST_BROADCAST_CELLS else full
        if not n or depth == _HALVINGS:
            parts = F.coalesce(F.ceil(F.col("_n") / F.lit(bound)), F.lit(1))
            salted = look.join(side, _CELL, "left").withColumn("_salt", F.pmod(F.col("_row"), parts).cast("int"))
            copies = F.explode(F.sequence(F.lit(0), parts.cast("int") - 1))
            settled.append(salted.drop("_n"))
            settled_cells.append(cells.join(side, _CELL, "left").withColumn("_salt", copies).drop("_n"))
            break
        settled.append(look.join(side, _CELL, "left_anti").withColumn("_salt", F.lit(0)))
        settled_cells.append(cells.join(side, _CELL, "left_anti").withColumn("_salt", F.lit(0)))
        # What lies in full cells is written with its quarter: the next round counts only that.
        inner = look.join(side, _CELL, "left_semi").withColumn("_depth", F.col("_depth") + 1)
        inner = inner.withColumn("_gy", F.floor(F.col("_y") / _width())).withColumn("_gx", F.floor(F.col("_x") / _width()))
        look = materialised(inner, "full-cell-rows")
        cells = materialised(_quarters(cells.join(side, _CELL, "left_semi")), "full-cell-places")
    return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, settled_cells)


def label_by_join(
    df: DataFrame, lat: str, lng: str, alt: str | None, places: DataFrame, out: str = "location",
    bound: int = CELL_BOUND, place_bound: int = PLACE_BOUND,
) -> DataFrame:
    """Label every row of ``df`` through an equi-join with a places table of any size.

    Every place lies in the grid cells of its own size, every row looks up one cell per size
    that places have (11 at most), with its number and position only; the join is on (size,
    cell), and the exact rule is checked on what meets. Of places with the same box and guard the
    best one is looked at; cells with more than ``place_bound`` places are quartered and keep those
    that can win there, so a row meets a bounded number however many places overlap. Cells with
    more than ``bound`` looked-up rows are split by their counts. The match of least ``priority`` wins (among equal
    priorities the least label); the labels that were found join back on the row number, the
    other rows get ``UNKNOWN``. Rows are kept one by one, whatever they hold; ``df`` is
    evaluated once, and its row numbers are written with it, so a task that is run again
    finds the same ones.
    """
    names = df.columns
    kept = materialised(df.withColumn("_row", F.monotonically_increasing_id()), "rows-to-label")
    ranked = ranked_places(places)
    shapes = ranked.groupBy(*_SHAPE).agg(F.min("_rank").alias("_rank"))
    cells = materialised(place_cells(shapes), "place-cells")
    levels = sorted(r[0] for r in cells.select("_level").distinct().collect())  # 11 at most
    altitude = F.col(alt).cast("int") if alt else F.lit(None).cast("int")
    look = kept.select("_row", F.col(lat).alias("_y"), F.col(lng).alias("_x"), altitude.alias("_alt")).filter(
        F.col("_y").isNotNull() & F.col("_x").isNotNull()
    )
    sizes = F.array(*[F.lit(k) for k in levels]).cast("array<int>")
    look = look.withColumn("_level", F.explode(sizes)).withColumn("_depth", F.lit(0))
    look = look.withColumn("_gy", F.floor(F.col("_y") / _width())).withColumn("_gx", F.floor(F.col("_x") / _width()))
    cells, splits = _split_crowded_cells(cells, place_bound)
    look = _deepened(look, splits)
    on = list(_CELL)
    if kept.count() > bound:
        look, cells = _split_full_cells(look, cells, bound)
        on.append("_salt")
    cells = cells.select(*on, "_rank", *[F.col(c).alias(f"_place_{c}") for c in _SHAPE])
    met = look.join(cells, on).filter(_table_match(F.col("_y"), F.col("_x"), F.col("_alt")))
    best = met.groupBy("_row").agg(F.min("_rank").alias("_rank"))
    found = best.join(ranked.select("_rank", F.col("label").alias("_label")), "_rank").select("_row", "_label")
    return kept.join(found, "_row", "left").select(
        *[n for n in names if n != out], F.coalesce(F.col("_label"), F.lit(UNKNOWN)).alias(out)
    )
