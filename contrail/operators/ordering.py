"""Ordered work over tracks without one task per track.

A track (all points of one key, ordered by a 1-based dense ordinal ``idx``) can be
arbitrarily large: one vehicle may hold a third of all rows. A window partitioned
by the track key alone would put that whole track into one task. The operators
here split every track into *chunks* of at most ``chunk_size`` consecutive points
and window over ``(keys, chunk)`` instead:

* neighbour access (``lag``/``lead`` by one) copies the single boundary row of each
  chunk into the adjacent chunk (a one-row halo), so every consecutive pair meets
  in one window partition;
* running totals are a local running sum plus the exclusive prefix of per-chunk
  totals, which is a small table (one row per chunk).

``ordinal`` builds the dense ordinal itself for flat inputs in the same way, inside
cells of the order (such as weeks) that are split (into days, hours, ...) where more rows
lie in them than a chunk holds, so that a hot key is split across tasks as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import materialised

# Points per chunk: the largest window partition any ordered operator builds.
DEFAULT_CHUNK_SIZE = 1 << 20

CHUNK = "_chunk"
HALO = "_halo"


def _keys(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def chunk_of(order: str = "idx", chunk_size: int = DEFAULT_CHUNK_SIZE) -> Column:
    """0-based chunk of a 1-based dense ordinal."""
    return F.floor((F.col(order) - F.lit(1)) / F.lit(chunk_size)).cast("bigint")


# What a NULL key is replaced by while it is joined on; its flag tells it from a real one.
_BLANK = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}


def sealed_keys(df: DataFrame, keys: Sequence[str] | str) -> tuple[DataFrame, list[str]]:
    """NULL-free keys for equi-joins that must keep rows with NULL keys.

    Every nullable key becomes a value plus a flag column, replaced once before the
    first exchange: windows, aggregates and joins on the returned keys then share one
    partitioning, which null-safe comparisons would not. ``opened_keys`` restores them.
    """
    keys = _keys(keys)
    flags = {f"_null_{k}": F.col(k).isNull() for k in keys if df.schema[k].nullable}
    blanks = {}
    for k in keys:
        if df.schema[k].nullable:
            kind = df.schema[k].dataType
            blanks[k] = F.coalesce(F.col(k), F.lit(_BLANK.get(kind.simpleString(), 0)).cast(kind))
    return df.withColumns(flags).withColumns(blanks), [*keys, *flags]


def opened_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Undo ``sealed_keys`` (``keys`` as it returned them)."""
    flags = [k for k in keys if k.startswith("_null_")]
    values = {k[6:]: F.when(~F.col(k), F.col(k[6:])) for k in flags}
    return df.withColumns(values).drop(*flags) if flags else df


def time_levels(c: Column | str) -> list[Column]:
    """Ever finer cells of a timestamp for ``ordinal``: week, day, hour, minute, second, microsecond."""
    micros = F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))
    widths = (7 * 86_400, 86_400, 3600, 60, 1)
    return [*(F.floor(micros / F.lit(w * 1_000_000)) for w in widths), micros]


# Hot cells that are handed to all tasks; more of them meet the rows by a shuffle.
MOST_BROADCAST_CELLS = 1_000_000


def _bounded_cells(rows: DataFrame, keys: Sequence[str], levels: Sequence[str], bound: int) -> tuple[DataFrame, list[str]]:
    """(rows, cell columns): cells of the keys and the first level, split level by level where a cell
    has more than ``bound`` rows (until the levels end). Outside of split cells deeper columns are 0.

    The counts come from the key and level columns alone; a table has one row per split cell,
    so at most rows / ``bound`` a level.
    """
    splits = []
    if len(levels) > 1 and rows.count() > bound:
        scope = rows.select(*keys, *levels)
        for depth in range(1, len(levels)):
            cell = [*keys, *levels[:depth]]
            full = scope.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bound).select(*cell)
            full = materialised(full, "full-cells")
            n = full.count()
            if not n:
                break
            splits.append(F.broadcast(full) if n <= MOST_BROADCAST_CELLS else full)
            scope = scope.join(splits[-1], cell, "left_semi")
    for depth, full in enumerate(splits, 1):
        cell = [*keys, *levels[:depth]]
        rows = rows.join(full.withColumn("_split", F.lit(True)), cell, "left")
        deeper = F.when(F.col("_split"), F.col(levels[depth])).otherwise(F.lit(0))
        rows = rows.withColumn(levels[depth], deeper).drop("_split")
    used = list(levels[: len(splits) + 1])
    return rows.drop(*levels[len(used) :]), used


def ordinal(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    levels: Column | Sequence[Column],
    name: str = "idx",
    bound: int = DEFAULT_CHUNK_SIZE,
) -> DataFrame:
    """Dense 1-based ``row_number()`` per key, ordered by ``order`` (unique per key).

    ``levels`` are numbers that do not decrease along ``order``, each finer than the one
    before (``time_levels`` of the leading timestamp, then the id that breaks ties). Rows are
    numbered inside cells of (key, first level), split into cells of the next levels where
    more than ``bound`` rows lie, and the counts of the key's earlier cells are added: no
    window has more rows than ``bound`` as long as the last level tells rows apart. The rows
    are shuffled once, on key and cell; the counts come from a scan of the key and level
    columns alone, combined per task before they are shuffled, and join on the rows' own
    partitioning. NULL keys are numbered like others.
    """
    keys, order = _keys(keys), _keys(order)
    levels = [levels] if isinstance(levels, Column) else list(levels)
    names, cells = df.columns, [f"_cell{k}" for k in range(len(levels))]
    rows, safe = sealed_keys(df.withColumns(dict(zip(cells, levels))), keys)
    rows, cells = _bounded_cells(rows, safe, cells, bound)
    counts = rows.groupBy(*safe, *cells).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*safe).orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*safe, *cells, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*safe, *cells).orderBy(*order)
    numbered = (
        rows.withColumn("_local", F.row_number().over(inside))
        .join(offsets, [*safe, *cells])
        .withColumn(name, (F.col("_local") + F.col("_off")).cast("bigint"))
    )
    return opened_keys(numbered, safe).select(*names, name)


def with_halo(
    df: DataFrame,
    order: str = "idx",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    previous: bool = True,
    following: bool = False,
) -> DataFrame:
    """Assign each row to its chunk, plus halo copies for the neighbouring chunks.

    ``previous``: the last row of chunk c is copied into chunk c+1 (for ``lag``).
    ``following``: the first row of chunk c is copied into chunk c-1 (for ``lead``).
    Copies carry ``_halo = true``; at most two extra rows per chunk.
    """
    idx = F.col(order)
    home = chunk_of(order, chunk_size)
    placed = F.array(F.struct(home.alias("c"), F.lit(False).alias("h")))
    # when/concat rather than a lambda filter: stays inside whole-stage codegen
    if previous:
        copy = F.array(F.struct((home + 1).alias("c"), F.lit(True).alias("h")))
        placed = F.when(idx % chunk_size == 0, F.concat(placed, copy)).otherwise(placed)
    if following:
        copy = F.array(F.struct((home - 1).alias("c"), F.lit(True).alias("h")))
        placed = F.when((idx % chunk_size == 1 % chunk_size) & (home > 0), F.concat(placed, copy)).otherwise(placed)
    return df.select("*", F.inline(placed).alias(CHUNK, HALO))


def chunk_window(keys: Sequence[str] | str, order: str = "idx"):
    """Window over one chunk of one track, in point order."""
    return Window.partitionBy(*_keys(keys), CHUNK).orderBy(order)


def neighbours(
    df: DataFrame,
    keys: Sequence[str] | str,
    columns: Sequence[str],
    order: str = "idx",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    previous: bool = True,
    following: bool = False,
) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` (the adjacent point of the same track).

    Equivalent to ``lag(c)`` / ``lead(c)`` over ``partitionBy(keys).orderBy(order)``
    for a dense ``order``; the first (last) point of a track gets NULL. The result
    keeps ``_chunk`` and is hash-partitioned on ``(keys, _chunk)``.
    """
    w = chunk_window(keys, order)
    out = with_halo(df, order, chunk_size, previous, following)
    added = {}
    for c in columns:
        if previous:
            added[f"prev_{c}"] = F.lag(c).over(w)
        if following:
            added[f"next_{c}"] = F.lead(c).over(w)
    return out.withColumns(added).filter(~F.col(HALO)).drop(HALO)
