"""Nested daily trace documents -> typed point table.

A document is one JSON object per entity-day file ``flight-track-<yyyy-MM-dd>.json``::

    {"icao": "abc123", "timestamp": 1746057600.0,
     "trace": [[offset_s, lat, lng, altitude_ft | "ground" | null, ...], ...]}

Only the first four elements of a point are used. A file may hold any number of
documents one after another, of this shape or the fallback feed's. The reader passes an
explicit schema (no inference pass over the data); malformed documents are kept in
``_corrupt_record`` and split off into a quarantine frame instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions import element, json_int, strict_double
from contrail.functions.scalar import TRACK_FILE_DATE_PATTERN
from contrail.operators.ingest import choose_source
from contrail.session import materialised

CORRUPT = "_corrupt_record"

TRACE_SCHEMA = T.StructType(
    [
        T.StructField("icao", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("trace", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# The fallback feed carries a "path" array instead of "trace".
FALLBACK_SCHEMA = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("startTime", T.DoubleType()),
        T.StructField("path", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

POINT_COLUMNS = [
    "entity", "flight_date", "base_timestamp", "idx", "time_offset", "lat", "lng", "altitude_ft", "timestamp",
]


# Every document that the readers know, trace or fallback.
DOCUMENT_SCHEMA = T.StructType(
    [f for f in TRACE_SCHEMA if f.name != CORRUPT] + [f for f in FALLBACK_SCHEMA if f.name != CORRUPT]
    + [T.StructField(CORRUPT, T.StringType())]
)


# ---------------------------------------------------------------- root objects of texts
#
# A text is read as fragments that end at "}", so a large file is cut into byte ranges (its
# blocks) that different tasks read, wherever its line ends are. What a fragment does is a
# function of whether it begins inside a string: how many braces it opens, and where it ends.
# These functions are composed inside a block by a window, then over the blocks of a file (one
# row per block); a root ends where the depth comes back to 0.


def source_name(metadata: str = "_metadata") -> Column:
    """The document file that a text belongs to: the file's name, or its folder's if that is one."""
    name, path = F.col(f"{metadata}.file_name"), F.col(f"{metadata}.file_path")
    folder = F.nullif(F.regexp_extract(path, r"([^/=]+\.json)/[^/]*$", 1), F.lit(""))
    return F.when(name.endswith(".json"), name).otherwise(F.coalesce(folder, name))


def _file_fragments(texts: DataFrame) -> DataFrame:
    """Rows of a text scan cut at ``}`` -> fragments (see ``_cut_roots``)."""
    return texts.select(
        source_name().alias("source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_size").alias("_size"),
        "value",
    )


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _effects(fragments: DataFrame, *names: str) -> DataFrame:
    """Per fragment, beside ``names``: _odd (it changes between inside and outside of strings), _out
    and _in (what it adds to the depth when it begins outside or inside of one; its own ``}`` included)."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # no fragment ends in an escape: } takes none
    bare = lambda text: F.regexp_replace(text, r'"[^"]*("|\z)', "")
    depth = lambda text: _count(text, "{") - _count(text, "}")
    odd = _count(F.col("_plain"), '"') % 2
    return fragments.select(*names, plain.alias("_plain")).select(
        *names,
        odd.alias("_odd"),
        (depth(bare(F.col("_plain"))) - F.when(odd == 0, 1).otherwise(0)).alias("_out"),
        (depth(bare(F.concat(F.lit('"'), "_plain"))) - F.when(odd == 1, 1).otherwise(0)).alias("_in"),
    )


def _placed(fragments: DataFrame) -> DataFrame:
    """_id -> _file, _root (number of the root in its file), _alone (the fragment is all of it), _open
    (no ``}`` follows the fragment: the end of a file that does not end in one)."""
    inside = Window.partitionBy("_file", "_block").orderBy("_id")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    mode = F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2  # if the block begins outside
    sized = fragments.withColumn("_bytes", (F.octet_length("value") + 1).cast("long"))
    local = _effects(sized, "_file", "_block", "_id", "_size", "_bytes").withColumn("_mode", mode)
    local = materialised(
        local.select(
            "_file",
            "_block",
            "_id",
            "_size",
            "_odd",
            "_bytes",
            F.sum(F.when(F.col("_mode") == 0, F.col("_out")).otherwise(F.col("_in"))).over(upto).alias("_depth0"),
            F.sum(F.when(F.col("_mode") == 0, F.col("_in")).otherwise(F.col("_out"))).over(upto).alias("_depth1"),
        ),
        "fragment-depths",
    )
    # One row per block of a file.
    file = Window.partitionBy("_file").orderBy("_block")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    blocks = local.groupBy("_file", "_block").agg(
        (F.sum("_odd") % 2).alias("_odd"),
        F.max_by("_depth0", "_id").alias("_total0"),
        F.max_by("_depth1", "_id").alias("_total1"),
        F.max("_id").alias("_last"),
        F.sum("_bytes").alias("_bytes"),
        F.max("_size").alias("_size"),
    )
    blocks = blocks.withColumn("_begins", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2).withColumns(
        {
            # The text ends without the } that each fragment is counted with.
            "_ends_open": (F.sum("_bytes").over(whole) == F.col("_size") + 1)
            & (F.col("_block") == F.max("_block").over(whole)),
            "_total": F.when(F.col("_begins") == 0, F.col("_total0")).otherwise(F.col("_total1")),
        }
    )
    blocks = blocks.select(
        "_file",
        "_block",
        "_begins",
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"),
        F.when(F.col("_ends_open"), F.col("_last")).alias("_open_at"),
    )
    depth = F.col("_base") + F.when(F.col("_begins") == 0, F.col("_depth0")).otherwise(F.col("_depth1"))
    is_open = F.coalesce(F.col("_id") == F.col("_open_at"), F.lit(False))
    deep = local.join(blocks, ["_file", "_block"]).select(
        "_file", "_block", "_id", "_base", is_open.alias("_open"), (depth + is_open.cast("int")).alias("_depth")
    )
    closes = (F.col("_depth") <= 0) & ~F.col("_open")
    closed = materialised(
        deep.select(
            "_file",
            "_block",
            "_id",
            "_open",
            closes.alias("_closes"),
            (closes & (F.coalesce(F.lag("_depth").over(inside), F.col("_base")) <= 0)).alias("_alone"),
            F.coalesce(F.count_if(closes).over(before), F.lit(0)).alias("_local"),
        ),
        "root-ends",
    )
    ends = closed.groupBy("_file", "_block").agg(F.count_if("_closes").alias("_n"))
    ends = ends.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return closed.join(ends, ["_file", "_block"]).select(
        "_id", "_file", (F.col("_before") + F.col("_local")).alias("_root"), "_alone", "_open", "_block"
    )


def _cut_roots(fragments: DataFrame) -> DataFrame:
    """source_file, doc: the root objects of texts that are cut into fragments at ``}``.

    fragments: source_file, _file (one per text), _block (where the fragment's part of the text
    begins), _id (rising inside a block, unique), _size (bytes of the text), value. Most roots are
    one fragment and stay where they are; the fragments of the others meet by root.
    """
    place = _placed(fragments)
    pieces = fragments.select("source_file", "_id", "value").join(place, "_id")
    text = F.concat("value", F.when(F.col("_open"), F.lit("")).otherwise(F.lit("}")))
    alone = pieces.filter("_alone").select("source_file", text.alias("doc"))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_id", text.alias("t"))))
    others = pieces.filter("NOT _alone").groupBy("source_file", "_file", "_root").agg(parts.alias("_parts"))
    return _trimmed(alone.union(others.select("source_file", F.array_join("_parts.t", "").alias("doc"))))


def _trimmed(docs: DataFrame) -> DataFrame:
    """Documents without blanks before them; blanks alone are none."""
    return docs.withColumn("doc", F.regexp_replace("doc", r"^\s+", "")).filter(F.col("doc") != "")


def _cut_texts(pieces: DataFrame) -> DataFrame:
    """source_file, doc: as ``_cut_roots`` for texts that are rows of a table already.

    pieces: source_file, _file, pos, value. All windows run over one text, which is one row, so the
    pieces move once and are put together where they are.
    """
    text = Window.partitionBy("_file").orderBy("pos")
    upto = text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = text.rowsBetween(Window.unboundedPreceding, -1)
    cut = _effects(pieces, "source_file", "_file", "pos", "value")
    cut = cut.withColumns({"_mode": F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2, "_open": F.lead("pos").over(text).isNull()})
    change = F.when(F.col("_mode") == 0, F.col("_out")).otherwise(F.col("_in"))
    cut = cut.withColumn("_depth", F.sum(change).over(upto))
    closes = (F.col("_depth") <= 0) & ~F.col("_open")
    cut = cut.withColumn("_root", F.coalesce(F.count_if(closes).over(before), F.lit(0)))
    whole = F.concat("value", F.when(F.col("_open"), F.lit("")).otherwise(F.lit("}")))
    parts = F.array_sort(F.collect_list(F.struct("pos", whole.alias("t"))))
    roots = cut.groupBy("_file", "source_file", "_root").agg(parts.alias("_parts"))
    return _trimmed(roots.select("source_file", F.array_join("_parts.t", "").alias("doc")))


def _parsed(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Every root object by the schema; one that is not valid JSON keeps its text in ``_corrupt_record``."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = docs.select("source_file", F.from_json("doc", schema, opts).alias("d"))
    return parsed.select(*[F.col(f"d.{f.name}").alias(f.name) for f in schema.fields], "source_file")


def read_traces(spark: SparkSession, path: str, schema: T.StructType = TRACE_SCHEMA) -> DataFrame:
    """Scan all matching files (glob or folder), one row per root object.

    A file may hold any number of root objects, on one line or many, and is read by as many
    tasks as it has splits (``spark.sql.files.maxPartitionBytes``). Adds ``source_file``. What is not valid JSON
    yields rows with only ``_corrupt_record`` set; a root that never closes takes the rest of
    its file with it. Null traces and empty files give no points.
    """
    return parse_fragments(_file_fragments(spark.read.option("lineSep", "}").text(path)), schema)


def parse_documents(texts: DataFrame, text: str = "value", source_file: str = "source_file",
                    schema: T.StructType = TRACE_SCHEMA) -> DataFrame:
    """Whole texts in a column -> one row per root object (S2 for texts that are no files).

    The texts are written once, so that their row numbers stay what they are.
    """
    rows = texts.select(F.col(source_file).alias("source_file"), F.col(text).alias("value"))
    kept = materialised(rows.withColumn("_file", F.monotonically_increasing_id()), "texts")
    cut = kept.select("source_file", "_file", F.posexplode(F.split("value", r"\}")).alias("pos", "value"))
    return _parsed(_cut_texts(cut), schema)


def read_trace_text(spark: SparkSession, path: str, schema: T.StructType = TRACE_SCHEMA) -> DataFrame:
    """``read_traces`` by its older name."""
    return read_traces(spark, path, schema)


def stream_fragments(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder as a stream of fragments, for ``parse_fragments`` on each micro-batch."""
    return _file_fragments(spark.readStream.option("lineSep", "}").text(path))


def parse_fragments(fragments: DataFrame, schema: T.StructType) -> DataFrame:
    """Documents of whole files that are read as fragments (a scan or a micro-batch of a stream).

    The fragments are written once with their numbers: how a file is split into ranges depends
    on the cluster's size at the time, so a second scan might number them otherwise.
    """
    numbered = fragments.withColumn("_id", F.monotonically_increasing_id())
    return _parsed(_cut_roots(materialised(numbered, "fragments")), schema)


def routed(docs: DataFrame) -> DataFrame:
    """Documents of either shape (``DOCUMENT_SCHEMA``) as trace documents, one by one.

    A document with a trace (or without a path) is one already; one that has only a path is
    mapped. Where a vehicle's day has documents of both shapes, those with a trace win.
    """
    is_fallback = F.col("trace").isNull() & F.col("path").isNotNull()
    own = docs.filter(~is_fallback).select("icao", "timestamp", "trace", CORRUPT, "source_file")
    other = docs.filter(is_fallback).withColumn("icao24", F.coalesce("icao24", "icao"))
    return choose_source(own, fallback_as_traces(other), ["icao", "source_file"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One scan of all files, whichever shapes their documents have, as trace documents."""
    return routed(read_traces(spark, path, DOCUMENT_SCHEMA))


def marked_documents(docs: DataFrame) -> DataFrame:
    """Documents with the ``reason`` why one is not to be flattened (NULL for the others).

    ``malformed``: not JSON; ``repeated``: it shares vehicle and day with another, and the points
    of both would mix. Counted over the documents' keys and joined back on them.
    """
    good = F.col(CORRUPT).isNull()
    counts = docs.filter(good).groupBy(F.col("icao").alias("_icao"), F.col("source_file").alias("_file")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    found = docs.join(counts.filter("_n > 1"), F.expr("icao <=> _icao AND source_file <=> _file"), "left")
    reason = F.when(~good, F.lit("malformed")).when(F.col("_n").isNotNull(), F.lit("repeated"))
    return found.withColumn("reason", reason).drop("_icao", "_file", "_n")


def day_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents to be flattened, set aside with their ``reason``): the reading path of trace documents."""
    marked = marked_documents(docs)
    aside = marked.filter(F.col("reason").isNotNull())
    return marked.filter(F.col("reason").isNull()).drop(CORRUPT, "reason"), aside.select("source_file", "icao", CORRUPT, "reason")


def split_quarantine(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good documents, quarantined raw records).

    The quarantine keeps a data column next to ``_corrupt_record``: Spark rejects a
    raw-file query whose only data column is the corrupt-record column. For the same
    reason write (or collect) the quarantine rather than ``count()`` it directly: a
    count prunes the read down to the corrupt-record column.
    """
    bad = F.col(CORRUPT).isNotNull()
    return docs.filter(~bad).drop(CORRUPT), docs.filter(bad).select("source_file", "icao", CORRUPT)


def flatten(
    docs: DataFrame,
    entity: str = "icao",
    base: str = "timestamp",
    trace: str = "trace",
    source_file: str = "source_file",
    strict: bool = True,
) -> DataFrame:
    """One row per point, typed like the point table.

    * ``flight_date`` = the date in the file name (``''`` when the name has none);
    * ``idx`` = 1-based position in the trace (``posexplode`` + 1, dense per document);
    * offset, lat, lng = strict DOUBLE casts (a non-numeric value fails the job, as in
      the reference); with ``strict=False`` such values become NULL instead, so a
      single bad value in a large input can be filtered out with ``bad_points``
      rather than stopping the job;
    * ``altitude_ft`` = JSON-style INT of the 4th element, 0 when NULL or not numeric;
    * ``timestamp`` = ``base + offset`` seconds since the epoch.

    NULL or empty traces give no rows.
    """
    exploded = docs.select(
        F.col(entity).alias("entity"),
        F.regexp_extract(F.col(source_file), TRACK_FILE_DATE_PATTERN, 1).alias("flight_date"),
        F.col(base).alias("base_timestamp"),
        F.posexplode(trace).alias("pos", "point"),
    )
    to_double = strict_double if strict else (lambda c: c.try_cast("double"))
    offset = to_double(element("point", 1))
    return exploded.select(
        "entity",
        "flight_date",
        "base_timestamp",
        (F.col("pos") + 1).cast("bigint").alias("idx"),
        offset.alias("time_offset"),
        to_double(element("point", 2)).alias("lat"),
        to_double(element("point", 3)).alias("lng"),
        F.coalesce(json_int(element("point", 4)), F.lit(0)).alias("altitude_ft"),
        F.timestamp_seconds(F.col("base_timestamp") + offset).alias("timestamp"),
    )


def _unparsed() -> Column:
    return F.col("time_offset").isNull() | F.col("lat").isNull() | F.col("lng").isNull()


def bad_points(points: DataFrame) -> DataFrame:
    """Points of a lenient ``flatten`` whose offset or position did not parse."""
    return points.filter(_unparsed())


def good_points(points: DataFrame) -> DataFrame:
    """The other points of a lenient ``flatten``."""
    return points.filter(~_unparsed())


# Fixed value: metres per foot.
METRES_PER_FOOT = 0.3048


def fallback_as_traces(docs: DataFrame) -> DataFrame:
    """Map the fallback feed's documents onto trace documents.

    A row of ``path`` is [epoch seconds, latitude, longitude, barometric altitude in
    metres, true track, on ground]. Offsets become relative to ``startTime``, altitudes
    whole feet, and ``ground`` for a point on the ground.
    """

    def point(p):
        offset = (element(p, 1).cast("double") - F.col("startTime")).cast("string")
        feet = F.round(element(p, 4).try_cast("double") / F.lit(METRES_PER_FOOT)).cast("bigint").cast("string")
        altitude = F.when(element(p, 6) == "true", F.lit("ground")).otherwise(feet)
        return F.array(offset, element(p, 2), element(p, 3), altitude)

    return docs.select(
        F.col("icao24").alias("icao"),
        F.col("startTime").alias("timestamp"),
        F.transform("path", point).alias("trace"),
        F.col(CORRUPT),
        F.col("source_file"),
    )


def one_per_day(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that are alone on their vehicle and file name, the others).

    The points of a day are numbered within one document; two documents of one day would
    mix, so they are split off, to be looked at like the quarantine.
    """
    keys = ["icao", "source_file"]
    counts = docs.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    same = docs["icao"].eqNullSafe(counts["_icao"]) & docs["source_file"].eqNullSafe(counts["_source_file"])
    counted = docs.join(counts, same)
    alone = F.col("_n") == 1
    return counted.filter(alone).select(*docs.columns), counted.filter(~alone).select(*docs.columns)
