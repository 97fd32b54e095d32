"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents are shuffled (by a keyed hash) and laid end to end, twice, as
a stream of words that is cut into blocks of equally many words. A source needs as many
slots as its target has blocks, the last one cut at the target, so every source takes its
target to the word, however small it is. The mix is a row of slots: slot i has the
golden-ratio point frac(i * phi), the source whose interval of the cumulative needs holds
the point owns the slot, and the k-th slot of a source takes block k of its stream until
the source has what it needs. Any prefix of the slots is therefore close to the target
mix, and no document is taken more than twice. The row is twice as long as the needs,
and is doubled as long as a source lacks slots; blocks grow with the corpus beyond
``_MOST_SLOTS``, which moves the order of the mix only.

Slots are ranked per source by a rank inside chunks of slots plus the counts of earlier
chunks; offsets inside a source come from hash buckets plus the totals of earlier
buckets. A source that holds a third of all rows is spread over many tasks by both, and
slots meet blocks on (source, block), which is unique on the slots' side.

Defined cases: a null or blank text has no words and is never taken (taken 0); a null
source is a source of its own, last in order; a null doc_id is an id like any other;
rows equal in id, source and size are interchangeable and taken as separate copies;
without words all targets are 0; a very long text lies in as many blocks as it fills and may
be taken in part; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import power_bits, stored, table, word_count

WEIGHTS = (5, 2, 1)  # by the sources' code point order, repeating
SHARE = 1.5  # words of the mix over words of the input
MOST = 2  # a source's target over its size at most; also the passes over its stream
BLOCK = 64  # words of a slot
SEED = "mix"

_POINTS = 1 << 32  # points are k / 2**32
_GOLDEN = 2654435769  # floor(2**32 / golden ratio), odd: i * it mod 2**32 is a permutation
_PERIOD = 1 << 31  # i is taken modulo this, so the product stays below 2**63
_CELLS = 4096  # equal cells of the unit interval on which points meet intervals
_CHUNK = 1 << 16  # slots ranked together
_MOST_SLOTS = 1 << 28  # needed of all sources; every need then spans several points


def source_targets(
    sizes: DataFrame, multiple: float = SHARE, most: int = MOST, weights=WEIGHTS, block: int = BLOCK
) -> DataFrame:
    """source, source_size -> plus src (ordinal), weight, target, quota (its words), need (its blocks),
    lo, hi (of 2**32 points, by the needs).

    Sharing by weight under the cap ``most * size``: with the sources in order of cap /
    weight, the level that all uncapped sources reach is the largest of (rest of the
    total) / (rest of the weights). One row per source; the windows run over that table.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("_ratio", "src")
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    by_src = Window.orderBy("src")
    upto = by_src.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = sizes.withColumn("src", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("src") % len(weights) + 1)
    )
    capped = named.withColumn("_cap", F.col("source_size") * most).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    levels = capped.withColumn("_all", F.sum("source_size").over(whole) * F.lit(float(multiple))).withColumn(
        "_level",
        (F.col("_all") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0))) / F.sum("weight").over(rest),
    )
    targets = levels.withColumn("_top", F.max("_level").over(whole)).withColumn(
        "target", F.least(F.col("_cap").cast("double"), F.col("_top") * F.col("weight"))
    )
    needs = targets.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long")).withColumn(
        "need", F.expr(f"(quota + {block - 1}) div {block}")
    )
    whole_row = F.greatest(F.sum("need").over(by_src.rowsBetween(*_WHOLE)), F.lit(1))
    cut = needs.withColumn("_row", whole_row).withColumn("_upto", F.sum("need").over(upto))
    cut = cut.withColumn("_edge", F.expr(f"(_upto * {_POINTS}) div _row"))
    return cut.select(
        "source",
        "source_size",
        "src",
        "weight",
        "target",
        "quota",
        "need",
        F.lag("_edge", 1, 0).over(by_src).alias("lo"),
        F.col("_edge").alias("hi"),
    )


_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """slot, src, rank, need: the owner of every slot, its number among the owner's slots, and the
    owner's need."""
    spark = targets.sparkSession
    width = _POINTS // _CELLS
    points = spark.range(slots).select(
        F.col("id").alias("slot"),
        ((F.col("id") % _PERIOD) * _GOLDEN % _POINTS).alias("point"),
    )
    points = points.withColumn("cell", F.col("point").bitwiseAND(F.lit(-width)) / width)
    points = points.withColumn("cell", F.col("cell").cast("long"))
    intervals = targets.filter(F.col("hi") > F.col("lo")).select(
        "src", "need", "lo", "hi", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})")).alias("cell")
    )
    owned = (
        points.join(intervals, "cell")
        .filter((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
        .select("slot", "src", "need", F.expr(f"slot div {_CHUNK}").alias("chunk"))
    )
    counts = owned.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("src", "chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("src", "chunk").orderBy("slot")
    return (
        owned.withColumn("_at", F.row_number().over(inside) - 1)
        .join(firsts, ["src", "chunk"])
        .select("slot", "src", (F.col("_first") + F.col("_at")).alias("rank"), "need")
    )


def full_schedule(targets: DataFrame) -> DataFrame:
    """slot, src, rank of the slots that the sources need: enough points for every source."""
    needed = targets.agg(F.sum("need")).first()[0] or 0
    slots = 2 * needed
    while True:
        plan = stored(schedule(targets, slots).filter("rank < need").select("slot", "src", "rank"), "mix-schedule")
        if plan.count() >= needed or slots >= _PERIOD:
            return plan
        slots = min(2 * slots, _PERIOD)


def streams(rows: DataFrame, targets: DataFrame, n_rows: int, seed: str = SEED) -> DataFrame:
    """Rows (doc_id, source, size) with src, source_size, target, start in the shuffled source and copy.

    Equal rows are one row with a count until the end, so a repeated id is combined
    before the shuffle; their copies are numbered, since those without words start alike. Buckets are ranges of the hash: the order does not depend on
    how many there are.
    """
    bits = min(24, power_bits(n_rows))
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    units = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("_copies"))
    units = units.withColumn("_key", key).withColumn(
        "_bucket", F.shiftright(F.conv(F.substring("_key", 1, 6), 16, 10).cast("int"), 24 - bits)
    )
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        units.groupBy("source", "_bucket")
        .agg(F.sum(F.col("size") * F.col("_copies")).alias("_words"))
        .select("source", "_bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start"))
    )
    named = buckets.alias("b").join(targets.alias("t"), F.expr("b.source <=> t.source"))
    named = named.select(
        F.col("b.source").alias("_source"), F.col("_bucket").alias("_b"), "_start", "src", "source_size", "target", "quota"
    )
    inside = (
        Window.partitionBy("source", "_bucket")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        units.withColumn("_in", F.coalesce(F.sum(F.col("size") * F.col("_copies")).over(inside), F.lit(0)))
        .join(named, F.expr("source <=> _source AND _bucket = _b"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        .select(
            "doc_id",
            "source",
            "size",
            "src",
            "source_size",
            "target",
            "quota",
            (F.col("_start") + F.col("_in") + F.col("_copy") * F.col("size")).alias("start"),
            F.col("_copy").alias("copy"),
        )
    )


def mix(
    docs: DataFrame, share: float = SHARE, most: int = MOST, block: int = BLOCK, weights=WEIGHTS, seed: str = SEED
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``."""
    rows = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = rows.agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).first()
    block = max(block, -int(-(float(whole.words or 0) * share) // _MOST_SLOTS))
    targets = stored(source_targets(sizes, share, most, weights, block), "mix-targets")
    plan = full_schedule(targets)
    # Both passes of a document over its source's stream, cut at the block edges.
    laid = streams(rows, targets, whole.n, seed).withColumn(
        "_pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    )
    laid = laid.withColumn("_from", F.col("start") + F.col("_pass") * F.col("source_size"))
    pieces = laid.withColumn(
        "rank",
        F.explode(
            F.expr(
                f"CASE WHEN size = 0 THEN array(-1L) ELSE sequence(_from div {block}, (_from + size - 1) div {block}) END"
            )
        ),
    ).withColumn(
        "_words",
        F.greatest(
            F.least(F.col("_from") + F.col("size"), (F.col("rank") + 1) * block, F.col("quota"))
            - F.greatest(F.col("_from"), F.col("rank") * block),
            F.lit(0),
        ),
    )
    return (
        pieces.join(plan, ["src", "rank"], "left")
        .groupBy("doc_id", "source", "size", "source_size", "target", "start", "copy")
        .agg(F.sum(F.when(F.col("slot").isNotNull(), F.col("_words")).otherwise(0)).cast("long").alias("taken"))
        .drop("start", "copy")
    )


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it, rounded to whole texts.

    A document of which the mix takes less than half its words is left out, one taken
    1.5 times or more comes twice; documents without words are kept once.
    """
    taken = mix(docs, **params)
    copies = taken.groupBy("doc_id", "source", "size").agg(F.avg("taken").alias("_taken"))
    copies = copies.select(
        F.col("doc_id").alias("_m_id"),
        F.col("source").alias("_m_source"),
        F.col("size").alias("_m_size"),
        F.expr("CASE WHEN size = 0 THEN 1 ELSE int(floor(_taken / size + 0.5)) END").alias("_m_copies"),
    ).filter("_m_copies > 0")
    given = docs.withColumn("_m_words", word_count(F.col("text")))
    return (
        given.join(copies, F.expr("doc_id <=> _m_id AND source <=> _m_source AND _m_words = _m_size"))
        .withColumn("_m_copy", F.explode(F.sequence(F.lit(1), F.col("_m_copies"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op2_golden_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 5:2:1 source weights at 150 % of their words."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# Slots of a source are its ranks 0, 1, ... without gaps up to its need, so the mix takes
# the first words of its doubled stream, up to its target: the SQL counts them directly.
ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS src
  FROM d GROUP BY source
), w AS (
  SELECT *, {list(WEIGHTS)}[src % {len(WEIGHTS)} + 1] AS weight, source_size * {MOST} AS cap,
         sum(source_size) OVER () * {SHARE}::DOUBLE AS words
  FROM s
), l AS (
  SELECT *, (words - coalesce(sum(cap) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (SELECT *, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM l),
i AS (SELECT *, floor(target + 0.5)::BIGINT AS upto FROM t),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(start + size, upto) - least(start, upto))
        + greatest(0, least(start + source_size + size, upto) - least(start + source_size, upto)))::BIGINT AS taken
FROM laid JOIN i ON laid.source IS NOT DISTINCT FROM i.source
"""
