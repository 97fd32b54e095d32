"""Contiguous shards of near equal bytes from global prefix sums.

Rows are laid in ``doc_id`` order over range partitions and numbered while they are
written. Every partition adds up its bytes and rows, in chunks; the running totals over the
partitions (one row each) and over a partition's chunks turn a running sum inside a chunk
into a global one, and equal steps of the grand total cut the shards. No window has more
rows than a chunk, or than there are chunks in a partition.

Defined cases: a null text has no bytes (its size is the per-record overhead) and the
CRC of the empty text; null ids come first; equal ids are ordered by size and CRC, and
rows equal in all three are interchangeable (ties are split over range partitions like
other rows); a very long text may fill more than a shard, which then leaves shards without
rows; an empty table gives no rows; other columns are ignored. Groups of equal
texts have no part in this law: a shard is a range of the id order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import ranked, table

SHARDS = 24
OVERHEAD = 8  # bytes a record takes besides its text
_CHUNK_BITS = 12  # rows added up together: 4,096


def sized_rows(docs: DataFrame, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size and text_crc32 of every row."""
    return docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )


def assign_shards(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to shards - 1) and slot (gapless in its shard).

    A row goes to the shard that holds the middle of its byte range, so a shard differs
    from its target by less than the two rows on its edges.
    """
    # Rows are numbered while their sorted range partition is written, and added up in chunks.
    rows = ranked(sized_rows(docs, overhead), ["doc_id", "size", "text_crc32"], "shard-ranges")
    number = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumns(
        {"_part": F.shiftright("_at", 33), "_row": number, "_chunk": F.shiftright(number, _CHUNK_BITS)}
    )
    chunks = rows.groupBy("_part", "_chunk").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: the ungrouped windows and the broadcast are bounded
    # by the number of partitions.
    by_part = Window.orderBy("_part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = (
        chunks.groupBy("_part")
        .agg(F.sum("_bytes").alias("_bytes"), F.sum("_rows").alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
            F.sum("_bytes").over(everything).alias("_total"),
        )
    )
    earlier = Window.partitionBy("_part").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunks.select("_part", "_chunk", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_inner"))
        .join(F.broadcast(parts), "_part")
        .select("_part", "_chunk", (F.col("_byte0") + F.col("_inner")).alias("_byte0"), "_row0", "_total")
    )
    running = Window.partitionBy("_part", "_chunk").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumn("_end", F.sum("size").over(running))
        .join(offsets, ["_part", "_chunk"])
        .withColumn("_middle2", 2 * (F.col("_byte0") + F.col("_end")) - F.col("size"))
        .withColumn(
            "shard",
            F.least(F.expr(f"(_middle2 * {shards}) div (2 * _total)"), F.lit(shards - 1)).cast("int"),
        )
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_row0") + F.col("_row")).alias("_rank"))
    )
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).cast("long").alias("slot")
    )


def shard_manifest(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """``assign_shards`` with the law's name; this law has no growth rule (null)."""
    return assign_shards(docs, shards, overhead).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 contiguous shards of near equal bytes (law ``bytes``)."""
    return shard_manifest(table(spark, sf_dir, "documents"))
