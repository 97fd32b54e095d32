"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import checkpoint_root

# Fixed by the contracts: a word is a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder, one tree per application."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark).rstrip('/')}/contrail-llm/{app}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint, but columnar, so later reads are pruned.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order, label: str) -> DataFrame:
    """``df`` as a table in ``order``, with ``_at``: range partition in the upper 31 bits, row in it below.

    The row number is counted while the sorted partition is written: no window, and no task
    holds more than a range partition. Rows equal in ``order`` are split over partitions too.
    """
    parts = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie")
    placed = parts.sortWithinPartitions(*order, "_tie").drop("_tie")
    return stored(placed.withColumn("_at", F.monotonically_increasing_id()), label)


def word_count(text) -> "F.Column":
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def power_bits(n: int) -> int:
    """Bits b with 2**b about sqrt(n): groups and group sizes then grow alike."""
    return max(0, (max(1, n).bit_length() + 1) // 2)
