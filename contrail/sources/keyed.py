"""A keyed table that is updated in place: hash buckets, versions, one switch per commit.

Layout below ``path``::

    data/bucket=<b>/version=<v>/*.parquet    rows of a bucket as commit v left them
    commits/version=<v>/*.parquet            (bucket, data_version): which data make up version v

A commit writes the buckets that its updates touch, as new folders, and then its list of
buckets; a reader takes the newest list and the folders that it names. Nothing that a
reader may be reading is overwritten: the table can be updated from itself, a writer that
dies before the list is written leaves the table as it was, and its data are overwritten by
the next try. A list is written once; a second writer of the same version fails.

The work of an update is that of its buckets: the others stay where they are. Buckets are
hashes of the whole key, so neither a busy entity nor a busy day makes one large.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.ingest import upsert as replace_entries
from contrail.session import materialised

BUCKETS = 64


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


_COMMIT = "bucket int, data_version bigint"


def create_table(spark: SparkSession, path: str) -> None:
    """An empty table: a first list without buckets. An existing one is an error."""
    spark.createDataFrame([], _COMMIT).coalesce(1).write.mode("errorifexists").parquet(f"{path}/commits/version=0")


def current_buckets(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """(version, bucket -> data version) of the newest commit; (0, {}) without one.

    A list has a row per bucket, so at most ``buckets`` rows reach the driver.
    """
    commits = spark.read.schema(f"{_COMMIT}, version bigint").parquet(f"{path}/commits")
    newest = commits.agg(F.max("version")).first()[0]
    if newest is None:
        return 0, {}
    rows = commits.filter(F.col("version") == newest).collect()
    return newest, {r.bucket: r.data_version for r in rows}


def _read(spark: SparkSession, path: str, schema, parts: dict[int, int]) -> DataFrame:
    folders = [f"{path}/data/bucket={b}/version={v}" for b, v in sorted(parts.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of the newest version; none before the first commit."""
    return _read(spark, path, schema, current_buckets(spark, path)[1])


def upsert_table(
    updates: DataFrame,
    path: str,
    keys: Sequence[str] = ("entity", "day"),
    buckets: int = BUCKETS,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = replace_entries,
) -> int:
    """Commit ``updates`` over the newest version; returns the new version's number.

    ``merge(old, updates, keys)`` gives a bucket's new rows; by default an update replaces its
    key's entry. Committing the same updates again changes nothing but the version.
    """
    spark, keys = updates.sparkSession, list(keys)
    version, parts = current_buckets(spark, path)
    placed = materialised(updates.withColumn("_bucket", _bucket(keys, buckets)), "updates")
    touched = [r[0] for r in placed.select("_bucket").distinct().collect()]  # at most ``buckets``
    if not touched:
        return version
    old = _read(spark, path, updates.schema, {b: parts[b] for b in touched if b in parts})
    merged = merge(old, placed.drop("_bucket"), keys).select(*updates.columns)
    new = version + 1
    rows = merged.withColumn("bucket", _bucket(keys, buckets)).withColumn("version", F.lit(new))
    (
        rows.repartition(len(touched), "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "version")
        .parquet(f"{path}/data")
    )
    listed = [(b, v) for b, v in ({**parts, **{b: new for b in touched}}).items()]
    commit = spark.createDataFrame(listed, _COMMIT).coalesce(1)
    commit.write.mode("errorifexists").parquet(f"{path}/commits/version={new}")
    return new
