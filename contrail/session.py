"""Session settings every contrail plan relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, not only speed: ISO text is printed with a
# literal 'Z', so the session zone must be UTC; ANSI makes bad casts visible.
_RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings for scale: runtime re-planning, partition coalescing and skew splits.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session (idempotent).

    Python workers also look for this package where the driver found it, so a driver that
    only extended its ``sys.path`` works too. On a cluster the package is installed or
    shipped like any other (the extra path does no harm there).
    """
    for key, value in {**_RESULT_CONF, **_SCALE_CONF}.items():
        spark.conf.set(key, value)
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, home) if p)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (stable across applications).

    Without the setting a session whose driver is also its only executor (master
    ``local`` or ``local[...]``: tests, laptops) gets a scratch folder once; on a
    cluster, where nobody else would see such a folder, a missing setting is an error.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-ckpt-"))
    return sc.getCheckpointDir()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder used by ``DataFrame.checkpoint()`` for lineage cuts.

    Spark sets it from ``spark.checkpoint.dir`` at startup (a per-application folder
    inside it); that is used as is. Only if the context has none, it is set to
    ``checkpoint_root``. The setting itself is never overridden.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        sc.setCheckpointDir(checkpoint_root(spark))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the checkpoint folder, in the folder of this application (which can be
    removed when it has ended)."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark).rstrip('/')}/contrail/{app}/{label}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint folder and read it back.

    For results that several branches of a plan read: columnar, so each branch prunes
    its columns, and safe against lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Local session used by tests, bench and tools; clusters pass their own."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName("contrail")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    for key, value in {**_RESULT_CONF, **_SCALE_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
