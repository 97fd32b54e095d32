import pytest

from contrail.session import checkpoint_dir, checkpoint_root, configure, materialised


def test_configure_sets_result_settings(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_workers_find_the_package_wherever_the_driver_runs(spark):
    import os

    import contrail

    home = os.path.dirname(os.path.dirname(os.path.abspath(contrail.__file__)))
    configure(configure(spark))
    assert spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep).count(home) == 1


def test_checkpoint_dir_uses_the_session_folder(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    folder = checkpoint_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    if configured:  # Spark's per-application folder inside the configured one, used as is
        assert folder.replace("file:", "").startswith(configured.replace("file:", ""))
        assert checkpoint_root(spark) == configured
    df = spark.range(10).checkpoint(eager=True)
    assert df.count() == 10


class _Cluster:
    """A session of a cluster without a checkpoint folder."""

    class sparkContext:
        master = "spark://host:7077"
        getConf = staticmethod(dict)
        getCheckpointDir = staticmethod(lambda: None)

    class conf:
        get = staticmethod(lambda key, default: default)


def test_missing_checkpoint_folder_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Cluster)


def test_configure_leaves_the_overwrite_mode_alone(spark):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    configure(spark)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_materialised_reads_back_what_was_written(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "x long, y string")
    back = materialised(df, "test")
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert checkpoint_root(spark).replace("file:", "") in back.inputFiles()[0].replace("file:", "")
