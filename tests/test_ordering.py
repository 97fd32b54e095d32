import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.operators.ordering import _bounded_cells, neighbours, opened_keys, ordinal, sealed_keys, time_levels


def hot_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)  # key 0 holds a third of all rows
        rows.append((key, rnd.randint(0, 10**6), i, rnd.randint(0, 5000)))
    return rows


def test_ordinal_equals_row_number_with_hot_and_null_keys(spark):
    rows = [(None if r[0] % 5 == 3 else r[0], *r[1:]) for r in hot_rows()]
    df = spark.createDataFrame(rows, "k long, ts long, id long, v int")
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.withColumn("idx", F.row_number().over(w))
    want = sorted(want.select("k", "ts", "id", "v", "idx").collect(), key=str)
    for width in (1_000, 100_000, 10**7):  # many buckets, a few, one
        got = ordinal(df, ["k"], ["ts", "id"], F.floor(F.col("ts") / width), "idx")
        assert sorted(got.select("k", "ts", "id", "v", "idx").collect(), key=str) == want


def test_a_track_within_an_hour_is_split_until_cells_are_bounded(spark):
    """All of a hot key lies in one hour, a part of it in one microsecond; ids break the ties."""
    rnd = random.Random(3)
    rows = [(k % 4 and 1 or None, 1_700_000_000_000_000 + rnd.choice([0, rnd.randrange(3_600_000_000)]), k) for k in range(2500)]
    rows += [(2, rnd.randrange(10**16), 10_000 + k) for k in range(300)]
    df = spark.createDataFrame(rows, "k long, us long, id long").withColumn("ts", F.timestamp_micros("us"))
    levels = [*time_levels("ts"), F.floor(F.col("id") / 64), F.col("id")]
    want = df.withColumn("idx", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    want = sorted(map(tuple, want.select("k", "id", "idx").collect()), key=str)
    for bound in (16, 200, 1 << 20):
        got = ordinal(df, ["k"], ["ts", "id"], levels, "idx", bound)
        assert sorted(map(tuple, got.select("k", "id", "idx").collect()), key=str) == want
        names = [f"_cell{n}" for n in range(len(levels))]
        sealed, keys = sealed_keys(df.withColumns(dict(zip(names, levels))), ["k"])
        cells, used = _bounded_cells(sealed, keys, names, bound)
        assert max(r["count"] for r in cells.groupBy(*keys, *used).count().collect()) <= bound
        assert (len(used) == 1) == (bound > 2800)


def test_ordinal_shuffles_the_rows_once_and_needs_no_checkpoint(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(hot_rows(), "k long, ts long, id long, v int")
        got = ordinal(df, ["k"], ["ts", "id"], F.floor(F.col("ts") / 1000), "idx")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange of the rows; the others carry one row per key and bucket (counts, running sum, offsets)
    assert plan.count("Exchange hashpartitioning") == 4 and "rangepartitioning" not in plan
    assert plan.count("partial_count(1)") == 1 and "RDDScan" not in plan


@pytest.mark.parametrize("kind", ["string", "int", "double", "date", "boolean", "timestamp", "decimal(9,2)"])
def test_sealed_keys_restore_nulls_of_any_type(spark, kind):
    df = spark.range(3).select(F.when(F.col("id") > 0, F.lit(None)).cast(kind).alias("k"), "id")
    sealed, keys = sealed_keys(df, "k")
    assert sealed.filter("k IS NULL").isEmpty() and keys == ["k", "_null_k"]
    back = opened_keys(sealed, keys)
    assert back.columns == df.columns and back.dtypes == df.dtypes and back.filter("k IS NULL").count() == 3


@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 64, 1 << 20])
def test_neighbours_equal_lag_lead(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(k, i + 1, rnd.randint(-5, 5)) for k in range(4) for i in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "k long, idx long, v int")
    got = neighbours(df, ["k"], ["v"], "idx", chunk, previous=True, following=True)
    w = Window.partitionBy("k").orderBy("idx")
    want = df.select("k", "idx", "v", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"))
    assert sorted(got.select("k", "idx", "v", "prev_v", "next_v").collect()) == sorted(want.collect())
