"""The keyed table: commits, untouched buckets, replays, broken writers, updates from itself."""

import os
import random

import pytest
from pyspark.sql import functions as F

from contrail.operators.ingest import upsert
from contrail.sources import keyed

SCHEMA = "entity string, day string, status string, source string, seen_at timestamp_ntz"


def looks(spark, rows):
    df = spark.createDataFrame([(*r[:4], str(r[4])) for r in rows], "entity string, day string, status string, source string, s string")
    return df.select("entity", "day", "status", "source", F.to_timestamp_ntz("s").alias("seen_at"))


def some(rng, n, entities=9):
    return [
        (rng.choice([None, *map(str, range(entities))]), f"2025-05-{rng.randrange(1, 29):02d}",
         rng.choice(["has_data", "no_data"]), rng.choice(["primary", "fallback"]), f"2025-06-01 00:00:{k % 60:02d}")
        for k in range(n)
    ]


def rows_of(df):
    return sorted(map(tuple, df.select("entity", "day", "status", "source", "seen_at").collect()), key=repr)


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet"))


def test_commits_are_upserts(spark, scratch):
    rng = random.Random(1)
    path = f"{scratch}/t"
    keyed.create_table(spark, path)
    assert keyed.read_table(spark, path, SCHEMA).count() == 0
    state = None
    for k, n in enumerate([300, 40, 1, 120]):
        new = looks(spark, some(rng, n))
        want = upsert(state if state is not None else new.limit(0), new).select(*new.columns)
        state = spark.createDataFrame(want.collect(), want.schema)
        assert keyed.upsert_table(new, path, buckets=8) == k + 1
        assert rows_of(keyed.read_table(spark, path, SCHEMA)) == rows_of(state)
    # The same updates once more change nothing but the version; no updates not even that.
    assert keyed.upsert_table(new, path, buckets=8) == 5
    assert rows_of(keyed.read_table(spark, path, SCHEMA)) == rows_of(state)
    assert keyed.upsert_table(new.limit(0), path, buckets=8) == 5


def test_only_touched_buckets_are_written(spark, scratch):
    path = f"{scratch}/t"
    keyed.create_table(spark, path)
    keyed.upsert_table(looks(spark, some(random.Random(2), 400)), path, buckets=16)
    before = files(path)
    keyed.upsert_table(looks(spark, [("1", "2025-05-03", "no_data", "primary", "2025-07-01 00:00:00")]), path, buckets=16)
    new = set(files(path)) - set(before)
    assert set(before) <= set(files(path)) and len({f.split("bucket=")[1].split("/")[0] for f in new}) == 1
    version, parts = keyed.current_buckets(spark, path)
    assert version == 2 and sorted(set(parts.values())) == [1, 2] and list(parts.values()).count(2) == 1


def test_a_table_is_updated_from_itself(spark, scratch):
    path = f"{scratch}/t"
    keyed.create_table(spark, path)
    keyed.upsert_table(looks(spark, some(random.Random(3), 200)), path, buckets=4)
    table = keyed.read_table(spark, path, SCHEMA)
    flipped = table.filter("status = 'no_data'").withColumn("status", F.lit("has_data"))
    keyed.upsert_table(flipped, path, buckets=4)
    back = keyed.read_table(spark, path, SCHEMA)
    assert back.count() == table.count() and back.filter("status = 'no_data'").isEmpty()


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    keyed.create_table(spark, path)
    keyed.upsert_table(looks(spark, some(random.Random(4), 200)), path, buckets=4)
    before = rows_of(keyed.read_table(spark, path, SCHEMA))
    # Data of the next version without its list, as after a crash.
    keyed.read_table(spark, path, SCHEMA).limit(3).write.parquet(f"{path}/data/bucket=0/version=2")
    assert rows_of(keyed.read_table(spark, path, SCHEMA)) == before
    new = looks(spark, some(random.Random(5), 50))
    want = rows_of(upsert(keyed.read_table(spark, path, SCHEMA), new))
    keyed.upsert_table(new, path, buckets=4)
    assert rows_of(keyed.read_table(spark, path, SCHEMA)) == want


def test_a_version_is_committed_once(spark, scratch):
    path = f"{scratch}/t"
    keyed.create_table(spark, path)
    with pytest.raises(Exception, match="(?i)already exists"):
        keyed.create_table(spark, path)
