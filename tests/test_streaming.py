import json
import os
import tempfile

from pyspark.sql import functions as F

from contrail.operators.ingest import latest_status
from contrail.operators.legs import LegParams, TrackCols, leg_summary
from contrail.sources import fixtures
from contrail.sources.traces import TRACE_SCHEMA, day_documents, flatten, read_documents, read_traces, split_quarantine
from contrail.streaming.incremental import current_legs, process_batch, stream_traces


def write(folder, name, doc):
    with open(os.path.join(folder, name), "w") as f:
        f.write(doc if isinstance(doc, str) else json.dumps(doc))


def run(spark, src, root):
    q = stream_traces(spark, src, os.path.join(root, "points"), checkpoint=os.path.join(root, "ckpt"),
                      quarantine_path=os.path.join(root, "bad"), manifest_path=os.path.join(root, "manifest"))
    q.awaitTermination()


def test_each_file_once(spark):
    root = tempfile.mkdtemp(prefix="contrail-stream-")
    src, out = os.path.join(root, "in"), os.path.join(root, "points")
    os.makedirs(src)
    doc = {"icao": "a", "timestamp": 0.0, "trace": [[0, 1, 2, 3000], [1, 1, 2, 3000]]}
    write(src, "flight-track-2025-05-01.json", doc)
    run(spark, src, root)
    assert spark.read.parquet(out).count() == 2
    run(spark, src, root)  # nothing new
    assert spark.read.parquet(out).count() == 2
    write(src, "flight-track-2025-05-02.json", dict(doc, trace=[[0, 1, 2, 10]]))
    write(src, "flight-track-2025-05-03.json", '{"icao": "a", "trace": [[0, 1')
    run(spark, src, root)
    back = spark.read.parquet(out)
    assert back.count() == 3
    assert sorted(str(r.flight_date) for r in back.select("flight_date").distinct().collect()) == [
        "2025-05-01", "2025-05-02"]
    # the incremental result equals a batch read of the same files
    batch = flatten(split_quarantine(read_traces(spark, src))[0])
    cols = ["entity", "idx", "time_offset", "lat", "lng", "altitude_ft"]
    assert sorted(back.select(cols).collect()) == sorted(batch.select(cols).collect())
    # the malformed file is quarantined and cached as no_data; the others as has_data
    assert spark.read.parquet(os.path.join(root, "bad")).count() == 1
    latest = latest_status(spark.read.parquet(os.path.join(root, "manifest")))
    assert sorted((r.entity, str(r.day), r.status) for r in latest.collect()) == [
        ("a", "2025-05-01", "has_data"), ("a", "2025-05-02", "has_data"), ("a", "2025-05-03", "no_data")]


def test_replayed_batch_is_not_duplicated(spark):
    root = tempfile.mkdtemp(prefix="contrail-replay-")
    src, out = os.path.join(root, "in"), os.path.join(root, "points")
    os.makedirs(src)
    write(src, "flight-track-2025-05-01.json", {"icao": "a", "timestamp": 0.0, "trace": [[0, 1, 2, 3000]]})
    batch = (spark.read.schema(TRACE_SCHEMA).option("multiLine", True).json(src)
             .withColumn("source_file", F.col("_metadata.file_name")))
    process_batch(batch, 7, out)
    process_batch(batch, 7, out)  # the same batch again, as after a failure
    process_batch(batch, 8, out)
    assert spark.read.parquet(out).count() == 2


PARAMS = LegParams(min_seconds=0, min_points=1)


def track(icao, alts, base=0.0):
    return {"icao": icao, "timestamp": base, "trace": [[10 * k, -11.0, 40.5 + k / 100, a] for k, a in enumerate(alts)]}


def legs_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_legs_follow_the_touched_days(spark):
    """Two batches and a replay give the leg table of one batch run over what is there in the end."""
    root = tempfile.mkdtemp(prefix="contrail-legs-")
    first, second, final = (os.path.join(root, n) for n in ("first", "second", "final"))
    for folder in (first, second, final):
        os.makedirs(folder)
    up = [0, 3000, 3100, 0, 4000, 4100]
    day = lambda d: f"flight-track-2025-05-0{d}.json"
    write(first, day(1), json.dumps(track("a", up[:3])) + json.dumps(track("b", up)))
    write(first, day(2), track("a", up))
    write(first, day(3), track("c", up))
    write(first, day(4), json.dumps(track("d", up)) * 2)  # set aside
    write(first, "notes.json", track("n", up))
    write(second, day(1), track("a", up))  # a longer document of the same day
    write(second, day(3), track("c", [0, 10, 20]))  # the day loses its only legs
    write(second, day(4), track("d", up))
    write(second, day(5), track("e", up))
    for name, text in ((day(1), json.dumps(track("a", up)) + json.dumps(track("b", up))), (day(2), track("a", up)),
                       (day(3), track("c", [0, 10, 20])), (day(4), track("d", up)), (day(5), track("e", up)),
                       ("notes.json", track("n", up))):
        write(final, name, text)
    points, legs = os.path.join(root, "points"), os.path.join(root, "legs")

    def batch(folder, number):
        process_batch(read_documents(spark, folder), number, points, os.path.join(root, "aside"), None, legs, PARAMS)

    want = legs_of(leg_summary(flatten(day_documents(read_documents(spark, final))[0]), TrackCols(), PARAMS))
    batch(first, 0)
    early = legs_of(current_legs(spark, legs))
    batch(first, 0)  # replayed
    assert legs_of(current_legs(spark, legs)) == early != want
    batch(second, 1)
    assert legs_of(current_legs(spark, legs)) == want
    batch(second, 1)
    assert legs_of(current_legs(spark, legs)) == want
    days = spark.read.parquet(os.path.join(legs, "days")).filter("ingest_batch = 1")
    assert sorted(r.flight_date[-1] for r in days.collect()) == ["1", "3", "4", "5"]  # day 2 was not computed anew


def test_the_stream_keeps_legs_and_reads_both_shapes(spark):
    root = tempfile.mkdtemp(prefix="contrail-stream-")
    src = os.path.join(root, "in")
    os.makedirs(src)

    def run_legs():
        stream_traces(spark, src, os.path.join(root, "points"), os.path.join(root, "ckpt"), os.path.join(root, "aside"),
                      os.path.join(root, "manifest"), os.path.join(root, "legs"), PARAMS).awaitTermination()

    path = {"icao24": "f", "startTime": 0, "path": [[10 * k, -11.0, 40.5, 1000.0, 0, False] for k in range(3)]}
    write(src, "flight-track-2025-05-01.json", json.dumps(track("a", [3000] * 3)) + json.dumps(path))
    run_legs()
    write(src, "flight-track-2025-05-02.json", track("a", [3000] * 4))
    run_legs()
    run_legs()
    legs = current_legs(spark, os.path.join(root, "legs"))
    assert sorted((r.entity, r.flight_date) for r in legs.collect()) == [
        ("a", "2025-05-01"), ("a", "2025-05-02"), ("f", "2025-05-01")]


def test_bad_points_do_not_stop_the_run(spark):
    root = tempfile.mkdtemp(prefix="contrail-bad-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    doc = {"icao": "a", "timestamp": 0.0, "trace": [[0, 1, 2, 3000], ["x", 1, 2, 3000], [2, None, 2, 3000], [3, 1, 2, 3000]]}
    write(src, "flight-track-2025-05-01.json", doc)
    docs = read_documents(spark, src)
    points, bad = os.path.join(root, "points"), os.path.join(root, "bad")
    for _ in range(2):
        process_batch(docs, 0, points, bad_points_path=bad)
    assert sorted(r.idx for r in spark.read.parquet(points).collect()) == [1, 4]
    assert sorted(r.idx for r in spark.read.parquet(bad).collect()) == [2, 3]


def test_arriving_documents_are_put_together_once(spark):
    """Both micro-batches read the written documents; neither gathers the events again."""
    root = tempfile.mkdtemp(prefix="contrail-arriving-")
    events = spark.range(60).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 05:00:00' + make_interval(0, 0, 0, int(id % 3), int(id)) AS ts",
        "if(id % 19 = 0, null, id % 14) AS user_id", "'view' AS event_type", "id * 1.5D AS value", "'' AS props")
    events.union(events.limit(5)).write.parquet(os.path.join(root, "events.parquet"))
    docs = fixtures.trace_shaped(spark, root)
    early, late = fixtures.arriving_documents(spark, root)
    for batch in (early, late):
        assert "Aggregate" not in batch._jdf.queryExecution().optimizedPlan().toString()
    text = lambda df: sorted(str(r) for r in df.collect())
    assert text(late) == text(docs.filter("user_id % 2 = 0 OR user_id % 10 = 3").drop("user_id"))
    halved = docs.withColumn("trace", F.expr("if(user_id % 2 = 0, slice(trace, 1, size(trace) div 2), trace)"))
    assert text(early) == text(halved.union(docs.filter("user_id % 10 = 3")).drop("user_id"))
