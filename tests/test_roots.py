"""Root objects of files and texts: byte ranges, strings, escapes, broken ends, both shapes."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from contrail.sources import traces


def document(rng, k):
    name = rng.choice(["a", "b } { c", 'q"}{"', "back\\slash\\", "tab\t{", "é}", "line\nend"]) + str(k)
    doc = {"icao": name, "timestamp": float(k), "trace": [[n, 1.5, 2.5, 3000] for n in range(rng.randrange(0, 30))]}
    if rng.random() < 0.3:
        doc["note"] = {"deep": [{"x": "}{\\"}, {}], "s": "{" * rng.randrange(9)}
    return json.dumps(doc, indent=rng.choice([None, None, 1]), ensure_ascii=rng.random() < 0.5)


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def names(docs):
    return sorted(r.icao for r in docs.select("icao").collect())


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_large_file_is_read_by_many_tasks(small_splits, scratch):
    spark, rng = small_splits, random.Random(1)
    texts = [document(rng, k) for k in range(300)]
    write(scratch, "flight-track-2025-05-01.json", "".join(t + rng.choice(["", "\n", " \r\n "]) for t in texts))
    write(scratch, "flight-track-2025-05-02.json", json.dumps(json.loads(texts[0])))
    scan = spark.read.option("lineSep", "}").text(os.path.join(scratch, "flight-track-2025-05-01.json"))
    assert scan.rdd.getNumPartitions() > 50
    good, bad = traces.split_quarantine(traces.read_traces(spark, scratch))
    want = [json.loads(t) for t in [*texts, texts[0]]]
    got = {(r.icao, r.source_file): r for r in good.collect()}
    assert len(got) == 301 and bad.collect() == []
    for doc, r in zip(want, [got[(d["icao"], "flight-track-2025-05-01.json")] for d in want[:300]]):
        assert r.timestamp == doc["timestamp"] and len(r.trace) == len(doc["trace"])
    assert ("flight-track-2025-05-02.json") in {f for _, f in got}


@pytest.mark.parametrize("seed", range(4))
def test_ends_of_files(small_splits, scratch, seed):
    spark, rng = small_splits, random.Random(seed)
    texts = [document(rng, k) for k in range(12)]
    body = "\n".join(texts)
    write(scratch, "flight-track-2025-05-01.json", body)
    write(scratch, "flight-track-2025-05-02.json", body + "\n\n")
    write(scratch, "flight-track-2025-05-03.json", body + '{"icao": "cut", "timestamp": 1.0')
    write(scratch, "flight-track-2025-05-04.json", body + '{"icao": "cut {", "trace": [[1, 2}')
    write(scratch, "flight-track-2025-05-05.json", body + " no json")
    write(scratch, "flight-track-2025-05-06.json", "")
    write(scratch, "flight-track-2025-05-07.json", " \n ")
    write(scratch, "flight-track-2025-05-08.json", "just text")
    good, bad = traces.split_quarantine(traces.read_traces(spark, scratch))
    assert names(good) == sorted(json.loads(t)["icao"] for t in texts * 5)
    assert sorted(r.source_file[-7:-5] for r in bad.collect()) == ["03", "04", "05", "08"]


def test_texts_in_a_column_give_the_same_roots(spark):
    rng = random.Random(5)
    texts = ["\n".join(document(rng, 100 * f + k) for k in range(rng.randrange(0, 40))) for f in range(12)]
    rows = spark.createDataFrame([("same.json", t) for t in texts] + [("x.json", None)], "source_file string, value string")
    good, bad = traces.split_quarantine(traces.parse_documents(rows))
    want = []
    for t in texts:
        at, decoder = 0, json.JSONDecoder()
        while at < len(t):
            doc, at = decoder.raw_decode(t, at)
            want.append(doc["icao"])
            at += len(t[at:]) - len(t[at:].lstrip())
    assert names(good) == sorted(want) and bad.collect() == []


def test_many_roots_of_one_text_stay_linear(spark):
    text = '{"icao": "a", "timestamp": 0.0, "trace": []}' * 60_000
    rows = spark.createDataFrame([("f.json", text)], "source_file string, value string")
    assert traces.parse_documents(rows).count() == 60_000


def test_one_scan_reads_both_shapes(spark, scratch):
    trace = {"icao": "aa", "timestamp": 1000.0, "trace": [[0, 1, 2, 3000], [5, 1, 2, "ground"]]}
    path = {"icao24": "bb", "startTime": 2000, "path": [[2000, 1, 2, 914.4, 0, False], [2007, 1, 2, 0, 0, True]]}
    both = dict(path, icao24="aa")  # the trace of the same day wins
    write(scratch, "flight-track-2025-05-01.json", json.dumps(trace) + json.dumps(path) + json.dumps(both))
    write(scratch, "flight-track-2025-05-02.json", json.dumps(dict(path, icao24="aa")) + '{"icao": "cut')
    good, aside = traces.day_documents(traces.read_documents(spark, scratch))
    points = sorted((r.entity, r.flight_date, r.idx, r.time_offset, r.altitude_ft) for r in traces.flatten(good).collect())
    assert points == [
        ("aa", "2025-05-01", 1, 0.0, 3000), ("aa", "2025-05-01", 2, 5.0, 0), ("aa", "2025-05-02", 1, 0.0, 3000),
        ("aa", "2025-05-02", 2, 7.0, 0), ("bb", "2025-05-01", 1, 0.0, 3000), ("bb", "2025-05-01", 2, 7.0, 0)]
    assert [(r.source_file, r.reason) for r in aside.collect()] == [("flight-track-2025-05-02.json", "malformed")]


def test_a_folder_stands_for_its_file(spark, scratch):
    for k, day in enumerate(["2025-05-01", "2025-05-02"]):
        doc = {"icao": f"v{k}", "timestamp": 0.0, "trace": [[0, 1, 2, 3]]}
        write(os.path.join(scratch, f"document=flight-track-{day}.json"), "part-0.txt", json.dumps(doc))
    points = traces.flatten(traces.read_traces(spark, scratch)).select("entity", "flight_date")
    assert sorted(map(tuple, points.collect())) == [("v0", "2025-05-01"), ("v1", "2025-05-02")]


def test_repeated_documents_are_set_aside_in_the_reading_path(spark, scratch):
    doc = json.dumps({"icao": "a", "timestamp": 0.0, "trace": [[0, 1, 2, 3]]})
    write(scratch, "flight-track-2025-05-01.json", doc + doc)
    write(scratch, "flight-track-2025-05-02.json", doc)
    good, aside = traces.day_documents(traces.read_traces(spark, scratch))
    assert [r.source_file for r in good.collect()] == ["flight-track-2025-05-02.json"]
    assert aside.filter(F.col("reason") == "repeated").count() == 2
