import datetime as dt

from pyspark.sql import functions as F

from contrail.operators import ingest as I


def d(s):
    return dt.date.fromisoformat(s)


def test_expected_days_inclusive_with_names(spark):
    spans = spark.createDataFrame([(1, d("2025-05-01"), d("2025-05-03")), (2, d("2025-08-29"), d("2025-08-29"))],
                                  "entity long, first_day date, last_day date")
    rows = sorted(I.expected_days(spans).collect())
    assert [(r.entity, str(r.day)) for r in rows] == [
        (1, "2025-05-01"), (1, "2025-05-02"), (1, "2025-05-03"), (2, "2025-08-29")]
    assert rows[0].file_name == "flight-track-2025-05-01.json" and rows[0].archive_path == "2025/05/01"


def test_full_reference_window_has_121_days(spark):
    spans = spark.createDataFrame([(1, d("2025-05-01"), d("2025-08-29"))], "entity long, first_day date, last_day date")
    assert I.expected_days(spans).count() == 121


def history(spark, rows):
    return spark.createDataFrame(
        [(e, d(day), st, src, dt.datetime.fromisoformat(ts)) for e, day, st, src, ts in rows],
        "entity long, day date, status string, source string, seen_at timestamp")


def days(spark, rows):
    return spark.createDataFrame([(e, d(day)) for e, day in rows], "entity long, day date")


def test_latest_look_wins_as_a_whole_and_ties_are_defined(spark):
    rows = [(1, "2025-05-01", "no_data", "primary", "2025-05-02 00:00:00"),
            (1, "2025-05-01", "has_data", "fallback", "2025-05-02 00:00:00"),
            (1, "2025-05-02", "has_data", "fallback", "2025-05-02 00:00:00"),
            (1, "2025-05-02", "no_data", "primary", "2025-05-03 00:00:00.000001"),
            (None, "2025-05-03", "has_data", "primary", "1960-01-01 00:00:00"),
            (2, "2025-05-04", "odd", "primary", "2025-05-03 00:00:00")]
    want = [("1", "2025-05-01", "has_data", "fallback"), ("1", "2025-05-02", "no_data", "primary"),
            ("2", "2025-05-04", None, "primary"), ("None", "2025-05-03", "has_data", "primary")]
    for order in (rows, rows[::-1]):
        got = I.latest_status(history(spark, order))
        assert sorted((str(r.entity), str(r.day), r.status, r.source) for r in got.collect()) == want
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    times = {str(r.day): str(r.seen_at) for r in got.collect()}
    assert times["2025-05-02"] == "2025-05-03 00:00:00.000001" and times["2025-05-03"] == "1960-01-01 00:00:00"


def test_an_update_replaces_the_entry_even_if_it_is_older(spark):
    old = history(spark, [(1, "2025-05-01", "has_data", "primary", "2025-06-02 00:00:00"),
                          (None, "2025-05-01", "has_data", "primary", "2025-06-02 00:00:00"),
                          (1, "2025-05-02", "has_data", "primary", "2025-05-03 00:00:00")])
    new = history(spark, [(1, "2025-05-01", "no_data", "fallback", "2025-05-01 00:00:00"),
                          (None, "2025-05-01", "no_data", "fallback", "2025-05-01 00:00:00")])
    got = sorted((str(r.entity), str(r.day), r.status, r.source) for r in I.upsert(old, new).collect())
    assert got == [("1", "2025-05-01", "no_data", "fallback"), ("1", "2025-05-02", "has_data", "primary"),
                   ("None", "2025-05-01", "no_data", "fallback")]


def test_a_run_over_all_kinds_of_days(spark):
    spans = spark.createDataFrame([(1, d("2025-05-01"), d("2025-05-06"))], "entity long, first_day date, last_day date")
    expected = I.expected_days(spans)
    latest = history(spark, [(1, "2025-05-01", "has_data", "primary", "2025-06-01 00:00:00"),
                             (1, "2025-05-02", "no_data", "primary", "2025-06-01 00:00:00"),
                             (1, "2025-05-03", "has_data", "primary", "2025-06-01 00:00:00"),
                             (1, "2025-05-04", "no_data", "primary", "2025-06-01 00:00:00")])
    # day 1 has its file; day 3 lost it; day 4 is cached as empty, yet its file is there
    present = days(spark, [(1, "2025-05-01"), (1, "2025-05-04"), (1, "2025-05-04"), (9, "2025-05-05")])
    classified = I.classify_days(expected, latest, present)
    outcome = {str(r.day)[-1]: r.outcome for r in classified.collect()}
    assert outcome == {"1": "skipped", "2": "cached_no_data", "3": "to_fetch", "4": "skipped", "5": "to_fetch",
                       "6": "to_fetch"}
    todo = I.missing_days(expected, latest, present).collect()
    assert sorted(str(r.day)[-1] for r in todo) == ["3", "5", "6"]
    ended = I.run_outcomes(classified, days(spark, [(1, "2025-05-03"), (1, "2025-05-05"), (1, "2025-05-01")]))
    counts = {r.outcome: r.days for r in I.outcome_counts(ended).collect()}
    assert counts == {"skipped": 2, "cached_no_data": 1, "downloaded": 2, "failed": 1, "total": 6}
    assert tuple(I.run_status(ended).first()) == (6, 1, True)
    assert tuple(I.run_status(ended.filter("outcome != 'failed'")).first()) == (5, 0, False)
    cache = I.upsert(latest, I.run_updates(ended, F.lit("2025-07-01").cast("timestamp")))
    assert {str(r.day)[-1]: r.status for r in cache.collect()} == {
        "1": "has_data", "2": "no_data", "3": "has_data", "4": "no_data", "5": "has_data", "6": "no_data"}


def test_choose_source_prefers_primary_and_fills_missing_columns(spark):
    primary = spark.createDataFrame([(1, d("2025-05-01"), 10)], "entity long, day date, n_points long")
    fallback = spark.createDataFrame([(1, d("2025-05-01"), "x"), (1, d("2025-05-02"), "y")],
                                     "entity long, day date, path string")
    out = sorted(I.choose_source(primary, fallback).collect(), key=lambda r: r.day)
    assert [(str(r.day), r.n_points, r.path) for r in out] == [("2025-05-01", 10, None), ("2025-05-02", None, "y")]


def test_valid_payload(spark):
    df = spark.createDataFrame([("",), (None,), ('{"icao": "a"}',), ('{"path": []}',)], "v string")
    got = [r[0] for r in df.select(I.valid_payload(F.col("v"), '"icao"')).collect()]
    assert got == [False, False, True, False]
