"""Leg segmentation: hand-made edge cases and chunk-size invariance against a
plain Python implementation of the reference semantics."""

import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import legs as L
from contrail.operators.places import TAKEOFF_PLACES

COLS = L.TrackCols(keys=("entity", "flight_date"), time="time_offset", base="base_timestamp")
SCHEMA = ("entity string, flight_date string, base_timestamp double, idx long, time_offset double, "
          "lat double, lng double, altitude_ft int")


def points(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def track(alts, entity="a", day="2025-05-01", step=60.0, lat=-11.0, lng=40.5, base=1746057600.0):
    return [(entity, day, base, i + 1, i * step, lat + i * 1e-3, lng, a) for i, a in enumerate(alts)]


def brute_force_legs(rows, below=2000):
    """The reference's numbering: LAG default 1, takeoff edges, running count."""
    by_track = {}
    for r in rows:
        by_track.setdefault((r[0], r[1]), []).append(r)
    out = {}
    for key, pts in by_track.items():
        pts.sort(key=lambda r: r[3])
        prev, leg = 1, 0
        for r in pts:
            g = 1 if r[7] < below else 0
            if prev == 1 and g == 0:
                leg += 1
            prev = g
            if g == 0:
                out[(key[0], key[1], r[3])] = leg
    return out


def test_first_point_airborne_is_a_takeoff(spark):
    df = L.number_legs(points(spark, track([3000, 3000, 100, 3000])), COLS)
    got = sorted((r.idx, r.flight_num) for r in df.collect())
    assert got == [(1, 1), (2, 1), (4, 2)]


def test_missing_altitude_splits_leg(spark):
    df = L.number_legs(points(spark, track([100, 3000, 3000, 0, 3000, 3000])), COLS)
    assert sorted((r.idx, r.flight_num) for r in df.collect()) == [(2, 1), (3, 1), (5, 2), (6, 2)]


def test_leg_crossing_midnight_becomes_two_legs(spark):
    rows = track([3000] * 3, day="2025-05-01") + track([3000] * 3, day="2025-05-02")
    df = L.number_legs(points(spark, rows), COLS)
    assert sorted((r.flight_date, r.flight_num) for r in df.collect()) == [
        ("2025-05-01", 1)] * 3 + [("2025-05-02", 1)] * 3


def test_significance_is_strict(spark):
    # 51 airborne points 18 s apart = exactly 900 s: excluded; 52 points: 918 s, kept
    rows = track([100] + [3000] * 51 + [100], step=18.0) + track([100] + [3000] * 52, entity="b", step=18.0)
    df = L.leg_summary(points(spark, rows), COLS)
    assert [r.entity for r in df.collect()] == ["b"]
    rows = track([100] + [3000] * 50 + [100], step=100.0)  # 50 points: excluded
    assert L.leg_summary(points(spark, rows), COLS).count() == 0


def test_summary_values_and_labels(spark):
    alts = [100] + [3000] * 60 + [100]
    rows = [r[:5] + (-25.9 + 0.1, 32.57, r[7]) for r in track(alts)]
    rows[-2] = rows[-2][:5] + (-10.82, 40.53, 3000)  # landing near Afungi at 3000 ft: guard fails
    r = L.leg_summary(points(spark, rows), COLS).first()
    assert r.takeoff_location == "Maputo" and r.landing_location == "Unknown"
    assert r.flight_num == 1 and r.takeoff_altitude_ft == 3000
    assert r.takeoff_timestamp == "2025-05-01T00:01:00Z" and r.flight_duration_minutes == 59.0


def test_point_on_box_edge_is_unknown(spark):
    from contrail.operators.places import label
    df = spark.createDataFrame([(-25.4, 32.57), (-11.0, 40.0), (-25.9, 32.57)], "lat double, lng double")
    got = [r[0] for r in df.select(label("lat", "lng", None, TAKEOFF_PLACES)).collect()]
    assert got == ["Unknown", "Afungi", "Maputo"]


def random_rows(seed, n_tracks=5):
    rnd = random.Random(seed)
    rows = []
    for t in range(n_tracks):
        n = rnd.randint(1, 80)
        alts = [rnd.choice([0, 500, 1999, 2000, 2500, 9000]) for _ in range(n)]
        rows += track(alts, entity=f"e{t % 3}", day=f"2025-05-0{1 + t // 3}")
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_numbering_matches_brute_force_for_any_chunk(spark, chunk, seed):
    rows = random_rows(seed)
    df = L.number_legs(points(spark, rows), COLS, chunk_size=chunk)
    got = {(r.entity, r.flight_date, r.idx): r.flight_num for r in df.collect()}
    assert got == brute_force_legs(rows)


@pytest.mark.parametrize("chunk", [1, 3, 7])
def test_summary_is_chunk_invariant(spark, chunk):
    rows = random_rows(3, n_tracks=6)
    params = L.LegParams(min_seconds=0, min_points=0)
    full = L.leg_summary(points(spark, rows), COLS, params)
    chunked = L.leg_summary(points(spark, rows), COLS, L.LegParams(min_seconds=0, min_points=0, chunk_size=chunk))
    assert sorted(full.collect()) == sorted(chunked.collect())


def test_properties(spark):
    rows = random_rows(4, n_tracks=6)
    pts = points(spark, rows)
    legs = L.number_legs(pts, COLS, chunk_size=3)
    ext = L.summarise_points(pts, COLS, L.LegParams(chunk_size=3))
    # sum of leg points = airborne points
    assert ext.agg(F.sum("num_points")).first()[0] == pts.filter("altitude_ft >= 2000").count()
    # legs are numbered 1..k without gaps per track
    for r in legs.groupBy("entity", "flight_date").agg(
        F.min("flight_num").alias("lo"), F.max("flight_num").alias("hi"),
        F.countDistinct("flight_num").alias("n")).collect():
        assert r.lo == 1 and r.hi == r.n
    assert ext.filter("takeoff_time > landing_time").count() == 0


def test_shuffled_input_gives_same_summary(spark):
    rows = random_rows(5)
    a = L.leg_summary(points(spark, rows), COLS, L.LegParams(min_seconds=0, min_points=0))
    random.Random(0).shuffle(rows)
    b = L.leg_summary(points(spark, rows).repartition(3), COLS, L.LegParams(min_seconds=0, min_points=0))
    assert sorted(a.collect()) == sorted(b.collect())


def test_join_and_window_forms_agree(spark):
    rows = random_rows(6)
    pts = points(spark, rows)
    one = L.summarise_points(pts, COLS, L.LegParams(chunk_size=4)).select(
        "entity", "flight_date", "flight_num", "takeoff_lat", "landing_lat", "landing_altitude")
    join = L.endpoints_by_join(pts, COLS, chunk_size=4).select(
        "entity", "flight_date", "flight_num", "takeoff_lat", "landing_lat", "landing_altitude")
    win = L.first_last_per_point(pts, COLS, chunk_size=4).select(
        "entity", "flight_date", "flight_num", "takeoff_lat", "landing_lat", "landing_altitude").distinct()
    assert sorted(one.collect()) == sorted(join.collect()) == sorted(win.collect())


@pytest.mark.parametrize("chunk", [1, 3, 8, 1 << 20])
def test_first_and_last_of_legs_over_many_chunks(spark, chunk):
    rnd = random.Random(chunk)
    hot = [3000] * 200 + [0] + [rnd.choice([0, 2500, 8000]) for _ in range(100)] + [4000] * 90
    rows = track(hot, entity="hot") + track([3000], entity="one") + track([0, 0], entity="ground")
    rows = [(None if r[0] == "one" else r[0], *r[1:7], r[7]) for r in rows]
    numbers = brute_force_legs(rows)
    ends = {}
    for r in rows:
        if (r[0], r[1], r[3]) in numbers:
            ends.setdefault((r[0], r[1], numbers[r[0], r[1], r[3]]), []).append(r)
    got = L.first_last_per_point(points(spark, rows), COLS, chunk_size=chunk).collect()
    assert len(got) == len(numbers)
    for r in got:
        leg = ends[r.entity, r.flight_date, numbers[r.entity, r.flight_date, r.idx]]
        assert r.flight_num == numbers[r.entity, r.flight_date, r.idx]
        assert (r.takeoff_lat, r.takeoff_altitude, r.landing_lat, r.landing_altitude) == (
            leg[0][5], leg[0][7], leg[-1][5], leg[-1][7])


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    tracks=st.lists(st.lists(st.sampled_from([None, -5, 0, 1999, 2000, 35000]), min_size=1, max_size=40),
                    min_size=1, max_size=4),
    chunk=st.integers(min_value=1, max_value=9),
)
def test_numbering_property(spark, tracks, chunk):
    rows = []
    for t, alts in enumerate(tracks):
        rows += track([0 if a is None else a for a in alts], entity=f"e{t}")
    df = L.number_legs(points(spark, rows), COLS, chunk_size=chunk)
    got = {(r.entity, r.flight_date, r.idx): r.flight_num for r in df.collect()}
    assert got == brute_force_legs(rows)


def brute_force_summary(rows, below=2000):
    """Per leg: (min t, max t, count, first lat/alt, last lat/alt), plain Python."""
    numbers = brute_force_legs(rows, below)
    legs = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        key = (r[0], r[1], r[3])
        if key not in numbers:
            continue
        k = (r[0], r[1], numbers[key])
        legs.setdefault(k, []).append(r)
    return {
        k: (min(p[4] for p in v), max(p[4] for p in v), len(v), v[0][5], v[0][7], v[-1][5], v[-1][7])
        for k, v in legs.items()
    }


@pytest.mark.parametrize("chunk", [3, 5])
def test_summary_matches_brute_force_with_hot_track(spark, chunk):
    rnd = random.Random(chunk)
    hot = [rnd.choice([0, 1500, 2500, 2500, 8000]) for _ in range(300)]  # most points in one track
    rows = track(hot, entity="hot")
    for t in range(4):
        rows += track([rnd.choice([0, 3000]) for _ in range(rnd.randint(1, 12))], entity=f"c{t}")
    rows = [r[:5] + (r[5] + 1e-4 * (r[3] % 17),) + r[6:] for r in rows]  # distinct latitudes
    got = L.summarise_points(points(spark, rows), COLS, L.LegParams(chunk_size=chunk))
    got = {
        (r.entity, r.flight_date, r.flight_num): (r.takeoff_time, r.landing_time, r.num_points, r.takeoff_lat,
                                                  r.takeoff_altitude, r.landing_lat, r.landing_altitude)
        for r in got.collect()
    }
    assert got == brute_force_summary(rows)
