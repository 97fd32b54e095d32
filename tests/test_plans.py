"""Plan shapes the design relies on (static plans, AQE off for determinism)."""

import os

import pytest

from contrail.operators import legs as L
from contrail.sources import sinks

COLS = L.TrackCols()
SCHEMA = ("entity string, flight_date string, base_timestamp double, idx long, time_offset double, "
          "lat double, lng double, altitude_ft int, timestamp timestamp")


@pytest.fixture()
def static_plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def points(spark):
    rows = [("e", "2025-05-01", 0.0, i, float(i), 1.0, 2.0, 3000 if i % 7 else 0, None) for i in range(1, 50)]
    return spark.createDataFrame(rows, SCHEMA)


def test_chunk_partials_run_in_place(static_plans):
    local = L.local_legs(points(static_plans), COLS, chunk_size=8)
    part = local.groupBy("entity", "flight_date", "base_timestamp", "_chunk", "_local_leg").count()
    p = plan(part)
    # the halo window's exchange is the only one: the aggregate reuses its partitioning
    assert p.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(entity" in p and "_chunk" in p


def test_points_are_evaluated_once_and_never_joined_on_the_leg(static_plans, scratch):
    static_plans.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = os.path.join(scratch, "points")
    points(static_plans).write.parquet(out)
    given = static_plans.read.parquet(out)
    try:
        for made in (
            L.number_legs(given, COLS, chunk_size=8),
            L.first_last_per_point(given, COLS, chunk_size=8),
            L.endpoints_by_join(given, COLS, chunk_size=8),
        ):
            p = plan(made)
            joins = [line for line in p.splitlines() if "SortMergeJoin" in line]
            assert joins and not any("flight_num" in line.split(", Inner")[0] for line in joins)
            # what was given has been read and written before: only the written legs are read
            assert out not in p and "Window [lag" not in p
    finally:
        static_plans.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_read_prunes_columns_and_days(static_plans, scratch):
    out = os.path.join(scratch, "points")
    sinks.write_points(points(static_plans), out)
    df = sinks.read_report_points(static_plans, out, "2025-05-01", "2025-05-01").filter("lat > 0.5")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(flight_date" in p
    assert "PushedFilters: [IsNotNull(lat), GreaterThan(lat,0.5)]" in p
    read_schema = p.split("ReadSchema: ")[1].split(">")[0]
    assert "time_offset" not in read_schema and "base_timestamp" not in read_schema
    assert df.count() == 49


def test_rule_chain_is_codegen(static_plans):
    legs = L.summarise_points(points(static_plans), COLS, L.LegParams(chunk_size=8))
    out = L.format_summary(legs, COLS)
    p = plan(out)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p  # no Python UDF anywhere
    assert "CASE WHEN" in p


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize(
    "name,columns",
    [
        ("point_total", ""),
        ("coordinate_total", "user_id:bigint"),
        ("track_counts", "user_id:bigint"),
        ("track_altitude_range", "user_id:bigint,value:double"),
        ("report_points", "event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double"),
    ],
)
def test_counts_and_ranges_come_straight_from_the_scan(static_plans, name, columns):
    from contrail.plans import catalog

    p = plan(catalog.queries()[name](static_plans, SF))
    assert p.count("FileScan parquet") == 1 and f"ReadSchema: struct<{columns}>" in p
    assert "Window" not in p and "rangepartitioning" not in p
    if name == "report_points":
        assert "Exchange" not in p


def test_label_join_is_an_equi_join(static_plans):
    from contrail.operators import places as P

    static_plans.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = static_plans.createDataFrame([(1, 0.5, 0.5, 1)], "id long, lat double, lng double, alt int")
        p = plan(P.label_by_join(df, "lat", "lng", "alt", P.places_frame(static_plans, P.LANDING_PLACES)))
    finally:
        static_plans.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "NestedLoop" not in p and "Cartesian" not in p and "Broadcast" not in p
