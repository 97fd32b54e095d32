from pyspark.sql import functions as F

from contrail.functions import from_hex, iso_utc, json_int, round_scaled, safe_div, to_hex, element


def one(spark, expr, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_json_int(spark):
    data = [("3025.5",), ("3026.5",), ("1e3",), ("ground",), (None,), ("9999999999",), ("-12",), ("7",)]
    assert one(spark, json_int("x"), data) == [3026, 3026, 1000, None, None, None, -12, 7]


def test_round_scaled_binary_rounding(spark):
    # 0.285 is 0.28499999999999998 in binary: rounds down, unlike decimal rounding
    assert one(spark, round_scaled("x", 2), [(0.285,), (1.005,), (-2.345,), (2.5e-7,)], "x double", ) == [0.28, 1.0, -2.35, 0.0]  # as DuckDB ROUND(x, 2)


def test_iso_utc_truncates(spark):
    assert one(spark, iso_utc("x"), [(1746057600.999,)], "x double") == ["2025-05-01T00:00:00Z"]


def test_safe_div(spark):
    got = one(spark, safe_div(F.lit(3.0), "x", 1.0), [(0.0,), (2.0,), (None,)], "x double")
    assert got == [3.0, 1.5, 3.0]


def test_hex_roundtrip(spark):
    assert one(spark, to_hex("x"), [(11256099,)], "x bigint") == ["abc123"]
    assert one(spark, from_hex("x"), [("abc123",)]) == [11256099]


def test_element_out_of_range_is_null(spark):
    df = spark.createDataFrame([(["a", "b"],)], "x array<string>")
    assert df.select(element("x", 1), element("x", 7)).first() == ("a", None)
