import random

from pyspark.sql import functions as F

from contrail.operators import places as P
from contrail.operators.places import LANDING_PLACES, Place, label, label_by_join, place_cells, places_frame

SCHEMA = ("priority int, label string, c_lat double, c_lng double, tol double, lat_lo double, lat_hi double, "
          "lng_lo double, lng_hi double, min_alt int")


def points(spark, rnd, n=3000):
    rows = [(i, rnd.uniform(-27, -9), rnd.uniform(31, 42), rnd.choice([None, 2500, 3000, 4000, 6000]))
            for i in range(n)]
    rows += [(10**6, -10.0, 40.0, 6000), (10**6 + 1, -11.82, 40.53, 4000), (10**6 + 2, -12.0, 41.5, 9000)]
    rows += [(None, -25.9, 32.57, None), (5, None, 32.57, 1), (5, None, 32.57, 1)]  # null key and place, repeats
    return spark.createDataFrame(rows, "id long, lat double, lng double, alt int")


def brute(row, places):
    found = []
    for prio, name, cy, cx, tol, y0, y1, x0, x1, above in places:
        if row.lat is None or row.lng is None:
            continue
        inside = (abs(row.lat - cy) < tol and abs(row.lng - cx) < tol) if tol is not None else (
            y0 < row.lat < y1 and x0 < row.lng < x1)
        if inside and (above is None or (10000 if row.alt is None else row.alt) > above):
            found.append((prio, name))
    return min(found)[1] if found else "Unknown"


def test_rule_chain_and_join_agree(spark):
    df = points(spark, random.Random(11))
    chain = df.select("id", label("lat", "lng", "alt", LANDING_PLACES).alias("location"))
    joined = label_by_join(df, "lat", "lng", "alt", places_frame(spark, LANDING_PLACES)).select("id", "location")
    key = lambda r: (str(r.id), r.location)
    a = sorted(chain.collect(), key=key)
    assert a == sorted(joined.collect(), key=key)
    assert {r.location for r in a} == {"Maputo", "Pemba", "Afungi", "Unknown"}


def test_one_plan_at_every_size_with_wide_narrow_and_centre_only_places(spark):
    rnd = random.Random(12)
    df = points(spark, rnd, 800)
    places = []
    for k in range(900):
        y, x, half = rnd.uniform(-27, -9), rnd.uniform(31, 42), rnd.choice([1e-4, 0.02, 0.3, 4.0, 60.0, 700.0])
        prio = 1000 - k // 2 if half < 4 else 5000 + k  # pairs share a priority; wide ones lose
        if k % 2:
            places.append((prio, f"O'Hare {k}", y, x, half, None, None, None, None, rnd.choice([None, 3000])))
        else:
            places.append((prio, f'"{k}"', None, None, None, y - half, y + half, x - half, x + half, None))
    rows = df.collect()
    for part in (places[:3], places[:101], places):
        got = label_by_join(df, "lat", "lng", "alt", spark.createDataFrame(part, SCHEMA))
        want = sorted((str(r.id), str(r.lat), brute(r, part)) for r in rows)
        assert sorted((str(r.id), str(r.lat), r.location) for r in got.collect()) == want


def hot_airport(spark, rnd):
    """Most rows lie at one airport, a third of all on one spot of it; many places share its cells."""
    rows = [(k, -25.92, 32.57, None) for k in range(900)]
    rows += [(1000 + k, -25.9 + rnd.gauss(0, 0.01), 32.6 + rnd.gauss(0, 0.01), rnd.choice([None, 4000])) for k in range(900)]
    rows += [(5000 + k, rnd.uniform(-27, -9), rnd.uniform(31, 42), 6000) for k in range(600)]
    df = spark.createDataFrame(rows, "id long, lat double, lng double, alt int")
    places = [(1 + k, f"gate {k}", -25.9 + rnd.gauss(0, 0.02), 32.6 + rnd.gauss(0, 0.02), rnd.choice([0.001, 0.004, 0.02]),
               None, None, None, None, rnd.choice([None, 3000])) for k in range(200)]
    places += [(500, "town", None, None, None, -26.4, -25.4, 32.1, 33.1, None), (900, "all", 0.0, 0.0, 700.0, None, None, None, None, None)]
    return df, places


def test_full_cells_are_split_by_their_counts(spark):
    rnd = random.Random(14)
    df, places = hot_airport(spark, rnd)
    table = spark.createDataFrame(places, SCHEMA)
    want = sorted((r.id, brute(r, places)) for r in df.collect())
    for bound in (60, 1 << 20):
        got = label_by_join(df, "lat", "lng", "alt", table, bound=bound)
        assert sorted((r.id, r.location) for r in got.collect()) == want
    cells = place_cells(table)
    look = df.select(F.col("id").alias("_row"), F.col("lat").alias("_y"), F.col("lng").alias("_x"), F.col("alt").alias("_alt"))
    look = look.withColumn("_level", F.explode(F.array(F.lit(-2), F.lit(5)))).withColumn("_depth", F.lit(0))
    look = look.withColumn("_gy", F.floor(F.col("_y") / P._width())).withColumn("_gx", F.floor(F.col("_x") / P._width()))
    split, _ = P._split_full_cells(look, cells, 60)
    sizes = [r["count"] for r in split.groupBy(*P._CELL, "_salt").count().collect()]
    assert max(sizes) <= 90 and sum(sizes) == 2 * df.count()  # dealt by the row's number: near the bound


def test_overlapping_places_do_not_all_meet_a_row(spark):
    """Many places over one area: a row meets those that can win there, however many there are."""
    rnd = random.Random(16)
    rows = [(k, rnd.uniform(-27, -9), rnd.uniform(31, 42), rnd.choice([None, 0, 2500, 4000, 6000])) for k in range(600)]
    edges = [-26.0, -25.5, -25.0, -16.0, 32.0, 32.5, 40.0]
    rows += [(1000 + k, rnd.choice(edges[:4]), rnd.choice(edges[4:]), rnd.choice([None, 3000])) for k in range(60)]
    rows += [(2000, None, 32.0, 1), (2001, float("nan"), 32.0, 1), (2002, -0.0, 0.0, 1)]
    df = spark.createDataFrame(rows, "id long, lat double, lng double, alt int")
    places = []
    for k in range(700):
        y, x, half = round(rnd.uniform(-27, -9), 1), round(rnd.uniform(31, 42), 1), rnd.choice([3.0, 3.0, 0.5, 0.25])
        guard, prio = rnd.choice([None, None, 1000, 3000, 5000]), rnd.choice([k // 2, 900 - k])
        if k % 2:
            places.append((prio, f"c{k}", y, x, half, None, None, None, None, guard))
        else:
            places.append((prio, f"b{k}", None, None, None, y - half, y + half, x - half, x + half, guard))
    places += [(950 + k % 3, f"same {k}", -20.0, 35.0, 6.0, None, None, None, None, None) for k in range(300)]
    places += places[:50]
    table = spark.createDataFrame(places, SCHEMA)
    want = sorted((r.id, brute(r, places)) for r in df.collect() if r.lat == r.lat)
    for kw in ({}, {"place_bound": 12, "bound": 200}):
        got = label_by_join(df, "lat", "lng", "alt", table, **kw)
        labels = {r.id: r.location for r in got.collect()}
        assert len(labels) == len(rows) and labels.pop(2001) == "Unknown"
        assert sorted(labels.items()) == want
    # All of these share a cell; no cell is left in which a row meets more than the bound.
    many = [(rnd.randrange(10**6), f"w{k}", rnd.uniform(-27, -9), rnd.uniform(31, 42), 3.0, None, None, None, None, None)
            for k in range(1000)]
    cells, splits = P._split_crowded_cells(place_cells(P.ranked_places(spark.createDataFrame(many, SCHEMA))), 32)
    assert splits and max(r["count"] for r in cells.groupBy(*P._CELL).count().collect()) <= 32


def test_one_row_is_looked_up_per_size_that_places_have(spark):
    df = points(spark, random.Random(15), 50)
    table = spark.createDataFrame([(1, "a", -20.0, 35.0, 0.1, None, None, None, None, None)] * 3
                                  + [(2, "b", None, None, None, -30.0, 0.0, 20.0, 50.0, None)], SCHEMA)
    assert sorted({r[0] for r in place_cells(table).select("_level").distinct().collect()}) == [-1, 3]
    plan = label_by_join(df, "lat", "lng", "alt", table)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode([-1,3])" in plan


def test_no_places_and_labels_with_quotes(spark):
    df = points(spark, random.Random(13), 10)
    none = label_by_join(df, "lat", "lng", "alt", spark.createDataFrame([], SCHEMA))
    assert {r.location for r in none.collect()} == {"Unknown"} and none.count() == df.count()
    rule = Place.box("O'Hare' OR '1", lat=(-90.0, 90.0), lng=(-180.0, 180.0))
    got = df.filter("lat IS NOT NULL").select(label("lat", "lng", None, [rule]).alias("location")).distinct().collect()
    assert [r.location for r in got] == ["O'Hare' OR '1"]
    assert df.select(label("lat", "lng", None, []).alias("x")).filter(F.col("x") != "Unknown").count() == 0
