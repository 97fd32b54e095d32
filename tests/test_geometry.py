import json

from contrail.operators import geometry as G
from contrail.operators.legs import TrackCols

COLS = TrackCols(keys=("entity",), time="t", base=None, alt="alt")


def pts(spark, rows):
    return spark.createDataFrame(rows, "entity long, idx long, t double, lat double, lng double, alt int")


def test_constant_altitude_is_red_and_equal_positions_draw_nothing(spark):
    rows = [(1, 1, 0.0, -11.0, 40.0, 3000), (1, 2, 1.0, -11.0, 40.0, 3000), (1, 3, 2.0, -11.1, 40.1, 3000)]
    col = G.coloured_pairs(pts(spark, rows), COLS)
    assert {r.color for r in col.collect()} == {"rgb(255, 0, 0)"}
    rib = G.ribbons(col, COLS)
    assert [r.idx for r in rib.collect()] == [2]


def test_invalid_altitudes_drop_pairs_and_ramp_ends(spark):
    rows = [(1, 1, 0.0, 0.0, 0.0, 1000), (1, 2, 1.0, 0.0, 1.0, 0), (1, 3, 2.0, 0.0, 2.0, 1000),
            (1, 4, 3.0, 0.0, 3.0, 5000), (1, 5, 4.0, 0.0, 4.0, 9000), (1, 6, 5.0, 0.0, 5.0, -5)]
    col = {r.idx: r for r in G.coloured_pairs(pts(spark, rows), COLS, chunk_size=2).collect()}
    assert sorted(col) == [3, 4]
    assert col[3].ratio == 0.25 and col[3].color == "rgb(255, 193, 0)"
    assert col[4].ratio == 0.75 and col[4].color == "rgb(0, 214, 255)"


def test_features_are_closed_polygons(spark):
    rows = [(1, i, float(i), -11.0 + i * 0.01, 40.0 + i * 0.02, 1000 * i) for i in range(1, 6)]
    rib = G.ribbons(G.coloured_pairs(pts(spark, rows), COLS), COLS)
    for r in G.features(rib, COLS).collect():
        f = json.loads(r.geojson)
        assert f["type"] == "Feature" and f["geometry"]["type"] == "Polygon"
        ring = f["geometry"]["coordinates"][0]
        assert len(ring) == 5 and ring[0] == ring[-1]
        assert f["properties"]["extrusion_height"] >= 150


def test_path_pieces_are_bounded_and_ordered(spark):
    rows = [(1, i, float(i), 1.0 * i, 2.0 * i, 3000) for i in range(1, 11)]
    got = sorted(G.path_pieces(pts(spark, rows), COLS, piece_size=4).collect())
    assert [r.n_points for r in got] == [4, 4, 2]
    assert got[0].path == "2.0,1.0 4.0,2.0 6.0,3.0 8.0,4.0"
