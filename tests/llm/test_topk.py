import math
import random

import pytest
from tests.llm.helpers import rows_of

from contrail.llm import topk
from contrail.llm.topk import query_vectors, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)


def brute(spark, rows, k=5, every=50, scale=256):
    """Over the values as stored (single precision)."""
    given = [
        (r.vec_id, [math.floor(scale * x) for x in r.embedding])
        for r in vectors(spark, rows).collect()
        if r.vec_id is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)
    ]
    out = []
    for own, (q, a) in enumerate(given):
        if q % every:
            continue
        others = [(i, e) for n, (i, e) in enumerate(given) if n != own and len(e) == len(a)]
        best = sorted((-sum(x * y for x, y in zip(a, e)), i) for i, e in others)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile,fan,block,lane", [(2048, 16, 16 << 20, 8), (7, 2, 900, 2)])
def test_matches_brute_force(spark, monkeypatch, tile, fan, block, lane):
    for name, value in (("TILE", tile), ("FAN", fan), ("BLOCK_BYTES", block), ("LANE", lane)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(18)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(8)]) for k in range(400)]
    rows += [(400 + k, [0.5] * 8) for k in range(120)]  # ties
    rows += [(50, rows[50][1]), (7, rows[7][1])]  # repeated rows
    rows += [(100, [-x for x in rows[100][1]]), (150, [9.0] * 8), (150, [9.0] * 7 + [8.0])]  # repeated ids
    rows += [(450, [0.5] * 8)] * 7  # more copies than a list holds
    rows += [(None, [1.0] * 8), (600, None), (650, []), (601, [math.nan] * 8), (602, [None] * 8)]
    rows += [(603, [math.inf] * 8), (700, [1.0, 2.0]), (701, [3.0, 4.0])]
    given = vectors(spark, rows).repartition(9)
    assert rows_of(top_k(given, query_vectors(given))) == brute(spark, rows)


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 1.0]), (3, [3e6, 3.0])]
    given = vectors(spark, rows)
    got = rows_of(top_k(given, query_vectors(given)))
    assert got == brute(spark, rows) and [r[2] for r in got] == [3, 1, 2]


def test_only_the_own_row_is_no_candidate(spark):
    given = vectors(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.5, 0.0])])
    one, half = 256 * 256, 256 * 128
    same = [(0, 1, 0, one), (0, 2, 1, half), (0, 3, 0, 0)]
    other = [(0, 1, 0, 0), (0, 2, 0, 0), (0, 3, 1, 0)]
    assert rows_of(top_k(given, query_vectors(given))) == sorted([*same, *same, *other], key=repr)


def test_fewer_candidates_than_k_and_empty(spark):
    given = vectors(spark, [(0, [1.0]), (1, [2.0])])
    assert rows_of(top_k(given, query_vectors(given))) == [(0, 1, 1, 256 * 512)]
    alone = vectors(spark, [(0, [1.0])])
    assert top_k(alone, query_vectors(alone)).collect() == []
    none = vectors(spark, [])
    assert top_k(none, query_vectors(none)).collect() == []
