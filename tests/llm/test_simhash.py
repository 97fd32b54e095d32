import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, documents, prose

from contrail.llm import simhash
from contrail.llm.components import connected_components
from contrail.llm.simhash import fingerprint, links, near_duplicates, one_of_each


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    codes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def components(codes):
    """Brute force: smallest position reachable over 3 or fewer bits."""
    root = list(range(len(codes)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    a = np.array(codes, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= 3):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(codes))]


@pytest.mark.parametrize("text", ["", "One", "one TWO", "a b c", "ÄB c\x85d e\x1cf", "x " * 500])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "_STEP", 7)
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_hash_is_sparks(spark):
    code = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert fingerprint(b"A b C") == code % (1 << 64)


def near_copies(rng):
    base = [prose(rng, 120) for _ in range(12)]
    rows = awkward(rng)
    for k, text in enumerate(base):
        words = text.split()
        for c in range(6):
            changed = list(words)
            changed[rng.randrange(120)] = "other"
            rows.append((1000 + 10 * k + c, " ".join(changed)))
    return rows


def test_components_match_brute_force(spark):
    rows = near_copies(random.Random(5))
    got = near_duplicates(documents(spark, rows, clashing=True)).collect()
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    codes = [plain_fingerprint(r[1]) for r in rows]
    want = [(rows[k][0], codes[k], rows[c][0]) for k, c in enumerate(components(codes))]
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [2048, 3])
def test_links_connect_dense_balls_exactly(spark, hot):
    """Many fingerprints within few bits of a centre; hot=3 refines every shared segment."""
    rng = random.Random(6)
    codes = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            codes.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
    codes |= {rng.getrandbits(64) for _ in range(100)}
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    roots = connected_components(links(spark.createDataFrame([(c,) for c in signed], "fp long"), hot))
    got = {r.node: r.root for r in roots.collect()}
    groups = components(codes)
    mine = [got.get(c, c) for c in signed]
    assert len({*zip(groups, mine)}) == len({*groups}) == len({*mine})


def test_components_of_a_long_chain(spark):
    edges = spark.range(400).select((F.col("id") * 7 % 401).alias("a"), ((F.col("id") + 1) * 7 % 401).alias("b"))
    assert {r.root for r in connected_components(edges).collect()} == {0}
    assert connected_components(edges).count() == 401


def test_one_of_each_keeps_one_row_per_component(spark):
    rows = near_copies(random.Random(7))
    docs = documents(spark, rows, clashing=True)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    want = {r.component_id for r in near_duplicates(docs).collect()}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_one_of_each_with_null_and_repeated_ids(spark):
    rng = random.Random(9)
    rows = near_copies(rng) + [(None, prose(rng, 50)) for _ in range(8)]
    rows += [(None, rows[-1][1])] * 3 + [(None, rows[20][1])]  # copies of a null id's and of a named text
    rows += [(3000 + k % 5, prose(rng, 50)) for k in range(20)]  # every id four times, with other texts
    low = prose(rng, 50)
    rows += [(0, prose(rng, 50)), (0, low), (50, low), (50, prose(rng, 50))]
    kept = [(r.doc_id, r.text) for r in one_of_each(documents(spark, rows, clashing=True)).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    roots = components([plain_fingerprint(r[1]) for r in rows])
    group = {(r[0], r[1]): root for r, root in zip(rows, roots)}
    assert sorted(group[k] for k in kept) == sorted(set(roots))
    assert all(d == rows[group[d, t]][0] for d, t in kept)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    assert one_of_each(documents(spark, [])).collect() == []
