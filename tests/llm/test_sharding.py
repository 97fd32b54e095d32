import random
import zlib
from collections import defaultdict

from tests.llm.helpers import awkward, documents

from contrail.llm.sharding import OVERHEAD, assign_shards, shard_manifest


def expected(rows, shards):
    """Brute force: shards by the middle of each row's bytes in (id, size, crc) order."""
    given = []
    for r in rows:
        data = (r[1] or "").encode()
        given.append((r[0] is not None, r[0] or 0, len(data) + OVERHEAD, zlib.crc32(data)))
    given.sort()
    total, at, out, slots = sum(g[2] for g in given), 0, [], defaultdict(int)
    for known, doc, size, crc in given:
        shard = min(shards - 1, (2 * at + size) * shards // (2 * total))
        out.append((doc if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return out


def test_matches_brute_force_with_awkward_rows(spark):
    rows = awkward(random.Random(1))
    for shards in (1, 5, 24):
        got = assign_shards(documents(spark, rows, clashing=True), shards).collect()
        got = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got]
        assert sorted(got, key=repr) == sorted(expected(rows, shards), key=repr)


def test_one_id_on_many_rows_is_spread_and_balanced(spark):
    rows = [(7, "x" * (k % 50)) for k in range(3000)] + [(k, "y" * 30) for k in range(1000)]
    got = assign_shards(documents(spark, rows), 10).collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in got:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert max(size.values()) - min(size.values()) <= 2 * 58
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table(spark):
    assert shard_manifest(documents(spark, [])).collect() == []
