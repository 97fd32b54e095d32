import random
import re
from collections import defaultdict

from tests.llm.helpers import awkward, documents, prose, rows_of

from contrail.llm.mixing import full_schedule, mix, mixed_documents, source_targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes: dict, share=1.5, most=2, weights=(5, 2, 1)) -> dict:
    """Brute force: give by weight, cap, and share the excess again until nobody is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = {s: w for s, w in weight.items() if s not in capped}
        target = {s: rest * w / sum(free.values()) for s, w in free.items()}
        above = {s: most * sizes[s] for s in free if target[s] > most * sizes[s]}
        if not above:
            return capped | target
        capped |= above


def check(spark, rows, clashing=False, block=64):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len(WORDS.findall(r[1] or ""))
    want = reshared(sizes)
    got = mix(documents(spark, rows, clashing), block=block).collect()
    assert sorted(((r.doc_id, r["size"], r.source) for r in got), key=repr) == sorted(
        ((r[0], len(WORDS.findall(r[1] or "")), r[2]) for r in rows), key=repr
    )
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3 * block, (s, taken[s], want[s])


def test_awkward_rows(spark):
    check(spark, awkward(random.Random(2)), clashing=True)


def test_repeated_rows_without_words_stay_rows(spark):
    rows = awkward(random.Random(8)) + [(1, None, "s")] * 2 + [(2, "", None)] * 3
    rows += [(None, None, "s")] * 4 + [(None, " \t", "s"), (None, None, None), (None, None, None), (None, "", "empty")]
    check(spark, rows + [(k % 3, " ", "empty") for k in range(9)])


def test_hot_source_and_many_sources(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, 40), "hot") for k in range(300)]
    check(spark, rows + [(1000 + k, prose(rng, rng.randrange(60)), f"s{k % 17}") for k in range(600)])


def test_small_sources_reach_their_targets(spark):
    """Sources from 5 words up, beside large ones: within one word of the target, so within 10 % from 5 words on."""
    rng = random.Random(9)
    rows = [(k, prose(rng, 50), "a large one") for k in range(200)]
    for k, n in enumerate([5, 6, 7, 9, 13, 20, 31, 60, 64, 65, 100, 129, 300]):
        rows += [(1000 + 10 * k + j, prose(rng, n // 5 + (j < n % 5)), f"s{k:02d}") for j in range(5)]
    check(spark, rows)
    taken, target = defaultdict(int), {}
    for r in mix(documents(spark, rows)).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s, want in target.items():
        assert abs(taken[s] - want) <= 0.5 and abs(taken[s] - want) <= 0.1 * want, (s, taken[s], want)


def test_a_table_of_a_hundred_words(spark):
    rows = [(1, prose(random.Random(1), 80), "a"), (2, prose(random.Random(2), 20), "b")]
    got = {r.source: (r.taken, r.target) for r in mix(documents(spark, rows)).collect()}
    assert all(abs(taken - target) <= 0.5 for taken, target in got.values())


def test_any_prefix_of_the_slots_is_near_the_mix(spark):
    sizes = spark.createDataFrame([("a", 100_000), ("b", 60_000), ("c", 640)], "source string, source_size long")
    targets = source_targets(sizes)
    need = {r.src: r.need for r in targets.collect()}
    plan = sorted((r.slot, r.src, r["rank"]) for r in full_schedule(targets).collect())
    assert {s: sum(1 for _, x, _ in plan if x == s) for s in need} == need
    for upto in (100, 500, 1500):
        for s, n in need.items():
            got = sum(1 for _, x, _ in plan[:upto] if x == s)
            assert abs(got - upto * n / sum(need.values())) <= 6


def test_reruns_agree_whatever_the_partitions(spark):
    docs = documents(spark, [(k, f"a b c d {k}", f"s{k % 3}") for k in range(500)])
    assert rows_of(mix(docs.repartition(7))) == rows_of(mix(docs.coalesce(1)))


def test_targets_without_words(spark):
    sizes = spark.createDataFrame([("a", 0), ("b", 0)], "source string, source_size long")
    assert [r.target for r in source_targets(sizes).collect()] == [0.0, 0.0]


def test_empty_table(spark):
    assert mix(documents(spark, [])).collect() == []


def test_mixed_documents_rounds_to_whole_texts(spark):
    rows = awkward(random.Random(4))
    docs = documents(spark, rows, clashing=True)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    taken = defaultdict(list)
    for r in mix(docs).collect():
        taken[r.doc_id, r.source, r["size"]].append(r.taken)
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, r.source, len(WORDS.findall(r.text or ""))] += 1
    for key, parts in taken.items():
        copies = 1 if key[2] == 0 else int(sum(parts) / len(parts) / key[2] + 0.5)
        assert got.get(key, 0) == copies * len(parts)
