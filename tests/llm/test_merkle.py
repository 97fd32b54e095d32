import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from tests.llm.helpers import CLASHING, SCHEMA, awkward, documents

from contrail.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """Levels of one tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k : k + 8])) for k in range(0, len(last), 8)])
    return levels


def flanks(levels, pos):
    out = []
    for level in levels[:-1]:
        run = level[pos // 8 * 8 : pos // 8 * 8 + 8]
        out.append(("".join(run[: pos % 8]), "".join(run[pos % 8 + 1 :])))
        pos //= 8
    return out


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for doc, text, lang, source, n in rows:
        head = "".join(map(framed, (doc, source, lang, n)))
        low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        leaf = sha(head + framed(text))
        groups[lang].append(((doc is not None, doc or 0, leaf), doc, leaf, sha(head + framed(low)) if hit else leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g])]) for g in order}
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for pos, (_, doc, leaf, forged) in enumerate(sorted(groups[g])):
            path = flanks(trees[g], pos) + flanks(top, k)
            node = forged
            for before, after in path:
                node = sha(before + node + after)
            proof = sha("".join(b + a for b, a in path))
            out.append((doc, leaf, trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def run(df):
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    got = merkle.verified_manifest(df)
    assert got.columns == names
    return sorted((tuple(r) for r in got.collect()), key=repr)


def rows_of(rng, n, langs):
    return [
        (k, f"Text {rng.randrange(50)} ÄB" * rng.randrange(3), rng.choice(langs), rng.choice(["s", None]), rng.randrange(9))
        for k in rng.sample(range(10 * n + 10), n)
    ]


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 600])
def test_one_group_of_every_shape(spark, n):
    rows = rows_of(random.Random(n), n, ["en"])
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_two_rounds_of_blocks_and_a_hot_group(spark):
    rng = random.Random(1)
    rows = rows_of(rng, 4700, ["en"] * 20 + ["de", None, "", "éa", "zz"])
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got == brute(rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_many_groups(spark):
    rows = rows_of(random.Random(2), 900, [f"l{k}" for k in range(700)] + [None])
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = [(r[0], r[1], rng.choice(["en", None]), r[2], None) for r in awkward(rng)]
    rows += [(5, "A" * 3_000_000, "en", None, 3), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(7, "Same", "en", "s", 4)] * 700  # one id in a third and more of the rows
    df = spark.createDataFrame([(*r, *[None] * 9) for r in rows], f"{SCHEMA}, {CLASHING}")
    assert run(df) == brute(rows)


def test_a_null_is_not_an_empty_text(spark):
    got = {r.doc_id: r.leaf for r in merkle.verified_manifest(documents(spark, [(1, None), (2, "")])).collect()}
    assert got[1] == sha("1:11:s2:en1:0-") and got[2] == sha("1:21:s2:en1:00:")


def test_empty_table(spark):
    assert run(documents(spark, [])) == []


def test_reruns_agree(spark):
    rows = rows_of(random.Random(4), 300, ["a", "b"])
    assert run(spark.createDataFrame(rows, SCHEMA)) == run(spark.createDataFrame(rows[::-1], SCHEMA).repartition(9))
