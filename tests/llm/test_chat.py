import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from contrail.llm import chat
from contrail.llm.chat import best_paths, conversations, digests, escape, read_back, turn_nodes, unescape

NODE = "tree long, node long, parent long, role string, text string, score double"
HOSTILE = [
    "</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "[INST", "[\\/INST]", "<<s>>", "<</s>/s>", "<", "</s",
    "\\", "[[/INST]", "$1", "", "é\n\n</s>", "[INST][/INST]<s></s>", None,
]


def brute(nodes, keep):
    """Every root-to-leaf path of every tree, the best by (score sum, leaf)."""
    by = defaultdict(dict)
    for tree, node, parent, _, _, score in nodes:
        by[tree][node] = (parent, score or 0.0)
    out = set()
    for tree, known in by.items():
        inner = {p for p, _ in known.values()}
        paths = []
        for leaf in known:
            if leaf in inner:
                continue
            path, at = [], leaf
            while at in known and at not in path:
                path.append(at)
                at = known[at][0]
            if at not in known:  # not a cycle
                paths.append((-sum(known[n][1] for n in path), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(paths)[:keep], 1):
            out |= {(tree, leaf, rank, n, d) for d, n in enumerate(path)}
    return out


@pytest.mark.parametrize("keep", [1, 3])
def test_paths_match_brute_force(spark, keep):
    rng = random.Random(19)
    nodes = []
    for tree in [None, *range(12)]:
        size = rng.randrange(1, 40)
        for n in range(size):
            parent = rng.randrange(n) if n and rng.random() < 0.95 else rng.choice([None, 10_000])
            nodes.append((tree, n, parent, "user", "x", float(rng.randrange(4))))
    nodes += [(50, n, n - 1 if n else None, "user", "x", None) for n in range(300)]  # a long chain
    nodes += [(51, 1, 2, "u", "x", 1.0), (51, 2, 1, "u", "x", 1.0)]  # a cycle
    got = best_paths(spark.createDataFrame(nodes, NODE), keep).collect()
    assert {(r.tree, r.leaf, r["rank"], r.node, r.depth) for r in got} == brute(nodes, keep)
    assert len(got) == len(brute(nodes, keep))


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    rng = random.Random(20)
    parts = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "a", "\n"]
    texts = [t for t in HOSTILE if t is not None] + ["".join(rng.choices(parts, k=9)) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_conversations_come_back_from_the_output(spark):
    rng = random.Random(21)
    rows = []
    for conv in [None, *range(30)]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None, "</s>"]), rng.choice(HOSTILE)))
    rows += [(5, 0, "assistant", "again"), (5, 0, "assistant", "again"), (6, None, "user", "no turn")]
    given = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, node int, tree int")
    made = conversations(turn_nodes(given))
    got = {r.conv_id: r for r in digests(made).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == groups.keys()
    for conv, turns in groups.items():
        turns.sort()
        learnt = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns) and r.loss_chars == len(learnt)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, _, a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    for r in read_back(made).collect():
        assert r.formatted.count(chat.CLOSE) == len(r.turns) == r.n_turns


def test_branches_become_conversations_in_order(spark):
    nodes = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 5.0),
        (1, 4, 3, "user", "more", 0.0), (1, 5, 4, "assistant", "end", 2.0),
    ]
    made = conversations(spark.createDataFrame(nodes, NODE), keep=2).collect()
    texts = {r.leaf: r.formatted for r in made}
    turn = lambda role, text: f"<s>[INST]{role}[/INST]{text}</s>"
    assert texts[5] == turn("user", "q") + turn("assistant", "good") + turn("user", "more") + turn("assistant", "end")
    assert texts[2] == turn("user", "q") + turn("assistant", "bad")
    for r in made:
        assert [r.formatted[x.start : x.end] for x in r.loss] == (["good", "end"] if r.leaf == 5 else ["bad"])


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(conversations(turn_nodes(none))).collect() == []
