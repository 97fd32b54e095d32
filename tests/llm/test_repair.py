import hashlib
import random
import re
import zlib

import pytest

from contrail.llm import repair

NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hurt(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit) with its lines, by trying every edit of every row: rows are (role, text, fault)."""

    def inserts(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                t, role = NEXT[s]
                found = (cost + 5, audit + "I", [*lines, f"{role}:"])
                best[t] = min(best.get(t, found), found)
        return best

    best = inserts({0: (0, "", [])})
    for role, text, fault in rows:
        after = {}
        for s, (cost, audit, lines) in best.items():
            t, name = NEXT[s]
            extra = 5 if fault == "truncated" else 0
            options = [(s, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                if role[:1] == "s" and s == 0:
                    options.append((1, (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
                if role[:1] == name[0]:
                    options.append((t, (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
                options.append((t, (cost + 1 + extra, audit + "R", [*lines, f"{name}:{text}"])))
            for t, found in options:
                after[t] = min(after.get(t, found), found)
        best = inserts(after)
    return min(best[s] for s in (0, 3) if s in best)


def brute(rows, damage=True):
    given = hurt(rows) if damage else rows
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in given if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), sha(r[3])))
        faults, seen = [], set()
        for _, _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            faults.append(kind)
            seen.add((role, text))
        turns = {r[1] for r in mine if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(mine, faults)]) if mine else (0, "", [])
        out.append(
            (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0)
            + tuple(faults.count(k) for k in ("blank", "duplicate", "truncated"))
            + (sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines)))
        )
    return sorted(out, key=repr)


def run(spark, rows, schema=SCHEMA, extra=()):
    df = spark.createDataFrame([(*r, *extra) for r in rows], schema)
    got = repair.repair(df, repair.damaged(df))
    assert got.columns == NAMES
    return sorted((tuple(r) for r in got.collect()), key=repr)


def talk(rng, conv, n, roles=("system", "user", "assistant", "user", "assistant", "tool", "")):
    texts = ["Yes.", "No!", "Why?  ", "cut off", "", " \t\n", "Ünd so.\n", "one. two"]
    turns = sorted(rng.randrange(2 * n + 1) for _ in range(n))
    return [(conv, t, rng.choice(roles), rng.choice(texts) + rng.choice(["", "", f" {k}."])) for k, t in enumerate(turns)]


def test_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [r for conv in range(150) for r in talk(rng, conv, rng.randrange(1, 14))]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_good_conversations_cost_nothing_but_their_damage(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for c in range(60) for t in range(6)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(cost == 0 and audit == "KKKKKK" for *_, cost, audit, _ in got)


def test_awkward_rows(spark):
    rng = random.Random(2)
    rows = talk(rng, None, 9) + talk(rng, 5, 6)
    rows += [(7, None, None, None), (7, None, "user", "Hm."), (7, 3, "user", "x" * 2_000_000 + "."), (7, 9, "assistant", None)]
    rows += [(8, 4, "user", "Same.")] * 40 + [(9, None, "assistant", "Only.")]
    lost = next(c for c in range(10_000, 20_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Dropped."))  # nothing is left of it
    got = run(spark, rows, SCHEMA + ", kind int, _seg long, audit string, _sha string, cost long", (None,) * 5)
    assert got == brute(rows)
    assert (lost, 0, 0, 0, 0, 0, 0, "", sha("")) in got


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_hot_conversation_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_BITS", 4)  # segments of 16 rows
    rng = random.Random(3)
    rows = talk(rng, 1, 700) + [r for c in range(2, 40) for r in talk(rng, c, rng.randrange(1, 9))]
    rows += [(99, k, "user", "All the same.") for k in range(300)]
    assert run(spark, rows) == brute(rows)


def test_turns_are_the_audited_edits(spark):
    rng = random.Random(4)
    rows = [r for conv in range(30) for r in talk(rng, conv, rng.randrange(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    lines = {}
    for r in sorted(repair.repaired_turns(df, repair.damaged(df)).collect(), key=lambda r: (r.conv_id, r.place)):
        lines.setdefault(r.conv_id, []).append(r)
    for conv, *_, audit, digest in brute(rows):
        mine = lines.get(conv, [])
        kept = [r for r in mine if r.edit != "D"]
        assert "".join(r.edit for r in mine) == audit and [r.place for r in mine] == list(range(len(mine)))
        assert sha("\n".join(f"{r.role}:{r.text}" for r in kept)) == digest
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))


def test_other_id_types(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho."), ("b", 0, "assistant", "Ha.")]
    assert run(spark, rows, SCHEMA.replace("conv_id long", "conv_id string")) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 65_537])
def test_binary_powers_are_repeated_steps(n):
    for letter in "ABEHIMP":
        sym = repair.symbol(letter)
        step = repair.END
        for _ in range(n):
            step = repair.moved(repair.power(sym, 0), step)
        assert repair.before_run(sym, n, repair.END) == step
