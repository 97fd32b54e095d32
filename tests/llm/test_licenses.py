import random
import re
from collections import Counter

import pytest
from tests.llm.helpers import awkward, documents, prose, rows_of

from contrail.llm.licenses import LEAST, NOTICES, TEMPLATES, license_matches, normalised


def plain_units(text):
    low = (text or "").lower()
    paragraphs = re.split(r"\n[^a-z0-9\n]*\n[^a-z0-9]*|\x02", low)
    sentences = [s for p in paragraphs for s in re.split(r"[.!?][ \t\r\n]+|\x01", p)]
    lines = [line for s in sentences for line in re.split(r"[\n\x03]", s)]
    return {normalised(u) for u in [low, *paragraphs, *sentences, *lines]}


def bag(text):
    words = text.split()
    return Counter(zip(words, words[1:]))


def expected(rows, given=TEMPLATES):
    templates = [(licence, bag(normalised(t))) for licence, t in given]
    out = []
    for r in rows:
        found = {}
        for unit in plain_units(r[1]):
            a = bag(unit)
            for licence, b in templates:
                dice = 2 * (a & b).total() / max(1, a.total() + b.total())
                if dice >= LEAST:
                    found.setdefault(licence, {}).setdefault(unit, []).append(dice)
        out += [(r[0], k, len(v), max(max(x) for x in v.values())) for k, v in found.items()]
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    rng = random.Random(25)
    rows = awkward(rng)
    for k in range(120):
        _, text = rng.choice(TEMPLATES)
        words = text.split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["Licence", "other", ""])
        lines = [prose(rng, 6), rng.choice(["\n", "\n", " "]).join([" ".join(words[:9]), " ".join(words[9:])])]
        rng.shuffle(lines)
        rows.append((2000 + k, rng.choice(["\n\n", "\n", ". ", " "]).join([*lines, lines[0]])))
    rows.append((3000, "\n".join(["Released under the MIT License."] * 500)))
    rows += [(3001, "Licensed under CC BY-NC 4.0.")] * 3 + [(3002, "\x01Licensed under CC BY-NC 4.0.\x02Licensed")]
    got = rows_of(license_matches(documents(spark, rows, clashing=True)), "doc_id", "license", "matches", "best")
    assert got == expected(rows) and len(got) > 40


def test_units_at_exactly_both_size_bounds(spark):
    """For every template size: units of 3/2 and of 2/3 of its bigrams, all shared, have Dice 0.8 exactly."""
    templates, rows = [], []
    for b in range(1, 61):
        words = [f"t{b}w{k}" for k in range(b + 1)]
        templates.append((f"L{b}", " ".join(words)))
        if b % 2 == 0:
            rows.append((1000 + b, " ".join(words + [f"more{k}" for k in range(b // 2)])))
            rows.append((2000 + b, " ".join(words + [f"more{k}" for k in range(b // 2 + 1)])))
        if b % 3 == 0:
            rows.append((3000 + b, " ".join(words[: 2 * b // 3 + 1])))
            rows.append((4000 + b, " ".join(words[: 2 * b // 3])))
    got = rows_of(license_matches(documents(spark, rows), tuple(templates)), "doc_id", "license", "matches", "best")
    assert got == expected(rows, tuple(templates))
    found = {r[0] for r in got}
    assert found == {1000 + b for b in range(2, 61, 2)} | {3000 + b for b in range(3, 61, 3)}


def test_notices_at_exactly_the_bound(spark):
    rows = [(1, "Licensed under the MIT License (see LICENSE)."), (2, "Released under the BSD License on request")]
    got = rows_of(license_matches(documents(spark, rows)), "doc_id", "license", "best")
    assert got == [(1, "MIT", 0.8), (2, "BSD", 0.8)]


def test_a_whole_licence_text_in_a_comment_header(spark):
    paragraphs = ["Copyright (c) 2024 Someone"] + [t for k, t in NOTICES if k == "MIT" and len(t) > 100]
    for mark in ("// ", "# ", " * ", ""):
        lines = []
        for text in paragraphs:
            words = text.split()
            lines += [mark + " ".join(words[k : k + 12]) for k in range(0, len(words), 12)] + [mark.rstrip()]
        rows = [(1, "\n".join([*lines, "int main() { return 0; }"]))]
        got = rows_of(license_matches(documents(spark, rows)), "doc_id", "license", "matches", "best")
        # Three paragraphs, and the two sentences of the last one.
        assert got == expected(rows) and (1, "MIT", 5, 1.0) in got


def notice(licence, start):
    return next(t for k, t in NOTICES if k == licence and t.startswith(start))


def test_a_header_directly_before_code(spark):
    text = notice("MPL-2.0", "This Source Code Form")
    for mark, width in (("// ", 9), ("# ", 5), (" * ", 12)):
        words = text.split()
        lines = [mark + " ".join(words[k : k + width]) for k in range(0, len(words), width)]
        rows = [(1, "\n".join([*lines, "int main() { return 0; }", *["x = f(x, y);"] * 200]))]
        got = rows_of(license_matches(documents(spark, rows)), "doc_id", "license", "best")
        assert got == [(1, "MPL-2.0", 1.0)]


def test_notices_wrapped_inside_a_paragraph(spark):
    """However the lines fall, a notice is found by its sentences among other prose."""
    rng = random.Random(7)
    cases = [("MIT", "Released under"), ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the"), ("GPL-3.0", "This program")]
    rows = []
    for k, (licence, start) in enumerate(cases):
        for width in (3, 4, 7, 11):
            words = f"{prose(rng, 40)}. {notice(licence, start)} {prose(rng, 400)}".split()
            wrapped = "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))
            rows.append((100 * k + width, wrapped))
    rows += [(900, prose(rng, 500)), (901, "Unless required by law you may not use this file. See the licence for more.")]
    got = rows_of(license_matches(documents(spark, rows)), "doc_id", "license", "matches", "best")
    assert got == expected(rows)
    assert {(r[0], r[1]) for r in got} >= {(100 * k + w, c[0]) for k, c in enumerate(cases) for w in (3, 4, 7, 11)}
    assert not {r[0] for r in got} & {900, 901}


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError, match="templates"):
        license_matches(documents(spark, []), (("x", "a b " * 300_000),))


def test_empty_table(spark):
    assert license_matches(documents(spark, [])).collect() == []
