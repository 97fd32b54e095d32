import random

import numpy as np
import pytest
from tests.llm.helpers import awkward, documents, prose, rows_of

from contrail.llm import decontamination as cgk
from contrail.llm.decontamination import Search, contaminations, uncontaminated


def distance(a, b):
    """Smallest edit distance of a to any stretch of b (plain dynamic programming)."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def words(text):
    return [w.encode() for w in "".join(c.lower() if c.isascii() else c for c in text or "").split()]


def edited(rng, text, rate):
    out = text.split()
    for _ in range(int(rate * len(out))):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = "changed"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "added")
    return " ".join(out)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_edit_distance_matches_dynamic_programming():
    rng = random.Random(13)
    for _ in range(200):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 14))])
        b = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 30))])
        want = distance(a.tolist(), b.tolist())
        got = cgk._edits_within(a, b, 99)
        assert got[0] == want
        if got[2] > got[1]:
            assert distance(a.tolist(), b[got[1] : got[2]].tolist()) == want
        assert (cgk._edits_within(a, b, want - 1) is None) == (want - 1 < want)


def test_words_do_not_cross_texts_and_long_words_differ():
    texts = [b"ab", b"c \xc3\xa9t\xc3\xa9", b"", b"x" * 30 + b" " + b"x" * 29 + b"y", b"AB"]
    data, cuts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    codes, a, b = cgk.words_of(data, cuts)
    assert [bytes(data[x:y]) for x, y in zip(a, b)] == [
        b"ab", b"c", b"\xc3\xa9t\xc3\xa9", b"x" * 30, b"x" * 29 + b"y", b"AB",
    ]
    assert codes[0] == codes[-1] and len(set(codes.tolist())) == 5
    pair = np.frombuffer("ÀÉÞß×ÿ àéþß÷ÿ ĀÉ āé".encode(), np.uint8)
    folded = cgk.words_of(pair, np.zeros(0, np.int64))[0]
    assert folded[0] == folded[1] and folded[2] != folded[3]


def test_recall_of_edited_copies_reaches_the_target(spark):
    rng = random.Random(14)
    items = [(k, prose(rng, rng.randrange(10, 90))) for k in range(80)]
    for rate in (0.0, 0.1):
        rows = [(k, f"{prose(rng, 60)} {edited(rng, t, rate)} {prose(rng, 50)}") for k, t in items]
        got = {(r.doc_id, r.item_id) for r in contaminations(documents(spark, rows), items_of(spark, items)).collect()}
        share = sum((k, k) in got for k, _ in items) / len(items)
        assert share == 1.0 if rate == 0 else share >= 0.95


@pytest.mark.parametrize("low, high", [(4, 7), (8, 15), (16, 31), (32, 63), (64, 127), (128, 255), (256, 511), (512, 600)])
def test_recall_at_the_promised_edits_in_every_class_of_lengths(low, high):
    rng = random.Random(18)
    items = [(k, prose(rng, rng.randint(low, high))) for k in range(200 if high < 128 else 60)]
    texts = [f"{prose(rng, 60)} {edited(rng, t, 0.15)} {prose(rng, 50)}".encode() for _, t in items]
    data, cuts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = {(d, i) for d, i, *_ in cgk.ItemIndex(items).hits(data, cuts)}
    assert sum((k, k) in found for k, _ in items) >= 0.95 * len(items)


@pytest.mark.parametrize("cut", [slice(1, None), slice(2, None), slice(None, -1), slice(None, -2)])
def test_copies_that_lack_words_at_a_documents_start_or_end(cut):
    rng = random.Random(19)
    items = [(k, prose(rng, 30)) for k in range(60)]
    copies = [" ".join(t.split()[cut]) for _, t in items]
    index = cgk.ItemIndex(items)
    for shape in ("{} {}", "{1} {0}", "{}"):  # at the start, at the end, alone
        texts = []
        for copy in copies:
            texts += [prose(rng, 50).encode(), shape.format(copy, prose(rng, 40)).encode()]
        data, cuts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        found = {(d, i) for d, i, *_ in index.hits(data, cuts)}
        assert found <= {(2 * k + 1, k) for k in range(60)} and len(found) >= 57


def test_typographic_marks_part_words_and_capitals_of_all_scripts_count_as_small():
    items = [(1, "naïve café menu"), (2, "слова на русском языке"), (3, "λόγος και ἀρχή"), (4, "œuvre šaty ⱥⱥ istanbul"), (5, "one two")]
    index = cgk.ItemIndex(items)
    spans = [
        ("He said “", "naïve café menu", "”—and left"),
        ("«", "Naïve\u00a0CAFÉ\u2003menu", "»"),
        ("ȺİẞK ‘", "СЛОВА НА РУССКОМ ЯЗЫКЕ", "’…"),
        ("", "ΛΌΓΟΣ ΚΑΙ ἈΡΧΉ", " Ⱥ"),
        ("x ", "ŒUVRE ŠATY ȺȺ İSTANBUL", "、y"),
        ("「", "One–Two", "」"),
    ]
    texts = ["".join(s).encode() for s in spans]
    data, cuts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = [(d, i, bytes(data[a:b]).decode(), e) for d, i, a, b, e in index.hits(data, cuts)]
    assert found == [(k, i, spans[k][1], 0) for k, i in enumerate([0, 0, 1, 2, 3, 4])]
    broken = np.frombuffer(b"\xff\xe2\x80 one two \xed\xb2\x80" + "Ⱥ”".encode(), np.uint8)
    assert index.hits(broken, np.array([0, len(broken)])) == [(0, 4, 4, 11, 0)]


def test_hits_are_exact_and_spans_point_at_the_passage(spark):
    rng = random.Random(15)
    items = [(k, prose(rng, 30)) for k in range(20)]
    rows = [(k, f"é {prose(rng, 20)} {edited(rng, items[k % 20][1], 0.1).upper()}. {prose(rng, 300)}") for k in range(60)]
    rows += [(100 + k, prose(rng, 400)) for k in range(40)]
    text, item = dict(rows), dict(items)
    got = contaminations(documents(spark, rows), items_of(spark, items)).collect()
    assert {r.doc_id for r in got} <= set(range(60)) and len({r.doc_id for r in got}) >= 57
    for r in got:
        a = words(item[r.item_id])
        b = words(text[r.doc_id][r.start : r.end].replace(".", " "))
        assert r.edits == distance(a, b) <= 0.15 * len(a)


def test_the_whole_result_against_every_item_in_every_document(spark):
    """All pairs of items and documents by plain dynamic programming: nothing else is found, and the recall holds."""
    rng = random.Random(20)
    items = [(k, prose(rng, rng.randrange(3, 40), 400)) for k in range(40)]
    items += [(100 + k, items[k][1]) for k in range(5)] + [(100, items[0][1])]  # repeated items
    rows = []
    for k in range(120):
        parts = [prose(rng, rng.randrange(0, 30), 400)]
        for _ in range(rng.randrange(3)):
            parts += [edited(rng, rng.choice(items)[1], rng.choice([0, 0.1, 0.15, 0.3])), prose(rng, rng.randrange(0, 30), 400)]
        rows.append((k, " ".join(parts)))
    want = set()
    for d, text in rows:
        b = words(text)
        for i, t in items:
            a = words(t)
            if distance(a, b) <= int(0.15 * len(a)):
                want.add((d, i))
    found = contaminations(documents(spark, rows), items_of(spark, items)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) > 60
    twins = {(d, i - 100 if i >= 100 else i) for d, i in got if i % 100 < 5}
    assert all((d, i) in got and (d, i + 100) in got for d, i in twins)
    spans = [tuple(r) for r in found if r.item_id == 0]
    again = [(d, 0, *rest) for d, i, *rest in map(tuple, found) if i == 100]
    assert sorted(spans * 2) == sorted(again)  # item 100 stands twice in the table


def test_short_items_awkward_rows_and_blocks(spark, monkeypatch):
    rng = random.Random(16)
    rows = awkward(rng)
    items = [(1, None), (2, ""), (3, "..."), (4, "same TEXT twice"), (4, "same text, twice"), (None, "wörds"), (5, "absent one")]
    items += [(10 + k, prose(rng, 40)) for k in range(6)]
    rows += [(900 + k, f"{items[7 + k][1]} end") for k in range(6)] + [(990, items[7][1]), (990, items[7][1])]
    want = [(7, 4)] * 6 + [(8, 4)] * 2 + [(6, None)] + [(900 + k, 10 + k) for k in range(6)] + [(990, 10)] * 2
    docs = documents(spark, rows, clashing=True)
    for size in (cgk.BLOCK_CHARS, 100):  # one block of items, then many
        monkeypatch.setattr(cgk, "BLOCK_CHARS", size)
        found = contaminations(docs, items_of(spark, items))
        assert rows_of(found, "doc_id", "item_id") == sorted(want, key=repr)
    kept = uncontaminated(docs, items_of(spark, items))
    assert kept.columns == docs.columns
    gone = {d for d, _ in want}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in rows if r[0] not in gone), key=repr)


def test_texts_larger_than_a_piece(monkeypatch):
    import pyarrow as pa

    rng = random.Random(17)
    item = prose(rng, 40)
    texts = [prose(rng, 200), f"{prose(rng, 500)} {item}", None, "", item]
    index = cgk.ItemIndex([(1, item)], Search())
    for piece in (64, 1 << 20):
        monkeypatch.setattr(cgk, "_PIECE", piece)
        hits = [row + h[0] for row, data, cuts in cgk._pieces(pa.array(texts)) for h in index.hits(data, cuts)]
        assert hits == [1, 4]


def test_empty_tables(spark):
    none, items = documents(spark, []), items_of(spark, [(1, "a b c")])
    assert contaminations(none, items).collect() == [] and uncontaminated(none, items).collect() == []
    docs = documents(spark, [(1, "a b c")])
    assert contaminations(docs, items_of(spark, [])).collect() == []
    assert uncontaminated(docs, items_of(spark, [])).count() == 1
