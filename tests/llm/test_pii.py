import itertools
import random
import re
import time

import numpy as np
import pytest
from tests.llm.helpers import awkward, documents

from contrail.llm import pii

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 0:
        return True
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 3:
        return 9 <= len(digits) <= 15
    total = sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits)))
    return 12 <= len(digits) <= 19 and total % 10 == 0


def plain(text):
    """The contract's patterns as they stand."""
    return sorted(
        (m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if passes(k, m[0])
    )


@pytest.fixture(scope="module")
def model():
    return pii.train(pii.labelled_rows())


def test_rules_match_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(6000):
        text = "".join(rng.choice("ab.Z@@..--_%++  0123456789(é") for _ in range(rng.randrange(1, 70)))
        assert pii.base_spans(text) == plain(text), text
    for _ in range(500):
        words = [w for k in range(6) for w in (pii._entity(rng, rng.choice(pii.BASE)) if k % 2 else pii._number(rng))]
        text = rng.choice([" ", "", ", ", "@"]).join(words)
        assert pii.base_spans(text) == plain(text), text


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(0)
    n, steps, k = 4, 5, len(pii.TAGS)
    emit, trans = rng.normal(size=(n, steps, k)), rng.normal(size=(k, k))
    used = np.arange(steps) < np.array([5, 3, 1, 4])[:, None]
    tags = rng.integers(0, k, (n, steps)) * used
    score, by_emit, by_trans = pii.likelihood(emit, trans, tags, used)
    assert score < 0
    for _ in range(20):
        i, j, a, b = rng.integers(n), rng.integers(steps), *rng.integers(k, size=2)
        more, moved = emit.copy(), trans.copy()
        more[i, j, a] += 1e-5
        moved[a, b] += 1e-5
        assert abs((pii.likelihood(more, trans, tags, used)[0] - score) / 1e-5 - by_emit[i, j, a]) < 1e-3
        assert abs((pii.likelihood(emit, moved, tags, used)[0] - score) / 1e-5 - by_trans[a, b]) < 1e-3


def test_likelihood_is_that_of_all_paths():
    rng = np.random.default_rng(1)
    emit, trans = rng.normal(size=(1, 3, 3)), rng.normal(size=(3, 3))

    def path(tags):
        return trans[0, tags[0]] + sum(emit[0, t, g] for t, g in enumerate(tags)) + trans[tags[0], tags[1]] + trans[
            tags[1], tags[2]
        ] + trans[tags[2], 0]

    whole = np.log(sum(np.exp(path(p)) for p in itertools.product(range(3), repeat=3)))
    score, _, _ = pii.likelihood(emit, trans, np.array([[2, 0, 1]]), np.ones((1, 3), bool))
    assert abs(score - (path((2, 0, 1)) - whole)) < 1e-9


def best_path(emit, moves):
    """Viterbi over all words of a text, one by one."""
    score, back = moves[0] + emit[0], []
    for e in emit[1:]:
        total = score[:, None] + moves
        back.append(total.argmax(0))
        score = total.max(0) + e
    out = [int((score + moves[:, 0]).argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def test_decoding_finds_the_best_path_of_whole_texts(model, monkeypatch):
    monkeypatch.setattr(pii, "_STEPS", 7)
    rng = random.Random(3)
    tagger = pii.Tagger(model)
    for n in [1, 2, 3, 8, 40] * 12 + [400]:
        rows = pii.labelled_rows(n, rng.randrange(10**6))
        words = [w for sentence, _ in rows for w in sentence]
        if n > 8:
            words += ["4111", "2222", "(743)", "555"] * 40  # a long stretch that may be inside
        ids = np.array([tagger.ids[w] for w in words], np.int64)
        emit = tagger.scores(ids)
        want = best_path(emit, model["moves"])
        open_ = tagger.open_words(emit - emit[:, :1])
        assert all(open_[k] or not want[k] for k in range(len(words)))
        starts, _, tags = tagger.tags(" ".join(words))
        got = dict(zip(starts.tolist(), tags.tolist()))
        places = np.cumsum([0, *[len(w) + 1 for w in words[:-1]]])
        found = [got.get(int(p), 0) for p in places]
        total = lambda path: model["moves"][0, path[0]] + model["moves"][path[-1], 0] + sum(
            emit[k, t] + (model["moves"][path[k - 1], t] if k else 0) for k, t in enumerate(path)
        )
        assert abs(total(found) - total(want)) < 1e-6


def test_random_weights_decode_exactly():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(30)]
    for trial in range(40):
        moves = rng.normal(size=(9, 9)) + pii._BARRED
        tagger = pii.Tagger({"weights": {}, "moves": moves})
        tagger.table = rng.normal(size=(64, 3, 9)) * 2
        tagger.table[:, 0, 0] += trial / 10
        for k, w in enumerate(words):
            tagger.ids[w] = k
        text = [words[k] for k in rng.integers(0, 30, 300)]
        emit = tagger.scores(np.array([tagger.ids[w] for w in text]))
        want = best_path(emit, moves)
        starts, _, tags = tagger.tags(" ".join(text))
        places = np.cumsum([0, *[len(w) + 1 for w in text[:-1]]])
        got = dict(zip(starts.tolist(), tags.tolist()))
        assert [got.get(int(p), 0) for p in places] == want


def test_held_out_accuracy(model):
    tagger = pii.Tagger(model)
    right = total = 0
    for words, tags in pii.labelled_rows(400, seed=99):
        starts, _, found = tagger.tags(" ".join(words))
        got = dict(zip(starts.tolist(), found.tolist()))
        at = 0
        for w, tag in zip(words, tags):
            right += pii.TAGS[got.get(at, 0)] == tag
            total += 1
            at += len(w) + 1
    assert right / total >= 0.985


def test_the_field_adds_forms_without_a_rule(model):
    tagger = pii.Tagger(model)
    text = "Call (743) 555-3824 or write to anna (at) lore (dot) org, card 4111.1111.1111.1111 not 2024 or v1.2.3."
    found = {(pii.KINDS[k], text[a:b]) for a, k, b in pii.all_spans(text, tagger)}
    assert ("crf_phone", "(743) 555-3824") in found and ("crf_card", "4111.1111.1111.1111") in found
    assert any(k == "crf_email" and "(at)" in t for k, t in found)
    assert not any("2024" in t or "1.2.3" in t for _, t in found)


def test_query_rows_and_awkward_texts(spark, model):
    rng = random.Random(6)
    rows = awkward(rng) + [
        (900, "é a.b@c.de 10.0.0.255, 4111 1111 1111 1111 +1 (743) 555-3824"),
        (901, "1.2.3.4.5.6.7.8 300.1.1.1 a@b@c.d.e_f@g.hi"),
        (902, " ".join(["word"] * 300_000 + ["x@y.zz"])),
    ]
    got = pii.scan(documents(spark, rows, clashing=True), pii.labelled_table(spark)).collect()
    assert len(got) == len(rows)
    tagger = pii.Tagger(model)
    want = {}
    for doc, text, *_ in rows:
        spans = [{"start": a, "kind": pii.KINDS[k], "end": b} for a, k, b in pii.all_spans(text or "", tagger)]
        assert [(s["start"], s["end"]) for s in spans if s["kind"] in pii.BASE] == [(a, b) for a, _, b in plain(text or "")]
        want.setdefault(doc, []).append(spans)
    for r in got:
        assert [s.asDict() for s in r.spans] in want[r.doc_id]


def test_without_labelled_rows_the_rules_stay(spark):
    none = pii.labelled_table(spark).limit(0)
    (row,) = pii.scan(documents(spark, [(1, "a@b.cd (743) 555-3824")]), none).collect()
    assert [(s.start, s.kind, s.end) for s in row.spans] == [(0, "email", 6)]
    assert pii.scan(documents(spark, []), none).collect() == []


def test_long_hostile_texts_take_linear_time(model):
    tagger = pii.Tagger(model)
    for text in ("a" * 3_000_000, "1" * 3_000_000, "1." * 1_500_000, "+1 " * 1_000_000, "a@" * 1_500_000, "1 " * 1_500_000):
        start = time.time()
        pii.all_spans(text, tagger)
        assert time.time() - start < 30
