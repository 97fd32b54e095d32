import math
import random
import re
import zlib

import numpy as np
from tests.llm.helpers import CLASHING, awkward, documents, prose

from contrail.llm import toxicity as tox

BAD = ("vilezu", "vileka", "grimbol", "snarfet")


def corpus(rng, n=700):
    rows, labels = [], []
    for k in range(n):
        parts = [prose(rng, rng.randrange(4, 12)).capitalize() + "." for _ in range(rng.randrange(1, 12))]
        bad = k % 4 == 0
        if bad:
            at = rng.randrange(len(parts))
            parts[at] = f"So {rng.choice(BAD)} {parts[at]}"
        rows.append((k, " ".join(parts)))
        labels.append((k, 1, int(bad)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_located_sentences(spark):
    rows, labels = corpus(random.Random(8))
    got = {r.doc_id: r for r in tox.toxicity(documents(spark, rows), labelled(spark, labels)).collect()}
    right = 0
    for (doc, text), (_, _, bad) in zip(rows, labels):
        r = got[doc]
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.5)
        if r.held_out:
            right += r.predicted == bad
            if bad and r.predicted and r.offending:
                spans = [tuple(map(int, s.split(":"))) for s in r.offending.split(",")]
                assert any(w in text[a:b].lower() for a, b in spans for w in BAD)
    held = [r for r in got.values() if r.held_out]
    assert right / len(held) >= 0.97


def test_held_out_labels_are_not_learned(spark):
    rows, labels = corpus(random.Random(9), 300)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    docs = documents(spark, rows)
    assert tox.fit_model(docs, labelled(spark, labels)) == tox.fit_model(docs, labelled(spark, flipped))


def test_noisy_or_of_evidence_above_the_background():
    model = {"bad": 4.0}
    text = "Good one. A bad one!\nBad bad again"
    score, n, offending, top = tox.score_text(text, tox._Marked(model), -3.0, -5.0)
    p, leak = 1 / (1 + np.exp(-1.0)), 1 / (1 + np.exp(5.0))
    shows = (1 - p) / (1 - tox.FLOOR)
    assert n == 3 and abs(score - (1 - (1 - leak) * shows * shows)) < 1e-12 and abs(top - p) < 1e-12
    assert [text[int(a) : int(b)] for a, b in (s.split(":") for s in offending.split(","))] == [
        "A bad one!",
        "Bad bad again",
    ]


def plain_score(text, model):
    """Brute force: every sentence's probability, then the noisy-or."""
    if not (text or "") or not re.split(r"(?<=[.!?])\s+|\n+", text):
        return 0.0
    parts = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if s]
    nothing = 1 - 1 / (1 + math.exp(-model["leak"]))
    for part in parts:
        names = {f for w in re.findall(r"\w+", part) for f in [w.lower(), *(w.lower()[:n] + "*" for n in (4, 5, 6) if len(w.lower()) > n)]}
        p = 1 / (1 + math.exp(-(model["bias"] + sum(model["weights"].get(f, 0.0) for f in names))))
        nothing *= min(1.0, (1 - p) / (1 - tox.FLOOR))
    return 1 - nothing if parts else 0.0


def test_every_row_scores_as_by_brute_force(spark):
    rows, labels = corpus(random.Random(13), 400)
    rows += [(10_000 + r[0] if r[0] is not None else None, r[1]) for r in awkward(random.Random(14))]
    docs, known = documents(spark, rows), labelled(spark, labels)
    model = tox.fit_model(docs, known)
    got = sorted((r.doc_id or -1, r.score) for r in tox.toxicity(docs, known).collect())
    want = sorted((r[0] or -1, plain_score(r[1], model)) for r in rows)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, want))


def test_length_alone_makes_no_text_toxic(spark):
    rows, labels = corpus(random.Random(15))
    docs = documents(spark, rows)
    model = tox.fit_model(docs, labelled(spark, labels))
    marked = tox._Marked(model["weights"])
    rng = random.Random(16)
    scores = []
    for n in (1, 10, 100, 1000, 10_000, 100_000):
        plain = [prose(rng, 6).capitalize() + "." for _ in range(n)]
        score, count, offending, _ = tox.score_text(" ".join(plain), marked, model["bias"], model["leak"])
        assert count == n and score < 0.5 and not offending
        scores.append(score)
        at = rng.randrange(n)
        plain[at] = f"So vilezu grimbol {plain[at]}"
        text = " ".join(plain)
        score, _, offending, _ = tox.score_text(text, marked, model["bias"], model["leak"])
        spans = [tuple(map(int, s.split(":"))) for s in offending.split(",")]
        assert score >= 0.5 and ["vilezu" in text[a:b] for a, b in spans] == [True]
    assert max(scores) - min(scores) < 0.1


def test_training_gradient_lowers_the_loss():
    rng = random.Random(10)
    rows, labels = corpus(rng, 200)
    y = np.array([t for _, _, t in labels])
    loss = []
    for epochs in (5, 100):
        m = tox.train([t for _, t in rows], y, 0.25, tox.Fit(epochs=epochs))
        p = np.clip([tox.score_text(t, tox._Marked(m["weights"]), m["bias"], m["leak"])[0] for _, t in rows], 1e-9, 1 - 1e-9)
        loss.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    assert loss[1] < loss[0]


def test_awkward_rows_and_labels(spark):
    rows, labels = corpus(random.Random(11), 200)
    rows += [(10_000 + r[0] if r[0] is not None else None, r[1]) for r in awkward(random.Random(12))]
    labels += [(None, 1, 1), (10_001, None, None), (10_007, 0, 0), (0, 0, 0), (0, 0, 1), (99_999, 1, 1)]
    got = tox.toxicity(documents(spark, rows, clashing=True), labelled(spark, labels)).collect()
    assert len(got) == len(rows)
    assert all(r.score == 0 for r in got if r.doc_id in (10_001, 10_002))
    assert all(r.held_out is not None for r in got)


def test_without_labels_nothing_is_toxic(spark):
    docs = documents(spark, [(1, "a b"), (2, None)], clashing=True)
    for labels in ([], [(1, 1, 1)], [(1, 1, None)]):
        assert {r.score for r in tox.toxicity(docs, labelled(spark, labels)).collect()} == {0.0}
    kept = tox.clean_documents(docs, labelled(spark, []))
    assert kept.columns == docs.columns and kept.count() == 2
    assert CLASHING.split()[0] in kept.columns


def test_empty_table(spark):
    assert tox.toxicity(documents(spark, []), labelled(spark, [])).collect() == []
    assert tox.toxicity(documents(spark, []), labelled(spark, [(1, 1, 1), (2, 0, 0)])).collect() == []
