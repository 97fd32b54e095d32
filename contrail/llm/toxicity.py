"""Toxicity by multiple-instance learning: sentences are instances, documents are bags.

A sentence has a probability p = sigmoid(bias + sum of the weights of its words' features);
a document is toxic if any of its sentences is. The noisy-or runs over evidence above the
background: a sentence counts q = 1 - (1 - p) / (1 - background), 0 below the background,
and the document's own leak stands for all that no sentence shows: score = 1 - (1 - leak) *
prod(1 - q). The background is ``FLOOR``, and a sentence without a weighted word is never
likelier than that; so neutral sentences, however many, leave the score at the leak, and
weak hints never add up. Only document labels are known; weights, bias and leak are
trained on the bags through the noisy-or (first above the neutral sentence, then above the
floor) and then locate the offending sentences. Features of a word are the word itself and
its prefixes, so unseen inflections of a known stem count.

The classifier is fitted in one task on a bounded sample of labelled documents
(``per_class`` documents of each label, those with the smallest hash of their id; whole
texts). The model has at most ``features`` weights and is all that goes through the
driver. Every document is scored where it is read, without a shuffle.

Defined cases: a null or empty text has no sentence and score 0; a very long text is scored
whole, and its length alone does not move the score; several labels of one id: toxic if any is; labels other than 0 and 1 are skipped;
several rows of one id: all are scored, one is learned from; without labelled rows of
both kinds all scores are 0; an empty table gives no rows; other columns are ignored,
and only the text enters a score.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import table

FOLDS = 5
THRESHOLD = 0.5
FLOOR = 0.05  # a sentence less likely than this is background
_PREFIXES = (4, 5, 6)
_WORD = re.compile(r"\w+")
_BREAK = re.compile(r"(?<=[.!?])\s+|\n+")


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the training; the sample has 2 * per_class documents at most."""

    per_class: int = 2000
    features: int = 20_000
    epochs: int = 200
    rate: float = 0.15
    l2: float = 0.05
    alpha: float = 5.0  # features let in by chance, expected


def features(word: str) -> list[str]:
    """The word in lower case and its prefixes (marked by a trailing ``*``)."""
    low = word.lower()
    return [low, *(low[:n] + "*" for n in _PREFIXES if len(low) > n)]


def sentences(text: str):
    """(start, end) of the sentences: cut at line ends and after . ! ? before a blank."""
    at = 0
    for cut in _BREAK.finditer(text):
        if cut.start() > at:
            yield at, cut.start()
        at = cut.end()
    if at < len(text):
        yield at, len(text)


def _bag(text: str) -> list[list[str]]:
    return [[f for w in _WORD.findall(text, a, b) for f in features(w)] for a, b in sentences(text)]


_NOTHING = {"weights": {}, "bias": -math.inf, "leak": -math.inf}  # learned from no labels
_FLOOR_AT = math.log(FLOOR / (1 - FLOOR))


def _divergence(a: float, b: float) -> float:
    """Kullback-Leibler divergence of two coins."""
    return (a * math.log(a / b) if a else 0.0) + ((1 - a) * math.log((1 - a) / (1 - b)) if a < 1 else 0.0)


def train(texts: list[str], labels: np.ndarray, prior: float, fit: Fit) -> dict:
    """Weights {feature: weight} and bias by gradient steps (Adam) on the noisy-or likelihood.

    prior: share of toxic documents among all labelled ones; the classes are weighed
    so that the sample counts like it.
    """
    y = np.asarray(labels, dtype=float)
    bags = [_bag(t) for t in texts]
    keep = [k for k, bag in enumerate(bags) if bag]
    bags, y = [bags[k] for k in keep], y[keep]
    n1, n0 = y.sum(), (1 - y).sum()
    if not n1 or not n0:
        return dict(_NOTHING)
    # Only features tied to the label beyond chance: the chance (Chernoff bound) that a
    # random feature is split so unevenly, times the number of features, is below alpha.
    in1, in0 = Counter(), Counter()
    for bag, label in zip(bags, y):
        (in1 if label else in0).update(set(chain.from_iterable(bag)))
    seen = {f: in1[f] + in0[f] for f in in1.keys() | in0.keys()}
    seen = {f: n for f, n in seen.items() if n >= 3}
    q, need = n1 / (n1 + n0), math.log(max(1, len(seen)) / fit.alpha)
    odd = {f: n * _divergence(in1[f] / n, q) for f, n in seen.items()}
    ranked = sorted((f for f in odd if odd[f] > need), key=lambda f: (-odd[f], f))
    chosen = {f: k for k, f in enumerate(ranked[: fit.features])}
    rows, cols, owner = [], [], []
    for d, bag in enumerate(bags):
        for words in bag:
            got = [chosen[f] for f in set(words) if f in chosen]
            rows += [len(owner)] * len(got)
            cols += got
            owner.append(d)
    rows, cols, owner = np.array(rows), np.array(cols, dtype=np.int64), np.array(owner)
    w, bias, leak = np.zeros(len(chosen)), -3.0, -3.0
    weigh = np.where(y == 1, prior / n1, (1 - prior) / n0)
    weigh = weigh / weigh.mean()
    first, second = np.zeros(len(w) + 2), np.zeros(len(w) + 2)
    for step in range(1, fit.epochs + 1):
        neutral = step <= fit.epochs // 2
        level = bias if neutral else _FLOOR_AT
        score = bias + np.bincount(rows, w[cols], minlength=len(owner))
        shows = score >= level
        above = np.where(shows, np.logaddexp(0, score) - np.logaddexp(0, level), 0.0)
        none = np.logaddexp(0, leak) + np.bincount(owner, above, minlength=len(y))  # -log of "nothing toxic"
        pull = np.where(y == 1, -1 / np.expm1(np.clip(none, 1e-9, 500)), 1.0) * weigh / len(y)
        slope = np.where(shows, pull[owner] / (1 + np.exp(-score)), 0.0)
        by_bias = slope.sum() - (pull[owner][shows].sum() / (1 + np.exp(-level)) if neutral else 0.0)
        grad = np.r_[
            np.bincount(cols, slope[rows], minlength=len(w)) + fit.l2 / len(y) * w,
            by_bias,
            pull.sum() / (1 + np.exp(-leak)),
        ]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        move = fit.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        w, bias, leak = w - move[:-2], min(bias - move[-2], _FLOOR_AT), leak - move[-1]
    weights = {f: float(w[k]) for f, k in chosen.items() if abs(w[k]) > 1e-4}
    return {"weights": weights, "bias": float(bias), "leak": float(min(leak, 0.0))}


class _Marked(dict):
    """word -> whether a feature of it has a weight; filled as words are met, emptied when large."""

    def __init__(self, weights: dict, most: int = 500_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> bool:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = any(f in self.weights for f in features(word))
        return found


def score_text(text: str | None, weigh: _Marked, bias: float, leak: float):
    """(score, sentences, offending sentences as start:end, the likeliest sentence's p)."""
    if not text:
        return 0.0, 0, "", 0.0
    none = _softplus(leak)
    marked = [w for w in set(_WORD.findall(text)) if weigh[w]]
    if not marked:  # every sentence is background
        count = sum(1 for _ in sentences(text))
        return (-math.expm1(-none), count, "", _sigmoid(bias)) if count else (0.0, 0, "", 0.0)
    count, top, spots = 0, 0.0, []
    for a, b in sentences(text):
        count += 1
        got = {f for w in set(_WORD.findall(text, a, b)) if weigh[w] for f in features(w)}
        z = bias + sum(weigh.weights.get(f, 0.0) for f in got)
        if z > _FLOOR_AT:
            none += _softplus(z) - _softplus(_FLOOR_AT)
        p = _sigmoid(z)
        top = max(top, p)
        if p >= THRESHOLD:
            spots.append(f"{a}:{b}")
    return -math.expm1(-none), count, ",".join(spots), top


def _softplus(z: float) -> float:
    return math.log1p(math.exp(z)) if z < 30 else z


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def held_out() -> "F.Column":
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> dict:
    """Model from the labels outside the held-out fold."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return dict(_NOTHING)
    prior = counts[1] / (counts[0] + counts[1])
    order = F.xxhash64("doc_id")
    chosen = known.filter("toxic = 1").orderBy(order, "doc_id").limit(fit.per_class).union(
        known.filter("toxic = 0").orderBy(order, "doc_id").limit(fit.per_class)
    )
    # At most 2 * per_class ids: the broadcast is bounded by that parameter.
    sample = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.max("text").alias("text"))
        .filter("text IS NOT NULL")
    )

    def learn(frames):
        rows = pd.concat([f for f in frames] or [pd.DataFrame({"doc_id": [], "toxic": [], "text": []})])
        rows = rows.sort_values("doc_id")
        model = train(rows["text"].tolist(), rows["toxic"].to_numpy(), prior, fit)
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    made = sample.repartition(1).mapInPandas(learn, "model binary").first()
    return pickle.loads(made.model) if made else dict(_NOTHING)


def scorer(spark: SparkSession, model: dict):
    """Column function text -> struct(score, n_sentences, offending, worst)."""
    shared = spark.sparkContext.broadcast(model)  # at most Fit.features weights

    @F.pandas_udf("score double, n_sentences int, offending string, worst double")
    def score(texts: pd.Series) -> pd.DataFrame:
        weigh, bias, leak = _Marked(shared.value["weights"]), shared.value["bias"], shared.value["leak"]
        if bias == -math.inf:
            return pd.DataFrame({"score": 0.0, "n_sentences": 0, "offending": "", "worst": 0.0}, index=texts.index)
        found = [score_text(t, weigh, bias, leak) for t in texts]
        return pd.DataFrame(found, columns=["score", "n_sentences", "offending", "worst"], index=texts.index)

    return score


def toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, offending (start:end, ...), worst."""
    score = scorer(docs.sparkSession, fit_model(docs, labels, fit))
    return (
        docs.select("doc_id", held_out().alias("held_out"), score(F.col("text").cast("string")).alias("s"))
        .select("doc_id", "held_out", "s.*")
        .select(
            "doc_id",
            "held_out",
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
            "n_sentences",
            "offending",
            "worst",
        )
    )


def clean_documents(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    score = scorer(docs.sparkSession, fit_model(docs, labels, fit))
    kept = score(F.col("text").cast("string"))["score"] < THRESHOLD
    return docs.filter(kept)


def op1_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or toxicity score of every document, with its offending sentences."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
