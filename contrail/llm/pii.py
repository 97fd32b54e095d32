"""Personal data: exact rules, and a linear-chain conditional random field beside them.

The rules (``BASE``) find addresses, IP numbers, payment cards and phone numbers by their
written form. The field tags every word of a text as outside, or as the begin or inside of
one of these kinds, from features of its shape (runs of digits, letters and signs, counted)
and of its neighbours' shapes; so it also finds forms that no rule covers, such as "name
(at) host (dot) org", phone numbers without a plus sign or cards cut up by dots. Its weights
are fitted by gradient steps on the exact log-likelihood (forward-backward) of a small
labelled table; ``Fit.sentences`` bounds it, and ``labelled_table`` makes one by rule. The
weights are all that passes through the driver.

Texts are tagged where they are read, without a shuffle. On the best path every entity gains
something over its words being outside; running sums bound what the best entity through a
word may gain, and most words cannot lie in any. What is left are short stretches between
words that are outside for certain. They are decoded by Viterbi in numpy batches, long ones
in pieces for every start tag at once, and the pieces are chained; the result is the best
path of the whole text.

Spans of the field that meet no span of a rule are added as kinds ``crf_...``; all spans of
the rules stay.

Defined cases: a null or empty text has no spans; spans are code points, end exclusive;
matches of one rule are leftmost and non-overlapping before the failing ones are dropped;
words are cut at ASCII blanks; equal scores take the earlier tag; repeated rows are scanned
each; very long texts are scanned whole, in time linear in their length; an empty labelled
table adds no spans; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import WORD, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, *(f"crf_{k}" for k in BASE))
TAGS = ("O", *(f"{p}-{k}" for k in BASE for p in "BI"))
_TAG = {t: k for k, t in enumerate(TAGS)}
_K = len(TAGS)

# ---------------------------------------------------------------- rules

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each sign's local part reaches back as far as its characters go, not into the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits with a sign between each two
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


RULES = (emails, ips, cards, phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), in order."""
    return sorted((a, k, b) for k, rule in enumerate(RULES) for a, b in rule(text))


# ---------------------------------------------------------------- features

_RUN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.DOTALL)
_SHOWN = frozenset("+-.@:/()[]_=#,")
_EDGE = "*$%&!;?\"'<>{},"


def _case(letters: str) -> str:
    return "X" if letters.isupper() else "Xx" if letters[0].isupper() else "x"


def shape(word: str) -> str:
    """Runs of digits with their length (10 at most), letters by their case, signs as they are."""
    out = []
    for run in _RUN.findall(word[:64]):
        if "0" <= run[0] <= "9":
            out.append(f"d{min(len(run), 10)}")
        elif run.isalpha():
            out.append(_case(run))
        elif run[0] in _SHOWN:
            out.append(run[0])
        elif not out or out[-1] != "~":
            out.append("~")
    return "".join(out)


_LONGEST = 12  # letters of a word that counts as itself


def features(word: str) -> list[str]:
    """Of the word itself; the first three are what its neighbours see of it."""
    core = word.strip(_EDGE).rstrip(".") or word
    form = shape(core)
    digits = _NOT_DIGIT.sub("", core) if any("0" <= c <= "9" for c in core) else ""
    low = core.strip("()[].:")
    found = [
        "c=" + re.sub(r"d\d+", "d", form)[:20],
        f"n={min(len(digits), 20)}",
        "w=" + core.lower() if low.isalpha() and len(low) <= _LONGEST else "w",
        "s=" + form[:28],
    ]
    if 12 <= len(digits) <= 19 and len(digits) == len(core):
        found.append("luhn" if luhn(digits) else "no luhn")
    if word[-1:] in ".,;:!?":
        found.append("ends")
    return found


_SEEN = 3  # features that neighbours see


# ---------------------------------------------------------------- training


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the training: the labelled rows and the rounds over them."""

    sentences: int = 2000
    seen: int = 3  # uses of a feature in the table, at least
    epochs: int = 80
    rate: float = 0.2
    l2: float = 0.3


def _names(words: list[str], k: int) -> list[str]:
    """Features of word k with its neighbours'."""
    out = features(words[k])
    if k:
        out = out + ["<" + f for f in features(words[k - 1])[:_SEEN]]
    if k + 1 < len(words):
        out = out + [">" + f for f in features(words[k + 1])[:_SEEN]]
    return out


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + np.squeeze(top, axis)


# An inside tag only follows its own kind; elsewhere a move costs what no evidence outweighs.
_BARRED = np.array([[-1e3 if b and b % 2 == 0 and a not in (b - 1, b) else 0.0 for b in range(_K)] for a in range(_K)])


def likelihood(emit: np.ndarray, trans: np.ndarray, tags: np.ndarray, used: np.ndarray):
    """Log-likelihood of padded sentences, and its gradients by emission and transition.

    emit: (sentences, steps, tags); used: which steps a sentence has. A sentence starts and
    ends in the tag O.
    """
    n, steps, k = emit.shape
    rows = np.arange(n)
    last = used.sum(1) - 1
    ahead = np.zeros((steps, n, k))
    ahead[0] = trans[0] + emit[:, 0]
    for t in range(1, steps):
        ahead[t] = _logsum(ahead[t - 1][:, :, None] + trans, 1) + emit[:, t]
    back = np.zeros((steps, n, k))
    for t in range(steps - 1, -1, -1):
        inner = _logsum(trans + (emit[:, t + 1] + back[t + 1])[:, None, :], 2) if t + 1 < steps else 0.0
        back[t] = np.where((last == t)[:, None], trans[:, 0], inner)
    whole = _logsum(ahead[last, rows] + trans[:, 0], 1)
    seen = used.T[:, :, None]
    after = np.where(seen, np.exp(ahead + back - whole[:, None]), 0.0).transpose(1, 0, 2)
    gold = np.eye(k)[tags] * used[:, :, None]
    moves = np.zeros((k, k))
    for t in range(1, steps):
        both = used[:, t]
        pair = ahead[t - 1][:, :, None] + trans + (emit[:, t] + back[t])[:, None, :] - whole[:, None, None]
        moves -= np.exp(pair[both]).sum(0)
        np.add.at(moves, (tags[both, t - 1], tags[both, t]), 1)
    moves[0] += gold[:, 0].sum(0) - after[:, 0].sum(0)
    ends = gold[rows, last].sum(0) - after[rows, last].sum(0)
    moves[:, 0] += ends
    score = (emit * gold).sum() + trans[0][tags[:, 0]].sum() + trans[tags[rows, last], 0].sum()
    for t in range(1, steps):
        score += trans[tags[used[:, t], t - 1], tags[used[:, t], t]].sum()
    return score - whole.sum(), gold - after, moves


def train(sentences: list[tuple[list[str], list[str]]], fit: Fit = Fit()) -> dict:
    """{"weights": {feature: vector of tags}, "moves": tag to tag} by Adam on the likelihood."""
    sentences = [(w, t) for w, t in sentences if len(w)]
    if not sentences:
        return {"weights": {}, "moves": None}
    n, steps = len(sentences), max(len(w) for w, _ in sentences)
    tags, used = np.zeros((n, steps), np.int64), np.zeros((n, steps), bool)
    index: dict[str, int] = {}
    owner, cols = [], []
    for s, (words, marks) in enumerate(sentences):
        for k in range(len(words)):
            tags[s, k], used[s, k] = _TAG[marks[k]], True
            for name in _names(words, k):
                owner.append(s * steps + k)
                cols.append(index.setdefault(name, len(index)))
    owner, cols = np.array(owner), np.array(cols)
    often = np.bincount(cols, minlength=len(index)) >= fit.seen
    place = np.cumsum(often) - 1
    index = {f: int(place[k]) for f, k in index.items() if often[k]}
    owner, cols = owner[often[cols]], place[cols[often[cols]]]
    shapes = (len(index), _K)
    flat = np.zeros(shapes[0] * _K + _K * _K)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, fit.epochs + 1):
        w, trans = flat[: -_K * _K].reshape(shapes), flat[-_K * _K :].reshape(_K, _K)
        emit = np.stack([np.bincount(owner, w[cols, k], minlength=n * steps) for k in range(_K)], 1)
        _, pull, moves = likelihood(emit.reshape(n, steps, _K), trans + _BARRED, tags, used)
        pull = pull.reshape(-1, _K)[owner]
        grad = np.stack([np.bincount(cols, pull[:, k], minlength=shapes[0]) for k in range(_K)], 1)
        grad = (np.r_[grad.ravel(), moves.ravel()] - fit.l2 * flat) / n
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        flat = flat + fit.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    w = flat[: -_K * _K].reshape(shapes)
    return {"weights": {f: w[k].copy() for f, k in index.items()}, "moves": flat[-_K * _K :].reshape(_K, _K) + _BARRED}


# ---------------------------------------------------------------- the labelled table

# Words that stand beside personal data, and beside numbers that are none.
_NEAR = {
    "email": "mail email contact write reply from".split(),
    "ip": "ip host server from ping address".split(),
    "card": "card visa credit debit paid number".split(),
    "phone": "phone call tel mobile fax dial".split(),
}
_ELSE = "order invoice year version page isbn total price room chapter token id build line".split()
_SYLLABLES = "an der la ti on en re st ou que ción lich schö é ü ara men to ve ri ba lo mi su de".split()


def _digits(rng: random.Random, n: int) -> str:
    return "".join(str(rng.randrange(10)) for _ in range(n))


def _valid_card(rng: random.Random, n: int = 16) -> str:
    body = str(rng.randrange(1, 10)) + _digits(rng, n - 2)
    return next(body + str(k) for k in range(10) if luhn(body + str(k)))


def _plain(rng: random.Random) -> str:
    word = "".join(rng.choice(_SYLLABLES) for _ in range(rng.randrange(1, 4)))
    word = rng.choice([word] * 6 + [word.capitalize(), word.upper()])
    return word + rng.choice([""] * 6 + [",", ".", "!", "***", "%%%", "?"])


def _entity(rng: random.Random, kind: str) -> list[str]:
    name = lambda: "".join(rng.choice(_SYLLABLES[:6]) for _ in range(2))
    d = lambda n: _digits(rng, n)
    if kind == "email":
        a, b, c = name(), name(), rng.choice(["com", "org", "net"])
        forms = [f"{a}.{d(2)}@{b}.{c}", f"{a}_{b}@mail.{b}.{c}", f"{a} (at) {b} (dot) {c}", f"{a}(at){b}.{c}",
                 f"{a}[at]{b}.{c}", f"{a} [at] {b} [dot] {c}", f"{a}@{b}"]
    elif kind == "ip":
        quad = ".".join(str(rng.randrange(256)) for _ in range(4))
        tail = ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(4))
        forms = [quad, quad, f"{quad}:{rng.randrange(1000, 9999)}", f"{quad}/24", f"fe80::{tail}"]
    elif kind == "card":
        c = _valid_card(rng)
        four = [c[k : k + 4] for k in (0, 4, 8, 12)]
        forms = [c, " ".join(four), "-".join(four), ".".join(four), "/".join(four), "_".join(four)]
    else:
        a, b, c = d(3), d(3), d(4)
        forms = [f"+1 ({a}) {b}-{c}", f"+{d(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}",
                 f"0{d(2)} {d(4)} {c}", f"00 {d(2)} {a} {b} {c}"]
    return rng.choice(forms).split()


def _number(rng: random.Random) -> list[str]:
    d = lambda n: _digits(rng, n)
    n = rng.randrange(1, 7)
    return rng.choice(
        [d(n), f"{rng.randrange(1900, 2030)}", f"20{d(2)}-0{rng.randrange(1, 10)}-1{d(1)}", f"1{d(1)}:{d(2)}", f"{d(1)}.{d(2)}",
         f"v{d(1)}.{d(1)}.{d(1)}", f"${d(2)}.{d(2)}", f"{d(2)}%", f"{d(1)},{d(3)},{d(3)}", f"978-3-16-{d(6)}-0", f"#{d(5)}",
         f"A-{d(4)}", "".join(rng.choice("0123456789abcdef") for _ in range(40)), f"http://www.x{d(1)}.org/{d(3)}", "@handle",
         'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"', f"{d(3)} {d(2)} {d(3)}", "at", "at at", "dot", str(int(_valid_card(rng)) + 1), d(rng.randrange(7, 12))]
    ).split()


def labelled_rows(n: int = 600, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """Sentences by rule: made-up words, personal data in many written forms, other numbers."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words, tags = [], []
        for _ in range(rng.randrange(1, 4)):
            filler = [_plain(rng) for _ in range(rng.randrange(0, 4))]
            roll = rng.random()
            if roll < 0.5:
                kind = rng.choice(BASE)
                lead = [rng.choice(_NEAR[kind])] if rng.random() < 0.4 else []
                got = _entity(rng, kind)
                marks = [f"B-{kind}", *[f"I-{kind}"] * (len(got) - 1)]
                if rng.random() < 0.25:
                    got[-1] += rng.choice([",", ".", "%%%", "!!", "$$$"])
            else:
                lead = [rng.choice(_ELSE)] if roll < 0.7 else []
                got = _number(rng) if roll < 0.85 else [_plain(rng)]
                marks = ["O"] * len(got)
            words += filler + lead + got
            tags += ["O"] * (len(filler) + len(lead)) + marks
        tail = [_plain(rng) for _ in range(rng.randrange(0, 3))]
        out.append((words + tail, tags + ["O"] * len(tail)))
    return out


def labelled_table(spark: SparkSession, n: int = 600, seed: int = 11) -> DataFrame:
    """sentence, words, tags: a small training table."""
    rows = [(k, w, t) for k, (w, t) in enumerate(labelled_rows(n, seed))]
    return spark.createDataFrame(rows, "sentence long, words array<string>, tags array<string>")


def fit_model(labelled: DataFrame, fit: Fit = Fit()) -> dict:
    """The field's weights, fitted in one task from ``Fit.sentences`` labelled rows at most."""
    rows = labelled.select("sentence", "words", "tags").orderBy("sentence").limit(fit.sentences)

    def learn(frames):
        given = pd.concat([*frames] or [pd.DataFrame({"sentence": [], "words": [], "tags": []})]).sort_values("sentence")
        yield pd.DataFrame({"model": [pickle.dumps(train([(list(w), list(t)) for w, t in zip(given.words, given.tags)], fit))]})

    made = rows.repartition(1).mapInPandas(learn, "model binary").first()
    return pickle.loads(made.model) if made else {"weights": {}, "moves": None}


# ---------------------------------------------------------------- decoding

_WORD = re.compile(WORD)
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_PIECE = 1 << 20  # characters cut into words at once
_STEPS = 128  # words of a piece of a long stretch
_LANES = 4096  # pieces decoded at once


def _pieces(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of a text, cut between words."""
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + _PIECE)
        stop = cut.start() if cut else len(text)
        yield at, stop
        at = stop


def _bounds(text: str, at: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a piece."""
    codes = np.frombuffer(text[at:stop].encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, blank, True].astype(np.int8)))
    return edge[0::2] + at, edge[1::2] + at


class _Words(dict):
    """word -> row of the tagger's table; filled as words are met."""

    def __init__(self, number):
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> int:
        k = self[word] = self.number(word)
        return k


class Tagger:
    """Decodes texts with a fitted field."""

    def __init__(self, model: dict, most: int = 1_000_000):
        self.weights, self.moves, self.most = model["weights"], model["moves"], most
        self.vocabulary = {f[f.index("=") + 1 :] for f in self.weights if f.lstrip("<>").startswith("w=")}
        self._clear()
        if self.moves is not None:
            m = self.moves
            # What an entity of kind x may gain by its moves over staying outside: on entry, per
            # further word, on leaving.
            begin, inside = np.arange(1, _K, 2), np.arange(2, _K, 2)
            self.enter = (m[:, begin] - m[:, :1]).max(0)
            self.stay = np.maximum(m[begin, inside], m[inside, inside]) - m[0, 0]
            ways = m[:, [0, *begin]] - m[0, [0, *begin]]
            self.leave = np.maximum(ways[begin].max(1), ways[inside].max(1))

    def _clear(self):
        self.ids, self.classes = _Words(self._number), {}
        self.table = np.zeros((1024, 3, _K))
        self.rows = 0

    def _number(self, word: str) -> int:
        """Row of a word in ``table``: its own scores, and what it adds to the next and the word before.

        Words of letters that have no weight of their own share a row: their other features
        are their case and whether a sign ends them.
        """
        core = word.strip(_EDGE).rstrip(".")
        key = None
        if core.isalpha() and (len(core) > _LONGEST or core.lower() not in self.vocabulary):
            key = (_case(core), len(core) > _LONGEST, word[-1:] in ".,;:!?")
            if key in self.classes:
                return self.classes[key]
        k, self.rows = self.rows, self.rows + 1
        if k == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        names = features(word)
        for place, found in enumerate((names, ["<" + f for f in names[:_SEEN]], [">" + f for f in names[:_SEEN]])):
            for f in found:
                if f in self.weights:
                    self.table[k, place] += self.weights[f]
        if key is not None:
            self.classes[key] = k
        return k

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Emission scores of the words of one text."""
        out = self.table[ids, 0]
        out[1:] += self.table[ids[:-1], 1]
        out[:-1] += self.table[ids[1:], 2]
        return out

    def open_words(self, gains: np.ndarray) -> np.ndarray:
        """Which words may lie in an entity on the best path.

        gains: (words, tags) scores over the outside score. An entity on the best path gains
        something over being outside throughout, so a word is open only if the best entity
        through it, by running sums of the largest gains, may do so.
        """
        begin = gains[:, 1::2] + self.enter
        total = np.cumsum(gains[:, 2::2] + self.stay, 0)
        # Best sum of a begin and the words up to here; best sum of further words from here on.
        before = np.maximum.accumulate(begin - total, 0)
        inner = np.full_like(total, -np.inf)
        inner[1:] = total[1:] + before[:-1]
        further = np.maximum.accumulate(total[::-1], 0)[::-1] - total
        best = np.maximum(begin, inner) + further + self.leave
        return (best > -1e-6).any(1)

    def tags(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, tag) of the words that may lie in an entity."""
        none = np.zeros(0, np.int64)
        if self.moves is None:
            return none, none, none
        if len(self.ids) > self.most:
            self._clear()
        ids, starts, ends = [none], [none], [none]
        for at, stop in _pieces(text):
            words = _WORD.findall(text, at, stop)
            ids.append(np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words)))
            a, b = _bounds(text, at, stop)
            starts.append(a)
            ends.append(b)
        ids = np.concatenate(ids)
        if not len(ids):
            return none, none, none
        emit = self.scores(ids)
        left = np.flatnonzero(self.open_words(emit - emit[:, :1]))
        return np.concatenate(starts)[left], np.concatenate(ends)[left], self._decode(left, emit[left])

    def _decode(self, left: np.ndarray, emit: np.ndarray) -> np.ndarray:
        """Best tags of the stretches of consecutive words; outside words lie around them."""
        out = np.zeros(len(left), np.int64)
        if not len(left):
            return out
        cut = np.flatnonzero(np.diff(left) != 1) + 1
        begin, size = np.r_[0, cut], np.diff(np.r_[0, cut, len(left)])
        for length in np.unique(size[size <= _STEPS]):
            of = begin[size == length]
            for low in range(0, len(of), _LANES):
                rows = of[low : low + _LANES, None] + np.arange(length)
                end, back = viterbi(emit[rows], self.moves, np.zeros(len(rows), np.int64))
                out[rows] = unwound(back, (end + self.moves[:, 0]).argmax(1))
        for a, n in zip(begin[size > _STEPS], size[size > _STEPS]):
            out[a : a + n] = self._long(emit[a : a + n])
        return out

    def _long(self, emit: np.ndarray) -> np.ndarray:
        """One long stretch: pieces for every tag before them, chained, then unwound."""
        pieces = [(a, min(a + _STEPS, len(emit))) for a in range(0, len(emit), _STEPS)]
        heads = [p for p in pieces if p[1] - p[0] == _STEPS]
        scores, backs = [], []
        for low in range(0, len(heads), _LANES // _K):
            some = heads[low : low + _LANES // _K]
            lanes = np.repeat(np.stack([emit[a:b] for a, b in some]), _K, 0)
            end, back = viterbi(lanes, self.moves, np.tile(np.arange(_K), len(some)))
            scores.append(end.reshape(len(some), _K, _K))
            backs.append(back)
        for a, b in pieces[len(heads) :]:
            end, back = viterbi(np.repeat(emit[None, a:b], _K, 0), self.moves, np.arange(_K))
            scores.append(end[None])
            backs.append(back)
        scores = np.concatenate(scores)
        best = np.full(_K, -np.inf)
        best[0] = 0.0
        chosen = []
        for piece in scores:  # best[tag before] + piece[tag before, last tag]
            total = best[:, None] + piece
            chosen.append(total.argmax(0))
            best = total.max(0)
        last = int((best + self.moves[:, 0]).argmax())
        out = np.zeros(len(emit), np.int64)
        lane = [(block, k) for block in backs for k in range(block.shape[1] // _K)]
        for (a, b), (block, k), back_to in zip(pieces[::-1], lane[::-1], chosen[::-1]):
            before = int(back_to[last])
            out[a:b] = unwound(block[:, k * _K + before : k * _K + before + 1], np.array([last]))[0]
            last = before
        return out

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, base kind number, end) of what the field finds."""
        starts, ends, tags = self.tags(text)
        hit = np.flatnonzero(tags)
        out: list[list[int]] = []
        for a, b, tag in zip(starts[hit].tolist(), ends[hit].tolist(), tags[hit].tolist()):
            if tag % 2:
                out.append([a, tag // 2, b])
            else:
                out[-1][2] = b
        return [span for span in (_trimmed(text, *s) for s in out) if span[0] < span[2]]


def _trimmed(text: str, start: int, kind: int, end: int) -> tuple[int, int, int]:
    """Without the signs at its edges (an opening sign before a number stays)."""
    while end > start and not text[end - 1].isalnum() and not (text[end - 1] == "]" and kind == 0):
        end -= 1
    while start < end and not text[start].isalnum() and text[start] not in "+(":
        start += 1
    return start, kind, end


def viterbi(emit: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best score per last tag, and the steps back, of sequences (lanes, steps, tags).

    first: the tag before each sequence.
    """
    best = moves[first] + emit[:, 0]
    back = np.zeros((emit.shape[1], len(emit), emit.shape[2]), np.int8)
    for t in range(1, emit.shape[1]):
        total = best[:, :, None] + moves
        back[t] = total.argmax(1)
        best = total.max(1) + emit[:, t]
    return best, back


def unwound(back: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tags (lanes, steps) from the steps back and the last tags."""
    out = np.zeros((back.shape[1], back.shape[0]), np.int64)
    rows = np.arange(len(out))
    out[:, -1] = last
    for t in range(len(back) - 1, 0, -1):
        last = back[t][rows, last]
        out[:, t - 1] = last
    return out


def all_spans(text: str, tagger: Tagger) -> list[tuple[int, int, int]]:
    """(start, number in ``KINDS``, end): the rules' spans and the field's that meet none of them."""
    base = base_spans(text)
    extra = []
    if tagger.moves is not None:
        last = np.array([0, *[b for _, _, b in base]])
        last = np.maximum.accumulate(last)
        opens = np.array([a for a, _, _ in base])
        for a, kind, b in tagger.spans(text):
            # Of the rules' spans that start before the end of this one, the furthest end.
            if last[np.searchsorted(opens, b)] <= a:
                extra.append((a, kind + len(BASE), b))
    return sorted(base + extra)


def scan(docs: DataFrame, labelled: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, spans (array of start, kind, end; by start, then kind) of every row."""
    spark = docs.sparkSession
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(fit_model(labelled, fit))  # bounded by Fit.sentences

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        kind = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])
        for batch in batches:
            spans = []
            for text in batch.column(1):
                found = all_spans(text.as_py() or "", tagger)
                spans.append([{"start": a, "kind": KINDS[k], "end": b} for a, k, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"])

    texts = docs.select("doc_id", F.col("text").cast("string"))
    return texts.mapInArrow(find, f"doc_id {id_kind}, spans array<struct<start:bigint,kind:string,end:bigint>>")


def op11_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digest of the rules' spans, and all spans."""
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scan(table(spark, sf_dir, "documents"), labelled_table(spark)).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
