"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Texts are sequences of words. The CGK random walk copies a sequence symbol by symbol and
moves on by a random bit that depends on the step and the symbol: two sequences of small
edit distance fall back into step and then copy equal symbols, so their embeddings have
small Hamming distance. Items and documents are walked from anchors, the words of least
hash among a quarter of the item length (minimizers): every stretch of that many words
has one, and equal stretches have the same, so the windows of a document that start at
its anchors are aligned with the items. Sampled steps of a walk form its LSH keys;
windows whose keys meet an item's are compared over all their steps, and the survivors
are verified by the exact edit distance of the item to the best matching stretch of the
document.

``walks`` x ``tables`` keys of ``sampled`` steps from each of an item's anchors reach the
target recall: with chance p of one key to meet, 1 - (1 - p) ** keys. A walk past many
edits hardly falls back into step, so it is never longer than that of ``longest`` words:
longer items have more anchors, each with a walk of its own, and one that meets is
enough. An unedited copy always meets; the tests measure the recall at ``edits`` in every
class of lengths (0.95 is the target).

The benchmark is a stated query set: it is taken in blocks of bounded text, each block's
index is sent to the tasks, and the documents are scanned once per block where they are
read. Nothing is shuffled, whatever the documents hold; a passage that a third of all
documents share costs each of them the same.

Defined cases: words are runs of ASCII letters, digits and non-ASCII characters but the
punctuation, blanks and control characters of Unicode, in lower case (case folding where
that is one character); bytes that are no UTF-8 stand for themselves; null and empty
texts have no words and no hits; items without words are skipped; an item of n words is found with floor(edits * n) word edits or fewer
(short ones exactly); repeated rows and items each give their own rows; very long texts are
searched whole, as a piece of their own; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import stored, table

BLOCK_CHARS = 1_000_000  # benchmark text indexed and sent to the tasks at once
_PIECE = 1 << 20  # bytes of documents worked on at once
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

_FOLD = np.zeros(256, np.uint8)  # byte -> folded byte, 0 outside words
for _b in range(256):
    _c = chr(_b)
    if _b >= 128 or _c.isalnum():
        _FOLD[_b] = ord(_c.lower()) if _b < 128 else _b
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k of eight bytes


@dataclass(frozen=True)
class Search:
    """edits: share of an item's words that may be edited."""

    edits: float = 0.15
    walks: int = 1
    tables: int = 3
    sampled: int = 4
    spread: int = 4  # anchors are least among (power of two below the item length) / spread words
    longest: int = 32  # items of more words are walked like items of so many, from all their anchors
    agree: float = 0.2  # share of the steps on which a window and an item must agree
    seed: int = 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CASED = 0x20000  # no character from here on has a small letter or is punctuation


@cache
def _plain() -> tuple[np.ndarray, np.ndarray]:
    """Character -> its small letter, or a blank where it parts words; character -> bytes in UTF-8."""
    small = np.arange(_CASED, dtype=np.uint32)
    for k in range(128, _CASED):
        c = chr(k)
        if unicodedata.category(c)[0] in "PZ" or k < 0xA0:
            small[k] = 32
        else:
            small[k] = ord(next((x for x in (c.casefold(), c.lower()) if len(x) == 1), c))
    small[0x130] = ord("i")  # the small letter of the dotted I is two characters in Python
    size = np.array([1, 2, 3, 4], np.uint8).repeat([0x80, 0x780, 0xF800, _CASED - 0x10000])
    size[0xDC80:0xDD00] = 1  # these stand for bytes that are no UTF-8
    return small, size


def plain(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """UTF-8 ``data`` in small letters with blanks for punctuation, its cuts, byte -> byte of ``data``.

    The last is None where all characters keep their place.
    """
    if not len(data) or data.max() < 0x80:
        return data, cuts, None
    text = data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass")
    chars = np.frombuffer(text, "<u4")
    table, size = _plain()
    known = np.minimum(chars, _CASED - 1)
    small = np.where(chars < _CASED, table[known], chars)
    made = small.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")
    made = np.frombuffer(made, np.uint8)
    old, new = size[known], size[np.minimum(small, _CASED - 1)]
    if (old == new).all():
        return made, cuts, None
    old, new = np.r_[0, np.cumsum(old, dtype=np.int64)], np.r_[0, np.cumsum(new, dtype=np.int64)]
    places = np.zeros(len(made) + 1, np.int64)
    places[new] = old
    return made, new[np.searchsorted(old, cuts)], places


def words_of(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first byte, byte after) of the words in UTF-8 ``data``; no word crosses a cut."""
    low = np.zeros(len(data) + 8, np.uint8)
    low[: len(data)] = _FOLD[data]
    # The accented capitals of Latin-1: C3 80 to C3 9E in UTF-8, 20 (hex) below the small ones.
    accent = np.flatnonzero(low[:-1] == 0xC3) + 1
    accent = accent[(low[accent] >= 0x80) & (low[accent] <= 0x9E)]
    low[accent] += 0x20
    inside = low[: len(data) + 1] != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(data) and inside[0]:
        edges = np.r_[0, edges]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
    if len(cuts):
        edges = np.sort(np.r_[edges, cuts, cuts])
    a, b = edges[0::2], edges[1::2]
    size = b - a
    # Eight bytes of each word at a time, read in place.
    eights = np.ndarray((len(data) + 1,), np.dtype("<u8"), buffer=low, strides=(1,))
    codes = _mixed((eights[a] & _FIRST[np.minimum(size, 8)]) ^ (size.astype(np.uint64) << np.uint64(56)))
    at = 8
    longer = np.flatnonzero(size > at)
    while len(longer):
        more = eights[a[longer] + at] & _FIRST[np.minimum(size[longer] - at, 8)]
        codes[longer] = _mixed(codes[longer] ^ more)
        at += 8
        longer = longer[size[longer] > at]
    return codes, a, b


def anchors(codes: np.ndarray, width: int) -> np.ndarray:
    """Positions that are least (by hash, then place) in some run of ``width`` words (a power of two)."""
    n = len(codes)
    if width == 1 or n <= 1:
        return np.arange(n)
    bits = np.uint64(max(1, n - 1).bit_length())
    least = (_mixed(codes) >> bits << bits) | np.arange(n, dtype=np.uint64)
    span = 1
    while span < width and len(least) > span:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    chosen = np.zeros(n, bool)
    chosen[(least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = True
    return np.flatnonzero(chosen)


def _edits_within(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the stretch of ``text`` nearest to ``item``, if within ``most``.

    Bit-parallel edit distance (Myers); the start is found by running it backwards.
    """

    def ends(pattern, stream, anchored):
        peq: dict[int, int] = {}
        for k, c in enumerate(pattern):
            peq[c] = peq.get(c, 0) | 1 << k
        full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
        plus, minus, score = full, 0, len(pattern)
        yield score
        for c in stream:
            eq = peq.get(c, 0)
            x = eq | minus
            d = ((((eq & plus) + plus) ^ plus) | eq) & full
            ph, mh = (minus | ~(d | plus)) & full, plus & d
            score += bool(ph & top) - bool(mh & top)
            ph = (ph << 1 | anchored) & full
            mh = mh << 1 & full
            plus, minus = (mh | ~(x | ph)) & full, ph & x
            yield score

    item, text = item.tolist(), text.tolist()
    best, end = min((s, e) for e, s in enumerate(ends(item, text, 0)))
    if best > most:
        return None
    back = [s for s in ends(item[::-1], text[:end][::-1], 1)]
    length = max(k for k, s in enumerate(back) if s == best) if best in back else end
    return best, end - length, end


@dataclass
class _Class:
    """Items whose length is at least ``least`` and, below the longest class, below twice that."""

    least: int
    items: list[int] = field(default_factory=list)

    def plan(self, search: Search) -> None:
        m = self.least
        self.width = max(1, m // search.spread)
        # An item has an anchor among its first ``width`` words. Below this many steps the
        # walk from there cannot leave the item, so an unedited copy always meets it.
        lo, hi = min(1, m - self.width), m - self.width + 1
        self.steps = hi
        draw = np.random.default_rng([search.seed, m])
        count = min(search.sampled, hi - lo)
        self.samples = [
            [np.sort(draw.choice(np.arange(lo, hi), count, replace=False)) for _ in range(search.tables)]
            for _ in range(search.walks)
        ]


def _turns(codes: np.ndarray, walk: int, steps: int, seed: int) -> list[np.ndarray]:
    """Random bits of each symbol for each step: one 64-bit word per 64 steps."""
    return [
        _mixed(codes ^ _mixed(np.array([seed * 1_000_003 + walk * 1009 + k + 1], np.uint64))) for k in range(-(-steps // 64))
    ]


def _embed(codes, turns, starts, steps) -> np.ndarray:
    """Symbols that the walks from ``starts`` copy, one column per step."""
    at, out = starts.copy(), np.empty((len(starts), steps), np.uint64)
    for j in range(steps):
        out[:, j] = codes[at]
        at += ((turns[j >> 6][at] >> np.uint64(j & 63)) & np.uint64(1)).astype(np.int64)
    return out


def _keys(codes, turns, starts, steps, samples) -> list[np.ndarray]:
    """LSH keys of the walks from ``starts``, one array per table."""
    keys = [np.zeros(len(starts), np.uint64) for _ in samples]
    wanted: dict[int, list[int]] = {}
    for t, chosen in enumerate(samples):
        for j in chosen:
            wanted.setdefault(int(j), []).append(t)
    end = max(wanted) + 1
    at = starts.copy()
    for j in range(min(end, steps)):
        for t in wanted.get(j, ()):
            keys[t] = keys[t] * np.uint64(0x9E3779B97F4A7C15) + codes[at]
        if j + 1 < end:
            at += ((turns[j >> 6][at] >> np.uint64(j & 63)) & np.uint64(1)).view(np.int64)
    return keys


class ItemIndex:
    """LSH index of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str | None]], search: Search = Search()):
        self.search, self.ids, self.words = search, [], []
        classes: dict[int, _Class] = {}
        for item_id, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            codes = words_of(*plain(data, np.zeros(0, np.int64))[:2])[0]
            if len(codes):
                least = min(search.longest, 1 << (len(codes).bit_length() - 1))
                classes.setdefault(least, _Class(least)).items.append(len(self.ids))
                self.ids.append(item_id)
                self.words.append(codes)
        self.classes = [classes[m] for m in sorted(classes)]
        for c in self.classes:
            c.plan(search)
            pad = np.zeros(c.steps + 1, np.uint64)
            codes = np.concatenate([np.r_[self.words[k], pad] for k in c.items])
            starts, c.owner, c.offset, at = [], [], [], 0
            for k in c.items:
                # All anchors from which at least half of the window lies in the item.
                found = anchors(self.words[k], c.width)
                found = found[found <= max(c.width - 1, len(self.words[k]) - c.steps // 2)]
                starts += (at + found).tolist()
                c.owner += [k] * len(found)
                c.offset += found.tolist()
                at += len(self.words[k]) + len(pad)
            starts = np.array(starts, dtype=np.int64)
            c.owner, c.offset = np.array(c.owner, dtype=np.int64), np.array(c.offset, dtype=np.int64)
            c.embedded, c.lookup = [], []
            for walk, samples in enumerate(c.samples):
                turns = _turns(codes, walk, c.steps, search.seed)
                c.embedded.append(_embed(codes, turns, starts, c.steps))
                tables = []
                for keys in _keys(codes, turns, starts, c.steps, samples):
                    order = np.argsort(keys, kind="stable")
                    hot = np.zeros(1 << 18, bool)
                    hot[(keys & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
                    tables.append((keys[order], order, hot))
                c.lookup.append(tables)

    def _candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, anchor, likely first word) of windows that meet an item in a key and on enough steps."""
        found_item, found_anchor, found_at = [], [], []
        steps = max((c.steps for c in self.classes), default=0)
        marks = {w: anchors(codes, w) for w in {c.width for c in self.classes}}
        codes = np.r_[codes, np.zeros(steps + 1, np.uint64)]
        for walk in range(self.search.walks):
            turns = _turns(codes, walk, steps, self.search.seed)
            for c in self.classes:
                for part in range(0, len(marks[c.width]), 1 << 15):
                    starts = marks[c.width][part : part + (1 << 15)]
                    made = _keys(codes, turns, starts, c.steps, c.samples[walk])
                    for keys, (known, order, hot) in zip(made, c.lookup[walk]):
                        maybe = np.flatnonzero(hot[(keys & np.uint64((1 << 18) - 1)).view(np.int64)])
                        lo = np.searchsorted(known, keys[maybe], "left")
                        hi = np.searchsorted(known, keys[maybe], "right")
                        met = hi > lo
                        maybe, lo, hi = maybe[met], lo[met], hi[met]
                        each = hi - lo
                        at = np.repeat(starts[maybe], each)
                        rank = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
                        row = order[np.repeat(lo, each) + rank]
                        for some in range(0, len(at), 1 << 15):
                            w, r = at[some : some + (1 << 15)], row[some : some + (1 << 15)]
                            same = (_embed(codes, turns, w, c.steps) == c.embedded[walk][r]).mean(axis=1)
                            near = same >= self.search.agree
                            found_anchor.append(w[near])
                            found_at.append((w - c.offset[r])[near])
                            found_item.append(c.owner[r[near]])
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *found]) for found in (found_item, found_anchor, found_at))

    def hits(self, data: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item, first byte, byte after, edits) in texts laid end to end at ``cuts``."""
        data, cuts, places = plain(data, cuts)
        codes, a, b = words_of(data, cuts)
        item, anchor, at = self._candidates(codes)
        if not len(item):
            return []
        # Words of each document: a stretch never leaves its document.
        doc = np.searchsorted(cuts, a, "right") - 1
        bounds = np.searchsorted(doc, np.arange(len(cuts)), "left")
        # The anchor tells the document: where words are missing at its start, the likely
        # first word lies before it.
        spans = np.unique(np.stack([item, doc[anchor], np.maximum(at, bounds[doc[anchor]])]), axis=1)
        out = []
        k = 0
        while k < spans.shape[1]:
            i, d, first = spans[:, k]
            need = len(self.words[i])
            most = int(self.search.edits * need)
            slack = most + max(1, need // 2)
            last = first
            while k < spans.shape[1] and spans[0, k] == i and spans[1, k] == d and spans[2, k] <= last + slack:
                last = spans[2, k]
                k += 1
            lo = max(int(bounds[d]), int(first) - slack)
            hi = min(int(bounds[d + 1]), int(last) + need + slack)
            # All but ``most`` words of the item stand in the stretch.
            if np.isin(codes[lo:hi], self.words[i]).sum() < need - most:
                continue
            best = _edits_within(self.words[i], codes[lo:hi], most)
            if best:
                start, end = a[lo + best[1]], b[lo + best[2] - 1]
                if places is not None:
                    start, end = places[start], places[end]
                out.append((int(d), int(i), int(start), int(end), best[0]))
        return sorted(set(out))


def _pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the first text, bytes, cuts) of runs of texts of about ``_PIECE`` bytes."""
    binary = texts.cast(pa.large_binary())
    ends = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2], np.uint8) if binary.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(binary):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + _PIECE, "right")) - 1)
        yield row, data[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def _item_key(text) -> "F.Column":
    return F.sha2(text, 256)


def _blocks(benchmark: DataFrame) -> Iterator[list]:
    """(key, text) of the distinct item texts in blocks of about ``BLOCK_CHARS`` characters."""
    texts = benchmark.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    items = stored(texts.withColumn("key", _item_key(F.col("text"))), "benchmark-texts")
    size = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = int(size // BLOCK_CHARS + 1)
    number = F.pmod(F.xxhash64("key"), F.lit(blocks))
    for k in range(blocks):
        yield [(r.key, r.text) for r in items.filter(number == k).collect()]


def contaminations(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """doc_id, item_id, start, end (characters of the text), edits: one row per passage found."""
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("_key", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("edits", T.IntegerType()),
        ]
    )
    found = spark.createDataFrame([], schema)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    for items in _blocks(benchmark):
        if items:
            index = spark.sparkContext.broadcast(ItemIndex(items, search))
            found = found.union(texts.mapInArrow(_finder(index), schema))
    # Equal texts are searched once; every row of the benchmark that has the text is reported.
    rows = benchmark.select("item_id", _item_key(F.col("text").cast("string")).alias("_key")).filter("_key IS NOT NULL")
    return found.join(rows, "_key").select("doc_id", "item_id", "start", "end", "edits")


def _finder(index):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, starts, ends, edits = [], [], [], [], []
            for row, data, cuts in _pieces(batch.column(1)):
                for d, i, a, b, e in index.value.hits(data, cuts):
                    before = bytes(data[cuts[d] : a]).decode("utf-8", "replace")
                    rows.append(row + d)
                    items.append(index.value.ids[i])
                    starts.append(len(before))
                    ends.append(len(before) + len(bytes(data[a:b]).decode("utf-8", "replace")))
                    edits.append(e)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(items), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(edits, pa.int32())]
                if rows
                else [ids, pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.int32())],
                names=["doc_id", "_key", "start", "end", "edits"],
            )

    return find


def uncontaminated(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """The rows of ``docs`` in which no passage of the benchmark is found."""
    at = docs.columns.index("text")
    for items in _blocks(benchmark):
        if items:
            index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, search))
            docs = docs.mapInArrow(_dropper(index, at), docs.schema)
    return docs


def _dropper(index, at: int):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, data, cuts in _pieces(batch.column(at).cast(pa.string())):
                keep[[row + hit[0] for hit in index.value.hits(data, cuts)]] = False
            yield batch.filter(pa.array(keep))

    return drop


def op4_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of the benchmark in all documents: doc_id, item_id, start, end, edits."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
