"""Secret scans over a trigram inverted index.

Every rule's regular expression gives a Boolean trigram query (see ``trigrams``). The
texts of an Arrow batch are a segment: its inverted index holds, for each trigram that
any rule asks for, the posting list of the texts that contain it, made by one pass over
the bytes. A rule's candidates are the union over its clauses of intersected postings;
only they are searched with the regex. Rules without mandatory trigrams search every
text. Segments are indexed and searched where the documents are read: nothing is
shuffled and a segment's memory is bounded by the batch.

Trigrams are of bytes in ASCII lower case, so case-insensitive rules are covered too.

Defined cases: a null or empty text has no spans; spans are code points, end exclusive;
matches of one rule are leftmost and non-overlapping before the failing ones are
dropped; repeated rows are scanned each; very long texts are scanned whole, in time linear
in their length; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import table
from contrail.llm.trigrams import Query, trigram_query


@dataclass(frozen=True)
class Rule:
    """passes: whether a match counts."""

    kind: str
    pattern: str
    flags: int = 0
    passes: Callable[[re.Match], bool] | None = None


# Fixed by the contract: the three base rules, in this order. For the class of hex
# digits, runs of 32 and more are the runs of one and more that pass.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
        lambda m: len(m[2]) >= 8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Publicly documented token formats.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    # Only where a run of token characters begins: a text of many such marks is read once.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+"),
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 1 << 20  # bytes indexed at once


class Segment:
    """Inverted index of some texts for a fixed set of trigrams: trigram -> text numbers."""

    def __init__(self, slots: np.ndarray, trigrams: list[str], binary: pa.Array):
        ends = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
        data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)
        found = []
        row = 0
        while row < len(binary):
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + _PIECE, "right")) - 1)
            low = _LOWER[data[ends[row] : ends[stop]]].astype(np.int32)
            if len(low) > 2:
                slot = slots[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
                at = np.flatnonzero(slot)
                text = np.searchsorted(ends, at + ends[row], "right") - 1
                within = at + ends[row] + 3 <= ends[text + 1]  # not across two texts
                pairs = slot[at[within]].astype(np.int64) * (len(binary) + 1) + text[within]
                found.append(np.unique(pairs))
            row = stop
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        slot, text = pairs // (len(binary) + 1), pairs % (len(binary) + 1)
        cuts = np.searchsorted(slot, np.arange(1, len(trigrams) + 2))
        self.postings = {t: text[cuts[k] : cuts[k + 1]] for k, t in enumerate(trigrams)}
        self.texts = len(binary)

    def candidates(self, query: Query) -> np.ndarray:
        """Texts that satisfy a clause; all texts for a query without mandatory trigrams."""
        found = []
        for clause in query:
            lists = sorted((self.postings[t] for t in clause), key=len)
            if not lists:
                return np.arange(self.texts)
            both = lists[0]
            for other in lists[1:]:
                both = np.intersect1d(both, other, assume_unique=True)
            found.append(both)
        return np.unique(np.concatenate(found))


class Scanner:
    """Compiled rules, their trigram queries and the lookup table of the trigrams asked for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, r.flags)) for r in rules]
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        # Bytes are indexed: a trigram of other than ASCII characters is left out.
        ascii_only = [frozenset(frozenset(t for t in c if t.isascii()) for c in q) for q in self.queries]
        self.queries = ascii_only
        self.trigrams = sorted({t for q in self.queries for c in q for t in c})
        self.slots = np.zeros(1 << 24, np.uint8 if len(self.trigrams) < 256 else np.int32)
        for k, t in enumerate(self.trigrams):
            a, b, c = t.encode()
            self.slots[a << 16 | b << 8 | c] = k + 1

    def scan(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For every text its spans (start, rule number, end), in order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        segment = Segment(self.slots, self.trigrams, texts.cast(pa.large_binary()))
        for number, ((rule, pattern), query) in enumerate(zip(self.rules, self.queries)):
            for row in segment.candidates(query).tolist():
                for m in pattern.finditer(texts[row].as_py() or ""):
                    if rule.passes is None or rule.passes(m):
                        out[row].append((m.start(), number, m.end()))
        for spans in out:
            spans.sort()
        return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, spans (array of start, kind, end; by start, then rule) of every row."""
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])
        for batch in batches:
            found = scanner.scan(batch.column(1).cast(pa.string()))
            spans = [[{"start": a, "kind": rules[n].kind, "end": b} for a, n, b in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"])

    texts = docs.select("doc_id", F.col("text").cast("string"))
    return texts.mapInArrow(find, f"doc_id {id_kind}, spans array<struct<start:bigint,kind:string,end:bigint>>")


def op7_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: counts and digest of the base spans, and all spans."""
    base = [r.kind for r in BASE]
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
