"""SimHash near-duplicates with deletion-variant signatures.

Fingerprints of d or fewer differing bits (d = 3) agree in one of two halves up to one
bit. Every half is indexed under its exact value and under each variant with one bit
deleted, so an equality join on these keys brings together every linked pair; the full
distance is then verified. Only distinct fingerprints enter the join: a group of copies
of any size is one of them.

A half that very many distinct fingerprints share is refined instead: its members are
indexed again under the same variants of the halves of their other bits (32, then 16,
then 8 wide). After the last cut a key leaves 11 bits free, so no group has more than
2,048 members, whatever the data. Nothing is capped or dropped.

Defined cases: a null text counts as empty; a text without words has fingerprint zero
and links like any other; rows with the same text and id are kept as rows; a null
doc_id never becomes a component id unless all ids of the component are null; a very long
text is fingerprinted whole, in steps of bounded memory; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import stored, table
from contrail.llm.components import connected_components

SHINGLE = 3  # words
BITS = 3  # differing bits of a link at most
SEED = 42
HOT = 2048  # distinct fingerprints on one exact segment beyond which it is refined
BUCKET = 50_000  # index rows joined together in one group on average
_STEP = 100_000  # shingles hashed at once


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text: unsigned XXH64 of its word shingles, majority per bit."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, _STEP):
        part = words[at : at + _STEP + width - 1]
        grams = zip(*(part[k:] for k in range(width))) if len(part) >= width else [part]
        codes = np.array([hashed(b" ".join(g), seed) for g in grams], dtype=">u8")
        ones += np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        codes = np.fromiter((fingerprint(t.as_py()) for t in texts), dtype=np.uint64, count=len(texts))
        named = {"doc_id": batch.column(0), "fp": pa.array(codes.view(np.int64))}
        named |= {batch.schema.names[k]: batch.column(k) for k in range(2, batch.num_columns)}
        yield pa.RecordBatch.from_pydict(named)


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) and the columns ``keep`` of every row."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", *keep)}
    schema = ", ".join([f"doc_id {kinds['doc_id']}, fp long", *[f"`{c}` {kinds[c]}" for c in keep]])
    return docs.select("doc_id", F.col("text").cast("string"), *keep).mapInArrow(_fingerprints, schema)


def _near(values: np.ndarray) -> np.ndarray:
    """Index pairs of a spanning forest of one group's links (breadth first)."""
    left = np.arange(1, len(values))
    todo, found = [0], []
    while len(left) or todo:
        if not todo:
            todo, left = [int(left[0])], left[1:]
            continue
        at = todo.pop()
        close = np.bitwise_count(values[left] ^ values[at]) <= BITS
        got = left[close]
        found += [(at, int(g)) for g in got]
        todo += got.tolist()
        left = left[~close]
        if not len(left):
            break
    return np.array(found, dtype=np.int64).reshape(-1, 2)


_SMALL = 48  # up to this size all pairs of a group are compared at once


def link_groups(rows: pa.Table) -> pa.Table:
    """Index rows (key, bit, fp) -> links (a, b) between fingerprints that share a key."""
    key = rows.column("key").to_numpy()
    fp = rows.column("fp").to_numpy().view(np.uint64)
    bit = rows.column("bit").to_numpy()
    order = np.lexsort((fp, key))
    key, fp, bit = key[order], fp[order], bit[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.array([], dtype=int)
    sizes = np.diff(np.r_[starts, len(key)])
    a, b = [], []
    for size in np.unique(sizes[sizes > 1]):
        first = starts[sizes == size]
        if size > _SMALL:
            for at in first:
                pairs = _near(fp[at : at + size])
                a.append(fp[at + pairs[:, 0]])
                b.append(fp[at + pairs[:, 1]])
            continue
        i, j = np.triu_indices(size, 1)
        x, y = fp[first[:, None] + i].ravel(), fp[first[:, None] + j].ravel()
        # Under a wildcard key only pairs that differ in the deleted bit are new; the
        # others share the exact segment, or hold the same wildcard at a finer level.
        wild = np.repeat(bit[first], len(i))
        diff = x ^ y
        new = (wild < 0) | ((diff >> np.maximum(wild, 0).astype(np.uint64)) & np.uint64(1) == 1)
        close = new & (diff != 0) & (np.bitwise_count(diff) <= BITS)
        a.append(x[close])
        b.append(y[close])
    none = np.array([], dtype=np.uint64)
    return pa.table(
        {"a": np.concatenate([none, *a]).view(np.int64), "b": np.concatenate([none, *b]).view(np.int64)}
    )


def _segments(rows: DataFrame, width: int) -> DataFrame:
    """Rows (ctx, base, fp): the two segments of ``width`` bits above bit ``base``."""
    cut = rows.withColumn("part", F.explode(F.array(F.lit(0), F.lit(1))))
    cut = cut.withColumn("low", F.col("base") + F.col("part") * width)
    return cut.withColumn("value", F.expr(f"shiftrightunsigned(fp, low) & {(1 << width) - 1}L"))


def _variants(segments: DataFrame, width: int) -> DataFrame:
    """One row per exact segment (bit -1) and per variant with one bit deleted."""
    wild = segments.withColumn("v", F.explode(F.sequence(F.lit(-1), F.lit(width - 1))))
    kept = F.expr("CASE WHEN v < 0 THEN value ELSE value & ~shiftleft(1L, v) END")
    return wild.withColumn("key", F.xxhash64("ctx", "low", "v", kept)).withColumn(
        "bit", F.expr("CASE WHEN v < 0 THEN -1 ELSE low + v END")
    )


def _links(index: DataFrame, n_rows: int) -> DataFrame:
    groups = max(1, n_rows // BUCKET)
    return (
        index.select("key", F.col("bit").cast("byte").alias("bit"), "fp")
        .groupBy(F.pmod("key", F.lit(groups)).alias("_group"))
        .applyInArrow(link_groups, "a long, b long")
    )


def links(codes: DataFrame, hot: int = HOT) -> DataFrame:
    """codes(fp), distinct -> links (a, b) that connect all fingerprints of ``BITS`` bits or fewer."""
    rows = codes.select(F.lit(0).cast("long").alias("ctx"), F.lit(0).alias("base"), "fp")
    found = []
    for width in (32, 16, 8):
        segments = _segments(rows, width)
        index = _variants(segments, width)
        n = rows.count() * 2 * (width + 1)
        crowded = stored(
            segments.groupBy("ctx", "low", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot), "hot"
        )
        # At width 8 a group is bounded (2,048), so nothing is refined any more.
        if width == 8 or crowded.isEmpty():
            found.append(_links(index, n))
            break
        keys = _variants(crowded, width).select("key").distinct()
        found.append(_links(index.join(keys, "key", "left_anti"), n))
        members = stored(index.join(keys, "key", "left_semi").select("key", "low", "bit", "fp"), "hot-members")
        # A wildcard key brings in something new only if both values of its bit occur.
        side = F.expr("CASE WHEN bit < 0 THEN 2 ELSE shiftrightunsigned(fp, bit) & 1 END")
        live = members.groupBy("key").agg(F.min(side).alias("x"), F.max(side).alias("y")).filter("y = 2 OR x < y")
        # The other segment of the pair this one was cut from is cut again.
        rows = stored(
            members.join(live, "key", "left_semi").select(
                F.col("key").alias("ctx"),
                F.expr(f"CASE WHEN (low div {width}) % 2 = 0 THEN low + {width} ELSE low - {width} END")
                .cast("int")
                .alias("base"),
                "fp",
            ),
            "hot-rows",
        )
    union = found[0]
    for more in found[1:]:
        union = union.union(more)
    return union.distinct()


def _marked(docs: DataFrame, hot: int, *keep: str) -> DataFrame:
    """doc_id, fp, root (least fingerprint reachable), component_id and ``keep`` of every row."""
    marked = stored(fingerprints(docs, *keep), "simhash")
    codes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-codes")
    roots = connected_components(links(codes.select("fp"), hot))
    rooted = codes.join(roots, codes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    names = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = rooted.join(names, "root").select("fp", "root", "component_id")
    return marked.join(labels, "fp").select("doc_id", "fp", "root", "component_id", *keep)


def near_duplicates(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable) of every row."""
    return _marked(docs, hot).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the row with the smallest id.

    Null ids come last, of equal ids the row with the smallest hash stays. Rows are told
    apart by 128 bits over all columns, so neither null nor repeated ids join components;
    a component of null ids only keeps one row.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # The hash passes over nulls, the flags tell which column is null.
    flags = [c.isNull() for c in cols]
    names = dict(zip(("_h1", "_h2"), (F.xxhash64(*cols, *flags), F.xxhash64(F.lit(1), *flags, *cols))))
    given = docs.select(F.struct(*cols).alias("_row"), F.col("doc_id"), F.col("text"), *[h.alias(n) for n, h in names.items()])
    order = F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", *names)
    kept = _marked(given, hot, *names).groupBy("root").agg(F.min(order).alias("_least")).select("_least.*")
    # Equal rows are combined before they are shuffled.
    whole = given.groupBy(*names).agg(F.first("_row").alias("_row"))
    return whole.join(kept, [*names], "left_semi").select("_row.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
