"""Merkle manifest of a dataset: every row is a leaf, every group a tree, one root over all.

A leaf is the digest of the row's fields, each written as ``-`` if null, else as its UTF-8
byte count, ``:`` and the value. Per group the leaves stand in the order of their ids; as
long as several nodes remain, every ``FAN`` consecutive ones become the digest of their
concatenated hex text. The groups' roots form one more tree of the same kind.

A level is kept as concatenated text: a block of ``BLOCK`` aligned nodes is one row that
holds each of its three levels as one hex string. Fixed-width substrings of a level are the
runs that hash to their parents, and the flanks of a node inside its run are the sibling
segments of its proof. Blocks leave one node each, which are the leaves of the next round,
until one block is left per group: every round divides the rows by ``BLOCK``. Proofs come
down the same way, block by block, so a leaf meets its upper levels through a join on
(group, block) and no key has more than ``BLOCK`` rows.

Positions are taken inside range partitions of (group, id, leaf), which are written in
order; only one row per partition and group is added up. A group that holds most rows is
cut like any other, and a text is read once, where its row is hashed.

Defined cases: a null field is ``-``, an empty one ``0:``; null ids come first in their
group; rows of one id are ordered by leaf, and rows equal in all fields are leaves of their
own, in any order; the null group comes first, then groups in byte order; a lone leaf is
its group's root, a lone group's root the root; very long texts count as any; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import ranked, stored, table

FAN = 8
BLOCK = FAN**3  # nodes of a block: three levels
HEX = 64  # characters of a digest
RUN = FAN * HEX
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(text) -> "F.Column":
    """Lower-case hex SHA-256 of a text."""
    return F.sha2(text, 256)


def framed(value) -> "F.Column":
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(fields: dict) -> "F.Column":
    return digest(F.concat(*[framed(c) for c in fields.values()]))


def _group_text(group: str) -> "F.Column":
    """Group as text without nulls, in the same order: empty for null, else ``=`` and the value."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))


def positions(leaves: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """grp, pos (from 0, in ``order`` inside the group), total (leaves of the group), hash, item."""
    # Written first: finding the ranges reads the rows twice, the texts are hashed once.
    placed = ranked(stored(leaves, f"{label}-hashed"), ["grp", *order], label).withColumn("_part", F.shiftright("_at", 33))
    spans = placed.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per group and range partition.
    group = Window.partitionBy("grp")
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "grp",
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(group).alias("total"),
    )
    return placed.join(spans, ["grp", "_part"]).select(
        "grp", (F.col("_at") + F.col("_shift")).alias("pos"), "total", "hash", "item"
    )


def _parents(level: str) -> str:
    """SQL: a level's hex string to the string of its parents."""
    cut = f"sha2(substr({level}, i * {RUN} + 1, {RUN}), 256)"
    return f"array_join(transform(sequence(0, (length({level}) - 1) div {RUN}), i -> {cut}), '')"


def build(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Rounds of blocks, from the leaves up: grp, block, total, steps, items, s0, s1, s2, top.

    steps: levels that the block climbs, 3 unless fewer reach the group's root; top: what
    is left of it. The last round holds one block per group, whose top is the group's root.
    """
    rounds = []
    while True:
        blocks = nodes.groupBy("grp", F.expr(f"pos div {BLOCK}").alias("block"), "total").agg(
            F.array_sort(F.collect_list(F.struct("pos", "hash", "item"))).alias("_members")
        )
        # Levels from n nodes to one: the octal digits of n - 1.
        height = F.when(F.col("total") == 1, 0).otherwise(F.length(F.conv((F.col("total") - 1).cast("string"), 10, FAN)))
        blocks = (
            blocks.withColumn("steps", F.least(F.lit(3), height))
            .withColumn("items", F.col("_members.item"))
            .withColumn("s0", F.array_join("_members.hash", ""))
            .withColumn("s1", F.when(F.col("steps") >= 1, F.expr(_parents("s0"))))
            .withColumn("s2", F.when(F.col("steps") >= 2, F.expr(_parents("s1"))))
            .withColumn("s3", F.when(F.col("steps") >= 3, F.expr(_parents("s2"))))
            .withColumn("top", F.coalesce("s3", "s2", "s1", "s0"))
            .drop("_members", "s3")
        )
        made = stored(blocks, f"{label}-{len(rounds)}")
        rounds.append(made)
        if (made.agg(F.max("total")).first()[0] or 0) <= BLOCK:
            return rounds
        nodes = made.select(
            "grp",
            F.col("block").alias("pos"),
            F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"),
            F.col("top").alias("hash"),
            F.lit(None).cast("string").alias("item"),
        )


def proofs(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """grp, pos, item, hash, path of every leaf, and the further columns of ``tops``.

    tops: grp, pos (0), path (above the group's root), further columns. A path lists, level
    by level, the hex text before and after the node in its run.
    """
    carried = [c for c in tops.columns if c not in ("grp", "pos", "path")]
    below = None
    for blocks in reversed(rounds):
        upper = tops.select("grp", F.col("pos").alias("block"), F.col("path").alias("_upper"), *carried)
        # A block's runs of leaves, each with its parents' runs, then the nodes of each run.
        runs = blocks.select(
            "grp", "block", "steps", "items", "s0", "s1", "s2",
            F.explode(F.expr(f"sequence(0, (size(items) - 1) div {FAN})")).alias("_run"),
        ).select(
            "grp",
            "block",
            "steps",
            "_run",
            F.slice("items", F.col("_run").cast("int") * FAN + 1, FAN).alias("items"),
            *[F.expr(f"substr(s{k}, shiftright(_run, {3 * k}) * {RUN} + 1, {RUN})").alias(f"r{k}") for k in range(3)],
        )
        nodes = runs.join(upper, ["grp", "block"]).select(*runs.columns, "_upper", *carried, F.posexplode("items").alias("i", "item"))
        flanks = []
        for k in range(3):  # node i of run r is node (8r + i) >> 3k of level k
            slot = f"(shiftright(_run * {FAN} + i, {3 * k}) & {FAN - 1}) * {HEX}"
            flanks.append(f"named_struct('before', substr(r{k}, 1, {slot}), 'after', substr(r{k}, {slot} + {HEX + 1}))")
        below = nodes.select(
            "grp",
            F.expr(f"block * {BLOCK} + _run * {FAN} + i").alias("pos"),
            "item",
            F.expr(f"substr(r0, i * {HEX} + 1, {HEX})").alias("hash"),
            F.concat(F.expr(f"cast(slice(array({', '.join(flanks)}), 1, steps) as {PATH})"), F.col("_upper")).alias("path"),
            *carried,
        )
        tops = below.drop("item", "hash")
    return below


def fold(leaf, path) -> "F.Column":
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["before"], node, s["after"])))


def proof_digest(path) -> "F.Column":
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def manifest(leaves: DataFrame, order: Sequence[str] = ("id", "hash")) -> DataFrame:
    """grp, pos, item, hash, path (leaf to root), subroot, root of every leaf.

    leaves: grp (text, not null), hash (hex digest), item (any columns in a struct) and the
    columns of ``order``.
    """
    groups = build(positions(leaves, order, "merkle-leaves"), "merkle-blocks")
    subroots = groups[-1].select(
        F.lit("").alias("grp"), F.col("top").alias("hash"), F.struct("grp").alias("item"), F.col("grp").alias("id")
    )
    whole = build(positions(subroots, ["id"], "merkle-subroots"), "merkle-root")
    nothing = F.expr(f"cast(array() as {PATH})")
    ends = whole[-1].select("grp", F.lit(0).alias("pos"), nothing.alias("path"), F.col("top").alias("root"))
    tops = proofs(whole, ends).select(
        F.col("item.grp").alias("grp"), F.lit(0).alias("pos"), "path", F.col("hash").alias("subroot"), "root"
    )
    return proofs(groups, tops)


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def document_leaves(docs: DataFrame) -> DataFrame:
    """grp, id, hash, item(doc_id, tampered): tampered is the leaf of the row whose text has
    its A-Z in lower case, where 3 divides the CRC-32 of the id; else null."""
    fields = {name: F.col(name) for name in FIELDS}
    lowered = fields | {"text": F.translate(F.col("text").cast("string"), _CAPITALS, _CAPITALS.lower())}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        _group_text("lang").alias("grp"),
        F.col("doc_id").alias("id"),
        row_digest(fields).alias("hash"),
        F.struct("doc_id", F.when(hit, row_digest(lowered)).alias("tampered")).alias("item"),
    )


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and what its possibly tampered leaf folds to."""
    rows = manifest(document_leaves(docs)).withColumn(
        "folded_root", fold(F.coalesce("item.tampered", "hash"), F.col("path"))
    )
    return rows.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, every third document tampered with."""
    return verified_manifest(table(spark, sf_dir, "documents"))


# The CRC-32 of a decimal text by its table, which a rule makes. Nodes of both trees carry
# their tree (0 groups, 1 root); a fold is carried up level by level.
ORACLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), doc AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, n_chars, text,
         doc_id IS NOT NULL AND xor(list_reduce([4294967295::BIGINT] ||
             list_transform(string_split(coalesce(doc_id, 0)::VARCHAR, ''), lambda x: ord(x)::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS hit
  FROM documents, crc
), hashed AS (
  SELECT rid, doc_id, coalesce('=' || lang, '') AS g,
         sha256(a || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN hit THEN sha256(a || coalesce(strlen(text) || ':' ||
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS forged
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') ||
                  coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') ||
                  coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS a FROM doc)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n FROM hashed
), nodes AS (
  SELECT 0 AS level, g, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, g, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, g, pos // 8, n
), subroots AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), over AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM over WHERE n > 1 GROUP BY level, pos // 8, n
), runs AS (
  SELECT 0 AS tree, g, level, pos // 8 AS run, string_agg(h, '' ORDER BY pos) AS s FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 1, '', level, pos // 8, string_agg(h, '' ORDER BY pos) FROM over WHERE n > 1 GROUP BY ALL
), walk AS (
  SELECT rid, 0 AS tree, g, 0 AS level, pos, n, coalesce(forged, leaf) AS f, '' AS proof FROM leaves
  UNION ALL
  SELECT rid, CASE WHEN w.n = 1 THEN 1 ELSE w.tree END, CASE WHEN w.n = 1 THEN '' ELSE w.g END,
         CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
         CASE WHEN w.n = 1 THEN s.pos ELSE w.pos // 8 END, CASE WHEN w.n = 1 THEN s.n ELSE (w.n + 7) // 8 END,
         CASE WHEN w.n = 1 THEN f ELSE sha256(substr(r.s, 1, 64 * (w.pos % 8)) || f || substr(r.s, 64 * (w.pos % 8) + 65)) END,
         CASE WHEN w.n = 1 THEN proof ELSE proof || substr(r.s, 1, 64 * (w.pos % 8)) || substr(r.s, 64 * (w.pos % 8) + 65) END
  FROM walk w LEFT JOIN runs r ON r.tree = w.tree AND r.g = w.g AND r.level = w.level AND r.run = w.pos // 8
  LEFT JOIN subroots s ON s.g = w.g
  WHERE NOT (w.tree = 1 AND w.n = 1)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM walk w JOIN leaves l USING (rid) JOIN subroots s ON s.g = l.g, (SELECT h AS root FROM over WHERE n = 1)
WHERE w.tree = 1 AND w.n = 1
"""
