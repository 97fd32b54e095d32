"""Reply trees to conversations: best root-to-leaf paths, formatted with a loss mask.

Messages are nodes (tree, node, parent, role, text, score). Path sums of the scores and
depths come from pointer doubling: each round joins the nodes with themselves and
doubles how far a node has looked up, so a chain of n replies takes log2(n) joins. The
leaves of a tree are ranked by path score and the best ``keep`` become conversations.
Their paths are enumerated by the same jumps in reverse: a set of path nodes joined with
the jump of 2^i steps doubles until every ancestor is in it once.

Template of a turn: ``<s>[INST]`` role ``[/INST]`` text ``</s>``. Control strings inside
roles and texts get one backslash after their first character, one more if they have
some already; reading takes one away, so any text survives. The loss mask lists, per
turn of the trained role, the code points [start, end) of its text in the output.

Defined cases: null texts and roles count as empty; a null tree id is a tree of its own
(null); nodes whose parent is null or unknown are roots; very long texts count as any and
make one long output; an empty table gives no rows;
other columns are ignored. A cycle of parents has no root and gives no conversation.
Conversations (rows by turn) are trees without branches: rows are ordered by turn (null
first), role and text, and each answers the one before; repeated rows are turns of
their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import stored, table

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
TRAINED = "assistant"


def escape(text) -> "F.Column":
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text) -> "F.Column":
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2$3"))


def turn_nodes(conversations: DataFrame) -> DataFrame:
    """Nodes of conversations stored as rows by turn: a chain per conv_id."""
    rows = conversations.select(
        F.col("conv_id").alias("tree"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return rows.withColumn("node", place).select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def best_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """tree, leaf, rank (1 to keep), node, depth: the nodes of the best paths, root at depth 0.

    nodes: tree, node, parent, score. Ranked by the sum of the scores along the path,
    then the smaller leaf.
    """
    given = stored(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "chat-nodes")
    known = given.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    up = given.join(known, F.expr("tree <=> _t AND parent = _n"), "left").select(
        "tree", "node", F.col("_n").alias("up"), "score", F.when(F.col("_n").isNotNull(), 1).otherwise(0).alias("depth")
    )
    up = stored(up, "chat-up")
    jumps = []
    limit = given.count()
    while (1 << len(jumps)) < 2 * max(1, limit) and not up.filter("up IS NOT NULL").isEmpty():
        # Nodes that have seen their root are done: only the others look further up.
        moving = up.filter("up IS NOT NULL")
        jumps.append(moving.select("tree", "node", "up"))
        far = up.select(
            F.col("tree").alias("_t"),
            F.col("node").alias("_n"),
            F.col("up").alias("_up"),
            F.col("score").alias("_score"),
            F.col("depth").alias("_depth"),
        )
        # The node reached brings what it has summed up, its own score included.
        moved = moving.join(far, F.expr("tree <=> _t AND up = _n")).select(
            "tree",
            "node",
            F.col("_up").alias("up"),
            (F.col("score") + F.col("_score")).alias("score"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
        )
        up = stored(up.filter("up IS NULL").union(moved), "chat-up")
    parents = given.select(F.col("tree").alias("_t"), F.col("parent").alias("_p")).filter("_p IS NOT NULL").distinct()
    leaves = up.filter("up IS NULL").join(parents, F.expr("tree <=> _t AND node = _p"), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "node"))
    best = leaves.withColumn("rank", rank).filter(F.col("rank") <= keep)
    paths = best.select("tree", F.col("node").alias("leaf"), "rank", "node", "depth")
    for k, jump in reversed(list(enumerate(jumps))):
        higher = jump.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"))
        paths = stored(
            paths.union(
                paths.join(higher, F.expr("tree <=> _t AND node = _n")).select(
                    "tree", "leaf", "rank", F.col("_up").alias("node"), F.expr(f"depth - {1 << k}").alias("depth")
                )
            ),
            "chat-paths",
        )
    return paths


def format_paths(paths: DataFrame, nodes: DataFrame, trained: str = TRAINED) -> DataFrame:
    """tree, leaf, n_turns, formatted, loss (array of start, end): one row per path."""
    texts = nodes.select(
        F.col("tree").alias("_t"),
        F.col("node").alias("_n"),
        F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit(""))), F.lit(MIDDLE)).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
        (F.coalesce("role", F.lit("")) == trained).alias("learn"),
    )
    turns = paths.join(texts, F.expr("tree <=> _t AND node = _n")).select(
        "tree",
        "leaf",
        "depth",
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        F.length("head").cast("long").alias("before"),
        F.length("body").cast("long").alias("size"),
        "learn",
    )
    earlier = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn(
        "start", F.coalesce(F.sum(F.length("piece").cast("long")).over(earlier), F.lit(0)) + F.col("before")
    )
    return (
        placed.groupBy("tree", "leaf")
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            F.array_sort(F.collect_list(F.struct("depth", "piece"))).alias("pieces"),
            F.array_sort(
                F.collect_list(
                    F.when(F.col("learn"), F.struct("start", (F.col("start") + F.col("size")).alias("end")))
                )
            ).alias("loss"),
        )
        .select("tree", "leaf", "n_turns", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted(tree, leaf, formatted, loss) -> turns (role, text) and the texts under the mask."""
    pieces = F.split(F.col("formatted"), F.lit(CLOSE))
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), MIDDLE, 1)).alias("role"),
            unescape(F.substring_index(p, MIDDLE, -1)).alias("text"),
        ),
    )
    learnt = F.transform(
        F.col("loss"),
        lambda x: unescape(
            F.substr(F.col("formatted"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))
        ),
    )
    return formatted.withColumn("turns", turns).withColumn("learnt", learnt)


def conversations(nodes: DataFrame, keep: int = 1, trained: str = TRAINED) -> DataFrame:
    """The ``keep`` best paths of every tree as formatted conversations."""
    nodes = stored(nodes, "chat-turns")
    return format_paths(best_paths(nodes, keep), nodes, trained)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text and its mask hold when read back."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.array_join("learnt", "")
    return read_back(formatted).select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"  # fixed by the contract: the texts of conversation -1


def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe conversation, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TRAINED).alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return digests(conversations(turn_nodes(given.unionByName(probe))))


ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS body,
         regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS head
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(9 + length(head) + 7 + length(body) + 4)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
