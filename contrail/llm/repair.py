"""Conversation structure repair: the cheapest edits that make the roles ``(s?(ua)+)?``.

Every row is a symbol: its role's initial and its first fault (blank, duplicate,
truncated). Edits keep, rerole or delete a row or insert an empty turn; what they may do
depends on one of four states (nothing yet, after system, after user, after assistant), so
a symbol is a 4 x 4 min-plus matrix of costs. Equal symbols in a row are one run: a run of
n rows moves the vector of costs-to-go by the binary powers of its matrix, which are
cached, in log2(n) steps. With the costs at the run's end known, its choices are unrolled
forwards: of the edits that keep the cost least, the one of least letter.

Rows get their order inside range partitions of (conversation, turn, role, digest of the
text); whether a row has been seen earlier is a join on its unique place with the first
places of equal rows, so neither a hot conversation nor a hot text meets in one task. The
symbols of a conversation are cut into segments of at most 65,536 rows; vectors pass over
the segments backwards, states forwards. A repaired conversation is one digest of its whole
text and one audit, so at the end its rows pass through one task, one by one, in order; the
task holds the audit (a letter per edit), never the texts.

Defined cases: null roles and texts are one space, and so is a null id or turn in the
damage key; a null turn comes first and counts neither for gaps nor as a turn; the null
conversation is one of its own; rows of one turn are ordered by role and the digest of the
text, and equal rows are duplicates of the first; roles with other initials can only be
reroled or deleted; a conversation without rows has zero counts, an empty audit and the
digest of the empty text; very long texts and conversations count as any; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from contrail.llm.common import ranked, stored, table

# Fixed by the contract: costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
SEGMENT_BITS = 16

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
INSERTED = (2, 2, 3, 2)  # the turn that may follow a state, by the state it leads to
ROLE = {2: "user", 3: "assistant"}
FAR = 1 << 60

# A row's letter: "A" plus 4 * initial (s, u, a, other) plus fault (none, blank, duplicate, truncated).
BLANK, DUPLICATE, CUT = 1, 2, 3


# ---------------------------------------------------------------- the rows


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, _sha after the damage fixed by the contract (no nulls but in ids)."""
    blank = F.lit(" ")
    key = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank)
    )
    code = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    kept = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("_code"))
    return (
        kept.filter("_code <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("_code") == 1, "")
            .when(F.col("_code") == 2, F.translate("text", "".join(ENDS), ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .withColumn("_sha", F.sha2("text", 256))
        .drop("_copy")
    )


def segments(rows: DataFrame) -> DataFrame:
    """conv_id, _seg, symbols: the letters of at most 65,536 rows of a conversation, in order.

    rows: conv_id, turn, role, text, _sha.
    """
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(body == "", BLANK).when(F.right(body, F.lit(1)).isin(*ENDS), 0).otherwise(CUT)
    first = F.left("role", F.lit(1))
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    light = stored(
        rows.select("conv_id", "turn", "role", "_sha", initial.alias("_initial"), fault.alias("_fault")), "repair-rows"
    )
    placed = ranked(light, ["conv_id", "turn", "role", "_sha"], "repair-order")
    firsts = placed.groupBy("conv_id", "role", "_sha").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("_first"))
    repeated = F.col("_first").isNull() & (F.col("_fault") != BLANK)
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("_fault"))
    letters = placed.join(firsts, "_at", "left").select(
        "conv_id",
        "_at",
        F.shiftright("_at", SEGMENT_BITS).alias("_seg"),
        F.char((65 + 4 * F.col("_initial") + fault).cast("long")).alias("_letter"),
    )
    found = letters.groupBy("conv_id", "_seg").agg(F.array_sort(F.collect_list(F.struct("_at", "_letter"))).alias("_rows"))
    return found.select("conv_id", "_seg", F.array_join("_rows._letter", "").alias("symbols"))


# ---------------------------------------------------------------- costs


def product(a, b):
    """Min-plus product of two matrices."""
    return tuple(tuple(min(x + y for x, y in zip(row, col)) for col in zip(*b)) for row in a)


def moved(matrix, vector):
    return tuple(min(x + y for x, y in zip(row, vector)) for row in matrix)


def symbol(letter: str) -> str:
    """What the costs depend on: all rows that must go are one symbol."""
    return "X" if (ord(letter) - 65) % 4 in (BLANK, DUPLICATE) else letter


def row_edits(sym: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if sym != "X":
        initial, fault = divmod(ord(sym) - 65, 4)
        extra = TRUNCATED if fault == CUT else 0
        turn = INSERTED[state]
        if initial == 0 and state == 0:
            out.append(("K", KEEP + extra, 1))
        elif initial + 1 == turn:  # u leads to 2, a to 3
            out.append(("K", KEEP + extra, turn))
        out.append(("R", REROLE + extra, turn))
    return out


# Inserts before a row: from every state to the states that they lead to.
_INSERTS = tuple(
    tuple(min([n * INSERT for n in range(3) if (s, INSERTED[s], INSERTED[INSERTED[s]])[n] == t], default=FAR) for t in range(4))
    for s in range(4)
)
END = moved(_INSERTS, (0, FAR, FAR, 0))


@lru_cache(maxsize=None)  # nine symbols, at most SEGMENT_BITS + 1 powers each
def power(sym: str, k: int):
    """The matrix of 2**k rows of a symbol."""
    if k:
        half = power(sym, k - 1)
        return product(half, half)
    step = [[FAR] * 4 for _ in range(4)]
    for s in range(4):
        for _, cost, t in row_edits(sym, s):
            step[s][t] = min(step[s][t], cost)
    return product(_INSERTS, step)


def before_run(sym: str, n: int, after):
    """Costs-to-go before n equal rows from those after them."""
    k = 0
    while n:
        if n & 1:
            after = moved(power(sym, k), after)
        n, k = n >> 1, k + 1
    return after


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(sym, sum(1 for _ in same)) for sym, same in groupby(map(symbol, symbols))]


@lru_cache(maxsize=1 << 14)
def _before(symbols: str, after):
    for sym, n in reversed(runs(symbols)):
        after = before_run(sym, n, after)
    return after


def before_rows(symbols: str, after):
    """Costs-to-go before a segment; short segments repeat, so theirs are remembered."""
    low = min(after)
    rest = tuple(x - low for x in after)
    found = (_before if len(symbols) <= 64 else _before.__wrapped__)(symbols, rest)
    return tuple(x + low for x in found)


def _unroll(symbols: str, state: int, after):
    cuts, ends = runs(symbols), []
    for sym, n in reversed(cuts):
        ends.append(after)
        after = before_run(sym, n, after)
    audit = []
    for (sym, n), end in zip(cuts, reversed(ends)):
        costs = [end]
        for _ in range(n):
            costs.append(moved(power(sym, 0), costs[-1]))
        choices = [row_edits(sym, s) for s in range(4)]
        for k in range(n, 0, -1):
            now, rest = costs[k], costs[k - 1]
            while True:
                best = [(e, t) for e, cost, t in choices[state] if cost + rest[t] == now[state]]
                if INSERT + now[INSERTED[state]] == now[state] and not (best and best[0][0] == "D"):
                    audit.append("I")
                    state = INSERTED[state]
                    continue
                audit.append(best[0][0])
                state = best[0][1]
                break
    return "".join(audit), state


_unrolled = lru_cache(maxsize=1 << 14)(_unroll)


def unroll(symbols: str, state: int, after):
    """(audit, state at the end) of a segment, given the costs-to-go after it."""
    low = min(after)
    return (_unrolled if len(symbols) <= 64 else _unroll)(symbols, state, tuple(x - low for x in after))


def closing(state: int) -> str:
    """The inserts that end a conversation."""
    audit = ""
    while END[state]:
        audit, state = audit + "I", INSERTED[state]
    return audit


# ---------------------------------------------------------------- passes over conversations


def _same(a, b) -> bool:
    return a is b or a == b


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a conversation, last first: adds the costs-to-go after and before each."""
    conv, vector = object(), END
    for batch in batches:
        ends, starts = [], []
        for c, symbols in zip(batch.column("conv_id").to_pylist(), batch.column("symbols").to_pylist()):
            if not _same(c, conv):
                conv, vector = c, END
            ends.append(vector)
            vector = before_rows(symbols, vector)
            starts.append(vector[0])
        costs = [pa.array(ends, pa.list_(pa.int64())), pa.array(starts, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *costs], names=[*batch.schema.names, "after", "cost"])


class _Repair:
    """One conversation: its segments come first, then its rows."""

    def __init__(self, conv):
        self.conv, self.state, self.cost, self.pieces = conv, 0, None, []
        self.counts, self.illegal, self.last = [0] * 4, 0, None
        self.turns, self.low, self.high = 0, None, None
        self.audit, self.at, self.role_state = None, 0, 0

    def segment(self, symbols: str, after: list, cost: int):
        if self.cost is None:
            self.cost = cost
        for letter in symbols:
            initial, fault = divmod(ord(letter) - 65, 4)
            self.counts[fault] += 1
            if self.last is not None and (self.last, initial) not in ((0, 1), (1, 2), (2, 1)):
                self.illegal += 1
            self.last = initial
        audit, self.state = unroll(symbols, self.state, tuple(after))
        self.pieces.append(audit)

    def _inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.role_state = INSERTED[self.role_state]
            yield "I", ROLE[self.role_state], ""

    def row(self, turn, role: str, text: str):
        """(edit, role, text) of the inserted turns before the row, and of the row itself."""
        if self.audit is None:
            self.audit = "".join(self.pieces) + closing(self.state)
        if turn is not None and (self.high is None or turn != self.high):
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        yield from self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.role_state = 1 if role[:1] == "s" else INSERTED[self.role_state]
        elif edit == "R":
            self.role_state = INSERTED[self.role_state]
            role = ROLE[self.role_state]
        yield edit, role, text

    def tail(self):
        if self.audit is None:
            self.audit = ""
        yield from self._inserts()

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _walk(batches: Iterator[pa.RecordBatch]):
    """(conversation, edit, role, text) per edit and (conversation, None, None, None) at its end."""
    now = None
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or not _same(row["conv_id"], now.conv):
                if now is not None:
                    yield from ((now, *e) for e in now.tail())
                    yield now, None, None, None
                now = _Repair(row["conv_id"])
            if row["kind"] == 1:
                now.segment(row["symbols"], row["after"], row["cost"])
            elif row["kind"] == 2:
                yield from ((now, *e) for e in now.row(row["turn"], row["role"], row["text"]))
    if now is not None:
        yield from ((now, *e) for e in now.tail())
        yield now, None, None, None


def _batches(rows, schema: pa.Schema, size: int = 2048, weight: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows (dicts) in record batches of bounded rows and text."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row.get("text") or row.get("audit") or "")
        if len(held) >= size or chars >= weight:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _stream(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Per conversation, together and in order: a marker, its segments, its rows."""
    segs = segments(rows)
    ordered = segs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("_seg"))
    id_kind = conversations.schema["conv_id"].dataType.simpleString()
    costs = ordered.mapInArrow(
        _backwards, f"conv_id {id_kind}, _seg bigint, symbols string, after array<bigint>, cost bigint"
    )
    marker = conversations.select("conv_id").distinct().withColumn("kind", F.lit(0))
    head = costs.withColumn("kind", F.lit(1))
    body = rows.withColumn("kind", F.lit(2))
    together = marker.unionByName(head, allowMissingColumns=True).unionByName(body, allowMissingColumns=True)
    return (
        together.repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "_seg", "turn", "role", "_sha")
        .drop("_seg", "_sha")
    )


def repaired_turns(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R, D or I), role, text of every edit, in order.

    rows: conv_id, turn, role, text, _sha of the conversations as they are to be repaired
    (``damaged`` makes them). Without the rows of edit D it is the repaired conversation.
    """
    id_kind = conversations.schema["conv_id"].dataType.simpleString()

    def edits(batches):
        def each():
            conv, place = None, 0
            for now, edit, role, text in _walk(batches):
                if now is not conv:
                    conv, place = now, 0
                if edit is not None:
                    yield {"conv_id": now.conv, "place": place, "edit": edit, "role": role, "text": text}
                    place += 1

        yield from _batches(each(), schema)

    schema = pa.schema(
        [_id_field(conversations), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    )
    return _stream(conversations, rows).mapInArrow(
        edits, f"conv_id {id_kind}, place bigint, edit string, role string, text string"
    )


def _id_field(conversations: DataFrame):
    return ("conv_id", to_arrow_type(conversations.schema["conv_id"].dataType))


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    id_kind = conversations.schema["conv_id"].dataType.simpleString()

    def summarise(batches):
        def each():
            conv, digest, first = None, None, True
            for now, edit, role, text in _walk(batches):
                if now is not conv:
                    conv, digest, first = now, hashlib.sha256(), True
                if edit is None:
                    _, blank, duplicate, truncated = now.counts
                    yield {
                        "conv_id": now.conv,
                        "gaps": now.gaps(),
                        "blank": blank,
                        "duplicate": duplicate,
                        "truncated": truncated,
                        "illegal": now.illegal,
                        "cost": now.cost or 0,
                        "audit": now.audit,
                        "repaired_sha256": digest.hexdigest(),
                    }
                elif edit != "D":
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False

        yield from _batches(each(), schema)

    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema(
        [_id_field(conversations), *[(n, pa.int64()) for n in numbers], ("audit", pa.string()), ("repaired_sha256", pa.string())]
    )
    fields = ", ".join(f"{n} bigint" for n in numbers)
    return _stream(conversations, rows).mapInArrow(
        summarise, f"conv_id {id_kind}, {fields}, audit string, repaired_sha256 string"
    )


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations, damaged by rule."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(given, damaged(given))


# The CRC-32 of an ASCII text by its table, which a rule makes. A step of the recursion takes
# one row of every conversation: per state the least (cost, audit), the repaired text with it.
ORACLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295::BIGINT] || list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code
  FROM conversations, crc
), rows AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded, range(2) r(i) WHERE code <> 0 AND (i = 0 OR code = 3)
), placed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') AS k, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM rows
), faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY k ORDER BY i) AS earlier
  FROM placed
), counts AS (
  SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY k
), follow(state, nxt, line) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')
), inserts AS (  -- none, one or two inserted turns after a state
  SELECT state, state AS target, 0 AS cost, '' AS audit, [] ::VARCHAR[] AS lines FROM follow
  UNION ALL SELECT state, nxt, 5, 'I', [line || ':'] FROM follow
  UNION ALL SELECT a.state, b.nxt, 10, 'II', [a.line || ':', b.line || ':'] FROM follow a JOIN follow b ON b.state = a.nxt
), edits AS (
  SELECT k, i, state, 'D' AS edit, 2 AS cost, state AS target, [] ::VARCHAR[] AS lines FROM faults, follow
  UNION ALL
  SELECT k, i, state, 'K', CASE fault WHEN 'truncated' THEN 5 ELSE 0 END,
         CASE WHEN initial = 's' THEN 1 ELSE nxt END, [role || ':' || text]
  FROM faults, follow WHERE fault NOT IN ('blank', 'duplicate')
    AND ((initial = 's' AND state = 0) OR initial = left(line, 1))
  UNION ALL
  SELECT k, i, state, 'R', 1 + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, nxt, [line || ':' || text]
  FROM faults, follow WHERE fault NOT IN ('blank', 'duplicate')
), dp AS (
  SELECT k, 0::BIGINT AS i, target AS state, {'c': cost::BIGINT, 'a': audit, 'l': lines} AS best
  FROM counts, inserts WHERE inserts.state = 0
  UNION ALL
  SELECT d.k, d.i + 1, s.target, min({'c': d.best.c + e.cost + s.cost, 'a': d.best.a || e.edit || s.audit,
                                     'l': d.best.l || e.lines || s.lines})
  FROM dp d JOIN edits e ON e.k = d.k AND e.i = d.i + 1 AND e.state = d.state JOIN inserts s ON s.state = e.target
  GROUP BY d.k, d.i, s.target
), ended AS (
  SELECT k, min(best) AS best FROM dp JOIN counts USING (k) WHERE dp.i = n AND state IN (0, 3) GROUP BY k
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts ON counts.k = coalesce(c.conv_id::VARCHAR, ' ') LEFT JOIN ended USING (k)
"""
