"""Conversation repair: cheapest edits that make turns alternate, by depth-first branch and bound."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

# --- fixed values -----------------------------------------------------------
FIX_COST = 3  # of an insertion, of another role, and of a truncated row that stays
DELETE_COST = 4
# ----------------------------------------------------------------------------

#: What the roles kept so far end in: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a row of this initial, or none where it may not follow.
_AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: The role that may come next, other than system.
_NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Cost of ending in a state: insertions that complete the last exchange.
_END = (0, 2 * FIX_COST, FIX_COST, 0)
#: Faults of a row; the first two force its deletion.
BLANK, DUPLICATE, TRUNCATED, SOUND = range(4)


def _row_edits(initial: str, fault: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, rows used, next state) of the edits at a row, in order of their letters."""
    yield "D", DELETE_COST, 1, state
    yield "I", FIX_COST, 0, _NEXT[state]
    if fault in (TRUNCATED, SOUND):
        stays = FIX_COST if fault == TRUNCATED else 0
        kept = _AFTER.get(initial, (None,) * 4)[state]
        if kept is not None:
            yield "K", stays, 1, kept
        yield "R", stays + FIX_COST, 1, _NEXT[state]


def suffix_bounds(initials: str, faults: bytes) -> array:
    """Least cost of the rows from each place on, by state: entry 4 * place + state.

    Two insertions in a row change nothing that one edit could not, but at the end.
    """
    n = len(faults)
    out = array("q", bytes(32 * (n + 1)))
    out[4 * n :] = array("q", _END)
    for i in range(n - 1, -1, -1):
        at, after = 4 * i, 4 * (i + 1)
        for state in range(4):
            out[at + state] = min(c + out[after + t] for _, c, used, t in _row_edits(initials[i], faults[i], state) if used)
        least = [min(out[at + s], FIX_COST + out[at + _NEXT[s]]) for s in range(4)]
        out[at : at + 4] = array("q", least)
    return out


def cheapest_edits(initials: str, faults: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a conversation, the ASCII-least audit among equals.

    ``initials``: one character a row, ``faults``: one byte a row.  Depth first with
    an explicit stack; letters are tried in ASCII order.  A prefix is cut off if its
    cost and the bound of what is left exceed the incumbent's cost, or equal it with
    a greater audit, or if its node (place, state) was reached at no more before:
    of two prefixes as cheap, the one met first has the lesser audit.  The bounds are
    exact in cost, so only ties are searched twice; the incumbent is proved best when
    the stack is empty.
    """
    n = len(faults)
    bound = suffix_bounds(initials, faults)
    reached = array("q", [-1]) * (4 * (n + 1))
    best_cost, best_audit = bound[START] + 1, ""
    path = bytearray()
    stack = [(0, START, 0, 0, "")]
    while stack:
        i, state, cost, depth, letter = stack.pop()
        node = 4 * i + state
        if cost + bound[node] >= best_cost or 0 <= reached[node] <= cost:
            continue
        reached[node] = cost
        if depth:
            del path[depth - 1 :]
            path += letter.encode()
        if i == n:
            if state in (START, ASSISTANT):
                # an equal cost met later has a greater audit, so from here on only less will do
                best_cost, best_audit = cost, path.decode()
                continue
            edits = [("I", FIX_COST, 0, _NEXT[state])]
        else:
            edits = list(_row_edits(initials[i], faults[i], state))
        for letter, c, used, after in reversed(edits):
            if cost + c + bound[4 * (i + used) + after] < best_cost:
                stack.append((i + used, after, cost + c, depth + 1, letter))
    return best_cost, best_audit


def replayed(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of the repaired rows; ``rows`` are read one by one, as the audit asks for them."""
    state = START
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            yield letter, ROLE_OF[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = _AFTER[role[0]][state]
            yield letter, role, text
        elif letter == "R":
            state = _NEXT[state]
            yield letter, ROLE_OF[state], text


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the rows after the damage that conversation and turn draw; nulls count as one blank."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), (
        F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn")).cast("binary")) % 20).alias("draw"))
    copies = F.when(F.col("draw") == 3, 2).otherwise(1)
    return rows.filter("draw <> 0").select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


def _own_fault(text: Column) -> Column:
    """Fault of a row by its text alone."""
    bare = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)


def _plain_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, text_key) without null roles and texts."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.md5(text.cast("binary")).alias("text_key"))


class _Tally:
    """Counts of one conversation whose rows come in order; a byte or two a row."""

    def __init__(self):
        self.initials, self.faults = bytearray(), bytearray()
        self.low = self.high = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: int, first: bool, copies: int) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        code = (initial if initial in _AFTER else "-").encode()
        pair = self.initials[-1:] + code
        self.illegal += (len(pair) == 2 and pair not in (b"su", b"ua", b"au")) + copies - 1
        self.initials += code * copies
        again = fault if fault == BLANK else DUPLICATE
        self.faults += bytes([fault if first else again]) + bytes([again]) * (copies - 1)

    def stats(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        count = self.faults.count
        return (gaps, count(BLANK), count(DUPLICATE), count(TRUNCATED), self.illegal,
                *cheapest_edits(self.initials.decode(), bytes(self.faults)))


STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_STATS_TYPE = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in STATS], ("audit", pa.string())])
_ROWS_TYPE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_HASH_TYPE = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
#: Rows and characters of text in one batch of results.
OUT_ROWS, OUT_CHARS = 2_000, 1 << 22


def _stream(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Each conversation with its rows, from rows that come sorted."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ["conv_id", *columns])))
    for conv, group in groupby(rows, itemgetter(0)):
        yield conv, (row[1:] for row in group)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[-1])
        if len(held) == OUT_ROWS or chars > OUT_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def tallies():
        for conv, rows in _stream(batches, ["turn", "initial", "fault", "first", "copies"]):
            tally = _Tally()
            for row in rows:
                tally.add(*row)
            yield conv, *tally.stats()

    return _batched(tallies(), _STATS_TYPE)


def diagnose(rows: DataFrame) -> DataFrame:
    """Faults of every conversation and its cheapest repair: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``rows(conv_id, turn, role, text)``; further columns are not read.  A
    conversation's rows go by turn, nulls first; those of one turn by role, then by
    the MD5 of their text, so equal rows are neighbours.  A null role or text counts
    as one blank; a null conv_id is a conversation of its own.  An empty table gives
    no rows.

    Texts stay where they are read: what is shuffled is a row's key and fault, equal
    rows of a turn once.  Rows reach a task sorted and are read as a stream, of which
    two bytes a row stay until the conversation ends, and about 70 during its search.
    """
    compact = _plain_rows(rows).select("conv_id", "turn", "role", "text_key", _own_fault(F.col("text")).alias("fault"))
    compact = compact.groupBy("conv_id", "turn", "role", "text_key", "fault").agg(F.count("*").alias("copies"))
    seen = Window.partitionBy("conv_id", "role", "text_key").orderBy(F.asc_nulls_first("turn"))
    told = (
        compact.repartition("conv_id").withColumn("first", F.row_number().over(seen) == 1)
        .sortWithinPartitions(*_order())
        .select("conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "fault", "first", "copies")
    )
    return told.mapInArrow(_tallied, "conv_id long, " + ", ".join(f"{c} long" for c in STATS) + ", audit string")


def _order(*between: str) -> list[Column]:
    return [F.asc_nulls_first("conv_id"), *[F.asc(c) for c in between], F.asc_nulls_first("turn"), F.asc("role"), F.asc("text_key")]


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    audits = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text_key"), "audit",
        F.lit("").alias("text"))
    texts = _plain_rows(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text_key", F.lit("").alias("audit"), "text")
    return audits.union(texts).repartition("conv_id").sortWithinPartitions(*_order("kind")).select("conv_id", "audit", "role", "text")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple[str, str, str]]]]:
    for conv, rows in _stream(batches, ["audit", "role", "text"]):
        audit = next(rows)[0]
        yield conv, replayed(audit, (row[1:] for row in rows))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batched(((conv, i, *e) for conv, edits in _edited(batches) for i, e in enumerate(edits)), _ROWS_TYPE)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def hashes():
        for conv, edits in _edited(batches):
            h, between = hashlib.sha256(), b""
            for _, role, text in edits:
                h.update(between + f"{role}:{text}".encode())
                between = b"\n"
            yield conv, h.hexdigest()

    return _batched(hashes(), _HASH_TYPE)


def repair(rows: DataFrame, audits: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (``K``, ``R`` or ``I``), role, text.

    ``audits(conv_id, audit)`` as ``diagnose`` gives them for the same rows; made here
    if not given.  Rows and order as there.  Texts are read as a sorted stream
    behind their audit, so no conversation is held whole.
    """
    audits = cut(diagnose(rows)) if audits is None else audits
    return _with_audits(rows, audits).mapInArrow(_repaired, _ddl(_ROWS_TYPE))


def repair_digest(conversations: DataFrame) -> DataFrame:
    """Faults, cheapest edits and hash of the repair of every conversation, after the damage.

    A conversation that lost all rows has zeros, an empty audit and the hash of the empty text.
    """
    rows = damaged(conversations)
    stats = diagnose(rows).withColumnRenamed("conv_id", "_conv")
    convs = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    convs = cut(convs.join(stats, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in STATS], F.coalesce("audit", F.lit("")).alias("audit")))
    hashes = _with_audits(rows, convs).mapInArrow(_hashed, _ddl(_HASH_TYPE)).withColumnRenamed("conv_id", "_conv")
    return convs.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


#: The same result in DuckDB: the best prefix of every state, carried from row to row.
REPAIRED_SQL = r"""
WITH RECURSIVE steps(i, t) AS (
  SELECT i, list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) FROM range(256) x(i)
), crc AS (SELECT list(t ORDER BY i) AS ts FROM steps),
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: xor(a >> 8, ts[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS draw
  FROM conversations, crc
), r AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE draw WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE draw <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM r
), f AS (
  SELECT *, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM o
), e AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY conv_id
), p AS (
  -- p: before a row, q: after an insertion; state 0 nothing kept, 1 system, 2 user, 3 assistant
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit FROM f
  UNION ALL
  SELECT conv_id, i, state, cost, audit FROM (
    SELECT m.conv_id, f.i, m.audit || letter AS audit, m.cost + own AS cost, after AS state,
      row_number() OVER (PARTITION BY m.conv_id, after ORDER BY m.cost + own, m.audit || letter) AS k
    FROM (
      SELECT conv_id, i, state, cost, audit FROM p
      UNION ALL
      SELECT conv_id, i, CASE state WHEN 2 THEN 3 ELSE 2 END, cost + 3, audit || 'I' FROM p
    ) m JOIN f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = m.i + 1, LATERAL (
      SELECT 'D' AS letter, 4 AS own, m.state AS after
      UNION ALL SELECT 'K', CASE fault WHEN 't' THEN 3 ELSE 0 END, CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
        WHERE fault IN ('', 't') AND (ini = 's' AND m.state = 0 OR ini = 'u' AND m.state <> 2 OR ini = 'a' AND m.state = 2)
      UNION ALL SELECT 'R', CASE fault WHEN 't' THEN 6 ELSE 3 END, CASE m.state WHEN 2 THEN 3 ELSE 2 END WHERE fault IN ('', 't')
    )
  ) WHERE k = 1
), best AS (
  SELECT p.conv_id, min({'c': cost + CASE state WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
    'a': audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS b
  FROM p JOIN e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = e.n GROUP BY p.conv_id
), letters AS (
  SELECT conv_id, unnest(string_split(b.a, '')) AS letter, unnest(range(len(b.a))) AS no FROM best WHERE b.a <> ''
), numbered AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY no) AS i,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY no) AS kept FROM letters
), lined AS (
  SELECT l.conv_id, no, letter, kept, f.role, f.text,
    max(CASE WHEN kept = 1 AND letter = 'K' AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS sys
  FROM numbered l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND letter <> 'I'
  WHERE letter <> 'D'
), hashes AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (kept - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY no)) AS h
  FROM lined GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
  coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN hashes ON hashes.conv_id IS NOT DISTINCT FROM a.conv_id
"""
