r"""Conversation structure repair: the cheapest edits that make the roles of a conversation `(s?(ua)+)?`.

Rows of a conversation are taken by turn, NULLs first, then by role and the SHA-256 of the text. A row's first fault
counts: blank (no character outside `[\x20\x09-\x0D]`), duplicate (role and text seen earlier), truncated (its last such
character is none of `.!?`). Edits are Keep (0), Rerole to user or assistant (2), Delete (3, the only one for blank
and duplicate rows) and Insert of an empty user or assistant row (2); a truncated row that is not deleted adds 1. Among the cheapest
edits those whose initials D, I, K, R are least in order are taken.

What a row offers depends on one byte: the class of its role and its fault. Costs to the end, one for each state of
the roles so far, are kept relative to their least one, so few different vectors occur and a step is looked up.
The backward pass stores the vectors of each square root of n rows only; the forward walk computes those
of one stretch again from the checkpoint at its end and takes, at each row, the least initial among the tight edits.

Duplicates are found by the first turn of each (conversation, role, text), counted on the map side, so no set of texts is
held. Then a conversation's narrow rows, followed by its whole rows, go sorted through one task as a stream: the task
holds a byte for each row, as the audit does, and the state of the hash, which is a chain over the text. No text is held.

Defined results: a NULL role or text is one space, and so is a NULL conversation or turn where the damage is drawn; rows of NULL
conv_id are one conversation; a role counts by its first character; repeated rows are duplicates; rows without a turn have no part in
gaps; a conversation of which no row is left, and one that is wholly deleted, has the hash of the empty text; further columns
do not matter; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
#: Edits in the order of their initials.
DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
#: States of the roles so far: none yet, a system row only, ended by user, ended by assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Costs to the end where no row is left; what is missing is inserted.
AT_END = (0, 2 * INSERT_COST, INSERT_COST, 0)
#: The role that a Rerole or an Insert gives in each state, and the state after it.
TURN_ROLE, TURN_STATE = ("user", "user", "assistant", "user"), (USER, USER, ASSISTANT, USER)
#: Classes of a row: system, user, assistant, other, each whole or truncated; then blank and duplicate.
ROLES = "sua"
TRUNCATED, BLANK, DUPLICATE = 4, 8, 9


def kept_state(code: int, state: int) -> int | None:
    """The state after keeping a row in a state, None if its role may not stand there."""
    role = code % 4 if code < BLANK else 3
    if role == 0:
        return SYSTEM if state == EMPTY else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def base_cost(code: int, after: tuple, state: int) -> int:
    """Cost to the end from before a row by an edit of that row."""
    found = DELETE_COST + after[state]
    if code < BLANK:
        extra = TRUNCATED_COST if code >= TRUNCATED else 0
        found = min(found, REROLE_COST + extra + after[TURN_STATE[state]])
        to = kept_state(code, state)
        if to is not None:
            found = min(found, extra + after[to])
    return found


@lru_cache(maxsize=1 << 14)
def step(code: int, after: tuple) -> tuple[tuple, int]:
    """The vector before a row, relative to its least cost, and that cost."""
    cost = [base_cost(code, after, state) for state in range(4)]
    # two rounds: an insert may precede another one, a third would lead back
    for _ in range(2):
        cost = [min(c, INSERT_COST + cost[TURN_STATE[state]]) for state, c in enumerate(cost)]
    least = min(cost)
    return tuple(c - least for c in cost), least


def at_end(state: int) -> str:
    """The inserts after the last row."""
    found = ""
    while state not in (EMPTY, ASSISTANT):
        found, state = found + INSERT, TURN_STATE[state]
    return found


@lru_cache(maxsize=1 << 16)
def tight(code: int, after: tuple, state: int) -> tuple[str, int]:
    """The least initials of tight edits up to and including the row's own, and the state after it."""
    vector, least = step(code, after)
    found = ""
    while True:
        cost = vector[state] + least
        if cost == DELETE_COST + after[state]:
            return found + DELETE, state
        to = TURN_STATE[state]
        if cost == INSERT_COST + vector[to] + least:
            found, state = found + INSERT, to
            continue
        extra = TRUNCATED_COST if code >= TRUNCATED else 0
        kept = kept_state(code, state)
        if kept is not None and cost == extra + after[kept]:
            return found + KEEP, kept
        return found + REROLE, to


def edits(codes: bytes) -> tuple[int, Iterator[str]]:
    """The least cost for rows of these codes, and per row the initials up to its own; the last item is what follows the rows."""
    n = len(codes)
    width = max(1, isqrt(n))
    marks, vector, total = {}, AT_END, 0
    for i in range(n - 1, -1, -1):
        if (i + 1) % width == 0 or i == n - 1:
            marks[i // width] = vector
        vector, least = step(codes[i], vector)
        total += least

    def walk() -> Iterator[str]:
        state = EMPTY
        for block in range(-(-n // width)):
            low, high = block * width, min((block + 1) * width, n)
            after = [marks[block]]
            for i in range(high - 1, low, -1):
                after.append(step(codes[i], after[-1])[0])
            for i in range(low, high):
                found, state = tight(codes[i], after.pop(), state)
                yield found
        yield at_end(state)

    return total + vector[EMPTY], walk()


# --- rows ----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text` after faults drawn by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its
    text, 2 removes `[.!?]`, 3 repeats it, 4 makes its role user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    draw, text, role = F.col("draw"), F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("draw"))
    return rows.where(draw != 0).select(
        "conv_id",
        "turn",
        F.when(draw == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def row_class(role: Column, text: Column) -> Column:
    """The code of a row but for duplicates."""
    end = F.right(F.btrim(text, F.lit(BLANKS)), F.lit(1))
    role_class = F.coalesce(F.nullif(F.position(F.left(role, F.lit(1)), F.lit(ROLES)), F.lit(0)) - 1, F.lit(3))
    role_class = F.when(F.length(role) == 0, 3).otherwise(role_class)
    return F.when(end == "", BLANK).when(end.isin(".", "!", "?"), role_class).otherwise(role_class + TRUNCATED)


NARROW, WHOLE = 0, 1


def stream(rows: DataFrame) -> DataFrame:
    """`conv_id, kind, turn, role, digest, code, text`: a conversation's narrow rows with their codes, then its whole rows."""
    marked = rows.select(
        "conv_id", "turn", "role", "text",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        row_class(F.col("role"), F.col("text")).alias("code"),
    )
    same = ["conv_id", "role", "digest"]
    first = marked.groupBy(*[F.col(c).alias(f"first_{c}") for c in same]).agg(
        F.min("turn").alias("first_turn"), (F.count_if(F.col("turn").isNull()) > 0).alias("first_null")
    )
    narrow = marked.drop("text").join(first, [F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in same])
    later = F.col("turn").isNotNull() & (F.col("first_null") | (F.col("turn") > F.col("first_turn")))
    columns = ["conv_id", "turn", "role", "digest"]
    narrow = narrow.select(
        *columns,
        F.lit(NARROW).alias("kind"),
        F.when(later & (F.col("code") != BLANK), DUPLICATE).otherwise(F.col("code")).alias("code"),
        F.lit(None).cast("string").alias("text"),
    )
    whole = marked.select(*columns, F.lit(WHOLE).alias("kind"), F.lit(None).cast("int").alias("code"), "text")
    order = ["conv_id", "kind", "turn", "role", "digest"]
    return narrow.unionByName(whole).repartition("conv_id").sortWithinPartitions(*order).select(*order, "code", "text")


class Conversation:
    """Takes a conversation's rows as they come: first the narrow ones, which give the codes, then the whole ones."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.last = conv_id, bytearray(), None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn, self.turns_seen = None, 0
        self.plan, self.state, self.role = None, EMPTY, None
        self.hash, self.started, self.audit = hashlib.sha256(), False, []

    def narrow(self, turn, role, digest, code) -> None:
        key = (turn, role, digest)
        if turn is not None and (self.last is None or self.last[0] != turn):
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns_seen += 1
        if key == self.last and code != BLANK:
            code = DUPLICATE
        if self.last is not None and self.last[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = key
        self.blank += code == BLANK
        self.duplicate += code == DUPLICATE
        self.truncated += TRUNCATED <= code < BLANK
        self.codes.append(code)

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last[0] - self.first_turn + 1 - self.turns_seen

    def turns(self, initials: str, role: str | None, text: str | None) -> list[tuple]:
        """Rows that some initials leave of a row: (role, text, initial)."""
        found = []
        for initial in initials:
            if initial == DELETE:
                continue
            if initial == KEEP:
                found.append((role, text, initial))
                self.state = kept_state(ROLES.index(role[0]), self.state)
                continue
            found.append((TURN_ROLE[self.state], "" if initial == INSERT else text, initial))
            self.state = TURN_STATE[self.state]
        return found

    def whole(self, role, text) -> list[tuple]:
        if self.plan is None:
            self.cost, self.plan = edits(bytes(self.codes))
        return self.written(next(self.plan), role, text)

    def end(self) -> list[tuple]:
        return self.written(next(self.plan), None, None)

    def written(self, initials: str, role, text) -> list[tuple]:
        found = self.turns(initials, role, text)
        self.audit.append(initials)
        for row_role, row_text, _ in found:
            self.hash.update(f"{chr(10) if self.started else ''}{row_role}:{row_text}".encode("utf-8", "surrogatepass"))
            self.started = True
        return found


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
REPAIRED = "conv_id long, position long, role string, text string, edit string"


def _arrow(rows: list, names: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [pa.field(name, kinds[kind]) for name, kind in (f.split() for f in names.split(","))]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


def _repairer(texts: bool, batch_chars: int = 1 << 22):
    """The task function: repaired rows if `texts`, else one report per conversation."""

    def run(batches):
        now, out, size, position = None, [], 0, 0

        def finished():
            if now is None:
                return []
            rest = now.end()
            if texts:
                return [(now.conv_id, position + i, *row) for i, row in enumerate(rest)]
            numbers = now.gaps, now.blank, now.duplicate, now.truncated, now.illegal, now.cost
            return [(now.conv_id, *numbers, "".join(now.audit), now.hash.hexdigest())]

        for batch in batches:
            for conv_id, kind, turn, role, digest, code, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    out += finished()
                    now, position = Conversation(conv_id), 0
                if kind == NARROW:
                    now.narrow(turn, role, digest, code)
                    continue
                for row in now.whole(role, text):
                    if texts:
                        out.append((conv_id, position, *row))
                        size += len(row[1])
                    position += 1
                if size > batch_chars or len(out) > 10_000:
                    yield _arrow(out, REPAIRED if texts else REPORT)
                    out, size = [], 0
        out += finished()
        yield _arrow(out, REPAIRED if texts else REPORT)

    return run


def repair(rows: DataFrame) -> DataFrame:
    """`conv_id, position, role, text, edit`: the rows of the repaired conversations, by the edit that left them."""
    return stream(rows).mapInArrow(_repairer(True), REPAIRED)


def reports(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and repaired hash of every conversation that has a row."""
    return stream(rows).mapInArrow(_repairer(False), REPORT)


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of the conversations, whose rows are damaged before they are repaired."""
    conversations = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    found = reports(damaged(conversations))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


# the same rows in DuckDB: the cheapest way to every state, row by row
REPAIR_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
drawn AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(name, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS draw FROM named),
damaged AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE draw WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE draw <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS before,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
  FROM placed),
rows AS (
  SELECT *, blank OR again AS forced, (cut AND NOT blank AND NOT again)::INTEGER AS extra FROM faults),
inserts(f, t, c, a, x) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 2, 'I', E'user:\n'), (1, 2, 2, 'I', E'user:\n'), (3, 2, 2, 'I', E'user:\n'), (2, 3, 2, 'I', E'assistant:\n'),
    (0, 3, 4, 'II', E'user:\nassistant:\n'), (1, 3, 4, 'II', E'user:\nassistant:\n')),
own(f, t, c, a, x) AS (
  VALUES (0, 0, 3, 'D', ''), (1, 1, 3, 'D', ''), (2, 2, 3, 'D', ''), (3, 3, 3, 'D', ''),
    (0, 1, 0, 'K', 's'), (0, 2, 0, 'K', 'u'), (1, 2, 0, 'K', 'u'), (3, 2, 0, 'K', 'u'), (2, 3, 0, 'K', 'a'),
    (0, 2, 2, 'R', 'user'), (1, 2, 2, 'R', 'user'), (3, 2, 2, 'R', 'user'), (2, 3, 2, 'R', 'assistant')),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {'c': 0, 'a': '', 'x': ''} AS way FROM conversations
  UNION ALL
  SELECT w.conv_id, w.i + 1, o.t, min({
    'c': w.way.c + m.c + o.c + CASE o.a WHEN 'D' THEN 0 ELSE r.extra END,
    'a': w.way.a || m.a || o.a,
    'x': w.way.x || m.x || CASE o.a WHEN 'D' THEN '' WHEN 'K' THEN r.role || ':' || r.text || chr(10) ELSE o.x || ':' || r.text || chr(10) END})
  FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN inserts m ON m.f = w.state JOIN own o ON o.f = m.t
  WHERE o.a = 'D' OR NOT r.forced AND (o.a = 'R' OR o.x = r.initial)
  GROUP BY w.conv_id, w.i, o.t),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS again, sum(extra)::BIGINT AS cut,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id),
ends AS (
  SELECT w.conv_id, s.n, min({'c': w.way.c + m.c, 'a': w.way.a || m.a, 'x': w.way.x || m.x}) AS way
  FROM walk w LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id JOIN inserts m ON m.f = w.state
  WHERE w.i = coalesce(s.n, 0) AND m.t IN (0, 3) GROUP BY w.conv_id, s.n)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(again, 0) AS duplicate, coalesce(cut, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, way.c::BIGINT AS cost, way.a AS audit,
  sha256(CASE way.x WHEN '' THEN '' ELSE left(way.x, -1) END) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""
