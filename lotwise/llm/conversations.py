"""Conversation structure repair by depth-first branch-and-bound.

A conversation should read `(s?(ua)+)?` in the initials of its roles: system at most once and first, then user and
assistant in turns, or nothing. Rows are kept (0), reroled to user or assistant (1), deleted (2), and rows of user or
assistant without text inserted anywhere (5); a blank or repeated row must go, a truncated one that stays costs 5 more.
Of the cheapest edits those count whose initials (D, I, K, R) are least in ASCII order.

The search goes over nodes (rows done, role state) with an explicit stack. Suffix lower bounds, the least cost to end from
each node, open the most promising child first, the ASCII-least of equals, and cut every branch that cannot beat the
incumbent (cost, audit); a table per node drops a prefix that a better one has met there. One audit that starts another costs less
by its inserts, so among equal costs the order of prefixes decides, and tables and cuts stay exact. A conversation
longer than a block is searched block by block for every pair of border states, and the blocks' answers are joined from
the left, which is exact for the same reason and bounds the search's memory.

One shuffle brings a conversation's rows to a task, where they pass in order twice, for the search and for the hash; held are
one letter a row and the answers of four states, never its texts. SHA-256 takes its bytes in order, so one task it must be.

A null conv_id is a conversation of its own; null turns come first; null roles and texts are one space. Rows of one turn are
ordered by role, then text. Equal rows are repeats of each other. An empty role has no initial and fits nowhere. Empty texts
are blank. A conversation whose rows are all dropped has zeros. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows searched at once.
BLOCK = 256
#: States: nothing yet, after system, after user, after assistant.
STATES, ENDS = range(4), (0, 3)
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: Where an inserted or reroled row leads: to user, except after user.
TURN = (2, 2, 3, 2)
BLANK = r"[^ \t\n\x0B\f\r]"

Answer = tuple[int, str]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after drops, emptied texts, lost marks, repeats and changed roles, drawn by id and turn. Rows that go leave one with null role."""
    space, text, turn = F.lit(" "), F.coalesce("text", F.lit(" ")), F.col("turn")
    draw = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space)).cast("binary")) % 20
    text = F.when(draw == 1, F.lit("")).when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(draw == 0, F.lit(None).cast("string")).when(draw == 4, F.lit("user")).otherwise(F.coalesce("role", space))
    copies = F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = conversations.select("conv_id", F.when(draw != 0, turn).alias("turn"), role.alias("role"), F.when(draw != 0, text).alias("text"), copies.alias("copy"))
    return rows.drop("copy")


def combined(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times: equal rows of a batch are counted before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["conv_id", "turn", "role", "text"]
        for b in batches:
            found = pa.Table.from_batches([b]).group_by(keys).aggregate([([], "count_all")])
            yield from found.select([*keys, "count_all"]).rename_columns([*keys, "times"]).to_batches()

    return rows.select(*(F.col(c).cast(t).alias(c) for c, t in (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string")))).mapInArrow(run, "conv_id long, turn long, role string, text string, times long")


def tagged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times (equal rows of the turn), pos, code and rest: role initial (- for none) and fault initial of the first of them and of the others; null role, null codes.

    One shuffle by conversation serves the count, the search for repeats and the order.
    """
    same = combined(rows).repartition("conv_id").groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    turn = F.col("turn").asc_nulls_first()
    met = Window.partitionBy("conv_id", F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "role", "text")).orderBy(turn)
    out = same.withColumn("again", F.row_number().over(met) > 1).withColumn("pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(turn, "role", "text")))
    last = F.right(F.regexp_replace("text", r"[ \t\n\x0B\f\r]+$", ""), F.lit(1))
    kind = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("-")

    def code(repeated: Column) -> Column:
        fault = F.when(~F.col("text").rlike(BLANK), "b").when(repeated, "d").when(~last.isin(".", "!", "?"), "t").otherwise("-")
        return F.when(F.col("role").isNotNull(), F.concat(kind, fault))

    return out.select("conv_id", "turn", "role", "text", "times", "pos", code(F.col("again")).alias("code"), code(F.lit(True)).alias("rest"))


def edits(state: int, code: str) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row, in ASCII order of letters."""
    yield "D", DELETE, state
    if code[1] in "bd":
        return
    more = TRUNCATED if code[1] == "t" else 0
    if (state, code[0]) in KEEPS:
        yield "K", more, KEEPS[state, code[0]]
    yield "R", REROLE + more, TURN[state]


def lower_bounds(codes: list[str], ends: tuple[int, ...]) -> list[list[float]]:
    """Least cost to end from each number of done rows and state, audits aside."""
    far = float("inf")
    here = [0 if s in ends else far for s in STATES]
    out = []
    for k in range(len(codes), -1, -1):
        if k < len(codes):
            here = [min(cost + out[-1][to] for _, cost, to in edits(s, codes[k])) for s in STATES]
        for _ in range(2):  # two inserts in a row at most lead anywhere new
            here = [min(here[s], INSERT + here[TURN[s]]) for s in STATES]
        out.append(here)
    return out[::-1]


def search(codes: list[str], start: int, ends: tuple[int, ...]) -> Answer | None:
    """Cheapest (cost, audit) from a state over all rows to one of the ends, ASCII-least of equals; None if no edits lead there."""
    bounds = lower_bounds(codes, ends)
    best: Answer | None = None
    held: dict[tuple[int, int], Answer] = {}
    stack = [(0, start, 0, "")]
    while stack:
        k, state, cost, audit = stack.pop()
        least = cost + bounds[k][state]
        if least == float("inf") or (best and (least > best[0] or (least == best[0] and audit > best[1][: len(audit)]))):
            continue
        if (k, state) in held and held[k, state] <= (cost, audit):
            continue
        held[k, state] = (cost, audit)
        if k == len(codes) and state in ends and (best is None or (cost, audit) < best):
            best = cost, audit
        children = [(k, TURN[state], cost + INSERT, audit + "I")]
        if k < len(codes):
            children += [(k + 1, to, cost + more, audit + letter) for letter, more, to in edits(state, codes[k])]
        stack += sorted(children, key=lambda c: (c[2] + bounds[c[0]][c[1]], c[3]), reverse=True)
    return best


class Search:
    """The answers of a conversation whose rows come one by one."""

    def __init__(self, block: int = BLOCK):
        self.block, self.codes, self.reached = block, [], {0: (0, "")}

    def add(self, code: str) -> None:
        if len(self.codes) == self.block:
            self._close([(s,) for s in STATES])
        self.codes.append(code)

    def _close(self, ends: list[tuple[int, ...]]) -> None:
        found = {}
        for (state, (cost, audit)), end in product(self.reached.items(), ends):
            if answer := search(self.codes, state, end):
                whole = cost + answer[0], audit + answer[1]
                found[end[0]] = min(found.get(end[0], whole), whole)
        self.reached, self.codes = found, []

    def answer(self) -> Answer:
        self._close([ENDS])
        return self.reached[ENDS[0]]


class Conversation:
    """What is known of a conversation while its rows pass."""

    def __init__(self):
        self.search, self.faults, self.illegal, self.before = Search(), dict.fromkeys("bdt", 0), 0, ""
        self.turns = self.low = self.high = self.answer = None

    def add(self, turn: int | None, code: str) -> None:
        initial = code[0]
        if self.before and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if code[1] in self.faults:
            self.faults[code[1]] += 1
        if turn is not None:  # turns come in ascending order
            if self.turns is None:
                self.turns, self.low, self.high = 1, turn, turn
            elif turn != self.high:
                self.turns, self.high = self.turns + 1, turn
        self.search.add(code)

    def row(self) -> tuple:
        if self.answer is None:  # all rows have passed
            self.answer = self.search.answer()
        gaps = 0 if self.turns is None else self.high - self.low + 1 - self.turns
        return gaps, *self.faults.values(), self.illegal, *self.answer


class Repair:
    """SHA-256 of a conversation's lines after its edits, line by line."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.lines, self.sha = audit, 0, 0, 0, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._turn("")
            self.at += 1

    def _turn(self, text: str) -> None:
        self.state = TURN[self.state]
        self._line("user" if self.state == 2 else "assistant", text)

    def add(self, role: str, text: str) -> None:
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEEPS[self.state, role[0]]
            self._line(role, text)
        elif letter == "R":
            self._turn(text)

    def digest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
KINDS = [pa.int64()] * 7 + [pa.string()] * 2


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation. Rows with null role only name their conversation.

    A conversation's rows pass twice, first without role and text for the search, then with them for the hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, repair, done = None, None, None, []

        def close() -> None:
            found = known.row()
            done.append((current, *found, (repair or Repair(found[-1])).digest()))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), KINDS)], [c.split()[0] for c in REPAIRED.split(", ")])
            done.clear()
            return out

        for b in batches:
            for conv, phase, turn, role, text, times, code, rest in zip(*(c.to_pylist() for c in b.columns)):
                if known is None or conv != current:
                    if known:
                        close()
                    current, known, repair = conv, Conversation(), None
                if phase == 0 and code is not None:
                    known.add(turn, code)
                    for _ in range(times - 1):
                        known.add(turn, rest)
                elif phase == 1 and role is not None:
                    repair = repair or Repair(known.row()[-1])
                    for _ in range(times):
                        repair.add(role, text)
            if len(done) >= 1000:
                yield flush()
        if known:
            close()
        if done:
            yield flush()

    twice = tagged(rows).withColumn("phase", F.explode(F.array(F.lit(0), F.lit(1))))
    full = F.col("phase") == 1
    twice = twice.select("conv_id", "phase", "pos", "turn", *(F.when(full, F.col(c)).alias(c) for c in ("role", "text")), "times", "code", "rest").sortWithinPartitions("conv_id", "phase", "pos")
    return twice.drop("pos").mapInArrow(run, REPAIRED)



#: DuckDB SQL for repaired over the damaged conversations: the cheapest audit to each role state, row by row.
SQL = r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
keyed AS (SELECT *, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: unicode(c)::BIGINT) AS b FROM conversations),
drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 20 AS h FROM keyed, crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, (SELECT unnest([0, 1]) AS copy) WHERE h <> 0 AND (copy = 0 OR h = 3)),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d),
f AS (SELECT *, left(role, 1) AS i, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM n),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS last FROM f GROUP BY conv_id),
ins(state, letters, cost, state2, lines) AS (VALUES (0, '', 0, 0, ''), (1, '', 0, 1, ''), (2, '', 0, 2, ''), (3, '', 0, 3, ''), (0, 'I', 5, 2, chr(10) || 'user:'), (1, 'I', 5, 2, chr(10) || 'user:'),
  (2, 'I', 5, 3, chr(10) || 'assistant:'), (3, 'I', 5, 2, chr(10) || 'user:'), (0, 'II', 10, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 'II', 10, 3, chr(10) || 'user:' || chr(10) || 'assistant:')),
act(state2, i, letter, to_state) AS (VALUES (0, 's', 'K', 1), (0, 'u', 'K', 2), (1, 'u', 'K', 2), (3, 'u', 'K', 2), (2, 'a', 'K', 3),
  (0, NULL, 'D', 0), (1, NULL, 'D', 1), (2, NULL, 'D', 2), (3, NULL, 'D', 3), (0, NULL, 'R', 2), (1, NULL, 'R', 2), (2, NULL, 'R', 3), (3, NULL, 'R', 2)),
walk AS (
  SELECT conv_id, 0::BIGINT AS k, 0 AS state, {'c': 0, 'a': '', 't': ''} AS best FROM facts
  UNION ALL
  SELECT w.conv_id, f.k, act.to_state, min({'c': w.best.c + ins.cost + CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN letter <> 'D' AND f.fault = 't' THEN 5 ELSE 0 END, 'a': w.best.a || ins.letters || letter,
    't': w.best.t || ins.lines || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || CASE act.to_state WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text END})
  FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1 JOIN ins ON ins.state = w.state JOIN act ON act.state2 = ins.state2 AND (act.i IS NULL OR act.i = f.i)
  WHERE letter = 'D' OR f.fault IN ('t', '-') GROUP BY w.conv_id, f.k, act.to_state),
done AS (SELECT w.conv_id, min({'c': w.best.c + ins.cost, 'a': w.best.a || ins.letters, 't': w.best.t || ins.lines}) AS best FROM walk w JOIN facts ON facts.conv_id IS NOT DISTINCT FROM w.conv_id AND w.k = last JOIN ins ON ins.state = w.state WHERE ins.state2 IN (0, 3) GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(best.c AS BIGINT), 0) AS cost, coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id
"""
