"""Repair of conversation structure: the cheapest edits that make the roles of a conversation `(s?(ua)+)?`, found by A* on the
lattice of (rows used, state of the roles), keyed (cost plus heuristic, audit).

Edits: Keep (0), Rerole to user or assistant (3), Delete (4), Insert an empty turn of user or assistant (3); a truncated
row that stays costs 3 more, blank and repeated rows must go. The heuristic is the suffix sum of what no path avoids: 4 for
a row that must go, 3 for a truncated one (it is charged or deleted). It is consistent, so the first path that ends in a
state is the cheapest and, of equal ones, has the least audit: two audits of one cost and one state are never prefixes of
each other, as what one has more would be inserts, which cost.

Rows are damaged and judged in the JVM; what was seen before is numbered by a window over (conversation, role, digest of
the text), whose rows need no more than a counter. The search reads two letters for each row in order, part by part of
`PART` rows: for each state at the end of a part, the best way there from each state at its begin. So no heap holds more
than a part, and a conversation needs a few bytes a row, as its audit does. The repaired text is hashed in a second pass,
as rows stream by behind their audit; no text is gathered.

Defined results: null roles and texts are one space, as are null ids and turns in the text that decides the damage; rows with equal turns
stand by role, then digest of the text, so repeated rows are neighbours; an empty role has no letter (Keep leaves the state as it is); null ids
are one conversation; a conversation without rows after damage has zeros and empty texts; an empty table gives no row;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakewright.llm import common

RENAME, DELETE, INSERT, CHARGE = 3, 4, 3, 3
#: States: nothing yet, after system, user, assistant; those in which a conversation may end.
STATES, ENDS = range(4), (0, 3)
#: What Rerole and Insert make in each state, and the state after it.
MADE = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = ("su", "ua", "au")
#: Rows of a conversation in one search.
PART = 1024

#: Good, blank, repeated, cut short; of equal rows the repeated ones stand last in this alphabet.
GOOD, BLANK, TWICE, CUT = "gbrc"


def search(rows: list[tuple[str, str]], start: int, ends: Iterable[int], n: int) -> dict[int, tuple[int, str]]:
    """state -> (cost, audit) of the best path over all rows to the `n` of `ends` that are reached first. rows: (letter, fault)."""
    least = [0]
    for _, fault in reversed(rows):
        least.append(least[-1] + (DELETE if fault in (BLANK, TWICE) else CHARGE if fault == CUT else 0))
    least.reverse()
    heap, closed, found = [(least[0], "", 0, start)], set(), {}
    while heap and len(found) < n:
        key, audit, i, state = heapq.heappop(heap)
        if (i, state) in closed:
            continue
        closed.add((i, state))
        cost = key - least[i]
        if i == len(rows) and state in ends:
            found[state] = cost, audit
        made = MADE[state][1]
        steps = [(INSERT, "I", i, made)]
        if i < len(rows):
            letter, fault = rows[i]
            steps.append((DELETE, "D", i + 1, state))
            if fault not in (BLANK, TWICE):
                more = CHARGE if fault == CUT else 0
                steps.append((RENAME + more, "R", i + 1, made))
                if (kept := KEPT.get((state, letter)) if letter else state) is not None:
                    steps.append((more, "K", i + 1, kept))
        for more, edit, j, after in steps:
            if (j, after) not in closed:
                heapq.heappush(heap, (cost + more + least[j], audit + edit, j, after))
    return found


class Repair:
    """The search over a conversation whose rows come one by one."""

    def __init__(self, part: int = PART) -> None:
        self.part, self.rows, self.best = part, [], {0: (0, "")}

    def add(self, letter: str, fault: str) -> None:
        if len(self.rows) == self.part:
            self._step(STATES, len(STATES))
        self.rows.append((letter, fault))

    def _step(self, ends: Iterable[int], n: int) -> None:
        ways: dict[int, tuple[int, str]] = {}
        for start, (cost, audit) in self.best.items():
            for end, (more, edits) in search(self.rows, start, ends, n).items():
                way = cost + more, audit + edits
                ways[end] = min(way, ways.get(end, way))
        self.rows, self.best = [], ways

    def result(self) -> tuple[int, str]:
        self._step(ENDS, 1)
        return min(self.best.values())


def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage, and `gone`: rows that were dropped stay as a trace of their conversation."""
    fault = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(_or_space("text"), ".!?", "")).otherwise(_or_space("text"))
    role = F.when(fault == 4, "user").otherwise(_or_space("role"))
    rows = conversations.select("conv_id", "turn", (fault == 0).alias("gone"), F.when(fault != 0, role).alias("role"), F.when(fault != 0, text).alias("text"), F.explode(
        F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))
    ).alias("copy"))
    return rows.drop("copy").withColumn("digest", F.unhex(F.md5("text")))


#: The order of a conversation's rows.
ORDER = ("gone", "turn", "role", "digest")


def judged(rows: DataFrame) -> DataFrame:
    """Rows without their texts, with `fault`, the first that applies."""
    blank = ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    ended = F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    narrow = rows.select("conv_id", *ORDER, F.when(blank, BLANK).when(~ended, CUT).otherwise(GOOD).alias("fault"))
    before = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy("turn")
    fault = F.when((F.col("fault") != BLANK) & (F.row_number().over(before) > 1), TWICE).otherwise(F.col("fault"))
    return narrow.withColumn("fault", fault)


def _streamed(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _searched(kind: pa.DataType, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *(x.split()[0] for x in _COUNTS.split(", "))]
        kinds = [kind, *[pa.int64()] * 6, pa.string()]
        now: _Told | None = None
        for batch in batches:
            ended = []
            for conv, gone, turn, role, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "gone", "turn", "role", "fault")], strict=True):
                if now is None or now.conv != conv:
                    ended += [now.row()] if now is not None else []
                    now = _Told(conv, part)
                if not gone:
                    now.add(turn, role[:1], fault)
            if ended:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*ended, strict=True), kinds, strict=True)], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(now.row(), kinds, strict=True)], names=names)

    return run


class _Told:
    """Counts of one conversation and its repair."""

    def __init__(self, conv, part: int) -> None:
        self.conv, self.repair, self.faults, self.illegal, self.turns = conv, Repair(part), dict.fromkeys((BLANK, TWICE, CUT, GOOD), 0), 0, 0
        self.first = self.last = self.letter = None

    def add(self, turn: int | None, letter: str, fault: str) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        if self.letter is not None:
            self.illegal += self.letter + letter not in LEGAL
        self.letter = letter
        self.faults[fault] += 1
        self.repair.add(letter, fault)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv, gaps, *(self.faults[x] for x in (BLANK, TWICE, CUT)), self.illegal, *self.repair.result()


def audits(conversations: DataFrame, part: int = PART) -> DataFrame:
    """A row for each conversation: its counts, the cost and the audit of its repair."""
    kind = conversations.schema["conv_id"].dataType
    # of equal rows the one that is no repeat comes first
    rows = _streamed(judged(damaged(conversations)), *ORDER, "fault")
    return rows.mapInArrow(common.released(_searched(to_arrow_type(kind), part)), f"conv_id {kind.simpleString()}, {_COUNTS}")


class Walk:
    """A repaired conversation, whose rows come one by one behind its audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _inserts(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = MADE[self.state]
            self.at += 1
            yield role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role, self.state = MADE[self.state]
        elif edit == "K" and role:
            self.state = KEPT[self.state, role[:1]]
        if edit != "D":
            yield role, text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._inserts()


class Hashed:
    """The digest of a repaired conversation."""

    def __init__(self) -> None:
        self.said, self.gap = hashlib.sha256(), ""

    def add(self, turns: Iterable[tuple[str, str]]) -> None:
        for role, text in turns:
            self.said.update(f"{self.gap}{role}:{text}".encode("utf-8", "replace"))
            self.gap = "\n"


def _behind(heads: DataFrame, conversations: DataFrame) -> DataFrame:
    """Each conversation's head as `told`, then its rows in order: what reads them holds one row and the head."""
    told = heads.select("conv_id", F.struct(*heads.columns).alias("told"), F.lit(False).alias("behind"))
    rows = damaged(conversations).filter("not gone").withColumn("behind", F.lit(True))
    return _streamed(told.unionByName(rows, allowMissingColumns=True), "behind", *ORDER).select("told", "role", "text")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head = None
    for batch in batches:
        ended, kind = [], batch.column("told").type
        for told, role, text in zip(*[batch.column(c).to_pylist() for c in ("told", "role", "text")], strict=True):
            if told is not None:
                ended += [_closed(head, walk, said)] if head is not None else []
                head, walk, said = told, Walk(told["audit"]), Hashed()
            else:
                said.add(walk.row(role, text))
        if ended:
            yield _told(ended, kind)
    if head is not None:
        yield _told([_closed(head, walk, said)], kind)


def _closed(head: dict, walk: Walk, said: Hashed) -> tuple[dict, str]:
    said.add(walk.end())
    return head, said.said.hexdigest()


def _told(ended: list[tuple[dict, str]], kind: pa.DataType) -> pa.RecordBatch:
    return common.batch_of(told=pa.array([x for x, _ in ended], kind), repaired_sha256=pa.array([x for _, x in ended], pa.string()))


def repaired(conversations: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, the counts, cost, audit and repaired_sha256."""
    heads = common.cut(audits(conversations, part), "audits")
    rows = _behind(heads, conversations)
    return rows.mapInArrow(common.released(_hashed), f"told {rows.schema['told'].dataType.simpleString()}, repaired_sha256 string").select("told.*", "repaired_sha256")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head = None
    for batch in batches:
        out, kind = [], batch.column("told").type
        for told, role, text in zip(*[batch.column(c).to_pylist() for c in ("told", "role", "text")], strict=True):
            if told is not None:
                out += [(head, *x) for x in walk.end()] if head is not None else []
                head, walk = told, Walk(told["audit"])
            else:
                out += [(head, *x) for x in walk.row(role, text)]
        yield _turns(out, kind)
    if head is not None:
        yield _turns([(head, *x) for x in walk.end()], kind)


def _turns(out: list[tuple[dict, str, str]], kind: pa.DataType) -> pa.RecordBatch:
    told, role, text = [list(x) for x in zip(*out, strict=True)] if out else ([], [], [])
    return common.batch_of(told=pa.array(told, kind), role=pa.array(role, pa.string()), text=pa.array(text, pa.string()))


def turns(conversations: DataFrame, part: int = PART) -> DataFrame:
    """The repaired conversations: conv_id, role, text, each one's turns in order within its partition."""
    heads = common.cut(audits(conversations, part), "audits").select("conv_id", "audit")
    rows = _behind(heads, conversations)
    return rows.mapInArrow(common.released(_listed), f"told {rows.schema['told'].dataType.simpleString()}, role string, text string").select("told.conv_id", "role", "text")


def query(conversations: DataFrame) -> DataFrame:
    return repaired(conversations)
