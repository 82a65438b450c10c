"""Repair of conversation structure: the cheapest edits that give turns of user and assistant.

A row is kept, given another role, or deleted, and turns are inserted, so that the roles' initials read
(s?(ua)+)?; among the cheapest edits those whose initials are least are taken. Four states follow the
initials, so the cost to the end from a row is a vector of four, and it is known only from behind. The
vectors are stored at every sqrt(n)-th row, and a block between two of them is recomputed when the
walk forward, which chooses the edits, comes to it.

Rows are ordered by ranges of (conversation, turn, ...), without their texts, so a conversation of any
length is spread over tasks. Each task has a run of a conversation's rows. Runs are linked by what
they cost from each state to each other: that gives the vector behind every run, then the state
before it, and so the runs' edits add up to those of the whole conversation. Only the digest of a
repaired conversation reads its rows one after the other, as they stream through a task.
"""

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import saved

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3   # costs
MUCH, HALF = 1 << 60, 1 << 59   # what can't be, and what is no sum of costs
RUN_ROWS = 1 << 20             # rows of a task, about

# states: before the first turn, behind a system turn, behind a user's, behind an assistant's
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = (USER, USER, ASSISTANT, USER)               # the next state where a turn follows
ENDS = (0, 2 * INSERT, INSERT, 0)                  # the vector behind the last row
ROLE = {USER: "user", ASSISTANT: "assistant"}

# a row's code: what its role may follow, with its fault
OTHER, IS_SYSTEM, IS_USER, IS_ASSISTANT = 0, 1, 2, 3
_KIND = {"s": IS_SYSTEM, "u": IS_USER, "a": IS_ASSISTANT}
FAULT = {None: 0, "blank": 4, "duplicate": 8, "truncated": 12}
BLANKS = " \t\n\x0b\x0c\r"
_LEGAL = {(IS_SYSTEM, IS_USER), (IS_USER, IS_ASSISTANT), (IS_ASSISTANT, IS_USER)}


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0 to 2) of damaged conversations; nulls are one space.

    crc32('conv_id:turn') % 20 says how: 0 drops a row, 1 empties its text, 2 takes its marks . ! ?
    away, 3 repeats it, 4 makes it the user's.
    """
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    name = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)])
    how = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(how == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(how == 1, "").when(how == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))


def coded(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, copies) with digest (of role and text) and code.

    A row stands once for each copy, and once with copies 0 if it has none. code is the role's kind,
    and the fault as far as the row itself shows it.
    """
    kind, code = F.substring("role", 1, 1), F.lit(OTHER)
    for initial, k in _KIND.items():
        code = F.when(kind == initial, k).otherwise(code)
    body = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(body == "", FAULT["blank"]).when(
        ~F.substring(body, -1, 1).isin(".", "!", "?"), FAULT["truncated"]).otherwise(0)
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    return rows.withColumns({
        "digest": F.unhex(F.substring(digest, 1, 32)), "code": (code + fault).cast("int"),
        "copy": F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))}).drop("copy")


def _with_duplicates(rows: DataFrame) -> DataFrame:
    """rows with the code of a duplicate where an equal one of the conversation stands before, in the order of turn and place."""
    order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), "place")
    first = rows.where("copies > 0").groupBy("conv_id", "digest").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    again = F.col("first").isNotNull() & (order > F.col("first")) & (F.col("code").bitwiseAND(F.lit(12)) != FAULT["blank"])
    return rows.join(first, same, "left").withColumn(
        "code", F.when(again, F.col("code").bitwiseAND(F.lit(3)) + FAULT["duplicate"]).otherwise(F.col("code"))).select(rows.columns)


# -- the walk --------------------------------------------------------------------------------------

def _turns(after: list[int]) -> list[int]:
    """The vector before any number of inserted turns."""
    out = list(after)
    for _ in range(2):
        for s in (ASSISTANT, USER, SYSTEM, START):
            out[s] = min(out[s], INSERT + out[TURN[s]])
    return out


def _options(code: int) -> tuple[int, int, int]:
    """What a row's kind is, and what it costs to leave it in and to delete it."""
    fault = code & 12
    if fault in (FAULT["blank"], FAULT["duplicate"]):
        return OTHER, MUCH, DELETE
    return code & 3, TRUNCATED if fault else 0, DELETE


def _kept(state: int, kind: int) -> int | None:
    """The state behind a row that is kept, if it may stand there."""
    if kind == IS_SYSTEM:
        return SYSTEM if state == START else None
    if kind == IS_USER:
        return USER if state != USER else None
    return ASSISTANT if kind == IS_ASSISTANT and state == USER else None


def _before(code: int, after: list[int]) -> list[int]:
    """The vector before a row, from that behind it."""
    kind, stay, away = _options(code)
    out = []
    for s in range(4):
        best = min(away + after[s], stay + REROLE + after[TURN[s]])
        to = _kept(s, kind)
        out.append(best if to is None else min(best, stay + KEEP + after[to]))
    return _turns(out)


_STEPS: dict[tuple[int, tuple], tuple] = {}


def before(code: int, after: tuple) -> tuple:
    """_before(), remembered: vectors are few but for a constant."""
    low = min(after)
    rest = tuple([MUCH if x >= HALF else x - low for x in after])
    known = _STEPS.get((code, rest))
    if known is None:
        known = _STEPS[code, rest] = tuple(_before(code, list(rest)))
    return tuple([MUCH if x >= HALF else x + low for x in known])


def walk(codes: bytes, state: int, after: tuple, last: bool) -> tuple[str, int]:
    """The edits of a run of rows from a state, and the state behind them.

    after: the vector behind the run. last: turns may be inserted behind the last row. Each edit is the
    first by its initial of those on a cheapest way.
    """
    n = len(codes)
    step = max(1, math.isqrt(n))
    marks, vector = {}, after
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i == n - 1:
            marks[i // step] = vector      # behind the last row of a block
        vector = before(codes[i], vector)
    out = []
    for block in range(-(-n // step)):
        a, b = block * step, min(n, block * step + step)
        behind = [marks[block]]
        for i in range(b - 1, a, -1):
            behind.append(before(codes[i], behind[-1]))
        for i in range(a, b):
            after_row = behind[b - 1 - i]
            kind, stay, away = _options(codes[i])
            here = before(codes[i], after_row)
            while True:
                to, left = _kept(state, kind), here[state]
                if away + after_row[state] == left:
                    out.append("D")
                    break
                if INSERT + here[TURN[state]] == left:
                    out.append("I")
                    state = TURN[state]
                    continue
                if to is not None and stay + after_row[to] == left:
                    out.append("K")
                    state = to
                else:
                    out.append("R")
                    state = TURN[state]
                break
    while last and state not in (START, ASSISTANT):
        out.append("I")
        state = TURN[state]
    return "".join(out), state


def _crossing(codes: bytes) -> list[int]:
    """The cost of a run from each state to each: the vector before it for each single state behind it."""
    out = []
    for end in range(4):
        vector = tuple(0 if s == end else MUCH for s in range(4))
        for c in reversed(codes):
            vector = before(c, vector)
        out += vector
    return out


# -- runs ------------------------------------------------------------------------------------------

_RUN = ("run bigint, conv_id bigint, codes binary, low bigint, high bigint, n_turns bigint, "
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first int, final int")
_RUN_TYPES = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 7, pa.int32(), pa.int32()]


def _batch(rows: list[tuple], types: list, schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _counted(codes: bytes, turns: list) -> tuple:
    """The columns of a run behind its conv_id."""
    known = [t for t in turns if t is not None]
    kinds, faults = [c & 3 for c in codes], [c & 12 for c in codes]
    return (codes, known[0] if known else None, known[-1] if known else None, len(set(known)),
            *[faults.count(FAULT[f]) for f in ("blank", "duplicate", "truncated")],
            sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:])), kinds[0] if kinds else None, kinds[-1] if kinds else None)


def _runs(rows: DataFrame, run_rows: int) -> DataFrame:
    """Each task's rows of a conversation in order: their codes, and what can be counted in them.

    Rows with copies 0 give no code. low, high: least and largest turn; first, final: kinds at the ends.
    """
    order = ["conv_id", "turn", "digest", "place"]
    parts = max(math.ceil(rows.count() / run_rows), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out, now, codes, turns = TaskContext.get().partitionId() << 40, [], None, None, []
        for batch in batches:
            for conv, turn, copies, code in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "copies", "code")]):
                if codes is None or conv != now:
                    if codes is not None:
                        out.append((number, now, *_counted(bytes(codes), turns)))
                        number += 1
                    now, codes, turns = conv, bytearray(), []
                if copies:
                    codes.append(code)
                    turns.append(turn)
            if out:
                yield _batch(out, _RUN_TYPES, _RUN)
                out = []
        if codes is not None:
            yield _batch([(number, now, *_counted(bytes(codes), turns))], _RUN_TYPES, _RUN)

    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, _RUN)


_JOINED = "run bigint, after array<bigint>, final_run boolean, shared bigint, crossed bigint"


def _behind(part: pd.DataFrame) -> pd.DataFrame:
    """Of a conversation's runs: the vector behind each, turns shared with the run before, illegal pairs across."""
    part = part.sort_values("run")
    vector, vectors = list(ENDS), []
    for cross in reversed(part["cross"].tolist()):
        vectors.append(vector)
        vector = [min(int(cross[4 * end + s]) + vector[end] for end in range(4)) for s in range(4)]
    shared, crossed, high, final = [], [], None, None
    for r in part.itertuples():
        has_turns, has_rows = not pd.isna(r.low), not pd.isna(r.first)
        shared.append(int(high is not None and has_turns and int(r.low) == high))
        crossed.append(int(final is not None and has_rows and (final, int(r.first)) not in _LEGAL))
        high, final = int(r.high) if has_turns else high, int(r.final) if has_rows else final
    n = len(part)
    return pd.DataFrame({"run": part["run"].to_numpy(), "after": vectors[::-1],
                         "final_run": [i == n - 1 for i in range(n)], "shared": shared, "crossed": crossed})


def _entered(part: pd.DataFrame) -> pd.DataFrame:
    """Of a conversation's runs: the state before each."""
    part, state, states = part.sort_values("run"), START, []
    for exits in part["exits"]:
        states.append(state)
        state = int(exits[state])
    return pd.DataFrame({"run": part["run"].to_numpy(), "state": states})


def _crossings(runs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names],
                 pa.array([_crossing(c) for c in batch.column("codes").to_pylist()], pa.list_(pa.int64()))], [*names, "cross"])

    names = ["conv_id", "run", "low", "high", "first", "final"]
    return runs.mapInArrow(run, "conv_id bigint, run bigint, low bigint, high bigint, first int, final int, cross array<bigint>")


def _walked(runs: DataFrame) -> DataFrame:
    """run, audits and exits of each run for every state before it (only START, if it is a whole conversation), cost from START."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, codes, after, last in zip(*[batch.column(c).to_pylist() for c in ("run", "codes", "after", "final_run")]):
                whole, vector = after is None, tuple(after or ENDS)
                ways = [walk(codes, s, vector, whole or last) for s in ([START] if whole else range(4))]
                cost = vector
                for c in reversed(codes):
                    cost = before(c, cost)
                out.append((number, [w[0] for w in ways], [w[1] for w in ways], cost[START]))
            yield _batch(out, [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64()], _WALKED)

    return runs.select("run", "codes", "after", "final_run").mapInArrow(run, _WALKED)


_WALKED = "run bigint, audits array<string>, exits array<int>, cost bigint"


def edits(rows: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation of coded rows.

    Rows stand by turn, nulls first, those of one turn by a digest of role and text. gaps: turns
    missing between the least and the largest. Each row's first fault is counted. illegal: pairs of
    neighbours that aren't system-user, user-assistant or assistant-user. audit has the initials of
    the edits: keep, rerole, delete, insert. A null conv_id is a conversation.
    """
    light = saved(rows.select("conv_id", "turn", "digest", "copies", "code").withColumn(
        "place", F.monotonically_increasing_id()), "coded")
    runs = saved(_runs(_with_duplicates(light), run_rows), "runs")
    several = runs.groupBy("conv_id").count().where(F.col("count") > 1).select(F.col("conv_id").alias("c"))
    spread = saved(runs.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi"), "spread")
    # what a group gets is a few numbers for each task's run of its rows
    behind = saved(_crossings(spread).groupBy("conv_id").applyInPandas(_behind, _JOINED), "behind")
    walked = saved(_walked(runs.join(behind, "run", "left")), "walked")
    entered = walked.join(spread.select("run", "conv_id"), "run").select("conv_id", "run", "exits").groupBy(
        "conv_id").applyInPandas(_entered, "run bigint, state int")
    parts = runs.drop("codes").join(walked, "run").join(behind, "run", "left").join(entered, "run", "left")
    zero = F.lit(0)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "run", F.element_at("audits", F.coalesce("state", zero) + 1).alias("audit")))), lambda x: x["audit"]), "")
    turns = F.sum(F.col("n_turns") - F.coalesce("shared", zero))
    return parts.groupBy("conv_id").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - turns, zero).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.coalesce("crossed", zero)).alias("illegal"),
        F.min_by("cost", "run").alias("cost"), text.alias("audit"))


# -- repaired rows ---------------------------------------------------------------------------------

_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _applied(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """A conversation's audit (kind 0), then its rows in order (kind 1), one conversation after the other in a partition."""
    nothing = lambda t, c: F.lit(None).cast(t).alias(c)
    head = edited.select("conv_id", F.lit(0).alias("kind"), nothing("bigint", "turn"), nothing("binary", "digest"),
                         nothing("string", "role"), F.col("audit").alias("text"), *_SUMMARY)
    body = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "digest", "role", "text",
                                           *[nothing("bigint", c) for c in _SUMMARY])
    return head.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")


class _Repair:
    """Applies an audit to rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _turn(self) -> str:
        self.state = TURN[self.state]
        return ROLE[self.state]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield "I", self._turn(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns inserted before a row, and of the row unless deleted."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _kept(self.state, _KIND[role[:1]])
            yield edit, role, text
        elif edit == "R":
            yield edit, self._turn(), text


def repaired(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit, role and text of the turns of repaired conversations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, now, place = None, None, 0
        for batch in batches:
            out = []
            for conv, kind, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text")]):
                turns = repair.inserted() if kind == 0 and repair else repair.row(role, text) if kind else ()
                for turn in turns:
                    out.append((now, place, *turn))
                    place += 1
                if kind == 0:
                    repair, now, place = _Repair(text), conv, 0
            yield _batch(out, types, schema)
        yield _batch([(now, place + k, *turn) for k, turn in enumerate(repair.inserted() if repair else ())], types, schema)

    schema, types = "conv_id bigint, place bigint, edit string, role string, text string", [pa.int64()] * 2 + [pa.string()] * 3
    return _applied(rows, edited).mapInArrow(run, schema)


def digests(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """The rows of edits() with repaired_sha256: of the repaired 'role:text', joined by newlines.

    The rows of a conversation stream through one task, since a digest has no parts; it holds none of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = digest = head = None
        lines = 0

        def add(turns):
            nonlocal lines
            for _, role, text in turns:
                digest.update(("\n" * (lines > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                lines += 1

        for batch in batches:
            out = []
            summary = zip(*[batch.column(c).to_pylist() for c in _SUMMARY])
            for conv, kind, role, text, counts in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text")], summary):
                if kind:
                    add(repair.row(role, text))
                    continue
                if repair:
                    add(repair.inserted())
                    out.append((*head, digest.hexdigest()))
                repair, digest, head, lines = _Repair(text), hashlib.sha256(), (conv, *counts, text), 0
            yield _batch(out, types, schema)
        if repair:
            add(repair.inserted())
            yield _batch([(*head, digest.hexdigest())], types, schema)

    schema = "conv_id bigint, " + "".join(f"{c} bigint, " for c in _SUMMARY) + "audit string, repaired_sha256 string"
    types = [pa.int64()] * 7 + [pa.string()] * 2
    return _applied(rows, edited).mapInArrow(run, schema)


def repair(rows: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation of rows (conv_id, turn, role, text, copies).

    Null roles and texts are for the caller to replace, as damaged() does. Rows that repeat are
    duplicates. A conversation without rows (copies 0) has zeros, an empty audit and the digest of
    nothing. Other columns are not read, an empty table gives no rows.
    """
    rows = coded(rows.select("conv_id", "turn", "role", "text", "copies"))
    return digests(rows, saved(edits(rows, run_rows), "edits"))
