"""Conversation repair against a plain search for the least edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from llm_small import CLASHING, SF_DIR
from larder.llm import conversations as c
from larder.llm import queries
from larder.llm.common import table

BLANK = "[^\x20\x09-\x0D]"


def damage(rows):
    """{conv_id: rows (turn, role, text) after damage, in order}."""
    out = {}
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        how = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        own = out.setdefault(conv, [])
        own += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()[:16]
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, digest(r))) for k, v in out.items()}


def plain(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired turns of one conversation's rows."""
    faults, seen = [], set()
    for _, role, text in rows:
        shown = re.findall(BLANK, text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else
                      "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    def after(state, initial):
        """state: the last initial, '' at the start."""
        return initial if state + initial in ("s", "u", "su", "ua", "au") else None

    @functools.cache
    def best(i, state, inserted=0):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 2:
            for role in ("user", "assistant"):
                if after(state, role[0]):
                    k, a, r = best(i, role[0], inserted + 1)
                    ways.append((k + 3, "I" + a, ((role, ""), *r)))
        if i < len(rows):
            _, role, text = rows[i]
            k, a, r = best(i + 1, state)
            ways.append((k + 4, "D" + a, r))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                for edit, name, cost in [("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)]:
                    if name and after(state, name[0]):
                        k, a, r = best(i + 1, name[0])
                        ways.append((k + cost + more, edit + a, ((name, text), *r)))
        return min(ways) if ways else (10 ** 9, "", ())

    cost, audit, turns = best(0, "")
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, turns)


def check(got, rows):
    want = {}
    for conv, own in damage(rows).items():
        *counts, turns = plain(tuple(own))
        want[conv] = (*counts, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, SF_DIR).collect()
    check(got, rows)
    assert {f for r in got for f in r.audit} >= set("KRDI")


def invented(seed, conversations, most):
    r = random.Random(seed)
    out = []
    for conv in [None, *range(conversations)]:
        for turn in range(r.randint(1, most)):
            out.append((conv, r.choice([turn, turn, turn, turn + 3, None]),
                        r.choice(["user", "assistant", "assistant", "system", "tool", "", None]),
                        r.choice(["Yes.", "No", "What?", "", None, " \t", "Fine!\n", f"{turn}."])))
    return out


@pytest.mark.parametrize("run_rows", [7, 1 << 20])
def test_invented_conversations(spark, run_rows):
    """Short runs spread every conversation over tasks."""
    rows = invented(1, 150, 12)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {name: F.lit("extra") for name in [*CLASHING, "digest", "code", "run", "audit", "low"]}).repartition(3)
    check(c.repair(c.damaged(df), run_rows).collect(), rows)


def test_one_long_conversation_over_many_tasks(spark):
    """The edits of runs add up to those of the whole conversation."""
    r = random.Random(2)
    rows = [(5, t, r.choice(["user", "assistant", "system"]), f"{t // 2}{r.choice('.?x')}") for t in range(1500)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    one, many = (c.repair(c.damaged(df), n).collect() for n in (1 << 20, 40))
    assert one == many and len(one) == 1
    own = damage(rows)[5]
    assert c.walk(bytes(codes(own)), c.START, c.ENDS, True)[0] == one[0].audit


def codes(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = re.findall(BLANK, text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        out.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + c.FAULT[fault])
    return out


@pytest.mark.parametrize("seed", range(30))
def test_walk_is_the_least_of_the_cheapest(seed):
    own = tuple(next(iter(damage([(1, *x[1:]) for x in invented(seed, 0, 25)]).values())))
    audit, state = c.walk(bytes(codes(own)), c.START, c.ENDS, True)
    assert audit == plain(own)[6] and state in (c.START, c.ASSISTANT)


def test_a_very_long_walk_remembers_few_vectors():
    r = random.Random(3)
    text = bytes(r.choice([0, 1, 2, 3, 4, 9, 14, 15]) for _ in range(200_000))
    audit, _ = c.walk(text, c.START, c.ENDS, True)
    assert len(audit) - audit.count("I") == len(text) and len(c._STEPS) < 20_000
    assert len(c._crossing(text)) == 16 and len(c._STEPS) < 20_000


def test_repaired_rows(spark):
    rows = invented(4, 20, 8)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    coded = c.coded(c.damaged(df))
    found = {}
    for r in sorted(c.repaired(coded, c.edits(coded)).collect(), key=lambda r: r.place):
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    want = {k: list(plain(tuple(v))[-1]) for k, v in damage(rows).items()}
    assert found == {k: v for k, v in want.items() if v}


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert c.repair(c.damaged(df)).collect() == []
