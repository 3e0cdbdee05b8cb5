import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from editstream.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damaged_rows(rows):
    out = {}
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        own = out.setdefault(conv, [])
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Best-first search over (row, state of the form), by cost, then by the edits' letters."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    made = {"": "user", "s": "user", "a": "user", "u": "assistant"}
    heap, done, tick = [(0, "", 0, 0, "", ())], set(), itertools.count(1)
    while True:
        cost, audit, _, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        if (i, state) in done:
            continue
        done.add((i, state))
        push = lambda *x: heapq.heappush(heap, (x[0], x[1], next(tick), *x[2:]))
        push(cost + 5, audit + "I", i, made[state][0], (*out, made[state] + ":"))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        push(cost + 2, audit + "D", i + 1, state, out)
        if fault in ("blank", "duplicate"):
            continue
        cut = 5 if fault == "truncated" else 0
        if role[:1] in step[state]:
            push(cost + cut, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}"))
        push(cost + cut + 1, audit + "R", i + 1, made[state][0], (*out, f"{made[state]}:{text}"))


def plain(rows):
    """The query by its definition."""
    found = {}
    for conv, own in damaged_rows(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        turns = {t for t, _, _ in own} - {None}
        seen, marked = set(), []
        for _, role, text in own:
            bare = text.strip(BLANK)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None
            fault = fault or ("truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            marked.append((role, text, fault))
        cost, audit, out = cheapest(marked)
        faults = [f for _, _, f in marked]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest(),
        )
    return found


def summaries(df):
    rows = df.collect()
    found = {r.conv_id: (*[r[n] for n in NUMBERS], r.audit, r.repaired_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def made_up(seed, conversations=120):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    texts = ["Hi.", "Well?", "no end", " \t", "", None, "x!\n", ". .", "é", "Yes.", "a "]
    rows = []
    for conv in [*range(conversations), None]:
        turn = 0
        for _ in range(rng.randint(1, 14)):
            turn += rng.choice([1, 1, 1, 2, 0])
            rows.append((conv, None if rng.random() < 0.05 else turn, rng.choice(roles), rng.choice(texts) or rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_definition(spark, seed):
    rows = made_up(seed)
    got = summaries(c.repair(c.damaged(spark.createDataFrame(rows, SCHEMA))))
    assert got == plain(rows)


@pytest.mark.parametrize("limits", [{"long_rows": 3}, {"long_bytes": 9}])
def test_slices_change_nothing(spark, monkeypatch, limits):
    monkeypatch.setattr(c.long_ones, "__defaults__", (7,))
    rows = made_up(3)
    rows += [(1000, i, ["user", "assistant"][i % 2 ^ (i % 17 == 0)], f"t{i % 90}.") for i in range(700)]
    rows += [(1001, None, "user", "same.")] * 50 + [(1002, 5, "user", "no end")] * 30
    rows += [(2**60 + 1, i, "assistant", f"{i}?") for i in range(40)]
    got = summaries(c.repair(c.damaged(spark.createDataFrame(rows, SCHEMA)), **limits))
    assert got == plain(rows)


def test_rows_after_repair(spark, monkeypatch):
    monkeypatch.setattr(c.long_ones, "__defaults__", (5,))
    rows = [(7, 0, "system", "Be kind."), (7, 1, "assistant", "Hi."), (7, 2, "user", "no end"), (7, 3, "user", "Go?")]
    df = spark.createDataFrame(rows, SCHEMA)
    for limit in (100, 1):
        lines = c.repair(df, whole=True, long_rows=limit).orderBy("place", "nth").collect()
        got = [(r.edit, r.role, r.text) for r in lines]
        assert got == [("K", "system", "Be kind."), ("R", "user", "Hi."), ("R", "assistant", "Go?")]


@pytest.mark.parametrize("seed", range(3))
def test_walks_from_checkpoints_equal_search(seed):
    rng = random.Random(seed)
    names = {0: None, 1: "blank", 2: "truncated"}
    roles = ["tool", "system", "user", "assistant"]
    for length in (0, 1, 2, 3, 5, 9, 16, 17, 40, 101):
        picks = [(rng.randrange(4), rng.choice([0, 0, 1, 2])) for _ in range(length)]
        codes = bytes(c.code(*p) for p in picks)
        cost, audit, _ = cheapest([(roles[i], "t", names[f]) for i, f in picks])
        edits, state = c.walk(codes, c.START, c.END)
        assert "".join(e[::2] for e in [*edits, c.closing(state)]) == audit
        assert c.cost_before(codes, c.END)[c.START] == cost
        # Two parts, the second's costs as the checkpoint between them.
        cut = length // 3
        matrix = c.transfer(codes[:cut])
        behind = c.cost_before(codes[cut:], c.END)
        assert min(matrix[q][c.START] + behind[q] for q in range(4)) == cost
        left, middle = c.walk(codes[:cut], c.START, tuple(behind))
        right, _ = c.walk(codes[cut:], middle, c.END)
        assert left + right == edits


def test_empty_gone_and_clashing(spark):
    # Conversation and turn whose hash drops the row.
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for limit in (0, 10):
        got = summaries(c.repair(c.damaged(df), long_rows=limit))
        assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    names = ["conv", "gone", "place", "slice", "digest", "code", "begin", "uid", "initial", "fault", "_conv"]
    wide = df.withColumns({n: F.lit("x") for n in names})
    for limit in (0, 10):
        assert summaries(c.repair(wide, long_rows=limit))[gone][6] == "D"
        assert c.repair(wide.where("false"), long_rows=limit).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert summaries(c.op13_conversations(spark, sf_dir)) == plain(rows)
