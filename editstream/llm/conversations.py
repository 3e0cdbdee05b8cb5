"""Conversation structure repair: the cheapest edits by a checkpointed dynamic programme."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import inf, isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.functions.slices import in_slices
from editstream.llm.common import python_path, stage, table

BLANKS = " \t\n\x0b\x0c\r"
LONG_ROWS = 20_000
LONG_BYTES = 16_000_000
SLICE_ROWS = 100_000

DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5
INITIALS = ["", "s", "u", "a"]  # of a row's role; the first for all others
ROLES = {2: "user", 3: "assistant"}
# States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a. What may come, and what an
# inserted or rewritten row becomes.
FOLLOWS = [{1: 1, 2: 2}, {2: 2}, {3: 3}, {2: 2}]
MADE = [2, 2, 3, 2]
START = 0
Costs = tuple[float, float, float, float]
#: Cost after the last row, by state: rows are inserted until the form is complete.
END: Costs = (0, 2 * INSERT, INSERT, 0)


def code(initial: int, fault: int) -> int:
    """A row for the programme. ``fault``: 0 none, 1 blank or duplicate, 2 truncated."""
    return 3 * initial + fault


def moves(row: int, state: int) -> Iterator[tuple[str, float, int]]:
    """Edits of a row in a state, in ASCII order, with their costs and the next states."""
    initial, fault = divmod(row, 3)
    yield "D", DELETE, state
    if fault != 1:
        cut = CUT if fault == 2 else 0
        if initial in FOLLOWS[state]:
            yield "K", cut, FOLLOWS[state][initial]
        yield "R", REROLE + cut, MADE[state]


@cache
def before(row: int, after: Costs) -> tuple[Costs, float]:
    """Costs by state before a row from those after it, less their minimum; and the minimum.

    Only differences of costs matter and these are small, so there are few different arguments.
    """
    own = [min(cost + after[to] for _, cost, to in moves(row, q)) for q in range(4)]
    out = [min(own[q], INSERT + own[MADE[q]], 2 * INSERT + own[MADE[MADE[q]]]) for q in range(4)]
    least = min(out)
    return tuple(x - least for x in out), least


@cache
def choice(row: int, after: Costs, state: int) -> tuple[str, str, int]:
    """The ASCII-least of the cheapest edits up to and with this row: their initials; the same with
    the state each leads to; the last state."""
    costs, least = before(row, after)
    letters, told = "", ""
    while True:
        found = {e: to for e, cost, to in moves(row, state) if cost + after[to] == costs[state] + least}
        inserted = INSERT + costs[MADE[state]] == costs[state]
        edit = "D" if "D" in found else "I" if inserted else min(found)
        state = MADE[state] if edit == "I" else found[edit]
        letters, told = letters + edit, told + edit + str(state)
        if edit != "I":
            return letters, told, state


def closing(state: int) -> str:
    """Edits after the last row."""
    told = ""
    while END[state]:
        state = MADE[state]
        told += f"I{state}"
    return told


def normal(costs: list[float]) -> tuple[Costs, float]:
    least = min(costs)
    return tuple(x - least for x in costs), least


def cost_before(rows: bytes, after: Costs) -> list[float]:
    costs, total = normal(list(after))
    for row in reversed(rows):
        costs, least = before(row, costs)
        total += least
    return [x + total for x in costs]


def walk(rows: bytes, state: int, after: Costs) -> tuple[list[str], int]:
    """The edits of every row, each with the state it leads to, and the last state.

    Backward cost vectors are kept at every square root of the length only; walking forward, those of
    one block at a time are worked out again from the checkpoint behind it.
    """
    step = isqrt(len(rows)) + 1
    costs, _ = normal(list(after))
    checkpoints = {}
    for i in range(len(rows) - 1, -1, -1):
        if (i + 1) % step == 0 or i == len(rows) - 1:
            checkpoints[i // step] = costs
        costs, _ = before(rows[i], costs)
    edits = []
    for block in range(-(-len(rows) // step)):
        part = rows[block * step : (block + 1) * step]
        behind = [checkpoints[block]]
        for row in part[:0:-1]:
            behind.append(before(row, behind[-1])[0])
        for row in part:
            _, told, state = choice(row, behind.pop(), state)
            edits.append(told)
    return edits, state


def transfer(rows: bytes) -> list[list[float]]:
    """``[to][from]``: the cost of getting over these rows from one state to another."""
    return [cost_before(rows, tuple(0 if q == to else inf for q in range(4))) for to in range(4)]


# --- What is wrong with rows -------------------------------------------------------------------


def prepared(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text`` (null role and text: one space), ``gone``, and what a row shows."""
    text = F.coalesce(conversations["text"], F.lit(" "))
    role = F.coalesce(conversations["role"], F.lit(" "))
    gone = conversations["_gone"] if "_gone" in conversations.columns else F.lit(False)
    return conversations.select(
        conversations["conv_id"].alias("conv"),
        conversations["turn"].cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        gone.alias("gone"),
    ).withColumns({"initial": initial_of(F.col("role")), "fault": fault_of(F.col("text"))})


def initial_of(role: Column) -> Column:
    found = F.array_position(F.array(*map(F.lit, INITIALS[1:])), F.left(role, F.lit(1)))
    return found.cast("int")


def fault_of(text: Column) -> Column:
    """1 blank, 2 truncated, 0 neither."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", 1).when(F.right(bare, F.lit(1)).isin(*".!?"), 0).otherwise(2)


def legal(left: int, right: int) -> bool:
    return INITIALS[left] + INITIALS[right] in ("su", "ua", "au")


# --- Conversations that fit in a task ------------------------------------------------------------

NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
SUMMARY = {**dict.fromkeys(NUMBERS, "long"), "audit": "string", "repaired_sha256": "string"}
LINES = {"place": "long", "nth": "int", "edit": "string", "role": "string", "text": "string"}
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def schema_of(conv: str, columns: dict[str, str]) -> str:
    return f"conv {conv}, " + ", ".join(f"{name} {kind}" for name, kind in columns.items())


def edited(roles: list[str], texts: list[str], edits: list[str]) -> Iterator[tuple[int, int, str, str, str]]:
    """Rows as they are after their edits: number of the row, of the edit, edit, role, text."""
    for at, told in enumerate(edits):
        for nth in range(0, len(told), 2):
            edit, role = told[nth], ROLES.get(int(told[nth + 1]))
            if edit == "I":
                yield at, nth // 2, edit, role, ""
            elif edit != "D":
                yield at, nth // 2, edit, role if edit == "R" else roles[at], texts[at]


def repaired(conv: object, rows: list[dict]) -> tuple[tuple, list[str], list[dict]]:
    """The summary of a conversation, the edits, and the rows they stand for."""
    turns = {r["turn"] for r in rows if not r["gone"]} - {None}
    rows = [r for r in rows if not r["gone"]]
    seen: set[tuple[str, str]] = set()
    counts, codes = [0, 0, 0], bytearray()
    for row in rows:
        key, fault = (row["role"], row["text"]), row["fault"]
        kind = 0 if fault == 1 else 1 if key in seen else 2 if fault == 2 else None
        seen.add(key)
        if kind is not None:
            counts[kind] += 1
        codes.append(code(row["initial"], 1 if kind in (0, 1) else fault))
    cost = int(cost_before(bytes(codes), END)[START])
    edits, state = walk(bytes(codes), START, END)
    edits.append(closing(state))
    initials = [r["initial"] for r in rows]
    illegal = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *counts, illegal, cost, "".join(e[::2] for e in edits)), edits, rows


def by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[dict]]]:
    conv, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["conv"] != conv:
                yield conv, rows
                rows = []
            conv = row["conv"]
            rows.append(row)
    if rows:
        yield conv, rows


def short_ones(rows: DataFrame, whole: bool) -> DataFrame:
    """Conversations one by one from sorted partitions: summaries or, if ``whole``, their rows."""
    columns = LINES if whole else SUMMARY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.DataType] = []
        made: list[tuple] = []
        size = 0

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids.append(batch.schema.field("conv").type)
                yield batch

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            kinds = {"conv": ids[0], **{name: ARROW[kind] for name, kind in columns.items()}}
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*made), kinds.values())]
            return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

        for conv, found in by_conversation(typed()):
            summary, edits, kept = repaired(conv, found)
            lines = edited([r["role"] for r in kept], [r["text"] for r in kept], edits)
            if whole:
                made += [(conv, *line) for line in lines]
                size += sum(len(r["text"]) for r in kept)
            else:
                text = "\n".join(f"{role}:{text}" for *_, role, text in lines)
                made.append((*summary, hashlib.sha256(text.encode()).hexdigest()))
                size += len(summary[-1])
            if len(made) >= 5_000 or size > LONG_BYTES:
                if made:
                    yield batch_of(made)
                made, size = [], 0
        if made:
            yield batch_of(made)

    ordered = rows.withColumn("digest", F.md5("text")).repartition("conv")
    ordered = ordered.sortWithinPartitions("conv", "turn", "role", "digest").drop("digest")
    kind = rows.schema["conv"].dataType.simpleString()
    return ordered.mapInArrow(run, schema_of(kind, columns))


# --- Conversations of any length -------------------------------------------------------------------


def segments_of(placed: DataFrame) -> DataFrame:
    """A row for the part of each conversation in each slice: the codes of its rows, a byte each."""
    first = placed.groupBy("conv", "role", "digest").agg(F.min("place").alias("first"))
    first = first.select(*[F.col(c).alias(f"_{c}") for c in first.columns])
    agree = [placed[c].eqNullSafe(first[f"_{c}"]) for c in ("conv", "role", "digest")]
    again = F.col("place") > F.col("_first")
    fault = F.when((F.col("fault") == 1) | again, 1).otherwise(F.col("fault"))
    rows = placed.join(first, agree[0] & agree[1] & agree[2]).select(
        "conv",
        "slice",
        "place",
        F.chr((F.col("initial") * 3 + fault).cast("int") + 65).alias("code"),
        (F.col("fault") == 1).alias("blank"),
        ((F.col("fault") != 1) & again).alias("duplicate"),
        ((F.col("fault") == 2) & ~again).alias("truncated"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("place", "code")))
    return rows.groupBy("conv", "slice").agg(
        F.array_join(F.transform(in_order, lambda r: r["code"]), "").alias("codes"),
        F.min("place").alias("begin"),
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )


def jumps(rows: bytes) -> int:
    """Neighbours whose roles may not follow each other."""
    return sum(not legal(a // 3, b // 3) for a, b in zip(rows, rows[1:]))


def read_codes(text: str) -> bytes:
    return bytes(ord(c) - 65 for c in text)


def long_ones(rows: DataFrame, whole: bool, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The same for conversations of any length: they are cut into slices of the whole order.

    Every slice gives the costs of getting over it; from these the costs at the borders of slices,
    which are the checkpoints, follow backward. With them every slice walks its rows for each
    state it may begin in, and a pass over the slices tells which walk holds. Only digests of whole
    conversations, which have to be read in order, are one task each, as a stream.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    kept = rows.where(~F.col("gone")).withColumns(
        {"digest": F.md5("text"), "uid": F.monotonically_increasing_id()}
    )
    order = ["conv", "turn", "role", "digest", "uid"]
    placed = stage(in_slices(kept, order, slice_rows), "turns")
    segments = stage(segments_of(placed), "segments")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_codes(c) for c in batch.column("codes").to_pylist()]
            columns = {
                "conv": batch.column("conv"),
                "slice": batch.column("slice"),
                "costs": pa.array([sum(transfer(r), []) for r in found], pa.list_(pa.float64())),
                "inner": pa.array([jumps(r) for r in found], pa.int64()),
                "first": pa.array([r[0] for r in found], pa.int32()),
                "last": pa.array([r[-1] for r in found], pa.int32()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    costs = segments.mapInArrow(
        over, f"conv {kind}, slice long, costs array<double>, inner long, first int, last int"
    )

    def back(group: pa.Table) -> pa.Table:
        group = group.sort_by("slice")
        after, told = list(END), []
        for matrix in reversed(group.column("costs").to_pylist()):
            told.append(after)
            after = [min(matrix[4 * to + q] + after[to] for to in range(4)) for q in range(4)]
        borders = zip(group.column("last").to_pylist(), group.column("first").to_pylist()[1:])
        illegal = sum(group.column("inner").to_pylist()) + sum(jumps(bytes(b)) for b in borders)
        columns = {
            "conv": group.column("conv"),
            "slice": group.column("slice"),
            "after": pa.array(told[::-1], pa.list_(pa.float64())),
            "cost": pa.array([int(after[START])] * len(told), pa.int64()),
            "illegal": pa.array([illegal] * len(told), pa.int64()),
        }
        return pa.table(columns)

    known = stage(
        costs.groupBy("conv").applyInArrow(
            back, f"conv {kind}, slice long, after array<double>, cost long, illegal long"
        ),
        "checkpoints",
    )

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"conv": "_conv", "slice": "_slice"})
        both = left["conv"].eqNullSafe(right["_conv"]) & (left["slice"] == right["_slice"])
        return left.join(right, both).drop("_conv", "_slice")

    def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("codes").to_pylist(), batch.column("after").to_pylist())
            found = [[walk(read_codes(c), q, tuple(after)) for q in range(4)] for c, after in pairs]
            columns = {name: batch.column(name) for name in ("conv", "slice", "begin")}
            ends = [[end for _, end in w] for w in found]
            edits = [[" ".join(told) for told, _ in w] for w in found]
            columns["ends"] = pa.array(ends, pa.list_(pa.int32()))
            columns["edits"] = pa.array(edits, pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(columns)

    walked = stage(
        joined(segments, known.select("conv", "slice", "after")).mapInArrow(
            walks, f"conv {kind}, slice long, begin long, ends array<int>, edits array<string>"
        ),
        "walks",
    )

    def begins(group: pa.Table) -> pa.Table:
        group = group.sort_by("slice")
        state, told = START, []
        for ends in group.column("ends").to_pylist():
            told.append(state)
            state = ends[state]
        columns = {
            "conv": group.column("conv"),
            "slice": group.column("slice"),
            "state": pa.array(told, pa.int32()),
            "closing": pa.array([""] * (len(told) - 1) + [closing(state)], pa.string()),
        }
        return pa.table(columns)

    states = (
        walked.select("conv", "slice", "ends")
        .groupBy("conv")
        .applyInArrow(begins, f"conv {kind}, slice long, state int, closing string")
    )
    edits = stage(
        joined(walked, states).select(
            "conv", "slice", "begin", F.col("edits")[F.col("state")].alias("edits"), "closing"
        ),
        "turn-edits",
    )
    told = edits.select("conv", "begin", F.posexplode(F.split("edits", " ")).alias("at", "told"))
    told = told.select((F.col("begin") + F.col("at")).alias("_place"), "told")
    steps = F.expr("sequence(0, cast(length(told) / 2 as int) - 1)")
    last = edits.where("closing <> ''").select(
        "conv",
        F.lit(2**62).alias("place"),
        F.lit("").alias("role"),
        F.lit("").alias("text"),
        F.col("closing").alias("told"),
    )
    lines = (
        placed.join(told, placed["place"] == told["_place"])
        .select("conv", "place", "role", "text", "told")
        .unionByName(last)
        .withColumn("nth", F.explode(steps))
        .withColumns(
            {
                "edit": F.substring("told", F.col("nth") * 2 + 1, F.lit(1)),
                "made": F.substring("told", F.col("nth") * 2 + 2, F.lit(1)),
            }
        )
        .where("edit <> 'D'")
    )
    name = F.when(F.col("made") == "2", ROLES[2]).otherwise(ROLES[3])
    lines = lines.select(
        "conv",
        "place",
        "nth",
        "edit",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(name).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"),
    )
    if whole:
        return lines
    return long_summaries(rows, segments, known, edits, lines, kind)


def long_summaries(
    rows: DataFrame, segments: DataFrame, known: DataFrame, edits: DataFrame, lines: DataFrame, kind: str
) -> DataFrame:
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, hashed, found = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if hashed is None or row["conv"] != conv:
                    if hashed is not None:
                        found.append((conv, hashed.hexdigest()))
                    conv, hashed = row["conv"], hashlib.sha256()
                else:
                    hashed.update(b"\n")
                hashed.update(f"{row['role']}:{row['text']}".encode())
        if hashed is not None:
            found.append((conv, hashed.hexdigest()))
        if found:
            ids, hashes = zip(*found)
            kinds = [pa.array(ids, batch.schema.field("conv").type), pa.array(hashes)]
            yield pa.RecordBatch.from_arrays(kinds, names=["conv", "repaired_sha256"])

    hashes = (
        lines.repartition("conv")
        .sortWithinPartitions("conv", "place", "nth")
        .mapInArrow(digests, f"conv {kind}, repaired_sha256 string")
    )
    letters = F.regexp_replace(F.concat("edits", F.lit(" "), "closing"), "[^A-Z]", "")
    audits = edits.groupBy("conv").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("slice", letters.alias("audit")))), lambda r: r["audit"]
            ),
            "",
        ).alias("audit")
    )
    left = rows.where(~F.col("gone"))
    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    parts = [
        left.groupBy("conv").agg(F.coalesce(spread, F.lit(0)).alias("gaps")),
        segments.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]),
        known.groupBy("conv").agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost")),
        audits,
        hashes,
    ]
    out = rows.select("conv").distinct()
    for part in parts:
        part = part.withColumnRenamed("conv", "_conv")
        out = out.join(part, out["conv"].eqNullSafe(part["_conv"]), "left").drop("_conv")
    return out.select(
        "conv",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in NUMBERS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


# --- The operator ------------------------------------------------------------------------------------


def repair(
    conversations: DataFrame,
    whole: bool = False,
    long_rows: int = LONG_ROWS,
    long_bytes: int = LONG_BYTES,
) -> DataFrame:
    """Repair the turns of every conversation with the cheapest edits.

    Rows come in order of ``turn``, nulls first, ties by role and by digest of the text. A row may be
    blank, a duplicate of an earlier one in role and text, or truncated: it ends without ``.!?``.
    Blank and duplicate rows are deleted. Every other row is kept (0), given another role (1) or
    deleted (2), and empty rows inserted (5), so that the initials of the roles read ``(s?(ua)+)?``;
    a truncated row that stays costs 5. Of the cheapest edits the ASCII-least hold.

    Gives a row per conversation with counts, ``cost``, ``audit`` (the edits' initials) and the digest of
    the repaired rows; with ``whole`` the repaired rows, in order of ``place, nth``.

    Null roles and texts are read as one space, null turns come first and count for no gap, rows of
    a null ``conv_id`` are one conversation. Rows marked in a column ``_gone`` are not there, but their
    conversation is. Other columns do not matter. No rows give no conversation. A conversation
    of more than ``long_rows`` rows or ``long_bytes`` of text is cut into slices over many tasks.
    """
    python_path(conversations.sparkSession)
    rows = prepared(conversations)
    sizes = rows.groupBy("conv").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")
    )
    long = sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes))
    long = stage(long.select(F.col("conv").alias("_conv")), "long-conversations")
    if long.isEmpty():
        found = short_ones(rows, whole)
    else:
        agree = rows["conv"].eqNullSafe(long["_conv"])
        found = short_ones(rows.join(long, agree, "left_anti"), whole).unionByName(
            long_ones(rows.join(long, agree, "left_semi"), whole)
        )
    return found.withColumnRenamed("conv", "conv_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by the hash of conversation and turn: 0 dropped (marked ``_gone``), 1 emptied,
    2 without ``.!?``, 3 there twice, 4 of role user."""
    part = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    rows = conversations.select(
        conversations["conv_id"].alias("conv_id"),
        conversations["turn"].alias("turn"),
        F.when(fault == 4, "user").otherwise(part("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("_gone"),
        F.when(fault == 3, 2).otherwise(1).alias("_copies"),
    )
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).drop(
        "_copies", "_copy"
    )


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))
