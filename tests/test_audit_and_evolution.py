import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editstream.functions.columns import join_group_sizes
from editstream.functions.slices import in_slices
from editstream.operators import audit, evolution, ingest
from editstream.schemas import EDIT_SCHEMA

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def test_first_per_id(edit_rows):
    rows = [{"evt_id": "a", "dt_server": at(i), "title": f"t{i}"} for i in (3, 1, 2)]
    rows.append({"evt_id": "b", "dt_server": at(0), "title": "x"})
    kept = audit.first_per_id(edit_rows(*rows))
    assert sorted((r["evt_id"], r["title"]) for r in kept.collect()) == [("a", "t1"), ("b", "x")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_repeated_ids(edit_rows):
    rows = [{"evt_id": i, "dt_server": at(n)} for n, i in enumerate("abacca")]
    found = audit.repeated_ids(edit_rows(*rows)).collect()
    assert {(r["evt_id"], r["copies"]) for r in found} == {("a", 3), ("c", 2)}


def test_content_copies_against_brute_force(edit_rows):
    contents = ["x", "y", "x", None, "", None, "x", "z"]
    rows = [{"evt_id": str(n), "title": "t", "user": "u", "comment": c} for n, c in enumerate(contents)]
    rows.append({"evt_id": "0", "title": "t", "user": "u", "comment": "x"})  # the same id again
    rows.append({"evt_id": "9", "title": "tu", "user": "", "comment": "x"})
    df = edit_rows(*rows)
    groups = audit.repeated_content(df).collect()
    assert sorted((r["copies"], r["first_id"], r["last_id"]) for r in groups) == [
        (2, "3", "5"), (4, "0", "6"),
    ]
    members = audit.repeated_content_members(df).collect()
    assert sorted((r["evt_id"], r["copies"]) for r in members) == [
        ("0", 4), ("0", 4), ("2", 4), ("3", 2), ("5", 2), ("6", 4),
    ]


@pytest.mark.parametrize("rows_of_slice", [1, 3, 100])
def test_late_events_against_brute_force(edit_rows, rows_of_slice):
    times = [5, 3, 9, 9, 2, 12, 11, 13, 1, 14, 14, 0]
    rows = [
        {"evt_id": str(n), "domain": "ab"[n % 2], "dt_server": at(t)} for n, t in enumerate(times)
    ]
    want = set()
    for domain in "ab":
        peak = None
        for row in [r for r in rows if r["domain"] == domain]:
            if peak is not None and peak > row["dt_server"]:
                want.add((row["evt_id"], peak))
            peak = max(peak or row["dt_server"], row["dt_server"])
    arrival = F.col("evt_id").cast("long")
    late = audit.late_events(edit_rows(*rows), arrival, slice_rows=rows_of_slice)
    assert {(r["evt_id"], r["latest_before"]) for r in late.collect()} == want


def test_clock_differences(edit_rows):
    rows = [
        {"domain": "d", "dt_user": "2024-01-01T00:00:00Z", "dt_server": at(0)},
        {"domain": "d", "dt_user": "2024-01-01T00:00:00Z", "dt_server": at(-61)},
        {"domain": "d", "dt_user": "never", "dt_server": at(0)},
    ]
    row = audit.clock_differences(edit_rows(*rows)).first()
    assert (row["events"], row["unreadable"], row["inconsistent"], row["max_seconds"]) == (3, 1, 1, 61)


def test_sizes(spark):
    df = spark.createDataFrame([("é",), ("abc",)], "a string")
    row = audit.row_sizes(df).first()
    assert (row["rows"], row["total_bytes"], row["max_bytes"]) == (2, 10 + 11, 11)
    payload = "x" * 2000
    dead = spark.createDataFrame([(payload, payload), (payload, payload * 3)], "_original_payload string, c string")
    growth = audit.dead_letter_growth(dead).first()
    assert (growth["large_rows"], growth["oversized_rows"]) == (2, 1)


def test_conform_only_adds(spark):
    df = spark.createDataFrame([("1", 5)], "evt_id string, future long")
    out = evolution.conform(df, EDIT_SCHEMA)
    assert out.columns == EDIT_SCHEMA.fieldNames() + ["future"]
    assert out.first()["evt_id"] == "1" and out.first()["ns"] is None and out.first()["future"] == 5
    assert evolution.missing_columns(out, EDIT_SCHEMA) == []


def field(name, kind=T.StringType(), nullable=True):
    return T.StructField(name, kind, nullable)


@pytest.mark.parametrize(
    "new, compatible",
    [
        ([field("a"), field("b")], True),
        ([field("a"), field("b"), field("c")], True),
        ([field("a")], False),
        ([field("a", T.LongType()), field("b")], False),
        ([field("a", nullable=False), field("b")], False),
    ],
)
def test_schema_report(new, compatible):
    report = evolution.schema_report(T.StructType([field("a"), field("b")]), T.StructType(new))
    assert report["is_compatible"] is compatible


def test_loosening_a_column_is_compatible():
    old = T.StructType([field("a", nullable=False)])
    report = evolution.schema_report(old, T.StructType([field("a")]))
    assert report["is_compatible"] is True
    assert report["mode_changes"] == [{"field": "a", "old_mode": "REQUIRED", "new_mode": "NULLABLE"}]


def test_observed_compatibility(lines):
    records = [
        {"evt_id": "1", "type": "edit", "domain": "d", "ns": 1, "title": None, "new_key": 1},
        {"evt_id": "2", "type": "edit", "ns": "x", "title": "t"},
    ]
    report = evolution.compatibility_report(ingest.parse_events(lines(*records, "[1]")))
    status = {r["field"]: (r["status"], r["breaking"]) for r in report.collect()}
    assert status["evt_id"] == ("ok", False)
    assert status["title"] == ("ok", False)
    assert status["ns"] == ("type_change", True)
    assert status["domain"] == ("not_required", True)
    assert status["new_key"] == ("added", False)
    assert status["comment"] == ("removed", True)


def test_rows_of_a_hot_group_are_not_shuffled(edit_rows):
    """One group with most rows, one with a few, the rest single."""
    contents = ["hot"] * 3000 + ["warm"] * 3 + [f"c{i}" for i in range(200)]
    rows = [{"evt_id": str(i), "comment": c, "title": "", "user": ""} for i, c in enumerate(contents)]
    df = edit_rows(*rows)
    digest = audit.content_digest().alias("content")
    groups = audit.repeated_content(df).select("content", "copies")
    members = join_group_sizes(df.select("evt_id", digest), groups, "content", "copies", most_hot=10)
    got = sorted((int(r["evt_id"]), r["copies"]) for r in members.collect())
    assert got == [(i, 3000) for i in range(3000)] + [(i, 3) for i in range(3000, 3003)]
    whole = audit.repeated_content_members(df)
    assert sorted((int(r["evt_id"]), r["copies"]) for r in whole.collect()) == got


def sparse(edit_rows, groups=3, count=4000):
    """Arrivals in microseconds with long pauses; one group has most of the rows."""
    rng = random.Random(4)
    rows, clock = [], 1_700_000_000_000_000
    for i in range(count):
        clock += rng.choice([1, 7, 10**6, 10**10])
        group = None if i % 50 == 1 else "hot" if i % 10 else f"g{i % groups}"
        time = datetime(2024, 1, 1) + timedelta(seconds=i - rng.choice([0] * 9 + [50, 300]))
        rows.append({"evt_id": str(i), "domain": group, "dt_server": time, "title": str(clock)})
    return rows, edit_rows(*rows)


def test_late_events_of_sparse_arrivals(edit_rows):
    rows, df = sparse(edit_rows)
    want, peaks = {}, {}
    for row in rows:
        peak = peaks.get(row["domain"])
        if peak and peak > row["dt_server"]:
            want[row["evt_id"]] = peak
        peaks[row["domain"]] = max(peak or row["dt_server"], row["dt_server"])
    late = audit.late_events(df, F.col("title").cast("long"), slice_rows=250)
    assert {r["evt_id"]: r["latest_before"] for r in late.collect()} == want
    assert len(want) > 300


def test_slices_are_of_like_size_whatever_the_group(edit_rows):
    _, df = sparse(edit_rows)
    slices = in_slices(df.select("domain", F.col("title").cast("long").alias("at")), ["domain", "at"], 250)
    sizes = sorted(r["count"] for r in slices.groupBy("slice").count().collect())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_late_events_plan(edit_rows):
    late = audit.late_events(edit_rows({"evt_id": "1"}), F.col("evt_id").cast("long"))
    plan = late._jdf.queryExecution().executedPlan().toString()
    # A window over slices, and one within a slice; the wide rows are in no window.
    assert plan.count("Window [max(top") == 1 and plan.count("Window [max(peak") == 1
    assert "comment" not in "".join(x for x in plan.splitlines() if "Window" in x)


def test_rows_of_one_arrival_are_not_before_each_other(edit_rows):
    rows = [{"evt_id": str(i), "domain": "d", "dt_server": at(-i), "title": None} for i in range(5)]
    late = audit.late_events(edit_rows(*rows, {**rows[4], "title": "1"}), F.col("title").cast("long"))
    assert [(r["title"], r["latest_before"]) for r in late.collect()] == [("1", at(0))]


def test_rows_without_id_or_group_are_audited(edit_rows):
    time = [datetime(2024, 1, 1, h) for h in (3, 1, 2)]
    rows = edit_rows(*[{"evt_id": None, "title": str(i), "dt_server": t} for i, t in enumerate(time)])
    assert audit.first_per_id(rows).count() == 3
    late = audit.late_events(rows, F.col("title").cast("long"), slice_rows=1)
    assert sorted(r["title"] for r in late.collect()) == ["1", "2"]


def test_copies_that_agree_in_the_order_keep_the_same_row(edit_rows):
    rows = [{"evt_id": "1", "title": "t", "comment": c} for c in "abc"]
    kept = {audit.first_per_id(edit_rows(*x)).first()["comment"] for x in (rows, rows[::-1])}
    assert len(kept) == 1
