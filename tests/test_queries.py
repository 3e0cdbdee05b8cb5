"""The stored queries: against SQL on the smallest tables, and their plans."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from compare_with_sql import compare
from editstream.plans import analytics
from editstream.registry.plain import plain

SF = "/root/testdata/sf0.001"
CHECKED = [
    "ingest_reject_counts",
    "media_strip",
    "flat_edits",
    "route_counts",
    "dead_letters",
    "flags_1_0_0",
    "flags_1_0_3",
    "rule_version_changes",
    "flagged_events",
    "quality_scores",
    "users_with_flags",
    "flag_rate_by_domain",
    "flag_pairs",
    "flag_correlation",
    "dead_letters_by_category",
    "daily_summary",
    "user_patterns",
    "pending_scan",
    "late_events",
    "repeated_content_members",
    "schema_compatibility",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["flag_type", "count"] and result.count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def flagged_table(spark, rows):
    schema = "event_id string, user string, title string, domain string, ai_flags map<string,boolean>"
    return spark.createDataFrame(rows, schema)


def test_samples_are_bounded_and_sorted(spark):
    rows = [(str(i), "hot", f"t{i % 30:02d}", "d", {"a": True}) for i in range(300)]
    rows += [("x", "one", "t", "d", {"a": True}), ("y", None, None, "d", {"a": True}), ("z", None, "q", "d", {})]
    result = analytics.users_with_flags(flagged_table(spark, rows))
    got = {r["user"]: (r["ai_flagged_count"], r["affected_pages"]) for r in result.collect()}
    assert got == {"hot": (300, [f"t{i:02d}" for i in range(10)]), None: (2, ["q"])}
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "ReusedExchange" in plan


def test_correlation_of_constant_flags_is_null(spark):
    rows = [("1", "u", "t", "d", {"a": True, "b": True}), ("2", "u", "t", "d", {"a": True}), ("3", "u", "t", "d", {"a": True, "c": True})]
    pairs = analytics.flag_correlation(flagged_table(spark, rows), ["a", "b", "c"])
    got = {(r["pattern_1"], r["pattern_2"]): r["phi"] for r in pairs.collect()}
    assert got[("a", "b")] is None and got[("b", "c")] == pytest.approx(-0.5)


def test_queries_on_empty_tables(spark, edit_rows):
    empty = edit_rows({"evt_id": "1"}).where("false")
    assert analytics.completeness(empty).first()["title_completeness"] is None
    assert analytics.total_events(empty).first()["total_events"] == 0
    flagged = flagged_table(spark, [("1", "u", "t", "d", {"a": True})]).where("false")
    assert analytics.flag_counts(flagged).count() == 0
    assert analytics.flag_correlation(flagged, ["a", "b"]).first()["phi"] is None


def test_unreadable_times_are_left_out_of_no_count(spark, edit_rows):
    edits = edit_rows({"evt_id": "1", "dt_user": "never"}, {"evt_id": "2", "dt_user": "2024-01-01T10:20:30Z"})
    hours = {str(r["hour"]): r["event_count"] for r in analytics.events_per_hour(edits).collect()}
    assert hours == {"None": 1, "2024-01-01 10:00:00": 1}


def test_whole_scans_read_only_their_columns(spark, tmp_path, edit_rows):
    edit_rows({"evt_id": "1", "domain": "d"}).write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    plan = analytics.events_by_domain(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<type:string,domain:string>" in plan
    filtered = analytics.large_edits(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(type)" in filtered and "EqualTo(type,edit)" in filtered


def test_plain_columns(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 01:02:03' t, date'2024-01-01' d, array('a','b') a,"
        " map('k', true) m, named_struct('x', 1) s"
    )
    assert plain(df).first().asDict() == {
        "t": "2024-01-01 01:02:03", "d": "2024-01-01", "a": "a|b", "m": "k", "s_x": 1,
    }
