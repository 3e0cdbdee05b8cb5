"""Rescans by the index of finished ids, and rule by rule."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from editstream.functions import rulebook
from editstream.operators import detect
from editstream.plans import by_rule, finished, rescan
from editstream.plans.routing import RuleSet
from editstream.sources import snapshots, tables

COMMENTS = ["plain", "great 🎉", "nestled in", "turn0search0 x", "— — — —", "as an AI language model", None, "**b**"]


@pytest.fixture
def stored(spark, edit_rows, tmp_path):
    root = str(tmp_path / "tables")
    tables.ensure_tables(spark, root)
    for batch in range(2):
        tables.write_table(edit_rows(*rows_of(batch)), root, "edits", batch)
    return root


def rows_of(batch):
    return [
        {"evt_id": f"{batch}-{i}", "comment": c, "type": "edit", "title": "t", "dt_server": datetime(2024, 1, 1 + i % 2)}
        for i, c in enumerate(COMMENTS)
    ]


def outcome(spark, root):
    """Flags by version and id, '' for clean ones."""
    flagged = tables.read_table(spark, root, "flagged").select(
        "rule_version", "event_id", F.array_join("detection_metadata.flag_types", "|").alias("f"), "content_sample.text_length"
    )
    clean = tables.read_table(spark, root, "clean").select("rule_version", "event_id", F.lit(""), F.lit(None))
    return sorted(tuple(map(str, r)) for r in flagged.union(clean).collect())


def test_index_follows_the_tables_and_is_joined_in_place(spark, stored):
    assert rescan.rescan(spark, stored, "1.0.3", buckets=6)["scanned"] == 16
    assert finished.sync(spark, stored) > 0
    assert finished.sync(spark, stored) == 0
    edits = tables.read_table(spark, stored, "edits")
    done = finished.screened_ids(spark, stored, "1.0.3")
    assert sorted(r[0] for r in done.collect()) == sorted(r["evt_id"] for r in edits.select("evt_id").collect())
    left = finished.pending_ids(edits, done)
    assert left.count() == 0
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = finished.pending_ids(edits, done)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Only the ids of the edits move, to as many partitions as the index has buckets.
    assert plan.count("Exchange") == 1
    assert re.search(r"Exchange hashpartitioning\(evt_id#\d+, 6\)", plan)


def test_a_compacted_table_is_not_indexed_again(spark, stored):
    rescan.rescan(spark, stored, "1.0.2")
    tables.write_table(
        tables.read_table(spark, stored, "flagged").withColumn("rule_version", F.lit("1.0.3")), stored, "flagged", "x"
    )
    finished.sync(spark, stored)
    day = next(f.day for f in snapshots.folders(spark, f"{stored}/flagged"))
    tables.compact_day(spark, stored, "flagged", day)
    assert finished.sync(spark, stored) == 0
    # Compacted before it was known: the whole folder is read.
    tables.write_table(tables.read_table(spark, stored, "flagged").limit(1), stored, "flagged", "y")
    tables.compact_day(spark, stored, "flagged", day)
    assert finished.sync(spark, stored) == 1


def test_rescan_by_rule_gives_the_tables_of_a_full_one(spark, stored, edit_rows, tmp_path):
    other = str(tmp_path / "other")
    tables.ensure_tables(spark, other)
    for root in (stored, other):
        tables.write_table(edit_rows({"evt_id": None, "comment": "nestled"}, {"evt_id": None}), root, "edits", "odd")
    for batch in range(2):
        tables.write_table(edit_rows(*rows_of(batch)), other, "edits", batch)
    for version in ("1.0.2", "1.0.3", "1.0.0"):
        full = rescan.rescan(spark, other, version)
        own = by_rule.rescan_changed(spark, stored, version)
        assert {k: own[k] for k in full} == full
    assert outcome(spark, stored) == outcome(spark, other)
    tables.write_table(edit_rows(*rows_of(7)), stored, "edits", 7)
    tables.write_table(edit_rows(*rows_of(7)), other, "edits", 7)
    by_rule.rescan_changed(spark, stored, "1.0.3")
    rescan.rescan(spark, other, "1.0.3")
    assert outcome(spark, stored) == outcome(spark, other)


def test_only_changed_rules_run(spark, stored, edit_rows, monkeypatch):
    ran = []
    hits_of = by_rule.hits_of

    def watched(edits, rules):
        ran.append(sorted(r["flag"] for r in rules))
        return hits_of(edits, rules)

    monkeypatch.setattr(by_rule, "hits_of", watched)
    assert by_rule.rescan_changed(spark, stored, "1.0.2")["rules"] == 11
    # The two versions differ in one rule.
    assert by_rule.rescan_changed(spark, stored, "1.0.3")["rules"] == 1
    assert ran[1:] == [["emoji_in_headings"]]
    own = RuleSet("own", [*rulebook.RULE_SETS["1.0.3"][:3], {"flag": "f", "kind": "phrases", "patterns": ["plain"]}])
    found = by_rule.rescan_changed(spark, stored, own)
    assert found == {"scanned": 16, "flagged": 6, "rules": 1} and ran[2:] == [["f"]]
    # New edits are seen by all rules of a version, old ones by none.
    tables.write_table(edit_rows(*rows_of(5)), stored, "edits", 5)
    assert by_rule.rescan_changed(spark, stored, own)["scanned"] == 8 and len(ran[3]) == 4
    # Compaction changes nothing.
    tables.compact_day(spark, stored, "edits", "2024-01-01")
    assert by_rule.missing(spark, stored, own.rules) == {}


def test_a_run_that_breaks_off_is_repeated(spark, stored, monkeypatch):
    commit, calls = snapshots.commit, []

    def once(spark, table, change):
        calls.append(table)
        if table.endswith(by_rule.SCREENED):
            raise OSError("lost")
        return commit(spark, table, change)

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", once)
        with pytest.raises(OSError):
            by_rule.rescan_changed(spark, stored, "1.0.3")
    assert by_rule.rescan_changed(spark, stored, "1.0.3")["rules"] == 11
    edits = tables.read_table(spark, stored, "edits")
    want = {
        (r["evt_id"], tuple(r["flag_types"]))
        for r in detect.flagged_only(edits, rulebook.RULE_SETS["1.0.3"]).collect()
    }
    flagged = tables.read_table(spark, stored, "flagged").collect()
    assert {(r["event_id"], tuple(r["detection_metadata"]["flag_types"])) for r in flagged} == want
    assert len(flagged) == len(want)
