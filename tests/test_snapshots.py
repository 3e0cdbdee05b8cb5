"""Tables by manifest: readers see whole versions, runs that break off leave none."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from editstream.plans import analytics
from editstream.sources import snapshots, tables

DAY = "2024-01-02"


def ids(df):
    return sorted(r["evt_id"] for r in df.select("evt_id").collect())


@pytest.fixture
def stored(spark, edit_rows, tmp_path):
    """Three batches over two days each, one row without a day."""
    root = str(tmp_path / "tables")
    for batch in "abc":
        rows = [
            {"evt_id": f"{batch}{i}", "dt_server": datetime(2024, 1, 1 + i % 2, 5), "title": "t"}
            for i in range(4)
        ]
        tables.write_table(edit_rows(*rows), root, "edits", batch)
    tables.write_table(edit_rows({"evt_id": "none"}), root, "edits", "d")
    return root


def path_of(root):
    return f"{root}/edits"


def test_readers_before_and_during_a_compaction_see_the_old_version(spark, stored, monkeypatch):
    whole = ids(tables.read_table(spark, stored, "edits"))
    early = tables.read_table(spark, stored, "edits")
    seen = []
    commit = snapshots.commit

    def looked_at(spark, table, change):
        seen.append(ids(tables.read_table(spark, stored, "edits")))
        done = commit(spark, table, change)
        seen.append(ids(tables.read_table(spark, stored, "edits")))
        return done

    monkeypatch.setattr(snapshots, "commit", looked_at)
    tables.compact_day(spark, stored, "edits", DAY)
    assert seen == [whole, whole]
    assert ids(early) == whole
    folders = snapshots.folders(spark, path_of(stored))
    assert sum(f.day == DAY for f in folders) == 1 and len(folders) == 5


def test_a_run_that_breaks_off_leaves_the_old_version(spark, stored, edit_rows, monkeypatch):
    whole, before = ids(tables.read_table(spark, stored, "edits")), snapshots.versions(spark, path_of(stored))
    broken = lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", broken)
        with pytest.raises(OSError):
            tables.compact_day(spark, stored, "edits", DAY)
        with pytest.raises(OSError):
            tables.write_table(edit_rows({"evt_id": "lost"}), stored, "edits", "a")
    assert ids(tables.read_table(spark, stored, "edits")) == whole
    assert snapshots.versions(spark, path_of(stored)) == before
    # What no version names goes, everything else stays.
    assert snapshots.vacuum(spark, path_of(stored), older_than_hours=24) == 0
    assert snapshots.vacuum(spark, path_of(stored), older_than_hours=-1) == 2
    assert ids(tables.read_table(spark, stored, "edits")) == whole
    tables.compact_day(spark, stored, "edits", DAY)
    assert ids(tables.read_table(spark, stored, "edits")) == whole


def test_older_versions_can_be_read_until_they_are_vacuumed(spark, stored, edit_rows):
    path = path_of(stored)
    old = snapshots.versions(spark, path)[-1]
    tables.write_table(edit_rows({"evt_id": "new", "dt_server": datetime(2024, 1, 9)}), stored, "edits", "a")
    assert "a1" in ids(tables.read_table(spark, stored, "edits", version=old))
    assert "a1" not in ids(tables.read_table(spark, stored, "edits"))
    snapshots.vacuum(spark, path, keep=2, older_than_hours=-1)
    assert "a1" in ids(tables.read_table(spark, stored, "edits", version=old))
    assert snapshots.vacuum(spark, path, older_than_hours=-1) == 2
    assert snapshots.versions(spark, path) == [old + 1]
    assert "new" in ids(tables.read_table(spark, stored, "edits"))


def test_writers_that_meet_both_count(spark, tmp_path, monkeypatch):
    table = str(tmp_path)
    add = lambda name: lambda now: [*now, snapshots.Folder(f"batch_id={name}", name)]
    publish, raced = snapshots._publish, []

    def slow(spark, table, version, content):
        if not raced:
            raced.append(version)
            snapshots.commit(spark, table, add("faster"))
        return publish(spark, table, version, content)

    snapshots.commit(spark, table, add("first"))
    monkeypatch.setattr(snapshots, "_publish", slow)
    assert snapshots.commit(spark, table, add("slower")) == 2
    assert [f.batch_id for f in snapshots.folders(spark, table)] == ["first", "faster", "slower"]
    assert not publish(spark, table, 1, [])
    assert [f.batch_id for f in snapshots.folders(spark, table, 1)] == ["first", "faster"]
    drafts = [p.name for p in Path(table, "_snapshots").iterdir() if not p.name.startswith(".")]
    assert sorted(drafts) == ["000000000000.json", "000000000001.json", "000000000002.json"]


def test_a_batch_replaced_during_a_compaction_wins(spark, stored, edit_rows, monkeypatch):
    commit = snapshots.commit
    new = edit_rows({"evt_id": "again", "dt_server": datetime(2024, 1, 2)})

    def late(spark, table, change):
        monkeypatch.setattr(snapshots, "commit", commit)
        tables.write_table(new, stored, "edits", "a")
        return commit(spark, table, change)

    monkeypatch.setattr(snapshots, "commit", late)
    with pytest.raises(snapshots.Moved):
        tables.compact_day(spark, stored, "edits", DAY)
    found = ids(tables.read_table(spark, stored, "edits"))
    assert "again" in found and "a1" not in found and "b1" in found


def test_tables_without_manifests_are_taken_over(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    rows = edit_rows(*[{"evt_id": str(i), "dt_server": datetime(2024, 1, 1 + i % 2)} for i in range(4)])
    rows = rows.withColumns({"day": F.to_date("dt_server"), "batch_id": F.lit("load")})
    rows.write.partitionBy("day", "batch_id").parquet(f"{root}/edits")
    tables.ensure_tables(spark, root)
    tables.ensure_tables(spark, root)
    table = tables.read_table(spark, root, "edits")
    assert ids(table) == ["0", "1", "2", "3"] and table.first()["batch_id"] == "load"
    tables.write_table(edit_rows({"evt_id": "9"}), root, "edits", "load")
    assert ids(tables.read_table(spark, root, "edits")) == ["9"]


def test_days_list_their_folders_only(spark, stored):
    one = tables.read_table(spark, stored, "edits", days=[DAY])
    assert ids(one) == [f"{b}{i}" for b in "abc" for i in (1, 3)]
    assert all(f"day={DAY}" in f for f in one.inputFiles())
    assert ids(tables.read_table(spark, stored, "edits", days=[None])) == ["none"]
    assert ids(tables.read_table(spark, stored, "edits", days=["1999-01-01"])) == []


def user_rows(count=60):
    start = datetime(2024, 3, 1)
    rows = [
        {
            "evt_id": str(i),
            "dt_user": (start + timedelta(hours=7 * i)).strftime("%Y-%m-%dT%H:%M:%SZ"),
            "dt_server": datetime(2024, 4, 1),
            "user": f"u{i % 3}",
        }
        for i in range(count)
    ]
    return [*rows, {"evt_id": "odd", "dt_user": "never", "dt_server": datetime(2024, 4, 1)}]


def test_days_of_the_user_time_are_pruned(spark, edit_rows, tmp_path):
    root, df = str(tmp_path), edit_rows(*user_rows())
    tables.write_table(df, root, "edits", "load")
    stored, day = tables.read_table(spark, root, "edits"), F.lit("2024-03-05").cast("date")
    minutes = analytics.events_per_minute(stored, day)
    plan = minutes._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dt_user), Or(EqualTo(user_day,2024-03-05),IsNull(user_day))]" in plan
    assert minutes.collect() == analytics.events_per_minute(df, day).collect() != []
    for build, limit in ((analytics.events_per_hour, 5), (analytics.events_per_day, 4)):
        latest = build(stored, limit)
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "Or(GreaterThanOrEqual(user_day,2024-03-" in plan
        assert latest.collect() == build(df, limit).collect()
        # More than there are: unreadable times count under NULL.
        assert build(stored, 500).collect() == build(df, 500).collect()


def test_files_without_the_user_day_are_read(spark, edit_rows, tmp_path):
    root, rows = str(tmp_path), user_rows(40)
    old = edit_rows(*rows[:20]).withColumns({"day": F.to_date("dt_server"), "batch_id": F.lit("old")})
    old.write.partitionBy("day", "batch_id").parquet(f"{root}/edits")
    tables.ensure_tables(spark, root)
    tables.write_table(edit_rows(*rows[20:]), root, "edits", "new")
    stored, df = tables.read_table(spark, root, "edits"), edit_rows(*rows)
    for day in ("2024-03-02", "2024-03-09"):
        day = F.lit(day).cast("date")
        assert analytics.events_per_minute(stored, day).collect() == analytics.events_per_minute(df, day).collect()
    assert analytics.events_per_day(stored, 8).collect() == analytics.events_per_day(df, 8).collect()
