"""Users of any span of days from stored sketches."""

from datetime import datetime, timedelta

import pytest

from editstream.plans import sketches
from editstream.sources import snapshots, tables


def rows_of(first, last, users, domain="d"):
    start = datetime(2024, 1, 1)
    return [
        {
            "evt_id": f"{domain}{i}",
            "domain": domain,
            "type": "edit" if i % 2 else "new",
            "user": f"u{i % users}",
            "dt_user": (start + timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%SZ"),
            "dt_server": start + timedelta(days=i // 1440),
        }
        for i in range(first, last)
    ]


def test_sketches_are_merged_and_close_to_exact(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    for batch, (first, last) in enumerate([(0, 2000), (1500, 5000)]):
        tables.write_table(edit_rows(*rows_of(first, last, 3000)), root, "edits", batch)
        sketches.sync(spark, root)
    stored = sketches.stored_sketches(spark, root)
    whole = sketches.about_users(stored).first()
    assert (whole["events"], whole["edits"]) == (5500, 2750)
    assert whole["about_unique_users"] == pytest.approx(3000, rel=0.03)
    days = {str(r["user_day"]): r for r in sketches.about_users(stored, "user_day").collect()}
    assert len(days) == 4 and days["2024-01-01"]["events"] == 1440
    assert days["2024-01-01"]["about_unique_users"] == pytest.approx(1440, rel=0.03)


def test_only_what_changed_is_read(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    for batch in "ab":
        tables.write_table(edit_rows(*rows_of(0, 40, 5, batch)), root, "edits", batch)
    assert sketches.sync(spark, root) == 2
    assert sketches.sync(spark, root) == 0
    before = {f.batch_id: f.path for f in snapshots.folders(spark, f"{root}/{sketches.NAME}")}
    tables.write_table(edit_rows(*rows_of(0, 10, 2, "b")), root, "edits", "b")
    assert sketches.sync(spark, root) == 1
    after = {f.batch_id: f.path for f in snapshots.folders(spark, f"{root}/{sketches.NAME}")}
    assert len(set(before.items()) & set(after.items())) == 1
    found = {r["domain"]: r["events"] for r in sketches.about_users(sketches.stored_sketches(spark, root), "domain").collect()}
    assert found == {"a": 40, "b": 10}
    # A compacted day keeps the sketches of what it was made of.
    tables.compact_day(spark, root, "edits", "2024-01-01")
    assert sketches.sync(spark, root) == 0
    assert sketches.about_users(sketches.stored_sketches(spark, root)).first()["events"] == 50


def test_nothing_stored(spark, tmp_path):
    assert sketches.sync(spark, str(tmp_path)) == 0
    assert sketches.about_users(sketches.stored_sketches(spark, str(tmp_path)), "domain").count() == 0
