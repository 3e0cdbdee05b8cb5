"""Chained windows, progress, the media strip, and de-duplication beyond the watermark."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from editstream.operators import ingest
from editstream.plans import routing
from editstream.schemas import EDIT_SCHEMA
from editstream.sources import tables
from editstream.sources.id_index import IdIndex
from editstream.streaming import dedup, rates
from editstream.streaming.ingest import start_routing


def edit_stream(spark, folder):
    return spark.readStream.schema(EDIT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run(df, out, checkpoint):
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", str(out))
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def test_chained_windows_over_restarts(spark, edit_rows, tmp_path):
    start = datetime(2024, 1, 1)
    minutes = [range(0, 900), range(900, 1800), range(1750, 3000)]
    state = []
    for number, part in enumerate(minutes):
        rows = [
            {"evt_id": str(m), "user": f"u{m % 7}", "dt_user": (start + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%SZ")}
            for m in part
        ]
        edit_rows(*rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        widths = ["1 minute", "1 hour", "1 day"]
        query = run(rates.chained_rates(edit_stream(spark, tmp_path / "in"), widths), tmp_path / "out", tmp_path / "ck")
        state.append([[o["numRowsTotal"] for o in p["stateOperators"]] for p in query.recentProgress])
        late = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
        # In the last batch the minutes 1750 to 1788 come after their windows.
        assert late == (39 if number == 2 else 0)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(str(r["window_start"])[:10], r["event_count"]) for r in rows] == [("2024-01-01", 1440), ("2024-01-02", 1440 + 11)]
    assert [r["about_unique_users"] for r in rows] == [7, 7]
    # After each batch only open windows are left: ten minutes, then an hour or two, then a day or two.
    for batches in state:
        assert all(m <= 12 and h <= 2 and d <= 2 for m, h, d in [sorted(b, reverse=True) for b in batches[-1:]])


def test_chained_windows_of_a_table(spark, edit_rows):
    rows = [{"evt_id": str(i), "user": f"u{i % 3}", "dt_user": f"2024-01-01T{i % 4:02}:10:00Z"} for i in range(40)]
    hours = rates.chained_rates(edit_rows(*rows, {"evt_id": "x", "dt_user": "odd"})).orderBy("window_start").collect()
    assert [(r["window_start"].hour, r["event_count"], r["about_unique_users"]) for r in hours] == [(h, 10, 3) for h in range(4)]


def lines_of(event):
    meta = {"id": "1", "dt": "2024-03-05T06:07:08Z", "domain": "d"}
    return [
        event(meta=meta),
        event(meta={**meta, "id": "2"}, title=5),
        event(meta={**meta, "domain": "canary"}),
        event(meta={"id": "3"}),
        event(meta=7),
        event(type="other"),
        "not json",
        event(meta={**meta, "id": "4"}, comment="nestled"),
    ]


WANT = {
    "lines": 8, "accepted": 3, "not_decoded": 1, "bad_meta": 1, "missing_meta_field": 1,
    "bad_type": 1, "canaries": 1, "valid": 2, "dead_letters": 1, "flagged": 1,
}


def told(row):
    return {name: row[name] for name in WANT}


def test_progress_of_every_batch(spark, event, lines, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "tables")
    batches = [lines_of(event), lines_of(event)[:2], lines_of(event)[6:7]]
    for number, batch in enumerate(batches):
        lines(*batch).coalesce(1).write.mode("append").text(str(source))
        stream = spark.readStream.text(str(source))
        query = start_routing(stream, root, str(tmp_path / "ck"), "s", trigger={"availableNow": True})
        query.awaitTermination()
    rows = {r["batch_id"]: told(r) for r in tables.read_table(spark, root, "progress").collect()}
    assert set(rows) == {"s-0", "s-1", "s-2"} and rows["s-0"] == WANT
    assert (rows["s-1"]["lines"], rows["s-1"]["valid"], rows["s-2"]["not_decoded"]) == (2, 1, 1)
    for number, batch in enumerate(batches):
        counts = {r["reason"]: r["events"] for r in ingest.reject_counts(lines(*batch)).collect()}
        own = {r: rows[f"s-{number}"][n] for n, r in ingest.REASON_COUNTS.items() if rows[f"s-{number}"][n]}
        assert own == counts


def test_progress_of_a_bounded_run_and_of_nothing(spark, event, lines, tmp_path):
    root = str(tmp_path)
    routing.route_batch(lines(*lines_of(event)), root, "b")
    routing.route_batch(lines(), root, "none")
    rows = {r["batch_id"]: told(r) for r in tables.read_table(spark, root, "progress").collect()}
    assert rows == {"b": WANT, "none": dict.fromkeys(WANT, 0)}


@pytest.mark.parametrize("strip", [True, False])
def test_dead_letters_without_the_media_payload(spark, event, lines, tmp_path, strip):
    heavy = event(namespace=6, length=7, log_params={"data": "x" * 100})
    light = event(namespace=0, length=7, log_params={"data": "y" * 100})
    spaced = json.dumps(light).replace(":", ":  ")
    routing.route_batch(lines(json.dumps(heavy), spaced), str(tmp_path), "b", strip=strip)
    rows = tables.read_table(spark, str(tmp_path), "dead_letter").collect()
    found = sorted((r["_original_payload"], r["_error_details"]) for r in rows)
    assert len(found) == 2
    for payload, details in found:
        assert ("xxx" in payload) == ("xxx" in details) == (not strip and "yyy" not in payload)
    # Other lines stay as they came.
    assert spaced in [p for p, _ in found]


def test_copies_after_the_watermark_are_dropped(spark, edit_rows, tmp_path):
    root = str(tmp_path / "tables")
    days = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    for number, ids in enumerate([["a", "b", "b"], ["b", "c", None], ["a", "d", None], ["c", "a"]]):
        rows = [{"evt_id": i, "title": days[number], "dt_user": f"{days[number]}T00:00:00Z"} for i in ids]
        edit_rows(*rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = dedup.start_dedup(  # started anew for each file
            edit_stream(spark, tmp_path / "in"), f"{root}/seen", str(tmp_path / "ck"), "s",
            lambda rows, run: tables.write_table(rows, root, "edits", run), buckets=3,
            trigger={"availableNow": True},
        )
        query.awaitTermination()
    found = sorted((str(r["evt_id"]), r["title"]) for r in tables.read_table(spark, root, "edits").collect())
    assert found == [
        ("None", days[1]), ("None", days[2]), ("a", days[0]), ("b", days[0]), ("c", days[1]), ("d", days[2]),
    ]


def test_a_repeated_batch_writes_the_same_rows(spark, edit_rows, tmp_path):
    index, written = IdIndex(spark, str(tmp_path / "seen"), 2), {}

    def write(rows, run):
        written[run] = sorted(r["evt_id"] for r in rows.collect())

    batch = edit_rows({"evt_id": "a"}, {"evt_id": "b"})
    dedup.keep_first(batch, index, "r-0", write)
    dedup.keep_first(batch, index, "r-0", write)
    assert written == {"r-0": ["a", "b"]} and index.rows().count() == 2
    dedup.keep_first(edit_rows({"evt_id": "b"}, {"evt_id": "c"}), index, "r-1", write)
    assert written["r-1"] == ["c"]
    plan = dedup.unseen(batch, index, "x")._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("FileScan parquet") - 400 :]
    assert "Exchange" not in side.split("LeftAnti")[-1].split("FileScan")[0].split("id#")[-1]


def test_ids_are_merged_and_forgotten(spark, edit_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(dedup, "MOST_RUNS", 2)
    index, first = IdIndex(spark, str(tmp_path / "seen"), 2), date(2024, 1, 1)
    keep = lambda i, run, day, days=None: dedup.keep_first(
        edit_rows({"evt_id": i}), index, run, lambda rows, _: rows.count(), keep_days=days, today=day
    )
    for n, i in enumerate("abc"):
        keep(i, f"r-{n}", first)
    assert index.labels() == {"2024-01-01": 3}
    keep("d", "r-4", first + timedelta(days=1))
    assert index.labels() == {"2024-01-01": 1, "2024-01-02": 1}
    assert sorted(r["id"] for r in index.rows().collect()) == ["a", "b", "c", "d"]
    keep("e", "r-5", first + timedelta(days=9), days=8)
    assert sorted(r["id"] for r in index.rows().collect()) == ["d", "e"]
