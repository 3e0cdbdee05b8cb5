"""What keeps the stored and streamed queries small on large tables: no wide shuffle, no single task."""

import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from editstream.plans import by_rule, routing
from editstream.registry import queries
from editstream.session import configure
from editstream.sources import tables, views
from editstream.sources.id_index import IdIndex
from editstream.streaming import dedup, rates

START = datetime(2024, 1, 1)


@pytest.fixture
def small_tables(spark, tmp_path):
    """Events and documents of a few rows, one event without a time."""
    configure(spark)
    events = [(i, START + timedelta(minutes=i) if i != 7 else None, i % 3, "click", 1.0) for i in range(40)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(
        str(tmp_path / "events.parquet")
    )
    documents = [(i, f"text {i}", "en", 6) for i in range(5)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    return str(tmp_path)


def test_open_minutes_are_counted(spark, small_tables):
    found = queries.QUERIES["streamed_minute_counts"](spark, small_tables).collect()
    want = {(START + timedelta(minutes=i)).strftime("%Y-%m-%d %H:%M:%S"): 1 for i in range(40) if i != 7}
    assert {r["window_start"]: r["event_count"] for r in found} == {**want, None: 1}


def test_the_last_state_of_a_window_counts(spark, edit_rows, tmp_path):
    for times in (["00:00:05", "00:20:00"], ["00:20:30", "00:21:00"]):
        rows = [{"evt_id": t, "user": "u", "dt_user": f"2024-01-01T{t}Z"} for t in times]
        edit_rows(*rows).write.mode("append").parquet(str(tmp_path / "in"))
        edits = spark.readStream.schema(edit_rows(*rows).schema).parquet(str(tmp_path / "in"))
        windows = rates.chained_rates(edits, ["1 minute"])
        rates.start_latest(windows, str(tmp_path / "out"), str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
    found = {r["window_start"].minute: r["event_count"] for r in rates.latest_windows(spark, str(tmp_path / "out")).collect()}
    assert found == {0: 1, 20: 2, 21: 1}


def test_all_edits_land_and_in_several_tasks(spark, small_tables, monkeypatch):
    monkeypatch.setattr(views, "TASK_CHARS", 8)
    _, land, landed = queries._edits_in_time(spark, small_tables)
    for number in range(queries.BATCHES):
        land(number)
    stored = spark.read.parquet(landed)
    assert stored.count() == 40 and len(stored.inputFiles()) > queries.BATCHES


def test_only_small_batches_are_gathered_by_day(spark, edit_rows, tmp_path, monkeypatch):
    rows = edit_rows(*[{"evt_id": str(i), "dt_server": START} for i in range(40)]).repartition(4)
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows")).repartition(4)
    tables.write_table(stored, str(tmp_path), "edits", "small")
    assert len(tables.read_table(spark, str(tmp_path), "edits").inputFiles()) == 1
    monkeypatch.setattr(tables, "GATHER_BYTES", 0)
    tables.write_table(stored, str(tmp_path), "edits", "small")
    assert len(tables.read_table(spark, str(tmp_path), "edits").inputFiles()) > 1
    assert tables.read_table(spark, str(tmp_path), "edits").count() == 40


def test_texts_are_cut_before_they_meet_their_hits(spark, edit_rows, tmp_path, monkeypatch):
    root, plans, write = str(tmp_path), {}, tables.write_table
    rows = edit_rows({"evt_id": "a", "comment": "nestled " * 100, "parsed_comment": "x"}, {"evt_id": "b", "comment": "plain"})
    tables.ensure_tables(spark, root)
    tables.write_table(rows, root, "edits", "load")

    def spy(df, root, table, batch_id):
        plans[table] = df._jdf.queryExecution().optimizedPlan().toString()
        write(df, root, table, batch_id)

    monkeypatch.setattr(by_rule.tables, "write_table", spy)
    by_rule.rescan_changed(spark, root, "1.0.3")
    join = plans["flagged"].index("Join Inner")
    assert plans["flagged"].index("substring(comment") > join
    row = tables.read_table(spark, root, "flagged").first()
    assert (row["event_id"], row["content_sample"]["text_length"]) == ("a", 802)
    assert len(row["content_sample"]["comment"]) == 500


def test_the_tasks_of_a_join_fill_all_cores(spark, small_tables, monkeypatch):
    monkeypatch.setattr(views, "TASK_CHARS", 40)
    cores = spark.sparkContext.defaultParallelism
    parts = views.join_tasks(*views.events_and_documents(spark, small_tables))
    assert parts >= 6 and parts % cores == 0  # 240 characters
    monkeypatch.setattr(views, "TASK_CHARS", 240)
    assert views.join_tasks(*views.events_and_documents(spark, small_tables)) is None


def test_json_members_are_cut_without_counting_characters(spark):
    rows = spark.createDataFrame([('é"\\\n☺🎉',), ("",), (None,)], "c string")
    cut = rows.select(views._json(rows["c"]).alias("json"))
    assert [r["json"] for r in cut.collect()] == ['"é\\"\\\\\\n☺🎉"', '""', None]
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert " length(" not in plan


def kept_in_memory(spark):
    return spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_a_micro_batch_is_not_kept_in_memory(spark, lines, event, tmp_path, monkeypatch):
    root, found, write = str(tmp_path), [], routing.write_routes
    tables.ensure_tables(spark, root)

    def spy(rows, *rest):
        found.append((kept_in_memory(spark), len(rows.inputFiles())))
        write(rows, *rest)

    monkeypatch.setattr(routing, "write_routes", spy)
    before = kept_in_memory(spark)
    routing.route_micro_batch(lines(event(), event(type=5), event(title=1)), root, "m-0")
    assert found[0][0] == before and found[0][1] > 0
    counts = {t: tables.read_table(spark, root, t).count() for t in ("edits", "dead_letter", "progress")}
    assert counts == {"edits": 1, "dead_letter": 1, "progress": 1}
    progress = tables.read_table(spark, root, "progress").first()
    assert (progress["lines"], progress["bad_type"], progress["valid"]) == (3, 1, 1)


def test_the_size_of_staged_rows_is_that_of_compressed_files(spark, edit_rows, tmp_path, monkeypatch):
    rows = edit_rows(*[{"evt_id": str(i), "dt_server": START} for i in range(40)])
    rows.repartition(4).write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(tables, "GATHER_BYTES", 2 * tables.estimated_bytes(stored))
    tables.write_table(stored.repartition(4), str(tmp_path), "edits", "a")
    assert len(tables.read_table(spark, str(tmp_path), "edits").inputFiles()) > 1


@pytest.mark.parametrize("most", [1_000_000, 2, 0])
def test_unseen_rows_are_found_without_their_texts(spark, edit_rows, tmp_path, monkeypatch, most):
    monkeypatch.setattr(dedup, "MOST_BROADCAST", most)
    index, found, plans = IdIndex(spark, str(tmp_path / "seen"), 4), {}, {}
    before = kept_in_memory(spark)

    def write(rows, run):
        assert kept_in_memory(spark) == before
        plans[run] = rows._jdf.queryExecution().executedPlan().toString()
        found[run] = sorted((r["evt_id"] or "", r["comment"]) for r in rows.collect())

    def batch(*rows):
        return edit_rows(*[{"evt_id": i, "comment": c, "dt_user": t} for i, c, t in rows])

    first = batch(("a", "late", "2"), ("a", "early", "1"), ("b", "x", "1"), (None, "n", "1"), (None, "n", "1"))
    dedup.keep_first(first, index, "r-0", write)
    second = batch(("a", "y", "0"), ("b", "y", "0"), ("b", "z", "0"), ("c", "y", "0"), ("c", "y", "0"))
    dedup.keep_first(second, index, "r-1", write)
    dedup.keep_first(first, index, "r-0", write)  # repeated
    assert found == {"r-0": [("", "n"), ("", "n"), ("a", "early"), ("b", "x")], "r-1": [("c", "y")]}
    if most:
        assert all("hashpartitioning" not in plan for plan in plans.values())


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_the_shuffle_files_of_a_write_go_with_it(spark, edit_rows, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = edit_rows(*[{"evt_id": str(i), "dt_server": START} for i in range(40)]).repartition(4, "evt_id")
    before, setting = shuffle_files(spark), spark.conf.get(key)
    tables.write_table(rows, str(tmp_path), "edits", "load")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(key) == setting
    assert tables.read_table(spark, str(tmp_path), "edits").count() == 40


def typed_tables(spark, folder):
    """Events of all types, of no type and without a document's language."""
    types = ["click", "view", "signup", "purchase", "error", None]
    events = [(i, START, i % 3, types[i % 6]) for i in range(60)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(
        f"{folder}/events.parquet"
    )
    documents = [(i, f"text {i}", "en" if i else None, 6) for i in range(5)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    return str(folder)


def test_rows_without_text_do_not_meet_the_texts(spark, tmp_path, monkeypatch):
    folder, plans, write = typed_tables(configure(spark), tmp_path), {}, tables.write_table
    others = views.edits_without_text(spark, folder)
    want = views.edits(spark, folder).where("type not in ('edit', 'new')")
    assert sorted(map(str, others.collect())) == sorted(map(str, want.collect())) and want.count() == 30

    def spy(df, root, table, batch_id):
        plans[batch_id] = df._jdf.queryExecution().optimizedPlan().toString()
        write(df, root, table, batch_id)

    monkeypatch.setattr(tables, "write_table", spy)
    assert queries.QUERIES["migrated_table"](spark, folder).count() == 60
    assert "prose" in plans["older"]
    assert "prose" not in plans["newer"]


def test_json_lines_of_the_round_trip_are_compressed(spark, tmp_path, monkeypatch):
    folder = typed_tables(configure(spark), tmp_path)
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, name: f"file://{tmp_path}/{name}")
    rows = queries.QUERIES["json_lines_round_trip"](spark, folder)
    files = [p.name for p in Path(f"{tmp_path}/flat-json").glob("part-*")]
    assert files and all(name.endswith(".gz") for name in files)
    lines = routing.flat_lines(views.raw_lines(spark, folder))
    assert rows.count() == lines.count() > 30
    tables.write_json_lines(lines, str(tmp_path / "plain"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "plain")).collect()) == sorted(
        r[0] for r in spark.read.text(f"{tmp_path}/flat-json").collect()
    )
