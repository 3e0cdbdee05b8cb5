import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editstream.functions import rulebook
from editstream.operators import audit
from editstream.plans import rescan, routing
from editstream.registry.plain import plain
from editstream.schemas import EDIT_FIELDS, EDIT_SCHEMA
from editstream.session import scratch_dir
from editstream.sources import event_lines, tables
from editstream.sources.rule_files import from_categories
from editstream.streaming import ingest as stream_ingest
from editstream.streaming import rates


def content(df):
    """Rows as a sorted list, without what depends on the time of the run."""
    timed = [c for c in df.columns if c in ("detection_timestamp", "_validation_timestamp")]
    df = plain(df.drop("batch_id", "day", *timed))
    return sorted(map(repr, (tuple(row) for row in df.collect())))


def write_events(folder, name, events):
    folder.mkdir(exist_ok=True)
    text = "".join(f"event: message\ndata: {json.dumps(e)}\n\n" for e in events)
    (folder / name).write_text(text)


def sample_events(event, start=0, count=8):
    changes = [{}, {"comment": "nestled"}, {"title": 5}, {"length": None}, {"type": "log"}]
    meta = {"dt": "2024-03-05T06:07:08Z", "domain": "d"}
    return [
        event(meta={"id": str(i), **meta}, timestamp=1709618828 + 40000 * i, **changes[i % 5])
        for i in range(start, start + count)
    ]


def test_stream_gives_the_tables_of_the_batch_run(spark, event, tmp_path):
    write_events(tmp_path / "in", "a.txt", sample_events(event))
    write_events(tmp_path / "in", "b.txt", sample_events(event, 8))
    stream = event_lines.stream_lines(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    root = str(tmp_path / "stream")
    query = stream_ingest.start_routing(
        event_lines.payload_lines(stream), root, str(tmp_path / "ck"), "s", trigger={"availableNow": True}
    )
    query.awaitTermination()
    batch_root = str(tmp_path / "batch")
    lines = event_lines.payload_lines(event_lines.read_lines(spark, str(tmp_path / "in")))
    routing.route_batch(lines, batch_root, "load")
    for table in ("edits", "dead_letter", "flagged"):
        streamed = tables.read_table(spark, root, table)
        assert content(streamed) == content(tables.read_table(spark, batch_root, table)), table
        assert {r[0] for r in streamed.select("batch_id").distinct().collect()} == {"s-0", "s-1"}
    assert tables.read_table(spark, root, "edits").count() == 10
    assert tables.read_table(spark, root, "dead_letter").count() == 6


def test_a_repeated_batch_replaces_its_own_rows(spark, lines, event, tmp_path):
    root = str(tmp_path)
    batch = lines(*sample_events(event))
    routing.route_micro_batch(batch, root, 0)
    before = content(tables.read_table(spark, root, "edits"))
    routing.route_micro_batch(batch, root, 0)
    assert content(tables.read_table(spark, root, "edits")) == before
    routing.route_micro_batch(batch, root, 1)
    assert tables.read_table(spark, root, "edits").count() == 2 * len(before)


def test_day_partitions_are_pruned(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    start = datetime(2024, 1, 1, 12)
    rows = [{"evt_id": str(i), "dt_server": start + timedelta(days=i % 3)} for i in range(9)]
    tables.write_table(edit_rows(*rows, {"evt_id": "none"}), root, "edits", "load")
    one_day = tables.on_day(tables.read_table(spark, root, "edits"), F.lit("2024-01-02").cast("date"))
    assert sorted(r["evt_id"] for r in one_day.collect()) == ["1", "4", "7"]
    scan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan
    assert tables.read_table(spark, root, "edits").count() == 10


def test_ensured_tables_are_empty_and_stay(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    for table, schema in tables.SCHEMAS.items():
        df = tables.read_table(spark, root, table)
        assert df.count() == 0 and df.columns[: len(schema)] == schema.fieldNames()
    tables.write_table(edit_rows({"evt_id": "1"}), root, "edits", "load")
    tables.ensure_tables(spark, root)
    assert tables.read_table(spark, root, "edits").count() == 1


def test_older_files_lack_columns(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    old = edit_rows({"evt_id": "1", "dt_server": datetime(2024, 1, 1)}).drop("log_comment")
    tables.write_table(old, root, "edits", "old")
    new = edit_rows({"evt_id": "2", "log_comment": "x", "dt_server": datetime(2024, 1, 2)})
    tables.write_table(new.withColumn("future", F.lit(7)), root, "edits", "new")
    table = tables.read_table(spark, root, "edits", [T.StructField("future", T.IntegerType())])
    got = {r["evt_id"]: (r["log_comment"], r["future"]) for r in table.collect()}
    assert got == {"1": (None, None), "2": ("x", 7)}


def test_rescan_is_idempotent_per_version(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    rows = [
        {"evt_id": "1", "comment": "great 🎉", "type": "edit"},
        {"evt_id": "2", "comment": "nestled", "type": "edit"},
        {"evt_id": "3", "comment": "plain", "type": "edit"},
    ]
    tables.write_table(edit_rows(*rows), root, "edits", "load")
    assert rescan.rescan(spark, root, "1.0.2") == {"scanned": 3, "flagged": 1}
    assert rescan.rescan(spark, root, "1.0.2") == {"scanned": 0, "flagged": 0}
    assert rescan.rescan(spark, root, "1.0.3") == {"scanned": 3, "flagged": 2}
    tables.write_table(edit_rows({"evt_id": "4", "comment": "nestled"}), root, "edits", "more")
    assert rescan.rescan(spark, root, "1.0.3") == {"scanned": 1, "flagged": 1}
    totals = rescan.version_totals(
        tables.read_table(spark, root, "flagged"), tables.read_table(spark, root, "clean")
    )
    assert {tuple(r) for r in totals.collect()} == {("1.0.2", 1, 2), ("1.0.3", 3, 1)}


def test_rescan_completes_an_interrupted_run(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    rows = [{"evt_id": str(i), "comment": c} for i, c in enumerate(["nestled", "plain"])]
    tables.write_table(edit_rows(*rows), root, "edits", "load")
    rescan.rescan(spark, root)
    # As if the job had ended before the clean rows were written.
    other = str(tmp_path / "other")
    tables.ensure_tables(spark, other)
    tables.write_table(edit_rows(*rows), other, "edits", "load")
    flagged = tables.read_table(spark, root, "flagged").drop("batch_id", "day")
    tables.write_table(flagged, other, "flagged", "interrupted")
    assert rescan.rescan(spark, other) == {"scanned": 1, "flagged": 0}


def test_version_totals_ignore_odd_versions(spark):
    flagged = spark.createDataFrame([("a", "1.0.3"), ("b", "1.0"), ("c", "x1.0.3")], "event_id string, rule_version string")
    clean = spark.createDataFrame([("d", "1.0.3"), ("e", "1.0.3-custom")], "event_id string, rule_version string")
    assert [tuple(r) for r in rescan.version_totals(flagged, clean).collect()] == [("1.0.3", 1, 1)]


def edit_stream(spark, folder):
    return spark.readStream.schema(EDIT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_rates_drop_what_is_later_than_the_watermark(spark, edit_rows, tmp_path):
    folder, out = tmp_path / "edits", str(tmp_path / "out")
    batches = [["10:00", "10:30", "11:10"], ["10:59", "13:00"], ["10:01", "13:30", "16:00"]]
    for n, times in enumerate(batches):
        rows = [{"evt_id": t, "user": t, "dt_user": f"2024-01-01T{t}:00Z"} for t in times]
        edit_rows(*rows).coalesce(1).write.mode("append").parquet(str(folder))
        query = (
            rates.event_rates(edit_stream(spark, folder), "1 hour", "30 minutes")
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "ck"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    got = {(str(r["window_start"])[11:16], r["event_count"]) for r in spark.read.parquet(out).collect()}
    # 10:59 still reaches its window; 10:01 of the last batch comes after the window was closed.
    assert got == {("10:00", 3), ("11:00", 1), ("13:00", 2)}


def test_duplicates_across_micro_batches(spark, edit_rows, tmp_path):
    folder, out = tmp_path / "edits", str(tmp_path / "out")
    for n, ids in enumerate(["ab", "bc", "ca"]):
        rows = [{"evt_id": i, "dt_user": f"2024-01-01T10:0{n}:00Z"} for i in ids]
        edit_rows(*rows).coalesce(1).write.mode("append").parquet(str(folder))
        query = (
            rates.first_in_stream(edit_stream(spark, folder))
            .select("evt_id")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "ck"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    assert sorted(r["evt_id"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_progress_counts(spark, event, tmp_path):
    events = [*sample_events(event, count=3), event(meta={"id": "1", "dt": "t", "domain": "canary"})]
    write_events(tmp_path / "in", "a.txt", events)
    (tmp_path / "in" / "b.txt").write_text("data: broken\n")
    payloads = event_lines.payload_lines(event_lines.stream_lines(spark, str(tmp_path / "in")))
    query = (
        stream_ingest.observed(payloads)
        .select("value")
        .writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    seen = query.lastProgress["observedMetrics"]["ingest"]
    assert (seen["lines"], seen["accepted"], seen["not_decoded"], seen["canaries"]) == (5, 3, 1, 1)


def test_backlog(spark):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def moves(*items):
        rows = [(s, start + timedelta(minutes=m)) for s, m, n in items for _ in range(n)]
        return spark.createDataFrame(rows, "source string, at timestamp")

    waiting = rates.backlog(moves(("a", 0, 3), ("a", 2, 1), ("b", 0, 1)), moves(("a", 1, 2), ("b", 5, 1)))
    got = {(r["source"], r["minute"].minute): r["waiting"] for r in waiting.collect()}
    assert got == {("a", 0): 3, ("a", 1): 1, ("a", 2): 2, ("b", 0): 1, ("b", 5): 0}


def test_severity(spark):
    df = spark.createDataFrame([(10001, 0), (10000, 0), (5001, 0), (5000, 0), (99, 1), (99, 0), (100, 1)], "w long, j long")
    got = [r[0] for r in df.select(rates.severity(F.col("w"), F.col("j"))).collect()]
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "NONE", "LOW", "NONE", "NONE"]


def test_flat_lines_keep_values_as_they_are(spark, lines, event, tmp_path):
    odd = event(title=123, bot=1, namespace=1.5, timestamp="not a time", minor="false")
    rows = routing.flat_lines(lines(odd, event(type="log"), event(length=None)))
    tables.write_json_lines(rows, str(tmp_path / "out"))
    stored = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    edit, log = sorted(stored, key=lambda r: r["type"])
    assert (edit["title"], edit["bot"], edit["ns"], edit["dt_server"]) == (123, 1, 1.5, "not a time")
    assert edit["minor"] is True and "log_id" not in edit and "minor" not in log


def test_own_rules_and_no_rules_are_routed(spark, lines, event, tmp_path):
    own = routing.RuleSet("own-1", from_categories({"spam": ["shorter lead"]}))
    for name, rules in (("own", own), ("off", ("none", []))):
        routing.route_batch(lines(event(), event(title=5)), str(tmp_path / name), "b", rules)
    read = {
        (name, t): tables.read_table(spark, str(tmp_path / name), t).collect()
        for name in ("own", "off")
        for t in ("edits", "dead_letter", "flagged")
    }
    assert {k: len(v) for k, v in read.items() if k[1] != "flagged"} == {
        (n, t): 1 for n in ("own", "off") for t in ("edits", "dead_letter")
    }
    assert [r["rule_version"] for r in read["own", "flagged"]] == ["own-1"] * 2
    assert read["off", "flagged"] == []


def test_scratch_must_be_shared_on_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        scratch_dir(Cluster, "x")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_rates_count_unreadable_times(spark, edit_rows):
    rows = edit_rows({"evt_id": "1", "dt_user": "2024-01-01T00:00:00Z"}, {"evt_id": "2", "dt_user": "x"})
    counts = {r["window_start"]: r["event_count"] for r in rates.event_rates(rows).collect()}
    assert counts == {datetime(2024, 1, 1): 1, None: 1}


def test_first_per_id_on_stored_duplicates(spark, edit_rows):
    rows = [{"evt_id": "1", "dt_server": datetime(2024, 1, d)} for d in (2, 1)]
    assert audit.first_per_id(edit_rows(*rows)).first()["dt_server"] == datetime(2024, 1, 1)


def test_rescan_joins_once(spark, edit_rows):
    edits = edit_rows({"evt_id": "1"})
    flagged = spark.createDataFrame([("1", "1.0.2")], "event_id string, rule_version string")
    plan = rescan.pending(edits, flagged, flagged, rulebook.LATEST_VERSION)
    assert plan.count() == 1
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 1


def test_tables_in_sql(spark, lines, event, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    routing.route_batch(lines(*sample_events(event)), root, "load")
    views = tables.register_views(spark, root, "wiki")
    assert views == ["wiki", "wiki_dead_letter", "wiki_flagged", "wiki_clean", "wiki_progress"]
    by_type = spark.sql("SELECT type, COUNT(*) AS count FROM wiki GROUP BY type ORDER BY count DESC")
    assert [tuple(r) for r in by_type.collect()] == [("edit", 4), ("log", 1)]
    rate = spark.sql(
        """SELECT main.domain, COUNT(DISTINCT main.evt_id) AS total_events,
                  COUNT(DISTINCT f.event_id) AS flagged_events
           FROM wiki main LEFT JOIN wiki_flagged f ON main.evt_id = f.event_id
           GROUP BY main.domain HAVING total_events > 1"""
    )
    assert [tuple(r) for r in rate.collect()] == [("d", 5, 2)]
    flags = spark.sql(
        "SELECT flag, COUNT(*) AS n FROM wiki_flagged LATERAL VIEW explode(map_keys(ai_flags)) k AS flag"
        " WHERE ai_flags[flag] GROUP BY flag"
    )
    assert [tuple(r) for r in flags.collect()] == [("promotional_language", 2)]
    categories = spark.sql(
        "SELECT _error_category, get_json_object(_error_details, '$[0].field') AS field"
        " FROM wiki_dead_letter ORDER BY 1, 2"
    )
    assert [tuple(r) for r in categories.collect()] == [
        ("OTHER", "_root"), ("TYPE_MISMATCH", "title"), ("TYPE_MISMATCH", "title"),
    ]


def stored_days(spark, edit_rows, root):
    for batch, days in (("a", (1, 2)), ("b", (1, 1, 3))):
        rows = [{"evt_id": f"{batch}{i}", "dt_server": datetime(2024, 1, d)} for i, d in enumerate(days)]
        tables.write_table(edit_rows(*rows, {"evt_id": f"{batch}none"}), root, "edits", batch)


def test_days_are_pruned_and_batches_replaced(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    stored_days(spark, edit_rows, root)
    tables.write_table(edit_rows({"evt_id": "x", "dt_server": datetime(2024, 1, 3)}), root, "edits", "b")
    read = tables.read_table(spark, root, "edits")
    assert sorted(r["evt_id"] for r in read.collect()) == ["a0", "a1", "anone", "x"]
    one = tables.on_day(read, F.lit("2024-01-02").cast("date"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert [r["evt_id"] for r in one.collect()] == ["a1"]


def test_a_compacted_day_keeps_its_rows(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    stored_days(spark, edit_rows, root)
    before = content(tables.read_table(spark, root, "edits"))
    tables.compact_day(spark, root, "edits", "2024-01-01")
    read = tables.read_table(spark, root, "edits")
    assert content(read) == before
    assert tables.on_day(read, F.lit("2024-01-01").cast("date")).select("batch_id").distinct().count() == 1


def test_ensure_adds_columns_and_refuses_other_types(spark, edit_rows, tmp_path):
    root = str(tmp_path)
    old = edit_rows({"evt_id": "1", "dt_server": datetime(2024, 1, 1)})
    tables.write_table(old.drop("log_id", "comment"), root, "edits", "old")
    assert sorted(tables.check_columns(spark, root, "edits")) == ["comment", "log_id"]
    tables.ensure_tables(spark, root)
    assert tables.read_table(spark, root, "edits").first()["log_id"] is None
    other = str(tmp_path / "other")
    tables.write_table(old.withColumn("ns", F.lit("text")), other, "edits", "odd")
    with pytest.raises(ValueError, match="ns: string is stored, bigint declared"):
        tables.ensure_tables(spark, other)
