import json

import pytest

from editstream.operators import flatten, ingest
from editstream.sources import event_lines


def reasons(df):
    return [row["reason"] for row in ingest.classify_events(df).collect()]


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, "OK"),
        ({"meta": ...}, "BAD_META"),
        ({"meta": None}, "BAD_META"),
        ({"meta": []}, "BAD_META"),
        ({"meta": "text"}, "BAD_META"),
        ({"meta": 5}, "BAD_META"),
        ({"meta": {"dt": "x", "domain": "d"}}, "MISSING_META_FIELD"),
        ({"meta": {"id": "1", "domain": "d"}}, "MISSING_META_FIELD"),
        ({"meta": {"id": "1", "dt": "x"}}, "MISSING_META_FIELD"),
        ({"meta": {"id": None, "dt": None, "domain": None}}, "OK"),
        ({"type": "invalid_type"}, "BAD_TYPE"),
        ({"type": 5}, "BAD_TYPE"),
        ({"type": None}, "BAD_TYPE"),
        ({"type": ...}, "BAD_TYPE"),
        ({"meta": {"id": "1", "dt": "x", "domain": "canary"}}, "CANARY"),
        ({"meta": {"id": "1", "dt": "x", "domain": "Canary"}}, "OK"),
    ],
)
def test_structure_check(lines, event, change, reason):
    assert reasons(lines(event(**change))) == [reason]


@pytest.mark.parametrize("text", ["", "not json", '{"a":', "{'a': 1}"])
def test_undecodable_lines(lines, text):
    assert reasons(lines(text)) == ["DECODE_ERROR"]


@pytest.mark.parametrize("text", ["5", "null", "[1, 2]", '"text"'])
def test_json_that_is_no_event(lines, text):
    assert reasons(lines(text)) == ["BAD_META"]


def test_payload_bytes(spark, event):
    good = json.dumps(event()).encode()
    rows = spark.createDataFrame([(bytearray(good),), (bytearray(b"\xff\xfe" + good),)], "value binary")
    assert sorted(reasons(rows)) == ["DECODE_ERROR", "OK"]


def test_repeated_key_keeps_the_last_value(lines, event):
    text = json.dumps(event())[:-1] + ', "type": "new"}'
    row = flatten.flatten(ingest.accepted_events(lines(text))).select("type").first()
    assert row["type"].toJson() == '"new"'


def test_many_extra_keys_and_deep_nesting_are_accepted(lines, event):
    deep = {}
    for _ in range(100):
        deep = {"level": deep}
    wide = {f"extra_{i}": i for i in range(1000)}
    assert reasons(lines(event(**wide), event(deep=deep))) == ["OK", "OK"]


def test_event_stream_payloads(lines, event):
    payload = json.dumps(event())
    text = lines("event: message", f"data: {payload}", "data: ", "", "data:x", ": comment")
    assert [r["value"] for r in event_lines.payload_lines(text).collect()] == [payload]


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"namespace": 6, "log_params": {"img": "x"}}, False),
        ({"namespace": 6.0, "log_params": {"img": "x"}}, False),
        ({"namespace": 0, "log_params": {"img": "x"}}, True),
        ({"namespace": "6", "log_params": {"img": "x"}}, True),
        ({"namespace": True, "log_params": {"img": "x"}}, True),
        ({"namespace": ..., "log_params": {"img": "x"}}, True),
    ],
)
def test_media_strip(lines, event, change, kept):
    original = event(**change)
    row = ingest.strip_media(ingest.accepted_events(lines(original))).first()
    after = json.loads(row["value"])
    assert ("log_params" in after) is kept
    original.pop("log_params")
    after.pop("log_params", None)
    assert after == original


def test_reject_filter_does_not_parse_twice(lines, event):
    plan = ingest.accepted_events(lines(event()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_message_of_a_row_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y long")
    assert event_lines.as_message(df).first()["value"] == '{"x":"a","y":null}'


def test_file_stream_reads_lines(spark, event, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("data: " + json.dumps(event()) + "\n\n")
    stream = event_lines.stream_lines(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    query = (
        ingest.accepted_events(event_lines.payload_lines(stream))
        .select("value")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
