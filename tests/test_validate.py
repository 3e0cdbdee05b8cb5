import json

import pytest
from pyspark.sql import functions as F

from editstream.operators import ingest, validate
from editstream.operators.validate import error_category
from editstream.plans import routing
from editstream.schemas import DEAD_LETTER_SCHEMA, EDIT_FIELDS, EDIT_SCHEMA

FULL = {
    "evt_id": "1", "type": "edit", "title": "T", "user": "U", "bot": False, "dt_user": "d",
    "dt_server": 1709618828, "domain": "x", "ns": 0, "wiki": "w", "srv_name": "s",
    "srv_url": "u", "minor": True, "patrolled": False, "len_old": 1, "len_new": 2,
    "rev_old": 1, "rev_new": 2, "comment": "c", "parsed_comment": "p",
}
MINIMAL = {"evt_id": "1", "type": "edit", "domain": "x"}


def judged(lines, *records):
    rows = routing.validated_records(lines(*records))
    return rows.withColumn("category", error_category(F.col("errors"))).collect()


def without(name):
    return {key: value for key, value in FULL.items() if key != name}


CATEGORIES = [
    (FULL, "VALID"),
    (MINIMAL, "VALID"),
    ({**FULL, "title": None}, "VALID"),
    ({**FULL, "unknown": {"a": 1}}, "VALID"),
    ({**FULL, "ns": True}, "VALID"),
    ({**FULL, "dt_server": "2024-03-05T00:00:00Z"}, "VALID"),
    (without("evt_id"), "MISSING_REQUIRED_FIELD"),
    (without("type"), "MISSING_REQUIRED_FIELD"),
    (without("domain"), "MISSING_REQUIRED_FIELD"),
    ({**FULL, "title": 123}, "TYPE_MISMATCH"),
    ({**FULL, "ns": "x"}, "TYPE_MISMATCH"),
    ({**FULL, "ns": 1.0}, "TYPE_MISMATCH"),
    ({**FULL, "bot": "x"}, "TYPE_MISMATCH"),
    ({**FULL, "bot": 1}, "TYPE_MISMATCH"),
    ({**FULL, "dt_server": 1.5}, "TYPE_MISMATCH"),
    ({**FULL, "evt_id": None}, "TYPE_MISMATCH"),
    ({**FULL, "comment": ["a"]}, "TYPE_MISMATCH"),
    ({**without("evt_id"), "ns": "x"}, "MISSING_REQUIRED_FIELD"),
    ({}, "OTHER"),
    ([], "OTHER"),
    ("null", "OTHER"),
    ('"text"', "OTHER"),
    ("broken", "OTHER"),
]


def test_categories(lines):
    rows = judged(lines, *[record for record, _ in CATEGORIES])
    for row, (record, category) in zip(rows, CATEGORIES, strict=True):
        assert row["category"] == category, record
        assert row["is_valid"] is (category == "VALID")


ERRORS = [
    ("title", 123, "STRING", "123", "Expected string for title, got int"),
    ("ns", "x", "INT64", "x", "Expected integer for ns, got str"),
    ("ns", 1.5, "INT64", "1.5", "Expected integer for ns, got float"),
    ("bot", 1, "BOOL", "1", "Expected boolean for bot, got int"),
    ("title", True, "STRING", "True", "Expected string for title, got bool"),
    ("domain", None, "STRING", "None", "Expected string for domain, got NoneType"),
    ("dt_server", [1], "TIMESTAMP", "[1]", "Expected timestamp (int/string) for dt_server, got list"),
    ("comment", {"a": 1}, "STRING", '{"a":1}', "Expected string for comment, got dict"),
]


def test_error_details(lines):
    rows = judged(lines, *[{**FULL, field: value} for field, value, *_ in ERRORS])
    for row, (field, _, expected, shown, message) in zip(rows, ERRORS, strict=True):
        assert [e.asDict() for e in row["errors"]] == [
            {
                "category": "TYPE_MISMATCH",
                "field": field,
                "expected_type": expected,
                "actual_value": shown,
                "message": message,
            }
        ]


def test_missing_columns_come_first(lines):
    record = {"type": 5, "title": 1, "ns": "x"}
    errors = judged(lines, record)[0]["errors"]
    assert [(e["category"], e["field"]) for e in errors] == [
        ("MISSING_REQUIRED_FIELD", "evt_id"),
        ("MISSING_REQUIRED_FIELD", "domain"),
        ("TYPE_MISMATCH", "type"),
        ("TYPE_MISMATCH", "title"),
        ("TYPE_MISMATCH", "ns"),
    ]


def test_typed_columns(lines):
    rows = judged(
        lines,
        {**FULL, "ns": True, "dt_server": "2024-03-05T12:00:00Z"},
    )
    assert rows[0]["ns"] == 1 and str(rows[0]["dt_server"]) == "2024-03-05 12:00:00"
    assert rows[0]["is_valid"]


def test_dead_letter_of_a_record(lines):
    bad = {"evt_id": "1", "type": "edit", "ns": "x", "extra": 1}
    dead = validate.dead_letters(routing.validated_records(lines(bad)))
    assert dead.columns == DEAD_LETTER_SCHEMA.fieldNames()
    assert [f.dataType for f in dead.schema] == [f.dataType for f in DEAD_LETTER_SCHEMA]
    row = dead.first()
    assert row["evt_id"] == "1" and row["domain"] == "" and row["comment"] == ""
    assert row["ns"] is None and row["len_old"] == 0 and row["minor"] is False
    assert str(row["dt_server"]) == "1970-01-01 00:00:00"
    assert row["_error_category"] == "MISSING_REQUIRED_FIELD"
    assert row["_schema_version"] == "1.0.0" and row["_validation_timestamp"] is not None
    assert json.loads(row["_original_payload"]) == bad
    assert [e["field"] for e in json.loads(row["_error_details"])] == ["domain", "ns"]


def test_dead_letter_of_a_malformed_event(lines, event):
    broken = event(length=None)
    line = json.dumps(broken)
    validated = routing.flat_validated(lines(line))
    row = validate.dead_letters(validated).first()
    assert row["_error_category"] == "OTHER" and row["_original_payload"] == line
    assert row["evt_id"] == "" and row["title"] == ""
    detail = json.loads(row["_error_details"])[0]
    assert detail["category"] == "MALFORMED_INPUT" and detail["field"] == "_root"


def test_every_accepted_event_has_one_fate(lines, event):
    events = [event(), event(title=5), event(length=None), event(comment="nestled", bot=1)]
    rows = routing.screened(lines(*events))
    outputs = {name: df.collect() for name, df in routing.routed(rows, "1.0.3", None).items()}
    assert len(outputs["edits"]) == 1 and len(outputs["dead_letter"]) == 3
    # A flagged row is recorded even where it does not pass validation.
    assert [r["event_id"] for r in outputs["flagged"]] == ["e7"]


def test_malformed_events_raise_no_flag(lines, event):
    rows = routing.screened(lines(event(length=None, title="nestled")))
    assert rows.first()["flag_types"] == []


def test_valid_rows_have_the_declared_schema(lines, event):
    rows = validate.valid_rows(routing.flat_validated(lines(event())))
    assert rows.columns == EDIT_FIELDS
    assert [f.dataType for f in rows.schema] == [f.dataType for f in EDIT_SCHEMA]


def test_required_report(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "evt_id string, title string")
    rows = {r["field"]: r for r in validate.required_report(df, ["evt_id", "title", "gone"]).collect()}
    assert rows["evt_id"]["rows_without_value"] == 0
    assert rows["title"]["rows_without_value"] == 1
    assert rows["gone"]["column_exists"] is False and rows["gone"]["rows_without_value"] == 2


def test_type_violations(lines):
    events = ingest.parse_events(lines({"a": 1, "b": "x"}, {"a": "1"}, {"b": None}, {"a": 2.5}))
    found = validate.type_violations(events, {"a": ["BIGINT"], "b": ["STRING"]}).collect()
    assert {(r["field"], r["actual"], r["rows"]) for r in found} == {
        ("a", "str", 1), ("a", "float", 1), ("b", "NoneType", 1),
    }


@pytest.mark.parametrize("value", ["not a time", 99999999999999, -99999999999999])
def test_times_that_cannot_be_kept_are_dead_letters(lines, event, value):
    row = routing.flat_validated(lines(event(timestamp=value))).first()
    assert not row["is_valid"] and row["dt_server"] is None
    assert [(e["category"], e["field"]) for e in row["errors"]] == [("VALIDATION_ERROR", "dt_server")]
    assert json.loads(row["payload"])["dt_server"] == value


def test_whole_numbers_of_over_64_bits_are_called_so(lines, event):
    row = routing.flat_validated(lines(event(namespace=2**64))).first()
    assert row["errors"][0]["message"] == "Expected integer for ns, got int of over 64 bits"
