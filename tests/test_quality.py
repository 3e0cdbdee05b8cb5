import math

import pytest
from pyspark.sql import functions as F

from editstream.functions.columns import python_strip, sanitize_text
from editstream.operators import flatten, ingest, quality

BASE = {"evt_id": "1", "type": "edit", "domain": "x"}


def cleaned(lines, *records):
    return quality.clean_records(flatten.flat_records(ingest.parse_events(lines(*records)))).collect()


CASTS = [
    ({"ns": "5"}, "ns", 5),
    ({"ns": "123.0"}, "ns", 123),
    ({"ns": " -7.9 "}, "ns", -7),
    ({"ns": "1e3"}, "ns", 1000),
    ({"ns": "1_000"}, "ns", 1000),
    ({"ns": "5d"}, "ns", 0),
    ({"ns": "inf"}, "ns", 0),
    ({"ns": "nan"}, "ns", 0),
    ({"ns": ""}, "ns", 0),
    ({"ns": True}, "ns", 1),
    ({"ns": 2.9}, "ns", 2),
    ({"ns": [1]}, "ns", 0),
    ({"ns": None}, "ns", 0),
    ({"bot": 1}, "bot", True),
    ({"bot": 0}, "bot", False),
    ({"bot": "yes"}, "bot", True),
    ({"bot": "TRUE"}, "bot", True),
    ({"bot": "1"}, "bot", True),
    ({"bot": "no"}, "bot", False),
    ({"bot": []}, "bot", False),
    ({"bot": [0]}, "bot", True),
    ({"title": "  Two words \t"}, "title", "Two words"),
    ({"title": 12}, "title", "12"),
    ({"title": True}, "title", "True"),
    ({"dt_server": 5}, "dt_server", "5"),
    ({}, "dt_user", None),
    ({}, "comment", ""),
    ({}, "log_id", 0),
    ({}, "minor", False),
]


def test_cast_and_defaults(lines):
    rows = cleaned(lines, *[{**BASE, **change} for change, _, _ in CASTS])
    for row, (change, name, value) in zip(rows, CASTS, strict=True):
        assert row["is_valid"] and row[name] == value, change


@pytest.mark.parametrize(
    "name, limit", [("title", 500), ("user", 100), ("comment", 1000), ("parsed_comment", 1000)]
)
def test_truncation(lines, name, limit):
    row = cleaned(lines, {**BASE, name: " " + "é" * (limit + 10)})[0]
    assert row[name] == "é" * (limit - 1)
    assert row["warnings"] == [f"Field '{name}' truncated from {limit + 11} to {limit} chars"]
    assert float(row["quality_score"]) == 0.95


SCORES = [
    (BASE, 1.0, 0, True),
    ({**BASE, "a": 1, "b": 2}, 0.9, 0, True),
    ({"type": "edit", "domain": "x"}, 0.7, 1, False),
    ({**BASE, "evt_id": ""}, 0.7, 1, False),
    ({**BASE, "evt_id": None}, 0.7, 1, False),
    ({"x": 1}, 0.0, 3, False),
    ({"x": 1, "title": "t" * 501}, 0.0, 3, False),
    ({}, 0.0, 1, False),
    ("[1]", 0.0, 1, False),
    ("broken", 0.0, 1, False),
]


def test_quality_score(lines):
    rows = cleaned(lines, *[record for record, *_ in SCORES])
    for row, (record, score, errors, valid) in zip(rows, SCORES, strict=True):
        assert float(row["quality_score"]) == score, record
        assert len(row["errors"]) == errors and row["is_valid"] is valid, record
        assert valid or row["type"] is None


def test_drift_is_listed(lines):
    row = cleaned(lines, {**BASE, "b": 1, "a": 2})[0]
    assert row["unknown_fields"] == ["a", "b"]
    assert row["warnings"] == ["Unknown fields detected (schema drift): a, b"]


@pytest.mark.parametrize(
    "text", ["  a ", "\x1c\x1fa b\x85\xa0", "　x​", "\n\t", "", "a ", "\x0bq\x0c"]
)
def test_strip_as_python_does(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(python_strip(F.col("t"))).first()[0] == text.strip()


def test_sanitize_cuts_before_it_strips(spark):
    df = spark.createDataFrame([("  " + "a" * 5,), (None,), ("🎉" * 9,)], "t string")
    got = [r[0] for r in df.select(sanitize_text(F.col("t"), 4)).collect()]
    assert got == ["aa", "", "🎉🎉🎉🎉"]


@pytest.mark.parametrize("text", ["1", "-2.5", ".5", "5.", "+3e-2", "1e400", "x", "", " 7 ", "0x1", "1__0", "1d"])
def test_float_casts_as_python_does(spark, text):
    try:
        want = float(text)
    except ValueError:
        want = -1.0
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(quality.safe_cast_text(F.col("t"), "float", -1.0)).first()[0]
    assert got == want or (math.isinf(want) and math.isinf(got))
