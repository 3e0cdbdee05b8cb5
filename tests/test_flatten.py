import json

import pytest

from editstream.operators import flatten, ingest
from editstream.schemas import EDIT_FIELDS


def flat(lines, *events):
    """Flat records as dicts of JSON values; absent columns are left out."""
    df = flatten.flatten(ingest.accepted_events(lines(*events)))
    return [
        {
            name: json.loads(row[name].toJson())
            for name in EDIT_FIELDS
            if row[name] is not None
        }
        for row in df.collect()
    ]


CORE = EDIT_FIELDS[:12]
EDIT = EDIT_FIELDS[12:20]
LOG = EDIT_FIELDS[20:]


@pytest.mark.parametrize(
    "event_type, fields",
    [
        ("edit", CORE + EDIT),
        ("new", CORE + EDIT),
        ("log", CORE + LOG),
        ("categorize", CORE),
        ("move", CORE),
    ],
)
def test_columns_by_type(lines, event, event_type, fields):
    assert list(flat(lines, event(type=event_type))[0]) == fields


def test_values(lines, event):
    record = flat(lines, event())[0]
    assert record["evt_id"] == "e7"
    assert record["dt_server"] == 1709618828
    assert (record["len_old"], record["len_new"]) == (812, 790)
    assert (record["rev_old"], record["rev_new"]) == (41, 57)
    assert record["parsed_comment"] == "<i>shorter lead</i>"


def test_defaults_for_absent_keys(lines):
    meta = {"id": "1", "dt": "t", "domain": "d"}
    record = flat(lines, {"meta": meta, "type": "new"})[0]
    assert record == {
        "evt_id": "1", "type": "new", "title": "", "user": "", "bot": False, "dt_user": "t",
        "dt_server": 0, "domain": "d", "ns": 0, "wiki": "", "srv_name": "", "srv_url": "",
        "minor": False, "patrolled": False, "len_old": 0, "len_new": 0, "rev_old": 0,
        "rev_new": 0, "comment": "", "parsed_comment": "",
    }
    log = flat(lines, {"meta": meta, "type": "log"})[0]
    assert {n: log[n] for n in LOG} == {
        "log_type": "", "log_action": "", "log_id": 0, "log_comment": "",
    }


def test_null_is_not_the_default(lines, event):
    record = flat(lines, event(title=None, length={"old": None}))[0]
    assert record["title"] is None
    assert record["len_old"] is None
    assert record["len_new"] == 0


@pytest.mark.parametrize(
    "change, malformed",
    [
        ({"length": None}, True),
        ({"length": []}, True),
        ({"revision": "x"}, True),
        ({"length": ..., "revision": ...}, False),
        ({"length": None, "type": "categorize"}, False),
        ({"length": None, "type": "log"}, False),
    ],
)
def test_bad_nesting(lines, event, change, malformed):
    line = lines(event(**change))
    row = flatten.flatten(ingest.accepted_events(line)).first()
    assert row["malformed"] is malformed
    assert (row["value"] is not None) is malformed


@pytest.mark.parametrize(
    "value, expected",
    [
        (True, True), (False, False), (None, False), (0, False), (1, True), (-2, True),
        (0.0, False), (0.5, True), ("", False), ("false", True), ([], False), ([0], True),
        ({}, False), ({"a": 1}, True), (..., False),
    ],
)
def test_boolean_cleaning_by_truthiness(lines, event, value, expected):
    records = flatten.flatten(ingest.accepted_events(lines(event(minor=value))))
    cleaned = flatten.clean_booleans(records, "minor").first()["minor"]
    assert json.loads(cleaned.toJson()) is expected


def test_boolean_cleaning_leaves_absent_columns(lines, event):
    records = flatten.flatten(ingest.accepted_events(lines(event(type="log"))))
    assert flatten.clean_booleans(records, "minor").first()["minor"] is None


def test_text_is_kept_verbatim(lines, event):
    texts = ["'; DROP TABLE x; --", "<script>alert(1)</script>", "${jndi:x}", "a\u0000b\u0007", "日本 🎉"]
    records = flat(lines, *[event(comment=text) for text in texts])
    assert [record["comment"] for record in records] == texts


def test_a_long_comment_stays_whole(lines, event):
    text = "A" * 1_000_000
    assert flat(lines, event(comment=text))[0]["comment"] == text
