"""Flattening a nested event to the 24 columns of the edit table.

The flat record keeps each column as VARIANT, so the validator can still tell an absent key
from a null and from a value of the wrong type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editstream.functions import variants as V
from editstream.schemas import DECLARED, EDIT_FIELDS

# --- Fixed values: where each column comes from, and its default when the key is absent ---
CORE = {
    "evt_id": ("$.meta.id", None),
    "type": ("$.type", None),
    "title": ("$.title", '""'),
    "user": ("$.user", '""'),
    "bot": ("$.bot", "false"),
    "dt_user": ("$.meta.dt", None),
    "dt_server": ("$.timestamp", "0"),
    "domain": ("$.meta.domain", None),
    "ns": ("$.namespace", "0"),
    "wiki": ("$.wiki", '""'),
    "srv_name": ("$.server_name", '""'),
    "srv_url": ("$.server_url", '""'),
}
EDIT = {
    "minor": ("$.minor", "false"),
    "patrolled": ("$.patrolled", "false"),
    "len_old": ("$.length.old", "0"),
    "len_new": ("$.length.new", "0"),
    "rev_old": ("$.revision.old", "0"),
    "rev_new": ("$.revision.new", "0"),
    "comment": ("$.comment", '""'),
    "parsed_comment": ("$.parsedcomment", '""'),
}
LOG = {
    "log_type": ("$.log_type", '""'),
    "log_action": ("$.log_action", '""'),
    "log_id": ("$.log_id", "0"),
    "log_comment": ("$.log_action_comment", '""'),
}
CONTENT = {
    "comment": ("$.comment", '""'),
    "parsed_comment": ("$.parsedcomment", '""'),
    "title": ("$.title", '""'),
    "user": ("$.user", '""'),
    "len_old": ("$.length.old", "0"),
    "len_new": ("$.length.new", "0"),
    "minor": ("$.minor", "false"),
    "bot": ("$.bot", "false"),
}
EDIT_TYPES = ["edit", "new"]
LOG_TYPES = ["log"]
# ------------------------------------------------------------------------------------------


def _read(event: Column, source: tuple[str, str | None]) -> Column:
    path, default = source
    value = V.child(event, path)
    return value if default is None else F.coalesce(value, F.parse_json(F.lit(default)))


def project(events: DataFrame, sources: dict[str, tuple[str, str | None]]) -> DataFrame:
    """One VARIANT column per source; ``CORE``, ``EDIT``, ``LOG`` and ``CONTENT`` are given."""
    event = F.col("event")
    return events.select([_read(event, source).alias(name) for name, source in sources.items()])


def flatten(events: DataFrame) -> DataFrame:
    """The flat record of every event, by event type, plus ``malformed`` and ``value``.

    Columns of another type's branch stay absent. ``malformed`` marks edits whose ``length``
    or ``revision`` is there but is not an object; only for these the raw line is kept.
    """
    event = F.col("event")
    event_type = V.as_text(V.child(event, "$.type"))
    is_edit, is_log = event_type.isin(EDIT_TYPES), event_type.isin(LOG_TYPES)

    bad_nesting = F.lit(False)
    for key in ("length", "revision"):
        nested = V.child(event, f"$.{key}")
        bad_nesting = bad_nesting | (nested.isNotNull() & ~V.is_object(V.kind(nested)))
    malformed = is_edit & bad_nesting

    columns = [_read(event, CORE[name]).alias(name) for name in CORE]
    columns += [F.when(is_edit, _read(event, EDIT[name])).alias(name) for name in EDIT]
    columns += [F.when(is_log, _read(event, LOG[name])).alias(name) for name in LOG]
    raw_line = F.when(malformed, F.col("value"))
    return events.select(raw_line.alias("value"), malformed.alias("malformed"), *columns)


def clean_booleans(records: DataFrame, *names: str) -> DataFrame:
    """Turn the columns to JSON booleans by truthiness; an absent column stays absent."""
    cleaned = {}
    for name in names:
        value = F.col(name)
        truth = V.truthy(value, V.kind(value))
        cleaned[name] = F.when(truth, F.parse_json(F.lit("true"))).when(
            ~truth, F.parse_json(F.lit("false"))
        )
    return records.withColumns(cleaned)


def flat_records(lines: DataFrame) -> DataFrame:
    """Flat JSON records, one per line, in the form :func:`flatten` gives.

    ``record_kind`` tells objects from other JSON; NULL where the line is not JSON.
    """
    record = F.col("event")
    return lines.select(
        "*",
        V.kind(record).alias("record_kind"),
        *[V.child(record, f"$.{name}").alias(name) for name in EDIT_FIELDS],
    )


def typed_columns(kind_of) -> list[Column]:
    """The 24 columns in their declared types; ``kind_of(name)`` gives the kind column."""
    return [
        V.typed(F.col(name), kind_of(name), declared).alias(name)
        for name, declared in DECLARED.items()
    ]
