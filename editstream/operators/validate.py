"""Field-by-field validation of flat records and the dead-letter form of the bad ones."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editstream.functions import variants as V
from editstream.functions.columns import compute_once, present_only
from editstream.operators.flatten import typed_columns
from editstream.schemas import (
    DECLARED,
    EDIT_FIELDS,
    ERROR_TYPE,
    REQUIRED_COLUMNS,
    SCHEMA_VERSION,
)

# --- Fixed values: error categories and message texts ---
MISSING = "MISSING_REQUIRED_FIELD"
MISMATCH = "TYPE_MISMATCH"
VALIDATION = "VALIDATION_ERROR"
MALFORMED = "MALFORMED_INPUT"
EXPECTED_WORDS = {
    "STRING": "string",
    "INT64": "integer",
    "BOOL": "boolean",
    "TIMESTAMP": "timestamp (int/string)",
}
MALFORMED_MESSAGE = "Input is not a valid dictionary"
MISSING_MESSAGE = "Required field {} is missing"
MISMATCH_MESSAGE = "Expected {} for {}, got "
# --------------------------------------------------------


TIMESTAMPS = [name for name in EDIT_FIELDS if DECLARED[name] == "TIMESTAMP"]


def _kind(name: str) -> Column:
    return F.col(f"kind_of_{name}")


def with_kinds(records: DataFrame) -> DataFrame:
    return records.withColumns({f"kind_of_{name}": V.kind(F.col(name)) for name in EDIT_FIELDS})


def _accepted(name: str) -> Column:
    """True for an absent value, a null in an optional column, or a kind that fits."""
    kinds = list(V.ACCEPTED_KINDS[DECLARED[name]])
    if name not in REQUIRED_COLUMNS:
        kinds.append("VOID")
    return F.coalesce(_kind(name).isin(kinds), F.lit(True))


def _error(category: str, field: str, expected: str, actual: Column, message: Column) -> Column:
    return F.struct(
        F.lit(category).alias("category"),
        F.lit(field).alias("field"),
        F.lit(expected).alias("expected_type"),
        actual.alias("actual_value"),
        message.alias("message"),
    ).cast(ERROR_TYPE)


def _missing_error(name: str) -> Column:
    return _error(
        MISSING, name, DECLARED[name], F.lit("None"), F.lit(MISSING_MESSAGE.format(name))
    )


def _mismatch_error(name: str) -> Column:
    expected = DECLARED[name]
    return _error(
        MISMATCH,
        name,
        expected,
        V.display_text(F.col(name), _kind(name)),
        F.concat(
            F.lit(MISMATCH_MESSAGE.format(EXPECTED_WORDS[expected], name)),
            V.type_name(_kind(name)),
        ),
    )


def _unreadable(name: str) -> Column:
    """True for a timestamp of a fitting type that is no time of the years 1 to 9999.

    Such a value cannot be kept in its column, so its row is not valid.
    """
    fits = _kind(name).isin(V.ACCEPTED_KINDS["TIMESTAMP"])
    time = V.typed(F.col(name), _kind(name), "TIMESTAMP")
    return F.coalesce(fits & time.isNull(), F.lit(False))


def _unreadable_error(name: str) -> Column:
    return _error(
        VALIDATION,
        name,
        DECLARED[name],
        V.display_text(F.col(name), _kind(name)),
        F.lit(f"Value of {name} is no time of the years 1 to 9999"),
    )


def field_errors() -> Column:
    """Errors of a record: missing required columns first, then mistyped columns in order, then
    unreadable times."""
    unreadable = [F.when(_unreadable(name), _unreadable_error(name)) for name in TIMESTAMPS]
    missing = [F.when(_kind(name).isNull(), _missing_error(name)) for name in REQUIRED_COLUMNS]
    mismatched = [F.when(~_accepted(name), _mismatch_error(name)) for name in EDIT_FIELDS]
    return present_only(missing + mismatched + unreadable)


def error_category(errors: Column) -> Column:
    categories = errors["category"]
    return (
        F.when(F.size(errors) == 0, "VALID")
        .when(F.array_contains(categories, MISSING), MISSING)
        .when(F.array_contains(categories, MISMATCH), MISMATCH)
        .when(F.array_contains(categories, VALIDATION), VALIDATION)
        .otherwise("OTHER")
    )


def validate(records: DataFrame, payload: Column | None = None) -> DataFrame:
    """Typed columns plus ``is_valid``, ``errors`` and, for invalid rows, ``payload``.

    Takes the flat VARIANT columns and a ``malformed`` flag; ``value`` is the raw line. The
    payload is the flat record as JSON unless another column is given. The error list is built
    only for rows that fail.
    """
    all_accepted = reduce(and_, [_accepted(name) for name in EDIT_FIELDS])
    all_readable = reduce(and_, [~_unreadable(name) for name in TIMESTAMPS])
    all_present = reduce(and_, [_kind(name).isNotNull() for name in REQUIRED_COLUMNS])
    records = compute_once(
        with_kinds(records), is_valid=~F.col("malformed") & all_present & all_accepted & all_readable
    )
    carried = [
        c
        for c in records.columns
        if c not in EDIT_FIELDS and not c.startswith("kind_of_") and c != "value"
    ]
    malformed_error = _error(
        MALFORMED, "_root", "DICT", F.col("value").cast("string"), F.lit(MALFORMED_MESSAGE)
    )
    errors = (
        F.when(F.col("is_valid"), F.array().cast(f"array<{ERROR_TYPE.simpleString()}>"))
        .when(F.col("malformed"), F.array(malformed_error))
        .otherwise(field_errors())
    )
    payload = F.when(
        ~F.col("is_valid"),
        F.when(F.col("malformed"), F.col("value").cast("string")).otherwise(
            F.to_json(F.struct(*EDIT_FIELDS)) if payload is None else payload
        ),
    )
    absent = present_only([F.when(_kind(name).isNull(), F.lit(name)) for name in EDIT_FIELDS])
    return records.select(
        *carried,
        *typed_columns(_kind),
        errors.alias("errors"),
        payload.alias("payload"),
        F.when(~F.col("is_valid"), absent).alias("absent_fields"),
    )


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where("is_valid").select(EDIT_FIELDS)


def _fill_value(declared: str) -> Column:
    """What an absent column of a dead letter is filled with."""
    if declared == "STRING":
        return F.lit("")
    if declared == "INT64":
        return F.lit(0).cast("long")
    if declared == "BOOL":
        return F.lit(False)
    return F.timestamp_seconds(F.lit(0))


def dead_letters(validated: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Invalid rows as dead letters.

    Absent columns are filled; a mistyped value is NULL in its column and stays whole in
    ``_original_payload``. A malformed event has no usable columns at all.
    """
    now = F.current_timestamp() if as_of is None else as_of

    def filled(name: str) -> Column:
        fill = _fill_value(DECLARED[name])
        use_fill = F.col("malformed") | F.array_contains("absent_fields", name)
        return F.when(use_fill, fill).otherwise(F.col(name)).alias(name)

    return validated.where("not is_valid").select(
        *[filled(name) for name in EDIT_FIELDS],
        now.alias("_validation_timestamp"),
        error_category(F.col("errors")).alias("_error_category"),
        F.to_json("errors").alias("_error_details"),
        F.col("payload").alias("_original_payload"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
    )


def exploded_errors(validated: DataFrame) -> DataFrame:
    """One row per error, with the id of its record."""
    return validated.where("not is_valid").select(
        "evt_id", F.inline("errors"), F.col("payload")
    )


def required_report(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: is it there, and how many rows lack a value."""
    absent = [name for name in required if name not in df.columns]
    counts = [F.count_if(F.col(name).isNull()).alias(name) for name in required if name not in absent]
    counted = df.agg(F.count("*").alias("rows"), *counts)
    report = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(name not in absent).alias("column_exists"),
            (F.col("rows") if name in absent else F.col(name)).alias("rows_without_value"),
        )
        for name in required
    ]
    return counted.select(F.inline(F.array(*report)), "rows")


def type_violations(events: DataFrame, declared: dict[str, list[str]]) -> DataFrame:
    """Counts of values whose JSON kind is not among the declared kinds of their key.

    Only the declared keys are looked up; a key that is absent is no violation.
    """
    event = F.col("event")
    checks = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(",".join(kinds)).alias("expected"),
            V.kind(V.child(event, f"$.{name}")).alias("kind"),
        )
        for name, kinds in declared.items()
    ]
    found = events.select(F.inline(F.array(*checks))).where("kind is not null")
    wrong = reduce(
        lambda seen, item: seen | ((F.col("field") == item[0]) & ~F.col("kind").isin(item[1])),
        declared.items(),
        F.lit(False),
    )
    return (
        found.where(wrong)
        .groupBy("field", "expected", V.type_name(F.col("kind")).alias("actual"))
        .agg(F.count("*").alias("rows"))
    )
