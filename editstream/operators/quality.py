"""Record clean-up with defaults, truncation, drift warnings and a quality score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editstream.functions import variants as V
from editstream.functions.columns import compute_once, present_only, python_strip
from editstream.schemas import EDIT_FIELDS, REQUIRED_COLUMNS

# --- Fixed values: clean-up types, defaults, length limits and score weights ---
CLEAN_TYPES = {
    "evt_id": ("str", ""),
    "type": ("str", "unknown"),
    "domain": ("str", "unknown"),
    "title": ("str", ""),
    "user": ("str", ""),
    "bot": ("bool", False),
    "ns": ("int", 0),
    "wiki": ("str", ""),
    "srv_name": ("str", ""),
    "srv_url": ("str", ""),
    "minor": ("bool", False),
    "patrolled": ("bool", False),
    "len_old": ("int", 0),
    "len_new": ("int", 0),
    "rev_old": ("int", 0),
    "rev_new": ("int", 0),
    "comment": ("str", ""),
    "parsed_comment": ("str", ""),
    "log_type": ("str", ""),
    "log_action": ("str", ""),
    "log_id": ("int", 0),
    "log_comment": ("str", ""),
    "dt_user": ("str", None),
    "dt_server": ("str", None),
}
MAX_LENGTHS = {
    "title": 500,
    "user": 100,
    "comment": 1000,
    "parsed_comment": 1000,
    "log_comment": 1000,
}
WEIGHT_REQUIRED = "0.30"
WEIGHT_TRUNCATED = "0.05"
WEIGHT_DRIFT = "0.10"
TRUE_WORDS = ["true", "1", "yes"]
EMPTY_MESSAGE = "Data cannot be empty"
# -------------------------------------------------------------------------------

_DIGITS = r"\d+(_\d+)*"
NUMBER = rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"


def number_or_null(text: Column) -> Column:
    """Text as a double where it is a plain decimal number; Spark alone would take '5d' too."""
    trimmed = python_strip(text)
    return F.when(
        trimmed.rlike(NUMBER), F.replace(trimmed, F.lit("_"), F.lit("")).try_cast("double")
    )


def whole_or_null(number: Column) -> Column:
    """Toward zero; NULL for NaN, infinity and what does not fit a long."""
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.when(F.abs(number) < F.lit(2.0**63), whole)


def safe_cast_text(text: Column, target: str, default) -> Column:
    """Text to ``str``, ``int``, ``float`` or ``bool``; the default for NULL or a bad value."""
    if target == "bool":
        return F.coalesce(F.lower(text).isin(TRUE_WORDS), F.lit(default))
    if target == "int":
        return F.coalesce(whole_or_null(number_or_null(text)), F.lit(default).cast("long"))
    if target == "float":
        return F.coalesce(number_or_null(text), F.lit(default).cast("double"))
    return F.coalesce(text, F.lit(default).cast("string"))


def safe_cast(value: Column, kind: Column, target: str, default) -> Column:
    """A VARIANT to the target type; absent, null and unusable values give the default."""
    if target == "bool":
        text = V.as_text(value)
        truth = F.when(kind == "STRING", F.lower(text).isin(TRUE_WORDS)).otherwise(
            V.truthy(value, kind)
        )
        return F.when(kind != "VOID", truth).otherwise(F.lit(default))
    if target == "int":
        number = (
            F.when(kind == "STRING", whole_or_null(number_or_null(V.as_text(value))))
            .when(kind.isin("BIGINT", "BOOLEAN"), V.as_long(value))
            .when(V.is_fraction(kind), whole_or_null(V.as_double(value)))
        )
        return F.coalesce(number, F.lit(default).cast("long"))
    text = F.when(kind != "VOID", V.display_text(value, kind))
    return F.coalesce(text, F.lit(default).cast("string"))


def _kind(name: str) -> Column:
    return F.col(f"kind_of_{name}")


def _is_missing(name: str) -> Column:
    """Absent, null or empty text."""
    return F.coalesce(_kind(name) == "VOID", F.lit(True)) | F.coalesce(
        (_kind(name) == "STRING") & (V.as_text(F.col(name)) == ""), F.lit(False)
    )


def clean_records(records: DataFrame) -> DataFrame:
    """Cleaned columns with ``is_valid``, ``errors``, ``warnings`` and ``quality_score``.

    Takes the flat VARIANT columns, the line in ``value`` and its ``record_kind``. A record
    with a required column missing keeps no data; its columns are NULL.
    """
    is_record = F.coalesce(
        V.is_object(F.col("record_kind")) & (F.col("record_kind") != "OBJECT<>"), F.lit(False)
    )
    # The key names come from the text: a map of the event would copy every value.
    keys = F.json_object_keys(F.col("value").cast("string"))
    unknown = F.when(
        F.col("is_record"),
        F.array_sort(F.array_except(keys, F.array(*[F.lit(name) for name in EDIT_FIELDS]))),
    )
    records = records.withColumns({f"kind_of_{name}": V.kind(F.col(name)) for name in EDIT_FIELDS})
    records = records.withColumn("is_record", is_record)
    casted = {
        name: safe_cast(F.col(name), _kind(name), *CLEAN_TYPES[name]).alias(name)
        for name in EDIT_FIELDS
    }
    missing = {name: _is_missing(name) for name in REQUIRED_COLUMNS}
    carried = [
        c
        for c in records.columns
        if c not in EDIT_FIELDS and not c.startswith("kind_of_") and c != "is_record"
    ]
    step = records.select(
        *carried,
        "is_record",
        *casted.values(),
        *[missing[name].alias(f"missing_{name}") for name in REQUIRED_COLUMNS],
        unknown.alias("unknown_fields"),
    )

    too_long = {
        name: F.char_length(F.col(name)) > limit for name, limit in MAX_LENGTHS.items()
    }
    errors = F.when(
        F.col("is_record"),
        present_only(
            [
                F.when(
                    F.col(f"missing_{name}"),
                    F.lit(f"Required field '{name}' is missing or empty"),
                )
                for name in REQUIRED_COLUMNS
            ]
        ),
    ).otherwise(F.array(F.lit(EMPTY_MESSAGE)))
    warnings = F.when(
        F.col("is_record"),
        present_only(
            [
                F.when(
                    too_long[name],
                    F.concat(
                        F.lit(f"Field '{name}' truncated from "),
                        F.char_length(F.col(name)).cast("string"),
                        F.lit(f" to {limit} chars"),
                    ),
                )
                for name, limit in MAX_LENGTHS.items()
            ]
            + [
                F.when(
                    F.size("unknown_fields") > 0,
                    F.concat(
                        F.lit("Unknown fields detected (schema drift): "),
                        F.array_join("unknown_fields", ", "),
                    ),
                )
            ]
        ),
    ).otherwise(F.array().cast("array<string>"))

    def count(flags) -> Column:
        return sum((F.when(flag, 1).otherwise(0) for flag in flags), F.lit(0))

    def weight(text: str) -> Column:
        return F.lit(text).cast("decimal(4,2)")

    score = (
        weight("1.00")
        - weight(WEIGHT_REQUIRED) * count(F.col(f"missing_{n}") for n in REQUIRED_COLUMNS)
        - weight(WEIGHT_TRUNCATED) * count(too_long.values())
        - weight(WEIGHT_DRIFT) * count([F.size("unknown_fields") > 0])
    )
    score = F.when(F.col("is_record"), F.greatest(score, weight("0.00"))).otherwise(weight("0.00"))

    step = compute_once(step, errors=errors)
    is_valid = F.size("errors") == 0

    def finished(name: str) -> Column:
        column = F.col(name)
        if name in MAX_LENGTHS:
            column = F.substring(column, 1, MAX_LENGTHS[name])
        if CLEAN_TYPES[name][0] == "str":
            column = python_strip(column)
        return F.when(is_valid, column).alias(name)

    return step.select(
        *carried,
        *[finished(name) for name in EDIT_FIELDS],
        is_valid.alias("is_valid"),
        "errors",
        warnings.alias("warnings"),
        score.cast("decimal(4,2)").alias("quality_score"),
        "unknown_fields",
    )


def drift_warnings(cleaned: DataFrame) -> DataFrame:
    """How many records carry each key that the schema does not know."""
    return (
        cleaned.select(F.explode("unknown_fields").alias("field"))
        .groupBy("field")
        .agg(F.count("*").alias("records"))
    )


def quality_summary(cleaned: DataFrame, *by: str) -> DataFrame:
    return cleaned.groupBy(*by).agg(
        F.count("*").alias("records"),
        F.count_if("is_valid").alias("valid_records"),
        F.avg("quality_score").cast("double").alias("avg_score"),
        F.min("quality_score").cast("double").alias("min_score"),
        F.sum(F.size("errors")).alias("errors"),
        F.sum(F.size("warnings")).alias("warnings"),
    )
