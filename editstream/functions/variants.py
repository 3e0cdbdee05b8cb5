"""Reading VARIANT values with the three states a JSON key can have: absent, null, typed.

A SQL NULL variant is an absent key; a JSON null is a variant of kind VOID.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLIEST_SECOND = -62135596800  # 0001-01-01T00:00:00Z
LATEST_SECOND = 253402300799  # 9999-12-31T23:59:59Z


def child(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def kind(value: Column) -> Column:
    """BIGINT, STRING, BOOLEAN, VOID, DECIMAL(..), DOUBLE, OBJECT<..>, ARRAY<..>; NULL if absent."""
    return F.schema_of_variant(value)


def plain_kind(kind_: Column) -> Column:
    """The kind without element types and precision, so that there are few different ones."""
    return F.regexp_extract(kind_, "^[A-Z]+", 0)


def is_object(kind_: Column) -> Column:
    return kind_.startswith("OBJECT")


def is_array(kind_: Column) -> Column:
    return kind_.startswith("ARRAY")


def is_fraction(kind_: Column) -> Column:
    return kind_.startswith("DECIMAL") | kind_.isin("DOUBLE", "FLOAT")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def as_long(value: Column) -> Column:
    return F.try_variant_get(value, "$", "bigint")


def as_double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def as_boolean(value: Column) -> Column:
    return F.try_variant_get(value, "$", "boolean")


def text_if_string(value: Column, kind_: Column | None = None) -> Column:
    """The text of a JSON string; NULL for every other kind."""
    return F.when((kind(value) if kind_ is None else kind_) == "STRING", as_text(value))


def type_name(kind_: Column) -> Column:
    """The value's type as the validation messages name it; a whole number of over 64 bits is a
    decimal without a fraction."""
    return (
        F.when(kind_ == "BIGINT", "int")
        .when(kind_.rlike(r"^DECIMAL\((19|[23]\d),0\)"), "int of over 64 bits")
        .when(kind_ == "STRING", "str")
        .when(kind_ == "BOOLEAN", "bool")
        .when(kind_ == "VOID", "NoneType")
        .when(is_object(kind_), "dict")
        .when(is_array(kind_), "list")
        .otherwise("float")
    )


def display_text(value: Column, kind_: Column) -> Column:
    """The value as text for an error report; nested values as JSON."""
    return (
        F.when(kind_ == "VOID", "None")
        .when(kind_ == "BOOLEAN", F.initcap(as_text(value)))
        .otherwise(as_text(value))
    )


def truthy(value: Column, kind_: Column) -> Column:
    """False for null, zero, empty text, empty list and empty object; NULL if absent."""
    return (
        F.when(kind_ == "BOOLEAN", as_boolean(value))
        .when(kind_ == "STRING", as_text(value) != "")
        .when(kind_ == "VOID", F.lit(False))
        .when(is_array(kind_) | is_object(kind_), ~as_text(value).isin("[]", "{}"))
        .when(kind_.isNotNull(), as_double(value) != 0)
    )


def typed(value: Column, kind_: Column, declared: str) -> Column:
    """The value in its declared column type; NULL where the kind does not fit."""
    if declared == "STRING":
        return text_if_string(value, kind_)
    if declared == "BOOL":
        return F.when(kind_ == "BOOLEAN", as_boolean(value))
    if declared == "INT64":
        return F.when(kind_.isin("BIGINT", "BOOLEAN"), as_long(value))
    seconds = as_long(value)
    return F.when(
        kind_.isin("BIGINT", "BOOLEAN") & seconds.between(EARLIEST_SECOND, LATEST_SECOND),
        F.timestamp_seconds(seconds),
    ).when(kind_ == "STRING", F.try_to_timestamp(as_text(value)))


ACCEPTED_KINDS = {
    "STRING": ["STRING"],
    "INT64": ["BIGINT", "BOOLEAN"],
    "BOOL": ["BOOLEAN"],
    "TIMESTAMP": ["BIGINT", "STRING", "BOOLEAN"],
}
