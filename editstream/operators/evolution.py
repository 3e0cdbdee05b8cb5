"""Schema evolution: tables that only ever gain columns, and reports of what has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editstream.functions import variants as V
from editstream.schemas import DECLARED, REQUIRED_COLUMNS
from editstream.session import kept


def missing_columns(df: DataFrame, target: T.StructType) -> list[T.StructField]:
    return [field for field in target.fields if field.name not in df.columns]


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Add the target's missing columns as NULL; columns beyond the target stay, at the end."""
    added = {f.name: F.lit(None).cast(f.dataType) for f in missing_columns(df, target)}
    extra = [name for name in df.columns if name not in target.fieldNames()]
    return df.withColumns(added).select(*target.fieldNames(), *extra)


def union_versions(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Rows of two versions of a table; a column only one of them has is NULL in the other."""
    return older.unionByName(newer, allowMissingColumns=True)


def schema_report(old: T.StructType, new: T.StructType) -> dict:
    """Which changes a new schema makes, and whether readers of the old one keep working."""
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    shared = [name for name in before if name in after]
    types = [
        {
            "field": name,
            "old_type": before[name].dataType.simpleString(),
            "new_type": after[name].dataType.simpleString(),
        }
        for name in shared
        if before[name].dataType != after[name].dataType
    ]
    modes = [
        {
            "field": name,
            "old_mode": "NULLABLE" if before[name].nullable else "REQUIRED",
            "new_mode": "NULLABLE" if after[name].nullable else "REQUIRED",
        }
        for name in shared
        if before[name].nullable != after[name].nullable
    ]
    removed = [name for name in before if name not in after]
    tightened = any(change["new_mode"] == "REQUIRED" for change in modes)
    return {
        "is_compatible": not (removed or types or tightened),
        "added_fields": [name for name in after if name not in before],
        "removed_fields": removed,
        "type_changes": types,
        "mode_changes": modes,
    }


def compatibility_report(records: DataFrame) -> DataFrame:
    """Observed keys of flat JSON records against the declared columns, one row per key.

    ``status``: ``added`` (unknown to the schema), ``type_change`` (some values do not fit),
    ``not_required`` (a required column with rows that lack it), ``removed`` (declared, never
    seen) or ``ok``. ``breaking`` says whether readers of the declared schema would notice.
    """
    keyed = records.select("event").where(V.is_object(V.kind(F.col("event"))))
    # A member without a name stands for the record, so that records are counted in the same pass.
    record = F.struct(F.lit(None).cast("string").alias("key"), F.col("event").alias("value"))
    members = F.map_entries(F.col("event").cast("map<string,variant>"))
    entries = keyed.select(F.inline(F.concat(F.array(record), members))).toDF("field", "content")
    kind = F.when(F.col("field").isNotNull(), V.plain_kind(V.kind(F.col("content"))))
    counted = kept(
        entries.groupBy("field", kind.alias("kind")).agg(F.count("*").alias("values")), "field-kinds"
    )
    observed = counted.where("field is not null")
    declared = keyed.sparkSession.createDataFrame(
        [
            (name, kind, V.ACCEPTED_KINDS[kind], name in REQUIRED_COLUMNS)
            for name, kind in DECLARED.items()
        ],
        "field string, declared string, accepted array<string>, required boolean",
    )
    unfit = ~F.array_contains("accepted", F.col("kind")) & (
        (F.col("kind") != "VOID") | F.col("required")
    )
    per_field = (
        observed.join(declared, "field", "full_outer")
        .groupBy("field", "declared", "required")
        .agg(
            F.coalesce(F.sum("values"), F.lit(0)).alias("values"),
            F.coalesce(F.sum(F.when(unfit, F.col("values"))), F.lit(0)).alias("unfit_values"),
        )
    )
    records_seen = counted.where("field is null").agg(F.coalesce(F.sum("values"), F.lit(0)).alias("n"))
    total = records_seen.select("n").scalar()
    status = (
        F.when(F.col("declared").isNull(), "added")
        .when(F.col("values") == 0, "removed")
        .when(F.col("unfit_values") > 0, "type_change")
        .when(F.col("required") & (F.col("values") < total), "not_required")
        .otherwise("ok")
    )
    return per_field.select(
        "field",
        "declared",
        "values",
        "unfit_values",
        status.alias("status"),
        status.isin("removed", "type_change", "not_required").alias("breaking"),
    )
