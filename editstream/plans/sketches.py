"""Distinct users over any span of days, from sketches that are kept per day and merged on reading."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editstream.functions.columns import parse_time
from editstream.sources import snapshots, tables

NAME = "user_sketches"
#: log2 of the number of registers: a relative standard error of about 1.04 / sqrt(2^14), 0.8 percent.
REGISTERS = 14
SCHEMA = T.StructType(
    [
        T.StructField("user_day", T.DateType()),
        T.StructField("domain", T.StringType()),
        T.StructField("events", T.LongType()),
        T.StructField("edits", T.LongType()),
        T.StructField("users", T.BinaryType()),
    ]
)


def sketched(edits: DataFrame) -> DataFrame:
    """Per day of the user time and domain: events, edits, and a sketch of the users, combined in
    the tasks that read the rows before anything is shuffled."""
    day = F.to_date(parse_time(F.col("dt_user")))
    return edits.groupBy(day.alias("user_day"), "domain").agg(
        F.count("*").alias("events"),
        F.count_if(F.col("type") == "edit").alias("edits"),
        F.hll_sketch_agg("user", F.lit(REGISTERS)).alias("users"),
    )


def _path(root: str) -> str:
    return f"{root.rstrip('/')}/{NAME}"


def sync(spark: SparkSession, root: str) -> int:
    """Bring the sketches in line with the edits: those of folders that the table no longer names go,
    folders that are new are sketched, all in one step. Returns how many folders were read.

    A folder made by compaction holds the rows of those it was made of, whose sketches stay.
    """
    edits = snapshots.folders(spark, tables.table_path(root, "edits"))
    stored = snapshots.folders(spark, _path(root))
    known = {f"edits/{f.batch_id}" for f in stored}
    new = [f for f in edits if not f.known_in(known, "edits")]
    named = {p for f in edits for p in (f.path, *f.merged)}
    if not new and all(f.batch_id in named for f in stored):
        return 0
    added = []
    for folder in new:
        rows = tables.read_folders(spark, root, "edits", [folder])
        target = f"run={uuid.uuid4().hex}"
        sketched(rows).coalesce(1).write.parquet(f"{_path(root)}/{target}")
        added.append(snapshots.Folder(target, folder.path))

    def change(now: list[snapshots.Folder]) -> list[snapshots.Folder]:
        return [f for f in now if f.batch_id in named] + added

    snapshots.commit(spark, _path(root), change)
    return len(new)


def stored_sketches(spark: SparkSession, root: str) -> DataFrame:
    found = [f"{_path(root)}/{f.path}" for f in snapshots.folders(spark, _path(root))]
    return spark.read.schema(SCHEMA).parquet(*found) if found else spark.createDataFrame([], SCHEMA)


def about_users(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Events, edits and about how many distinct users per group, merged from stored sketches: a few KB
    per day and domain are read, whatever the number of edits. The exact form is
    ``analytics.daily_summary`` and the like."""
    return sketches.groupBy(*by).agg(
        F.sum("events").alias("events"),
        F.sum("edits").alias("edits"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("about_unique_users"),
    )
