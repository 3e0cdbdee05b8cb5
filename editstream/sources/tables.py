"""Stored tables: folders per write and day, and a manifest that names those of each version.

``<root>/<table>/run=<write>/day=<date>/batch_id=<id>/*.parquet``. A write replaces what its ``batch_id``
wrote before, in one step: repeating a micro-batch or a failed run leaves no duplicate rows, and readers
see the table before or after it. :func:`compact_day` merges the batches of a day that is over.
See :mod:`editstream.sources.snapshots`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editstream.functions.columns import parse_time
from editstream.schemas import (
    CLEAN_SCHEMA,
    DEAD_LETTER_SCHEMA,
    EDIT_SCHEMA,
    FLAGGED_SCHEMA,
    PROGRESS_SCHEMA,
)
from editstream.session import COMPRESSION, GZIP, PARQUET_EXPANSION, estimated_bytes, freed_shuffles
from editstream.sources import snapshots

SCHEMAS = {
    "edits": EDIT_SCHEMA,
    "dead_letter": DEAD_LETTER_SCHEMA,
    "flagged": FLAGGED_SCHEMA,
    "clean": CLEAN_SCHEMA,
    "progress": PROGRESS_SCHEMA,
}
DAY_SOURCE = {
    "edits": "dt_server",
    "dead_letter": "_validation_timestamp",
    "flagged": "detection_timestamp",
}
SORT_WITHIN = {"flagged": ["rule_version", "domain"], "edits": ["user_day"]}
GATHER_BYTES = 1024**3
PARTITION_FIELDS = [T.StructField("day", T.DateType()), T.StructField("batch_id", T.StringType())]
#: Columns that are stored beside the declared ones: the day of the user time, by which files are
#: sorted, so that Parquet's own minima and maxima let queries on that time pass over most of them.
DERIVED_FIELDS = {"edits": [T.StructField("user_day", T.DateType())]}

# --- Fixed value: the columns a rescan reads ---
SCAN_COLUMNS = [
    "evt_id",
    "comment",
    "parsed_comment",
    "title",
    "user",
    "domain",
    "ns",
    "type",
    "dt_server",
]


def _derived(table: str) -> dict[str, Column]:
    return {"user_day": F.to_date(parse_time(F.col("dt_user")))} if table == "edits" else {}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_table(
    df: DataFrame, root: str, table: str, batch_id: str | int, gather_days: bool | None = None
) -> None:
    """Write one batch of a table, in place of what the batch wrote before.

    With ``gather_days`` the rows of a day meet before they are written, so that there are few files:
    ``rebalance`` lets AQE choose their count from the data; a day with most of the rows is split over
    many tasks, small days share one. That shuffles all there is to write. Without it the tasks that hold
    the rows write a file per day each, and no text is moved; :func:`compact_day` merges the files of a day
    that is over. By default only batches of a known size under ``GATHER_BYTES`` are gathered; the size of
    stored and staged rows is that of their compressed files.
    """
    if gather_days is None:
        gather_days = estimated_bytes(df) * PARQUET_EXPANSION < GATHER_BYTES
    spark, path = df.sparkSession, table_path(root, table)
    added = _write_run(df, path, table, str(batch_id), gather_days)
    snapshots.commit(
        spark, path, lambda now: [f for f in now if f.batch_id != str(batch_id)] + added
    )


def _write_run(
    df: DataFrame, path: str, table: str, batch_id: str, gather_days: bool
) -> list[snapshots.Folder]:
    """Write rows to folders of their own, which no reader sees yet."""
    run = uuid.uuid4().hex
    df = df.withColumns({**_derived(table), "batch_id": F.lit(batch_id)})
    if table in DAY_SOURCE:
        df = df.withColumn("day", F.to_date(DAY_SOURCE[table]))
        if gather_days:
            df = df.hint("rebalance", "day")
        df = df.sortWithinPartitions("day", *SORT_WITHIN.get(table, []))
    by = ["day", "batch_id"] if table in DAY_SOURCE else ["batch_id"]
    with freed_shuffles(df.sparkSession):
        df.write.partitionBy(*by).option("compression", COMPRESSION).parquet(f"{path}/run={run}")
    return snapshots.written(df.sparkSession, path, run, batch_id)


def compact_day(spark: SparkSession, root: str, table: str, day: str) -> None:
    """Rewrite a day that gets no more batches as one batch of few files.

    The old files stay until :func:`snapshots.vacuum`, for readers that are at them. If one of the
    day's batches is replaced meanwhile, the new files are given up and a :class:`snapshots.Moved`
    is raised.
    """
    path = table_path(root, table)
    old = [f for f in snapshots.folders(spark, path) if f.day == day]
    if len(old) < 2:
        return
    stored = read_folders(spark, root, table, old)
    batch_id = f"compacted-{uuid.uuid4().hex}"
    added = _write_run(stored.drop("day", "batch_id"), path, table, batch_id, gather_days=True)
    # What a folder was compacted from in the end: folders of writes only.
    merged = tuple(p for f in old for p in (f.merged or (f.path,)))
    added = [f._replace(merged=merged) for f in added]

    def replace(now: list[snapshots.Folder]) -> list[snapshots.Folder]:
        if not set(old) <= set(now):
            raise snapshots.Moved(f"{table} of {day} has changed while it was compacted")
        return [f for f in now if f not in old] + added

    snapshots.commit(spark, path, replace)


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Create the tables that do not exist yet, empty; of existing ones, check the columns.

    Tables of before there were manifests are taken over as they are.
    """
    for table in SCHEMAS:
        path = table_path(root, table)
        snapshots.adopt(spark, path)
        if snapshots.versions(spark, path):
            check_columns(spark, root, table)
        else:
            snapshots.commit(spark, path, lambda now: now)


def check_columns(spark: SparkSession, root: str, table: str) -> list[str]:
    """The declared columns that no stored file has; they read as NULL and come with new files.

    A column that is stored under another type cannot be read as declared: a ValueError names it.
    """
    path = table_path(root, table)
    files = [f"{path}/{f.path}" for f in snapshots.folders(spark, path)]
    if not files:
        return []
    merged = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*files).schema
    stored = {f.name: f.dataType.simpleString() for f in merged}
    declared = {f.name: f.dataType.simpleString() for f in SCHEMAS[table]}
    changed = [f"{n}: {stored[n]} is stored, {t} declared" for n, t in declared.items() if stored.get(n, t) != t]
    if changed:
        raise ValueError(f"table {table} cannot be migrated by adding columns: {'; '.join(changed)}")
    return [n for n in declared if n not in stored]


def _stored_fields(table: str) -> list[T.StructField]:
    partitions = PARTITION_FIELDS if table in DAY_SOURCE else PARTITION_FIELDS[1:]
    return [*SCHEMAS[table].fields, *DERIVED_FIELDS.get(table, []), *partitions]


def read_folders(
    spark: SparkSession,
    root: str,
    table: str,
    found: list[snapshots.Folder],
    extra: list[T.StructField] = (),
) -> DataFrame:
    """Some folders of a table, as :func:`read_table` gives them."""
    fields = _stored_fields(table)
    partitions = len(fields) - (2 if table in DAY_SOURCE else 1)
    schema = T.StructType([*fields[:partitions], *extra, *fields[partitions:]])
    if not found:
        return spark.createDataFrame([], schema)
    path = table_path(root, table)
    files = [f"{path}/{f.path}" for f in found]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*files)
    return rows.select(schema.fieldNames())


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    extra: list[T.StructField] = (),
    version: int | None = None,
    days: list[str] | None = None,
) -> DataFrame:
    """The table under its declared schema; columns that older files lack read as NULL.

    ``version`` is a state of the table, by default the newest. ``day`` prunes folders; with ``days``
    the folders of other days are not even listed. ``extra`` names columns that files may hold beyond
    the schema.
    """
    found = snapshots.folders(spark, table_path(root, table), version)
    if days is not None:
        found = [f for f in found if f.day in days]
    return read_folders(spark, root, table, found, extra)


def register_views(spark: SparkSession, root: str, name: str = "edits") -> list[str]:
    """The tables as SQL views: ``<name>``, ``<name>_dead_letter``, ``_flagged``, ``_clean``, ``_progress``."""
    views = []
    for table in SCHEMAS:
        view = name if table == "edits" else f"{name}_{table}"
        read_table(spark, root, table).createOrReplaceTempView(view)
        views.append(view)
    return views


def json_columns(flagged: DataFrame) -> DataFrame:
    """The nested columns of flagged records as JSON text, for sinks without nested types."""
    nested = ["ai_flags", "content_sample", "detection_metadata"]
    return flagged.withColumns({name: F.to_json(name) for name in nested})


def write_json_lines(lines: DataFrame, path: str, compressed: bool = False) -> None:
    """JSON texts in ``value``, one per line; a value keeps its JSON type, whatever was declared.

    Compressed files are gzip, which any reader of lines takes, a file per task.
    """
    with freed_shuffles(lines.sparkSession):
        lines.write.mode("overwrite").options(**(GZIP if compressed else {})).text(path)


def on_day(df: DataFrame, day: Column) -> DataFrame:
    return df.where(F.col("day") == day)
