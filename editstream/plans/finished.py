"""An index of the ids that were screened, by rule version, which rescans join where it lies.

The ids of the flagged and clean tables are kept a second time, bucketed and sorted by id. Joined with
them, edits are shuffled to the buckets; the index, which grows with every version, is not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.sources import snapshots, tables
from editstream.sources.id_index import IdIndex

INDEX = "finished"
SOURCES = ("flagged", "clean")


def open_index(spark: SparkSession, root: str, buckets: int | None = None) -> IdIndex:
    return IdIndex(spark, f"{root.rstrip('/')}/{INDEX}", buckets)


def sync(spark: SparkSession, root: str, buckets: int | None = None) -> int:
    """Add the ids of all folders of the flagged and clean tables that the index does not know yet.

    Which folders it knows is noted after their ids are there: a sync that breaks off in between is
    repeated, and an id that is there twice does no harm. A compacted folder holds nothing new if
    all folders merged in it are known. Returns the number of folders.
    """
    index, covered = open_index(spark, root, buckets), f"{root.rstrip('/')}/{INDEX}/covered"
    known = {f.path for f in snapshots.folders(spark, covered)}
    added = []
    ids = spark.createDataFrame([], "event_id string, rule_version string")
    for table in SOURCES:
        path = tables.table_path(root, table)
        new = [f for f in snapshots.folders(spark, path) if not f.known_in(known, table)]
        if new:
            added += [f._replace(path=f"{table}/{f.path}", merged=()) for f in new]
            rows = tables.read_folders(spark, root, table, new)
            ids = ids.unionByName(rows.select("event_id", "rule_version"))
    if added:
        index.add(ids.toDF("id", "label"), uuid.uuid4().hex)
        snapshots.commit(spark, covered, lambda now: now + added)
    return len(added)


def screened_ids(spark: SparkSession, root: str, version: str) -> DataFrame:
    """``id``: what was screened under the version, as far as the index is synced."""
    return open_index(spark, root).rows().where(F.col("label") == version).select("id")


def pending_ids(edits: DataFrame, done: DataFrame) -> DataFrame:
    """Ids of edits that are not in the index, repeated ones as often as they are there."""
    ids = edits.select("evt_id")
    return ids.join(done, ids["evt_id"] == done["id"], "left_anti")
