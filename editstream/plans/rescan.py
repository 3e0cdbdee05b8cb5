"""Screening stored edits again under another rule version, without repeating finished rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.functions import rulebook
from editstream.operators.detect import SAMPLE_LENGTH, flagged_records, with_flags
from editstream.plans import finished
from editstream.plans.routing import RuleSet, rule_set
from editstream.session import sized_shuffles, staged
from editstream.sources.tables import SCAN_COLUMNS, read_table, write_table


def finished_ids(flagged: DataFrame, clean: DataFrame, version: str) -> DataFrame:
    """Ids that were screened under the version, whatever came of it."""
    known = F.col("rule_version") == version
    return (
        flagged.where(known)
        .select("event_id")
        .unionByName(clean.where(known).select("event_id"))
    )


def pending(edits: DataFrame, flagged: DataFrame, clean: DataFrame, version: str) -> DataFrame:
    """Edits that neither table knows for this rule version.

    Both tables are cut to the version and to their id before they meet the edits in a single
    anti join, so the edits are shuffled once.
    """
    done = finished_ids(flagged, clean, version)
    return edits.join(done, edits["evt_id"] == done["event_id"], "left_anti")


@contextmanager
def pending_rows(edits: DataFrame, done: DataFrame) -> Iterator[DataFrame]:
    """Edits whose ids are not in ``done``, for wide tables, where texts should not be shuffled.

    A version that has never run needs no join. Otherwise only ids meet in the anti join, which
    leaves the index of finished ids where it lies; what is left is staged, and the texts are read
    against it: with few pending ids Spark broadcasts them by their known size, with many it shuffles
    both sides.
    """
    if done.isEmpty():
        yield edits
        return
    with staged(finished.pending_ids(edits, done), "pending") as todo:
        yield edits.join(todo, edits["evt_id"].eqNullSafe(todo["evt_id"]), "left_semi")


def rescan(
    spark: SparkSession,
    root: str,
    rules: str | RuleSet = rulebook.LATEST_VERSION,
    buckets: int | None = None,
) -> dict[str, int]:
    """Screen what is pending and append to the flagged and clean tables.

    What is finished is told by an index of these two tables, brought up to date first. The flagged
    rows are written first; should the job end between the two writes, the next run finds them and
    only adds the clean rows. ``buckets`` is for a new index.
    """
    version = rule_set(rules).version
    edits = read_table(spark, root, "edits").select(*SCAN_COLUMNS, "dt_user")
    finished.sync(spark, root, buckets)
    done = finished.screened_ids(spark, root, version)
    run = f"rescan-{version}-{uuid.uuid4().hex}"
    as_of = F.lit(datetime.now(timezone.utc))
    with sized_shuffles(edits), pending_rows(edits, done) as todo:
        with staged(screened_for_tables(todo, rule_set(rules).rules), "rescan") as rows:
            write_table(flagged_records(rows, version, as_of), root, "flagged", run)
            write_table(clean_markers(rows, version), root, "clean", run)
            counts = rows.agg(
                F.count("*").alias("scanned"),
                F.count_if(F.size("flag_types") > 0).alias("flagged"),
            ).first()
    return {"scanned": counts["scanned"], "flagged": counts["flagged"]}


def screened_for_tables(edits: DataFrame, rules: list[dict]) -> DataFrame:
    """Screened rows without what the tables do not keep: of clean rows only the id."""
    rows = with_flags(edits, rules).drop("parsed_comment")
    sample = F.when(F.size("flag_types") > 0, F.substring("comment", 1, SAMPLE_LENGTH))
    return rows.withColumn("comment", sample)


def clean_markers(rows: DataFrame, version: str) -> DataFrame:
    return rows.where(F.size("flag_types") == 0).select(
        F.col("evt_id").alias("event_id"), F.lit(version).alias("rule_version")
    )


def version_totals(flagged: DataFrame, clean: DataFrame) -> DataFrame:
    """Flagged and clean counts per rule version, well-formed versions only."""
    marked = flagged.select("rule_version", F.lit(True).alias("is_flagged")).unionByName(
        clean.select("rule_version", F.lit(False).alias("is_flagged"))
    )
    return marked_totals(marked)


def marked_totals(marked: DataFrame) -> DataFrame:
    """The same from one table of ``rule_version, is_flagged``."""
    return (
        marked.where(F.col("rule_version").rlike(rulebook.VERSION_PATTERN))
        .groupBy("rule_version")
        .agg(
            F.count_if("is_flagged").alias("flagged_events"),
            F.count_if(~F.col("is_flagged")).alias("clean_events"),
        )
    )
