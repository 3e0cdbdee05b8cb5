"""Audits of an edit table: duplicates, order, clocks, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editstream.functions.columns import join_group_sizes
from editstream.functions.slices import in_slices
from editstream.session import kept

CONTENT_KEY = ["title", "user", "comment"]
FIRST_ORDER = ["dt_server", "dt_user", "title"]


def first_per_id(edits: DataFrame, key: str = "evt_id", order: list[str] | None = None) -> DataFrame:
    """Keep the first row of every id, and all rows without an id.

    Rows that agree in ``order`` follow a digest of all their columns. The filter on the row number becomes a limit before the shuffle, so a task sends at most
    one row per id it holds, however often that id is repeated.
    """
    order = order or FIRST_ORDER
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    rows = edits.withColumns({"_own": own, "_digest": F.xxhash64(*edits.columns)})
    place = F.row_number().over(Window.partitionBy(key, "_own").orderBy(*order, "_digest"))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place", "_own", "_digest")


def repeated_ids(edits: DataFrame, key: str = "evt_id") -> DataFrame:
    return (
        edits.groupBy(key)
        .agg(
            F.count("*").alias("copies"),
            F.min("dt_server").alias("first_seen"),
            F.max("dt_server").alias("last_seen"),
        )
        .where("copies > 1")
    )


def content_digest(columns: list[str] = CONTENT_KEY) -> Column:
    """A digest of the columns that keeps NULL, '' and column borders apart."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def repeated_content(edits: DataFrame, columns: list[str] = CONTENT_KEY) -> DataFrame:
    """Groups of different ids with the same content, one row per group.

    Grouped by a digest instead of the text; a group is counted, never collected. The members
    of the groups come from :func:`repeated_content_members`.
    """
    return _content_groups(edits.select("evt_id", content_digest(columns).alias("content")))


def _content_groups(digests: DataFrame) -> DataFrame:
    return (
        digests.groupBy("content")
        .agg(
            F.count("*").alias("copies"),
            F.min("evt_id").alias("first_id"),
            F.max("evt_id").alias("last_id"),
        )
        .where("first_id <> last_id")
    )


def repeated_content_members(edits: DataFrame, columns: list[str] = CONTENT_KEY) -> DataFrame:
    """Every row of a repeated group: ``content``, ``copies`` and ``evt_id``.

    Ids and digests are staged, so the texts are read once.
    """
    rows = kept(edits.select("evt_id", content_digest(columns).alias("content")), "contents")
    groups = _content_groups(rows).select("content", "copies")
    return join_group_sizes(rows, groups, "content", "copies")


def late_events(
    edits: DataFrame, arrival: Column, by: str = "domain", slice_rows: int = 1_000_000
) -> DataFrame:
    """Rows that arrive after a row of the same group with a later server time.

    ``arrival`` is whatever tells the sequence: a counter, a time, microseconds. Rows that share one are
    not before each other; a row without an arrival is before all others of its group.

    A running maximum over a whole group would sort the group in one task. Here the groups'
    arrivals, each with its latest and earliest time, are put in order and cut into slices of like
    size, wherever the values lie. The maximum per slice and group is a small aggregate, its running
    maximum over slices a small window, and the window over arrivals stays in a slice. Only arrivals
    with a late row are joined back to the rows.
    """
    rows = edits.withColumn("arrival", arrival)
    times = rows.groupBy(F.col(by).alias("_by"), F.col("arrival").alias("_at")).agg(
        F.max("dt_server").alias("top"), F.min("dt_server").alias("least")
    )
    placed = kept(in_slices(times, ["_by", "_at"], slice_rows), "arrivals")
    before = Window.partitionBy("_by").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    peaks = placed.groupBy("_by", "slice").agg(F.max("top").alias("peak")).select(
        F.col("_by").alias("_group"), F.col("slice").alias("_slice"), F.max("peak").over(before).alias("peak_before")
    )
    inside = (
        Window.partitionBy("slice", "_by").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    same_group = F.col("_by").eqNullSafe(F.col("_group")) & (F.col("slice") == F.col("_slice"))
    late = (
        placed.withColumn("peak_inside", F.max("top").over(inside))
        .join(peaks, same_group)
        .select("_by", "_at", "least", F.greatest("peak_inside", "peak_before").alias("latest_before"))
        .where(F.col("latest_before") > F.col("least"))
    )
    here = F.col(by).eqNullSafe(F.col("_by")) & F.col("arrival").eqNullSafe(F.col("_at"))
    return (
        rows.join(late.drop("least"), here)
        .where(F.col("latest_before") > F.col("dt_server"))
        .drop("_by", "_at")
    )


def clock_differences(edits: DataFrame, tolerance_seconds: int = 60) -> DataFrame:
    """Per domain, how far the user time and the server time of an edit lie apart."""
    seconds = F.abs(
        F.unix_timestamp(F.try_to_timestamp("dt_user")) - F.unix_timestamp("dt_server")
    )
    return (
        edits.select("domain", seconds.alias("seconds"))
        .groupBy("domain")
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("seconds").isNull()).alias("unreadable"),
            F.count_if(F.col("seconds") > tolerance_seconds).alias("inconsistent"),
            F.max("seconds").alias("max_seconds"),
        )
    )


def flags_per_event(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy(F.size("ai_flags").alias("flags")).agg(F.count("*").alias("events"))


def row_sizes(df: DataFrame) -> DataFrame:
    """Bytes of the rows as JSON: total, mean and largest."""
    size = F.octet_length(F.to_json(F.struct("*")))
    return df.select(size.alias("size")).agg(
        F.count("*").alias("rows"),
        F.sum("size").alias("total_bytes"),
        F.avg("size").alias("mean_bytes"),
        F.max("size").alias("max_bytes"),
    )


def dead_letter_growth(
    dead: DataFrame, large_bytes: int = 1000, factor: int = 3
) -> DataFrame:
    """How many large dead letters exceed ``factor`` times the size of their payload."""
    size = F.octet_length(F.to_json(F.struct("*")))
    original = F.octet_length("_original_payload")
    return (
        dead.select(size.alias("size"), original.alias("original"))
        .where(F.col("original") > large_bytes)
        .agg(
            F.count("*").alias("large_rows"),
            F.count_if(F.col("size") >= F.col("original") * factor).alias("oversized_rows"),
        )
    )
