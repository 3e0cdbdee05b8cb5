"""Rates over event time, de-duplication in a stream, and the backlog of a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editstream.functions.columns import parse_time

# --- Fixed values: backlog thresholds in messages ---
HIGH_BACKLOG = 10000
MEDIUM_BACKLOG = 5000
LOW_BACKLOG = 100


def with_event_time(edits: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Edits with ``event_time`` from the user time, and a watermark on it."""
    return edits.withColumn("event_time", parse_time(F.col("dt_user"))).withWatermark(
        "event_time", late
    )


def event_rates(edits: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and (approximately) distinct users per window, for batch or stream.

    A bounded table also has a row of NULL ``window_start`` for events whose user time is not
    readable; a stream has no window for them, see :func:`unreadable_times`.
    """
    counts = [
        F.count("*").alias("event_count"),
        F.approx_count_distinct("user").alias("about_unique_users"),
    ]
    timed = with_event_time(edits, late)
    windows = (
        timed.groupBy(F.window("event_time", width))
        .agg(*counts)
        .select(F.col("window.start").alias("window_start"), "event_count", "about_unique_users")
    )
    if edits.isStreaming:
        return windows
    start = F.lit(None).cast("timestamp").alias("window_start")
    return windows.union(unreadable_times(edits).groupBy(start).agg(*counts))


def chained_rates(
    edits: DataFrame, widths: list[str] = ("1 minute", "1 hour"), late: str = "10 minutes"
) -> DataFrame:
    """Events and about how many distinct users in windows of the last width, made of windows of the
    width before, and these of the one before them.

    As a stream in append mode a window goes on to the next width, and out of the state, once the
    watermark has passed it, so the state holds the open windows of each width and no more. Users
    go from width to width as sketches that can be merged. Rows that come after their window are not
    counted; the progress tells their number (``numRowsDroppedByWatermark``).
    """
    counted = (
        with_event_time(edits, late)
        .groupBy(F.window("event_time", widths[0]))
        .agg(F.count("*").alias("event_count"), F.hll_sketch_agg("user").alias("users"))
    )
    for width in widths[1:]:
        counted = counted.groupBy(F.window("window", width)).agg(
            F.sum("event_count").alias("event_count"), F.hll_union_agg("users").alias("users")
        )
    return counted.select(
        F.col("window.start").alias("window_start"),
        "event_count",
        F.hll_sketch_estimate("users").alias("about_unique_users"),
    )


def start_latest(windows: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Store every state of every window, also while it is open: a micro-batch writes the windows it has
    changed. Only windows of one width can be followed like this; those the watermark has passed leave
    the state as in append mode. A batch that is repeated replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def latest_windows(spark: SparkSession, out: str) -> DataFrame:
    """The last state of every window that :func:`start_latest` has stored."""
    states = spark.read.schema(
        "window_start timestamp, event_count long, about_unique_users long, batch long"
    ).parquet(out)
    last = F.max_by(F.struct("event_count", "about_unique_users"), "batch").alias("last")
    return states.groupBy("window_start").agg(last).select("window_start", "last.*")


def unreadable_times(edits: DataFrame) -> DataFrame:
    """The events that no window of :func:`event_rates` counts."""
    return edits.where(parse_time(F.col("dt_user")).isNull())


def first_in_stream(edits: DataFrame, key: str = "evt_id", late: str = "10 minutes") -> DataFrame:
    """The first row of every id; an id is remembered for as long as the watermark allows."""
    return with_event_time(edits, late).dropDuplicatesWithinWatermark([key])


def backlog(arrivals: DataFrame, departures: DataFrame) -> DataFrame:
    """Messages waiting per source at the end of every minute.

    Both inputs hold ``source`` and ``at``; a row is one message, or as many as its column ``messages``
    says. They are counted per minute before the running sum, so the window sorts minutes, not messages.
    """

    def number(rows: DataFrame) -> Column:
        return F.col("messages").cast("long") if "messages" in rows.columns else F.lit(1)

    came, went, none = number(arrivals), number(departures), F.lit(0)
    moves = arrivals.select("source", "at", came.alias("arrived"), none.alias("processed"))
    moves = moves.unionByName(
        departures.select("source", "at", none.alias("arrived"), went.alias("processed"))
    )
    minutes = moves.groupBy("source", F.date_trunc("MINUTE", "at").alias("minute")).agg(
        F.sum("arrived").alias("arrived"), F.sum("processed").alias("processed")
    )
    so_far = Window.partitionBy("source").orderBy("minute").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return minutes.withColumn("waiting", F.sum(F.col("arrived") - F.col("processed")).over(so_far))


def severity(
    waiting: Column,
    running_jobs: Column,
    high: int = HIGH_BACKLOG,
    medium: int = MEDIUM_BACKLOG,
    low: int = LOW_BACKLOG,
) -> Column:
    return (
        F.when(waiting > high, "HIGH")
        .when(waiting > medium, "MEDIUM")
        .when((waiting < low) & (running_jobs > 0), "LOW")
        .otherwise("NONE")
    )
