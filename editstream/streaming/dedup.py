"""De-duplication of a stream beyond its watermark, against an index of the ids seen so far."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editstream.operators.audit import FIRST_ORDER, first_per_id
from editstream.session import staged
from editstream.sources.id_index import IdIndex

MOST_RUNS = 50
#: Of the numbers of rows that are broadcast; beyond it the rows are shuffled.
MOST_BROADCAST = 1_000_000


def unseen(
    batch: DataFrame, index: IdIndex, run: str, key: str = "evt_id", order: list[str] | None = None
) -> DataFrame:
    """The first row of every id of a batch that no other run has brought, and rows without an id.

    The batch is shuffled to the buckets of the index, which stays where it is.
    """
    first = first_per_id(batch, key, order)
    seen = index.rows().where(F.col("run") != run).select("id")
    return first.join(seen, first[key] == seen["id"], "left_anti")


@contextmanager
def _staged_unseen(arrived: DataFrame, index: IdIndex, run: str, key: str) -> Iterator[DataFrame]:
    """:func:`unseen` of staged rows with their number in ``_row`` and a digest of each in ``_whole``."""
    narrow = arrived.select(*dict.fromkeys([key, *FIRST_ORDER, "_whole", "_row"]))
    found = unseen(narrow, index, run, key, [*FIRST_ORDER, "_whole"]).select("_row")
    with staged(found, "unseen") as new:
        others = arrived.select("_row").join(new, "_row", "left_anti")
        with staged(others, "seen") as old:
            if old.count() <= MOST_BROADCAST:
                yield arrived.join(F.broadcast(old), "_row", "left_anti")
            elif new.count() <= MOST_BROADCAST:
                yield arrived.join(F.broadcast(new), "_row", "left_semi")
            else:
                yield arrived.join(old, "_row", "left_anti")


def keep_first(
    batch: DataFrame,
    index: IdIndex,
    run: str,
    write: Callable[[DataFrame, str], None],
    key: str = "evt_id",
    keep_days: int | None = None,
    today: date | None = None,
) -> None:
    """Write the unseen rows of a batch and remember their ids.

    The rows are written before their ids are remembered, and a run does not see its own ids: a
    run that is repeated writes the same rows, in place of the ones before if ``write`` replaces what
    the run wrote. Ids of more than ``keep_days`` days ago are forgotten, by default none. The
    runs of a day are merged now and then, so that the index has few files.

    The batch is staged. Which of its rows are unseen is found from its ids and what orders them, so
    whole rows are neither kept in memory nor shuffled, but for a batch that has many seen and many unseen ones.
    """
    today = today or date.today()
    numbered = batch.withColumns(
        {"_row": F.monotonically_increasing_id(), "_whole": F.xxhash64(*batch.columns)}
    )
    with staged(numbered, "arrived") as arrived, _staged_unseen(arrived, index, run, key) as rows:
        rows = rows.select(batch.columns)
        write(rows, run)
        index.drop(run=run)
        ids = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("id"))
        index.add(ids.withColumn("label", F.lit(str(today))), run)
    for label, runs in index.labels().items():
        if keep_days is not None and label < str(today - timedelta(days=keep_days)):
            index.drop(label=label)
        elif runs > MOST_RUNS and label < str(today):
            index.merge(label, f"merged-{label}")


def start_dedup(
    edits: DataFrame,
    folder: str,
    checkpoint: str,
    name: str,
    write: Callable[[DataFrame, str], None],
    key: str = "evt_id",
    keep_days: int | None = None,
    buckets: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Pass on the first row of every id of a stream, however late its copies come.

    ``folder`` holds the index of ids; ``write(rows, run)`` stores the rows of a micro-batch. There is no
    state in the stream itself, so nothing is lost or passed twice by a restart.
    """
    spark = edits.sparkSession

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        index = IdIndex(spark, folder, buckets)
        keep_first(batch, index, f"{name}-{batch_id}", write, key, keep_days)

    return (
        edits.writeStream.queryName(name)
        .foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
