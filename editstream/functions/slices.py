"""Ordered rows cut into slices of like size, for what depends on all rows before a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_slices(df: DataFrame, order: list[str], slice_rows: int) -> DataFrame:
    """The rows of ``df`` with ``slice`` and ``place``, both ascending in the given order.

    A range partitioning cuts the order into slices of about ``slice_rows`` rows, whatever the
    values are; rows that agree in all of ``order`` share a slice. ``place`` counts up by one within a
    slice. The borders come from a sample: stage the rows before they are read twice.
    """
    slices = max(1, -(-df.count() // slice_rows))
    rows = df.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    return rows.withColumns(
        {"slice": F.spark_partition_id().cast("long"), "place": F.monotonically_increasing_id()}
    )
