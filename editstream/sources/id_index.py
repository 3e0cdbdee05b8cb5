"""Ids in a bucketed table, so that joins with it leave it where it lies."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.sources import snapshots


class IdIndex:
    """``id, label, run`` under a folder: partitioned by label and run, bucketed and sorted by id.

    It is a table of the catalog over that folder, made on first use in a session. ``buckets`` counts
    for a new index only, by default as many as shuffle partitions are set: take enough for the ids
    that will once be there. The number is part of the folder's name.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, folder = spark, folder.rstrip("/")
        found = snapshots.listed(spark, f"{folder}/buckets=*")
        if found:
            buckets = int(found[0].getPath().getName().split("=")[1])
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = f"{folder}/buckets={self.buckets}"
        self.name = f"ids_{hashlib.md5(self.path.encode()).hexdigest()}"
        if not spark.catalog.tableExists(self.name):
            snapshots.make_folder(spark, self.path)
            location = self.path.replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE {self.name} (id STRING, label STRING, run STRING) USING parquet "
                "PARTITIONED BY (label, run) "
                f"CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS LOCATION '{location}'"
            )
            self._found_anew()

    def _found_anew(self) -> None:
        """Tell a catalog that keeps partitions of its own what the folder holds."""
        if self.spark.conf.get("spark.sql.catalogImplementation") == "hive":
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, ids: DataFrame, run: str) -> None:
        """Add ``id, label`` rows as one run."""
        rows = ids.select(F.col("id").cast("string"), F.col("label").cast("string"), F.lit(run).alias("run"))
        rows.repartition(self.buckets, "id").write.insertInto(self.name)

    def drop(self, label: str = "*", run: str = "*") -> int:
        """Delete the runs of a label that match the patterns; how many there were."""
        found = snapshots.listed(self.spark, f"{self.path}/label={label}/run={run}")
        for status in found:
            snapshots.delete(self.spark, status.getPath().toString())
        self._found_anew()
        return len(found)

    def merge(self, label: str, run: str) -> None:
        """Rewrite the runs of a label as one. In between ids are there twice, which does no harm."""
        old = snapshots.listed(self.spark, f"{self.path}/label={label}/run=*")
        self.add(self.rows().where(F.col("label") == label).select("id", "label").distinct(), run)
        for status in old:
            snapshots.delete(self.spark, status.getPath().toString())
        self._found_anew()

    def labels(self) -> dict[str, int]:
        """Labels and how many runs they have."""
        out: dict[str, int] = {}
        for status in snapshots.listed(self.spark, f"{self.path}/label=*/run=*"):
            label = status.getPath().getParent().getName().removeprefix("label=")
            out[label] = out.get(label, 0) + 1
        return out
