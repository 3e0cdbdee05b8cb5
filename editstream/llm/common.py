"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from editstream.session import scratch_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write the rows once to the shared scratch folder and read them from there."""
    path = scratch_dir(df.sparkSession, name)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def thinned(df: DataFrame, rows: int, *by: str) -> list[Row]:
    """About ``rows`` rows on average, or all of fewer, picked by hash of the columns ``by``; twice
    as many at most, so that the driver can hold them. ``df`` is read twice: stage it if it is dear."""
    step = -(-df.count() // rows)
    picked = df.where(F.pmod(F.xxhash64(*by), F.lit(max(step, 1))) == 0)
    return picked.limit(2 * rows).collect()


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def python_path(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package whatever their folder.

    On a cluster the package travels with ``--py-files``.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns as they came), ``doc``, ``text`` (null read as empty) and ``print``,
    a hash of the text. Columns of any name can come along inside ``row``."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[id_col].alias("doc"),
        text.alias("text"),
        F.xxhash64(text).alias("print"),
    )


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row`` again, some of them replaced."""
    return df.select(
        *[changed.get(c, df["row"].getField(c)).alias(c) for c in columns]
    )
