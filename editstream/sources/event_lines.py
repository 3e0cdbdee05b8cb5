"""Raw event text: event-stream files, message payloads and JSON lines, batch or streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed value: the prefix of a payload line in an event stream ---
DATA_PREFIX = "data: "


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the files landing in a folder, a bounded number of files per micro-batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_messages(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """Message payloads from a queue, as raw bytes in ``value``; needs the Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select("value", "timestamp")


def payload_lines(lines: DataFrame) -> DataFrame:
    """The non-empty payloads of ``data: `` lines."""
    value = F.col("value")
    return lines.where(
        value.startswith(DATA_PREFIX) & (F.length(value) > len(DATA_PREFIX))
    ).withColumn("value", F.substr(value, F.lit(len(DATA_PREFIX) + 1)))


def as_message(df: DataFrame) -> DataFrame:
    """Every row as one JSON payload in ``value``, ready for a file or queue sink."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def decoded_text(value: Column) -> Column:
    """Payload bytes or text as text; NULL where it is not UTF-8."""
    text = value.cast("string")
    return F.when(F.is_valid_utf8(text), text)
