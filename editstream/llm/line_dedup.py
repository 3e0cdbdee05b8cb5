"""Line dedup with levelled sorted runs of line hashes."""

from __future__ import annotations

import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.common import packed, remove, same, stage, table, unpacked
from editstream.session import scratch_dir

BLANKS = " \t\n\x0b\x0c\r"
HASHES = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z, and only these, lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)
    letters = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(bare)).otherwise(letters)


class LineRuns:
    """Line hashes in sorted runs: tables bucketed and sorted by hash, on levels.

    Every hash is in one run only. A new batch is merge-joined with the runs: what they lack
    becomes a run of its own on level 0, what they hold is noted as ``repeats``. As soon as a level
    holds ``fan_out`` runs, they are rewritten as one run of the next level. Joins with a run need
    no shuffle of it.
    """

    def __init__(self, spark: SparkSession, fan_out: int = 2):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, DataFrame]]] = []
        self.repeats: list[DataFrame] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for _, run in level]

    def _written(self, df: DataFrame) -> tuple[str, DataFrame]:
        path, name = scratch_dir(self.spark, "line-run"), f"line_run_{uuid.uuid4().hex}"
        writer = df.write.bucketBy(self.buckets, *HASHES).sortBy(*HASHES)
        writer.option("path", path).saveAsTable(name)
        return path, self.spark.table(name)

    def add(self, batch: DataFrame) -> None:
        """``batch``: one row per hash, ``h1, h2, n``."""
        flagged = batch.withColumn("again", F.lit(False))
        for run in self.runs():
            held = run.select(*HASHES, F.lit(True).alias("held"))
            flagged = flagged.join(held, HASHES, "left").select(
                *HASHES, "n", (F.col("again") | F.col("held").isNotNull()).alias("again")
            )
        path = scratch_dir(self.spark, "line-batch")
        name = f"line_batch_{uuid.uuid4().hex}"
        (
            flagged.write.partitionBy("again")
            .bucketBy(self.buckets, *HASHES)
            .sortBy(*HASHES)
            .option("path", path)
            .saveAsTable(name)
        )
        rows = self.spark.table(name)
        self.repeats.append(rows.where("again").drop("again"))
        self._push(0, (None, rows.where("NOT again").drop("again")))

    def _push(self, level: int, run: tuple[str | None, DataFrame]) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_out:
            full, self.levels[level] = self.levels[level], []
            merged = reduce(DataFrame.union, [df for _, df in full])
            self._push(level + 1, self._written(merged.repartition(self.buckets, *HASHES)))
            for path, _ in full:
                if path:  # a run of level 0 lies beside the repeats of its batch
                    remove(self.spark, path)

    def counted(self, least: int) -> DataFrame:
        """Hashes met at least ``least`` times in all batches."""
        again = reduce(DataFrame.union, self.repeats)
        again = again.groupBy(*HASHES).agg(F.sum("n").alias("more"))
        found = [
            run.join(again, HASHES, "left")
            .where(F.col("n") + F.coalesce("more", F.lit(0)) >= least)
            .select(*HASHES)
            for run in self.runs()
        ]
        return reduce(DataFrame.union, found)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
) -> DataFrame:
    """Drop lines that many documents share, except in the document of the largest id.

    Returns one row per input row: ``row`` (all its columns), ``n_lines``, ``n_dropped`` and
    ``kept``, the remaining lines joined. Lines are told apart by 128 bits of hash of their key.
    Null texts count as empty and have one empty line. A null id is one document, smaller than all
    others. Rows that repeat an id count as one document; where it is the largest holder, all its
    rows keep the line. The documents arrive at the runs in ``batches`` parts by hash of the id.
    """
    spark = docs.sparkSession
    rows = packed(docs, id_col, text_col)
    every = rows.select(
        "doc",
        "print",
        F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int").alias("batch"),
        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"),
    ).where(F.char_length("line") >= min_chars)
    key = line_key(F.col("line"))
    lines = stage(
        every.where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= min_chars).select(
            "doc",
            "print",
            "pos",
            F.xxhash64(key).alias("h1"),
            F.xxhash64(F.lit(1), key).alias("h2"),
            "batch",
        ),
        "lines",
        by="batch",
    )
    index = LineRuns(spark)
    for batch in range(batches):
        part = lines.where(F.col("batch") == batch)
        index.add(part.groupBy(*HASHES).agg(F.count(F.lit(1)).alias("n")))

    hits = stage(lines.join(index.counted(min_docs), HASHES).drop("batch"), "line-hits")
    holders = (
        hits.select(*HASHES, "doc")
        .distinct()
        .groupBy(*HASHES)
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("top"))
        .where(F.col("n_docs") >= min_docs)
    )
    gone = (
        hits.join(holders, HASHES)
        .where(~same(F.col("doc"), F.col("top")))
        .groupBy("doc", "print")
        .agg(F.collect_set("pos").alias("gone"))
        .withColumnsRenamed({"doc": "gone_doc", "print": "gone_print"})
    )
    joined = rows.join(
        gone,
        same(F.col("doc"), F.col("gone_doc")) & (F.col("print") == F.col("gone_print")),
        "left",
    )
    split = F.split("text", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(
        F.transform(places, lambda i: F.get(F.col("lines"), i)), "\n"
    )
    return joined.select("row", "text", "gone", split.alias("lines")).select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"),
    )


def without_shared_lines(docs: DataFrame) -> DataFrame:
    """All columns of the documents, with the texts that are left; ``n_chars`` follows them."""
    done = dedup_lines(docs)
    changed = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept"))}
    if "n_chars" in docs.columns:
        length = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, length).otherwise(
            F.col("row.n_chars")
        )
    return unpacked(done, docs.columns, **changed)


SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)),
shared AS (
  SELECT k, max(doc_id) AS top FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.i, l.line, s.k IS NOT NULL AND l.doc_id <> s.top AS gone
  FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
