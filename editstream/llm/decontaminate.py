"""Benchmark decontamination with spaced seeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.common import packed, same, stage, table, unpacked

BLOCK = 3
# The masks: two blocks of three tokens, so far apart; the tokens between them are ignored.
DISTANCES = (3, 6, 9, 12, 15)
WINDOW = 20
SHARE = 0.8
SHORT, LEAST = 12, 6
DELIMITERS = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """Hashes of the text's words: runs of letters and digits, lower-cased."""
    words = F.filter(F.split(F.lower(text), DELIMITERS, -1), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def block_hash(tokens: Column, at: Column) -> list[Column]:
    return [F.get(tokens, at + i) for i in range(BLOCK)]


def seeds(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per mask and token position of ``tokens``: ``at`` and the ``seed`` hash there.

    Masks that would reach past the end give no row.
    """
    size = F.size("tokens")
    shapes = [
        F.when(
            F.col("at") + distance + BLOCK <= size,
            F.xxhash64(
                F.lit(distance),
                *block_hash(F.col("tokens"), F.col("at")),
                *block_hash(F.col("tokens"), F.col("at") + distance),
            ),
        )
        for distance in DISTANCES
    ]
    return (
        rows.where(size >= 2 * BLOCK)
        .select(
            *keep,
            "tokens",
            F.explode(F.sequence(F.lit(0), size - 2 * BLOCK)).alias("at"),
        )
        .select(*keep, "tokens", "at", F.explode(F.array(*shapes)).alias("seed"))
        .where(F.col("seed").isNotNull())
    )


def window_best(equal: Column, length: Column) -> Column:
    """The most equal tokens in any ``length`` neighbours of ``equal`` (0 and 1)."""
    starts = F.sequence(F.lit(0), F.size(equal) - length)
    sums = F.transform(
        starts,
        lambda i: F.aggregate(F.slice(equal, i + 1, length), F.lit(0), lambda a, b: a + b),
    )
    return F.array_max(sums)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_seeds: int = 1_000_000,
) -> DataFrame:
    """Documents that hold a passage of a benchmark item, words changed in it included.

    A document holds an item if, laid side by side without gaps, 20 neighbouring words agree in at
    least 16; for an item of 12 to 19 words, the whole item in at least four fifths; one of 6 to 11
    words must be there unchanged. Shorter items say too little to prove a leak and have no hits.

    Such a window has at most 4 changed words. Of its six blocks of three words, two at least are
    unchanged (of the four or five blocks of a shorter item, likewise), so one of the masks hits.
    The benchmark's seeds are dealt by hash into parts of about ``block_seeds``, the proven bound of
    what is broadcast; the documents are read once per part. Hits of one alignment are merged before
    they are shuffled, so a passage that fills a document counts once.

    Returns ``doc, print, item, equal`` (most equal words of a window) and ``length`` of the window,
    one row per document text and item text. Null and empty texts have no words and no rows. Items of
    equal id and text count once.
    """
    items = (
        benchmark.select(
            benchmark[item_col].alias("item"), token_hashes(benchmark[item_text_col]).alias("tokens")
        )
        .where(F.size("tokens") >= LEAST)
        .distinct()
        .withColumn("item_print", F.xxhash64("tokens"))
    )
    item_seeds = stage(
        seeds(items, "item", "item_print").select(
            "item", "item_print", "seed", F.col("at").alias("item_at"), F.size("tokens").alias("n")
        ),
        "benchmark-seeds",
    )
    parts = item_seeds.count() // block_seeds + 1

    words = docs.select(
        docs[id_col].alias("doc"),
        F.xxhash64(docs[text_col]).alias("print"),
        token_hashes(docs[text_col]).alias("tokens"),
    )
    places = seeds(words, "doc", "print")
    shift = F.col("at") - F.col("item_at")
    first = F.greatest(shift, F.lit(0))
    # The document's words beside the item, as far as it has them.
    beside = F.slice(
        "tokens", first + 1, F.least(shift + F.col("n"), F.size("tokens")) - first
    )
    found = [
        places.join(
            F.broadcast(
                item_seeds.where(F.pmod("seed", F.lit(parts)) == part) if parts > 1 else item_seeds
            ),
            "seed",
        ).select("doc", "print", "item", "item_print", shift.alias("shift"), beside.alias("beside"))
        for part in range(parts)
    ]
    aligned = reduce(DataFrame.union, found).distinct().join(
        items.withColumnsRenamed({"item": "item_2", "item_print": "item_print_2", "tokens": "item_tokens"}),
        same(F.col("item"), F.col("item_2")) & (F.col("item_print") == F.col("item_print_2")),
    )
    over = F.greatest(-F.col("shift"), F.lit(0))
    equal = F.zip_with(
        "beside",
        F.slice("item_tokens", over + 1, F.size("beside")),
        lambda a, b: F.when(a == b, 1).otherwise(0),
    )
    size = F.size("item_tokens")
    length = F.least(size, F.lit(WINDOW))
    needed = F.when(size < SHORT, size).otherwise(F.ceil(length * F.lit(SHARE)))
    return (
        aligned.select("doc", "print", "item", "item_print", equal.alias("equal"), length.alias("length"), needed.alias("needed"))
        .where(F.size("equal") >= F.col("length"))
        .withColumn("equal", window_best(F.col("equal"), F.col("length")))
        .where(F.col("equal") >= F.col("needed"))
        .groupBy("doc", "print", "item", "item_print")
        .agg(F.max("equal").alias("equal"), F.first("length").alias("length"))
        .drop("item_print")
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max("equal").cast("long").alias("equal_words"), F.max("length").cast("long").alias("window_words")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of the documents that hold no benchmark item."""
    found = leaks(docs, benchmark).select(
        F.col("doc").alias("bad_doc"), F.col("print").alias("bad_print")
    ).distinct()
    rows = packed(docs, "doc_id", "text")
    clean = rows.join(
        found, same(F.col("doc"), F.col("bad_doc")) & (F.col("print") == F.col("bad_print")), "left_anti"
    )
    return unpacked(clean, docs.columns)


SQL = r"""
WITH doc_words AS (
  SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM (SELECT doc_id, unnest(s) AS w, generate_subscripts(s, 1) AS i
        FROM (SELECT doc_id, string_split_regex(lower(text), '[^\p{L}\p{N}]+') AS s FROM documents))
  WHERE w <> ''),
item_words AS (
  SELECT item_id, w, row_number() OVER (PARTITION BY item_id ORDER BY i) AS p,
         count(*) OVER (PARTITION BY item_id) AS n
  FROM (SELECT item_id, unnest(s) AS w, generate_subscripts(s, 1) AS i
        FROM (SELECT item_id, string_split_regex(lower(text), '[^\p{L}\p{N}]+') AS s FROM benchmark))
  WHERE w <> ''),
equal_words AS (
  SELECT doc_id, item_id, d.p - i.p AS shift, i.p AS p, i.n AS n
  FROM doc_words d JOIN item_words i ON d.w = i.w WHERE n >= 6),
likely AS (
  SELECT doc_id, item_id, shift, any_value(n) AS n FROM equal_words
  GROUP BY ALL HAVING count(*) >= CASE WHEN any_value(n) < 12 THEN any_value(n) ELSE ceil(least(any_value(n), 20) * 0.8) END),
doc_sizes AS (SELECT doc_id, max(p) AS size FROM doc_words GROUP BY doc_id),
starts AS (
  SELECT doc_id, item_id, shift, n, least(n, 20) AS length, unnest(range(1, (n - least(n, 20) + 2)::BIGINT)) AS s FROM likely),
sums AS (
  SELECT s.doc_id, s.item_id, s.shift, s.s, any_value(s.n) AS n, any_value(s.length) AS length, count(*) AS equal
  FROM starts s JOIN doc_sizes z ON s.doc_id = z.doc_id
  JOIN equal_words e ON e.doc_id = s.doc_id AND e.item_id = s.item_id AND e.shift = s.shift
    AND e.p >= s.s AND e.p < s.s + s.length
  WHERE s.s + s.shift >= 1 AND s.s + s.shift + s.length - 1 <= z.size
  GROUP BY s.doc_id, s.item_id, s.shift, s.s)
SELECT doc_id, item_id, max(equal) AS equal_words, max(length)::BIGINT AS window_words
FROM sums WHERE equal >= CASE WHEN n < 12 THEN n ELSE ceil(length * 0.8) END
GROUP BY doc_id, item_id
"""
