"""Books of thousands of phrases: an index of byte sequences instead of a search per phrase."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editstream.functions.columns import compute_once, present_only
from editstream.functions.rules import holds_phrase
from editstream.session import kept

GRAM_BYTES = 6
STRIDE = 8
PIECE_BYTES = 128
SAMPLE_STEP = 64
MOST_BROADCAST = 100_000
FEW_SHORT = 100


def with_grams(rows: DataFrame, text: str, size: int, step: int = 1) -> DataFrame:
    """A row per byte sequence of that size at every ``step``-th byte of the text, with its hash in ``gram``
    and its place in ``at``.

    Cut in two steps, pieces that overlap and then the sequences of each, so that no array is longer than
    a piece or the number of pieces. There is no lambda in it, so all of it is compiled.
    """
    columns, last = rows.columns, F.octet_length("octets") - size
    rows = compute_once(rows.where(F.octet_length(text) >= size), octets=F.col(text).cast("binary"))
    rows = rows.withColumn("start", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE_BYTES))))
    piece = F.substring("octets", F.col("start") + 1, F.lit(PIECE_BYTES + size - 1))
    rows = compute_once(rows.select(*columns, "start", "octets"), piece=piece).drop("octets")
    ends = F.octet_length("piece") - size + 1
    rows = rows.select(*columns, "start", "piece", F.explode(F.sequence(F.lit(1), ends, F.lit(step))).alias("begin"))
    gram = F.xxhash64(F.substring("piece", F.col("begin"), F.lit(size)))
    return rows.select(*columns, (F.col("start") + F.col("begin") - 1).alias("at"), gram.alias("gram"))


def phrase_index(rows: DataFrame, book: DataFrame, text: str, size: int, step: int = 1) -> DataFrame:
    """``gram, category, phrase``: each phrase under a sequence that is rare in a part of the texts.

    With a ``step`` only the sequence at every ``step``-th byte of a text is looked up, so a phrase comes under one
    for each of the ``step`` ways in which it can lie to these places. Which one that is only matters for
    speed, so one of ``SAMPLE_STEP`` texts is enough to tell.
    """
    phrases = book.select("category", "phrase")
    all_grams = with_grams(phrases, "phrase", size).withColumn("way", F.col("at") % step)
    some = rows.where(F.pmod(F.xxhash64(text), F.lit(SAMPLE_STEP)) == 0)
    seen = with_grams(some.select(text), text, size).select("gram")
    counts = (
        seen.join(all_grams.select("gram").distinct(), "gram", "left_semi")
        .groupBy("gram")
        .agg(F.count("*").alias("n"))
    )
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))["gram"]
    return (
        all_grams.join(counts, "gram", "left")
        .groupBy("category", "phrase", "way")
        .agg(rarest.alias("gram"))
        .select("gram", "category", "phrase")
        .distinct()
    )


def phrase_hits(
    rows: DataFrame, book: DataFrame, key: str = "evt_id", text: str = "folded_text"
) -> DataFrame:
    """``key, category`` of every text that contains a phrase of the category, each pair once.

    ``book`` has ``category, phrase``; phrases are looked up as they are, so give them in lower case for
    folded texts. Every text is cut into byte sequences once; they meet the index in a join, in
    the same stage if the index is small enough to be broadcast, and what meets is verified. The cost
    follows the texts and the hits, not the number of phrases. For phrases of ``GRAM_BYTES + STRIDE - 1``
    bytes or more, a sequence at every ``STRIDE``-th byte is enough. Phrases shorter than ``GRAM_BYTES`` are
    searched one by one while they are at most ``FEW_SHORT``, else by sequences of their own length.
    Null keys, texts and phrases give no hit, nor does an empty phrase.
    """
    rows = rows.select(key, text).where(F.col(key).isNotNull() & F.col(text).isNotNull())
    count = F.octet_length("phrase")
    step = F.when(count >= GRAM_BYTES + STRIDE - 1, STRIDE).otherwise(1)
    sized = book.select("category", "phrase", F.least(count, F.lit(GRAM_BYTES)).alias("size"), step.alias("step"))
    sized = kept(sized.where("size > 0").distinct(), "phrases")
    found = []
    short = sized.where(F.col("size") < GRAM_BYTES).limit(FEW_SHORT + 1).collect()
    if 0 < len(short) <= FEW_SHORT:
        hits = [F.when(holds_phrase(F.col(text), r["phrase"]), F.lit(r["category"])) for r in short]
        found.append(rows.select(key, F.explode(F.array_distinct(present_only(hits))).alias("category")))
        sized = sized.where(F.col("size") == GRAM_BYTES)
    # With steps the index is that much larger; a book that fits a broadcast only without them goes without.
    if MOST_BROADCAST < sized.where(F.col("step") > 1).count() * STRIDE <= MOST_BROADCAST * STRIDE:
        sized = sized.withColumn("step", F.lit(1))
    for size, step in sorted(map(tuple, sized.select("size", "step").distinct().collect())):
        part = sized.where((F.col("size") == size) & (F.col("step") == step))
        index = kept(phrase_index(rows, part, text, size, step), "phrase-index")
        if index.count() <= MOST_BROADCAST:
            index = F.broadcast(index)
        met = with_grams(rows, text, size, step).join(index, "gram")
        found.append(met.where(F.contains(F.col(text), F.col("phrase"))).select(key, "category"))
    if not found:
        empty = rows.select(key, F.lit("").alias("category"))
        return empty.where("false")
    return reduce(DataFrame.union, found).distinct()
