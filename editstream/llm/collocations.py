"""Collocations: Misra-Gries summaries find every frequent phrase, a second pass counts exactly."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editstream.llm.bpe import chunks
from editstream.llm.common import python_path, stage, table

BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST = 4
LEAST = 30
TOP = 2_000
SUBSUMED = 80
SCALE = 2_000_000
UNKNOWN = "und"

CHUNK_BYTES = 4_000_000
SLOT_BYTES = 8_000_000
MOST_SIEVE_BITS = 2**28

#: What a byte is: 0 part of a word, 1 a blank, 2 the end of a piece.
KIND = np.zeros(256, dtype=np.uint8)
KIND[list(BLANKS)] = 1
KIND[list(BREAKS)] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts of one language, as numbers, with their pieces."""

    def __init__(self, texts: list[bytes], lang: str):
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        kind = KIND[data]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        self.n = len(starts)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        letters = LOWER[data[inside]]
        words = pa.Array.from_buffers(
            pa.large_binary(), self.n, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        ).dictionary_encode()
        self.known = words.dictionary
        self.words = words.indices.to_numpy().astype(np.int64)
        self.pieces = np.cumsum(kind == 2)[starts]
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = [xxhash.xxh3_64_intdigest(w, seed) for w in self.known.to_pylist()]
        self.hashes = np.array(hashes, dtype=np.uint64)[self.words] if self.n else np.zeros(0, np.uint64)

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of words: where phrases of as many begin, and their hashes."""
        running = self.hashes
        for size in range(1, LONGEST + 1):
            if size > 1:
                running = mixed(running[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[size - 1 :])
            last = self.pieces[size - 1 :] if size > 1 else self.pieces
            at = np.flatnonzero(self.pieces[: len(last)] == last)
            yield size, at, running[at]

    def counted(self, size: int, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Distinct phrases of ``size`` words at these places, and how often each is there.

        Equal means equal in every word: pairs of word numbers, then pairs of pairs.
        """
        base = np.int64(max(len(self.known), 1))
        pair = lambda places: self.words[places] * base + self.words[places + 1]
        dense = lambda keys: np.unique(keys, return_inverse=True)[1].astype(np.int64)
        if size == 1:
            keys = self.words[at]
        elif size == 2:
            keys = pair(at)
        elif size == 3:
            keys = dense(pair(at)) * base + self.words[at + 2]
        else:
            keys = dense(pair(at)) * np.int64(len(at) + 1) + dense(pair(at + 2))
        _, first, counts = np.unique(keys, return_index=True, return_counts=True)
        parts = [pc.take(self.known, pa.array(self.words[at[first] + k])) for k in range(size)]
        joined = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        return joined.cast(pa.large_string()), counts


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    for batch in batches:
        for part in chunks(batch, "text", CHUNK_BYTES):
            groups: dict[str, list[bytes]] = {}
            texts = part.column("text").cast(pa.large_binary())
            for lang, text in zip(part.column("lang").to_pylist(), texts.to_pylist()):
                groups.setdefault(lang, []).append(text)
            for lang, found in groups.items():
                yield lang, Words(found, lang)


@dataclass(frozen=True)
class Slots:
    """Phrases are dealt into 2^``log_slots`` slots by hash; each owns ``bits`` bits of the sieve."""

    log_slots: int
    bits: int

    @classmethod
    def for_bytes(cls, size: int) -> Slots:
        slots = 1 << max(2, (size // SLOT_BYTES).bit_length())
        wanted = min(MOST_SIEVE_BITS, 1 << max(16, (size // 8).bit_length()))
        return cls(slots.bit_length() - 1, max(8, wanted // slots))

    @property
    def count(self) -> int:
        return 1 << self.log_slots

    def split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each hash, and a 32-bit key in it."""
        return hashes >> np.uint64(64 - self.log_slots), hashes & np.uint64(0xFFFFFFFF)

    def bit(self, keys: np.ndarray) -> np.ndarray:
        """The bit of a key within its slot."""
        return (keys * np.uint64(self.bits)) >> np.uint64(32)


class Summary:
    """A Misra-Gries summary of ``capacity`` counters that others are merged into.

    ``error`` is the most by which a counter, a missing one too, is below the truth: every cut takes
    as much from ``capacity`` + 1 counters, so it stays under mass / (capacity + 1).
    """

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, places = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        both = np.concatenate([self.counts, counts])
        self.counts = np.zeros(len(self.keys), np.int64)
        np.add.at(self.counts, places, both)
        if len(self.keys) > self.capacity:
            place = len(self.keys) - self.capacity - 1
            cut = int(np.partition(self.counts, place)[place])
            self.error += cut
            keep = self.counts > cut
            self.keys, self.counts = self.keys[keep], self.counts[keep] - cut

    def may_reach(self, least: int) -> np.ndarray:
        return self.keys[self.counts + self.error >= least]


def sieve(texts: DataFrame, slots: Slots, least: int) -> bytes:
    """A bit for every phrase that may occur ``least`` times, in its language.

    Every chunk of texts gives a summary per slot, still exact; those of a slot are merged in one
    with a capacity of its mass divided by ``least``. So no phrase of ``least`` occurrences is lost.
    Phrases that share a key only add to the bound. What is collected is the sieve alone, of at most
    ``MOST_SIEVE_BITS`` bits: on larger inputs it lets more through, which the exact count drops.
    """

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in by_language(batches):
            if not words.n:
                continue
            keys, counts = np.unique(
                np.concatenate([h for _, _, h in words.phrases()]), return_counts=True
            )
            places, short = slots.split(keys)
            begin = np.flatnonzero(np.diff(places, prepend=np.uint64(slots.count)))
            end = np.append(begin[1:], len(keys))
            short, counts = short.astype("<u4"), counts.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(places[begin].astype(np.int64)),
                    pa.array([short[i:j].tobytes() for i, j in zip(begin, end)], pa.binary()),
                    pa.array([counts[i:j].tobytes() for i, j in zip(begin, end)], pa.binary()),
                ],
                names=["slot", "keys", "counts"],
            )

    def merged(group: pa.Table) -> pa.Table:
        read = lambda c, t: [np.frombuffer(x, "<u4").astype(t) for x in group.column(c).to_pylist()]
        keys, counts = read("keys", np.uint64), read("counts", np.int64)
        summary = Summary(sum(int(c.sum()) for c in counts) // least)
        begin = held = 0
        for i, part in enumerate(keys):
            held += len(part)
            if held > summary.capacity or i == len(keys) - 1:
                summary.merge(np.concatenate(keys[begin : i + 1]), np.concatenate(counts[begin : i + 1]))
                begin, held = i + 1, 0
        bits = np.zeros(-(-slots.bits // 8) * 8, dtype=bool)
        bits[slots.bit(summary.may_reach(least))] = True
        return pa.table({"slot": group.column("slot")[:1], "bits": pa.array([np.packbits(bits).tobytes()])})

    parts = texts.mapInArrow(summaries, "slot long, keys binary, counts binary")
    found = parts.groupBy("slot").applyInArrow(merged, "slot long, bits binary")
    size = -(-slots.bits // 8)
    out = bytearray(size * slots.count)
    for row in found.collect():
        out[row.slot * size : (row.slot + 1) * size] = row.bits
    return bytes(out)


def frequent(docs: DataFrame, text_col: str, lang_col: str, least: int) -> DataFrame:
    """``lang, size, phrase, f``: phrases of 1 to 4 words that occur ``least`` times, with exact
    counts; and a row of ``size`` 0 per language with the number of its words."""
    spark = docs.sparkSession
    python_path(spark)
    texts = docs.select(
        F.coalesce(docs[lang_col], F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    slots = Slots.for_bytes(total)
    shared = spark.sparkContext.broadcast(sieve(texts, slots, least))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8).reshape(slots.count, -1)
        for lang, words in by_language(batches):
            sizes, phrases, counts = [[0]], [pa.array([""], pa.large_string())], [[words.n]]
            for size, at, hashes in words.phrases():
                slot, keys = slots.split(hashes)
                bit = slots.bit(keys).astype(np.int64)
                held = bits[slot.astype(np.int64), bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1
                found, often = words.counted(size, at[held == 1])
                sizes.append([size] * len(found))
                phrases.append(found)
                counts.append(often)
            for part, size, often in zip(phrases, sizes, counts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array(size, pa.int32()),
                        part.cast(pa.string()),
                        pa.array(often, pa.int64()),
                    ],
                    names=["lang", "size", "phrase", "n"],
                )

    counted = texts.mapInArrow(exact, "lang string, size int, phrase string, n long")
    grouped = counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))
    return grouped.where((F.col("size") == 0) | (F.col("f") >= least))


def whole(c: str) -> F.Column:
    """Decimals of 29 digits: their products with the factors used here stay exact."""
    return F.col(c).cast("decimal(29,0)")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    subsumed: int = SUBSUMED,
) -> DataFrame:
    """All phrases of 2 to 4 words with ``least`` occurrences in a language, scored.

    A phrase lies within a piece of text between punctuation or line ends; only A-Z are lower-cased. ``a``
    counts it, ``l`` and ``r`` the parts of its worst cut, ``score`` is ``2000000 * a / (l + r)``,
    rounded down, ``n`` the language's words. A phrase goes if a longer one that holds it
    has at least ``subsumed`` percent of its occurrences.

    A null text is empty, a null language is ``und``; repeated rows count as often as they are there.
    Other columns do not matter. No rows give no phrases. Long texts are read whole, a row at a time.
    """
    rows = stage(frequent(docs, text_col, lang_col, least), "phrases")
    totals = rows.where("size = 0").select("lang", F.col("f").alias("n"))
    phrases = rows.where("size > 0").select("lang", "size", "phrase", "f")
    split = phrases.where("size > 1").withColumn("words", F.split("phrase", " "))
    within = lambda at, count: F.array_join(F.slice("words", at, count), " ")

    cuts = split.select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "size",
        "words",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"),
    ).select(
        "lang",
        "phrase",
        "a",
        "cut",
        within(F.lit(1), F.col("cut")).alias("first"),
        within(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"),
    )
    lefts = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr(
        f"cast(cast(a as decimal(29,0)) * {SCALE}BD div (cast(l as decimal(29,0)) + cast(r as decimal(29,0))) as long)"
    )
    worst = (
        cuts.join(lefts, ["lang", "first"])
        .join(rights, ["lang", "rest"])
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct(score.alias("score"), "cut", "a", "l", "r")).alias("w"))
    )

    longer = split.where("size > 2").select(
        "lang", "f", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k")
    )
    inner = (
        longer.select(
            "lang", "f", "words", "k", F.explode(F.expr("sequence(1, size - k + 1)")).alias("at")
        )
        .groupBy("lang", within(F.col("at"), F.col("k")).alias("phrase"))
        .agg(F.max("f").alias("outer"))
    )
    taken = whole("outer") * F.lit(100) >= whole("w.a") * F.lit(subsumed)
    return (
        worst.join(inner, ["lang", "phrase"], "left")
        .where(F.col("outer").isNull() | ~taken)
        .join(totals, "lang")
        .select("lang", "phrase", "w.a", "w.l", "w.r", "n", "w.score")
    )


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first of every language, by score, occurrences, and the phrase's bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked(collocations(table(spark, sf_dir, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM words, (SELECT unnest([1, 2, 3, 4]) AS k))
), counted AS MATERIALIZED (
    SELECT lang, k, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}
), split AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE k > 1
), cuts AS (
    SELECT lang, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS first,
        array_to_string(w[c + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS c FROM split)
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r,
        ({SCALE}::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
    FROM cuts
    JOIN counted x ON x.lang = cuts.lang AND x.phrase = first
    JOIN counted y ON y.lang = cuts.lang AND y.phrase = rest
), worst AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_ones AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS f
    FROM (SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i
          FROM (SELECT *, unnest(range(2, k)) AS m FROM split))
    GROUP BY ALL
)
SELECT worst.lang, row_number() OVER (
        PARTITION BY worst.lang ORDER BY score DESC, a DESC, worst.phrase) AS rank,
    worst.phrase, a, l, r, n, score
FROM worst
JOIN totals USING (lang)
LEFT JOIN inner_ones i ON i.lang = worst.lang AND i.phrase = worst.phrase
WHERE i.f IS NULL OR 100::HUGEINT * i.f < {SUBSUMED}::HUGEINT * a
QUALIFY rank <= {TOP}
"""
