"""Removal of repeated byte strings by sorting suffixes in range-partitioned buckets."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.bpe import chunks
from editstream.llm.common import python_path, same, stage, table, thinned

LENGTH = 400
GRAM = 8
BUCKET_ROWS = 50_000
HOT_ROWS = 50_000
SPLITTERS = 10_000
CHUNK_BYTES = 8_000_000
TEXT = ["t1", "t2"]
U64 = np.uint64


def window_of(length: int) -> int:
    """Places in which a string's anchor is sought: four fifths of its length, so that the anchor
    and at least a fifth of the string stay to its right."""
    return length * 4 // 5


def gram_hashes(data: bytes, count: int) -> np.ndarray:
    grams = np.ndarray((count,), dtype="<u8", buffer=data, strides=(1,))
    x = grams * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def anchors(data: bytes, length: int) -> list[tuple[int, int, int]]:
    """``(place, most, least)``: the suffixes that stand for all strings of ``length`` bytes.

    The anchor of the string at p is the place of the smallest hash of 8 bytes among its first
    ``window_of(length)`` places, the leftmost of equal ones; it depends on the string alone. An
    anchor at ``place`` is that of the strings that start ``least`` to ``most`` bytes before it.
    """
    window, strings = window_of(length), len(data) - length + 1
    if strings <= 0:
        return []
    places = strings + window - 1
    keys = (gram_hashes(data, places) & U64(0xFFFFFFFF00000000)) | np.arange(places, dtype=U64)
    # Minima of all windows, from minima towards both sides of every window-th place.
    padded = np.full(-(-places // window) * window, ~U64(0))
    padded[:places] = keys
    blocks = padded.reshape(-1, window)
    after = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    before = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(before[:strings], after[window - 1 : window - 1 + strings])
    at = (least & U64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [strings]]) - 1
    found = at[first]
    return list(zip(found.tolist(), (found - first).tolist(), (found - last).tolist()))


def sorted_words(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows of big-endian words: the order, and the number of leading bytes
    that each row shares with the one before it in that order.

    All groups of rows that agree so far are sorted by their next word, at once; those that then
    differ from their neighbours leave.
    """
    n, width = words.shape
    order = np.arange(n)
    shared = np.zeros(n, dtype=np.int64)
    shared[:1] = 0
    group = np.zeros(n, dtype=np.int64)  # of each place in the order
    open_places = np.arange(n) if n > 1 else np.zeros(0, dtype=np.int64)
    for depth in range(width):
        if not len(open_places):
            break
        rows = order[open_places]
        column = words[rows, depth]
        by = np.lexsort((column, group[open_places]))
        order[open_places] = rows[by]
        column = column[by]
        groups = group[open_places]
        new_group = np.concatenate([[True], groups[1:] != groups[:-1]])
        differs = np.concatenate([[False], column[1:] != column[:-1]]) & ~new_group
        places = np.flatnonzero(differs)
        if len(places):
            other = column[places] ^ column[places - 1]
            # Leading equal bytes of two words: from the highest bit that differs.
            high = np.frexp((other >> U64(8)).astype(np.float64) * 256.0 + 1)[1]
            high = np.where(other >> U64(8) == 0, 8, high)
            shared[open_places[places]] = depth * 8 + (64 - high) // 8
        starts = new_group | differs
        ids = np.cumsum(starts)
        group[open_places] = open_places[np.flatnonzero(starts)][ids - 1]
        sizes = np.bincount(ids)[ids]
        # A place whose row agrees with the one before, in all words so far.
        shared[open_places[~starts]] = (depth + 1) * 8
        open_places = open_places[sizes > 1]
    return order, shared


def as_words(parts: list[bytes], size: int) -> np.ndarray:
    width = -(-size // 8) * 8
    return (
        np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=">u8")
        .reshape(len(parts), width // 8)
        .astype(U64)
    )


def classes(order: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Equal numbers for rows that share ``least`` leading bytes."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(shared < least)
    return out


def repeated_starts(
    left: list[bytes], right: list[bytes], most: np.ndarray, least: np.ndarray, length: int
) -> list[list[tuple[int, int]]]:
    """For each anchor the ranges of offsets whose string occurs at another anchor, too.

    ``left`` is the text before the anchor, backwards, ``right`` the text from it on. The string
    that starts ``o`` bytes before the anchor is ``o`` bytes of the one and ``length - o`` of the
    other; both are sorted as suffixes, so who shares them follows from common prefixes of neighbours.
    """
    right_order = sorted_words(as_words(right, length))
    left_order = sorted_words(as_words(left, length))
    out: list[list[tuple[int, int]]] = [[] for _ in left]
    open_at = np.full(len(left), -1)
    n = len(left) + 1
    for o in range(int(least.min()), int(most.max()) + 2):
        hit = np.zeros(len(left), dtype=bool)
        rows = np.flatnonzero((least <= o) & (o <= most))
        if len(rows):
            both = classes(*right_order, length - o)[rows] * n + classes(*left_order, o)[rows]
            _, at, sizes = np.unique(both, return_inverse=True, return_counts=True)
            hit[rows] = sizes[at] > 1
        for i in np.flatnonzero(hit & (open_at < 0)):
            open_at[i] = o
        for i in np.flatnonzero(~hit & (open_at >= 0)):
            out[i].append((int(open_at[i]), o - 1))
            open_at[i] = -1
    return out


def lead_of(data: bytes, at: int) -> int:
    return int.from_bytes(data[at : at + 8], "big") - (1 << 63)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


ANCHOR = "struct<pos:long,most:int,least:int,head:long,whole:long>"


def anchored(texts: DataFrame, length: int) -> DataFrame:
    """``t1, t2, doc, anchors, sample``. Of each anchor: ``head``, a hash of the bytes that all its
    strings have to the right, and ``whole``, of all that its strings cover. ``sample`` are leading
    bytes and head of one anchor in 16, for the splitters."""
    kind = texts.schema["doc"].dataType.simpleString()
    head = length - window_of(length) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                rows, samples = [], []
                for text in part.column("text"):
                    data = text.as_buffer().to_pybytes()
                    found, sample = [], []
                    for pos, most, least in anchors(data, length):
                        h = xxhash.xxh3_64_intdigest(data[pos : pos + head])
                        cover = data[pos - most : pos + length - least]
                        w = xxhash.xxh3_64_intdigest(cover, seed=most)
                        found.append((pos, most, least, signed(h), signed(w)))
                        if h % 16 == 0:
                            sample.append((lead_of(data, pos), signed(h)))
                    rows.append(found)
                    samples.append(sample)
                names = ["pos", "most", "least", "head", "whole"]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in (*TEXT, "doc")],
                        listed(rows, names, kinds),
                        listed(samples, ["lead", "head"], [pa.int64()] * 2),
                    ],
                    names=[*TEXT, "doc", "anchors", "sample"],
                )

    def listed(rows: list[list[tuple]], names: list[str], kinds: list[pa.DataType]) -> pa.Array:
        flat = list(zip(*[x for r in rows for x in r])) or [()] * len(names)
        values = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(flat, kinds)], names)
        return pa.ListArray.from_arrays(np.cumsum([0, *map(len, rows)]).astype(np.int32), values)

    return texts.mapInArrow(
        run,
        f"t1 long, t2 long, doc {kind}, anchors array<{ANCHOR}>, sample array<struct<lead:long,head:long>>",
    )


CONTEXT = "bucket int, t1 long, t2 long, pos long, most int, least int, left binary, right binary"
RANGES = "t1 long, t2 long, low long, high long"


def contexts(wanted: DataFrame, splitters: list[tuple[int, int]], length: int) -> DataFrame:
    """The suffixes to sort, with the bucket of each: ``t1, t2, text`` and the ``list`` of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t1, t2, text, found in zip(*[batch.column(c) for c in ("t1", "t2", "text", "list")]):
                data = text.as_buffer().to_pybytes()
                for a in found.as_py():
                    pos, most, least = a["pos"], a["most"], a["least"]
                    bucket = bisect_right(splitters, (lead_of(data, pos), a["head"]))
                    left, right = data[pos - most : pos][::-1], data[pos : pos + length - least]
                    out.append((bucket, t1.as_py(), t2.as_py(), pos, most, least, left, right))
                if len(out) > 4_000:
                    yield rows_of(out, CONTEXT)
                    out = []
            yield rows_of(out, CONTEXT)

    return wanted.mapInArrow(run, CONTEXT)


def rows_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields]
    )


def solved(suffixes: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated strings among the suffixes of each bucket.

    Strings that are equal share lead and head, so no bucket but their own holds any: splitters are
    pairs of both, and equal pairs go to the same side.
    """

    def solve(rows: list[tuple]) -> list[tuple]:
        once = list({row[1:4]: row for row in rows}.values())
        _, t1, t2, pos, most, least, left, right = zip(*once)
        found = repeated_starts(list(left), list(right), np.array(most), np.array(least), length)
        return [
            (t1[i], t2[i], pos[i] - high, pos[i] - low)
            for i, ranges in enumerate(found)
            for low, high in ranges
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                if rows and row[0] != rows[0][0]:
                    yield rows_of(solve(rows), RANGES)
                    rows = []
                rows.append(row)
        if rows:
            yield rows_of(solve(rows), RANGES)

    return suffixes.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, RANGES)


def strings_of_hot(wanted: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated strings whose head is too frequent for one bucket: every string of such an
    anchor becomes a row, by a hash of 128 bits, counted like any other key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = "w1 long, w2 long, t1 long, t2 long, at long"
        for batch in batches:
            for t1, t2, text, found in zip(*[batch.column(c) for c in ("t1", "t2", "text", "list")]):
                data, out = text.as_buffer().to_pybytes(), []
                for a in found.as_py():
                    for p in range(a["pos"] - a["most"], a["pos"] - a["least"] + 1):
                        h = xxhash.xxh3_128_intdigest(data[p : p + length])
                        w = signed(h >> 64), signed(h & (2**64 - 1))
                        out.append((*w, t1.as_py(), t2.as_py(), p))
                yield rows_of(out, schema)

    strings = wanted.mapInArrow(run, "w1 long, w2 long, t1 long, t2 long, at long").distinct()
    strings = stage(strings, "hot-strings")
    several = strings.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    return strings.join(several, ["w1", "w2"]).select(
        *TEXT, F.col("at").alias("low"), F.col("at").alias("high")
    )


def repeated_ranges(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """``t1, t2, low, high``: strings that start from low to high occur elsewhere in another text or
    place; and ``t1, t2, copies``, how many rows have a text. ``texts``: ``doc, t1, t2, text``."""
    spark = texts.sparkSession
    once = stage(
        anchored(texts, length)
        .groupBy(*TEXT)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("doc").alias("first"),
            F.first("anchors").alias("anchors"),
            F.first("sample").alias("sample"),
        ),
        "anchors",
    )
    every = once.select(*TEXT, "first", F.inline("anchors"))
    heads = (
        every.groupBy("head")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("whole").alias("low"),
            F.max("whole").alias("high"),
        )
        .where("n > 1")
        .select("head", (F.col("low") != F.col("high")).alias("mixed"))
    )
    shared = stage(every.join(heads, "head"), "shared-anchors")
    wholes = (
        shared.where("mixed")
        .groupBy("head", "whole")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(*TEXT, "first", "pos", "most", "least")).alias("a"),
        )
    )
    wholes = stage(wholes, "contexts")
    mixed = wholes.groupBy("head").agg(F.count(F.lit(1)).alias("kinds"))
    hot = mixed.where(F.col("kinds") > HOT_ROWS).select(F.col("head").alias("hot"))
    # One hot head per HOT_ROWS suffixes at most: 8 bytes for some 20 MB of them.
    asked = wholes.join(F.broadcast(hot), F.col("head") == F.col("hot"), "left").select(
        "a.*", "head", "n", F.col("hot").isNotNull().alias("hot")
    )
    asked = stage(asked, "suffixes")
    # All strings of an anchor are repeated if another covers the same bytes.
    covered = shared.where("NOT mixed").select("t1", "t2", "pos", "most", "least").union(
        shared.where("mixed")
        .join(wholes.where("n > 1").select("head", "whole"), ["head", "whole"])
        .select("t1", "t2", "pos", "most", "least")
    )
    known = covered.select(
        *TEXT, (F.col("pos") - F.col("most")).alias("low"), (F.col("pos") - F.col("least")).alias("high")
    )

    rows = asked.count()
    leads = once.select(F.inline("sample")).distinct()
    leads = stage(leads.join(wholes.select("head").distinct(), "head", "left_semi"), "leads")
    sample = sorted((r.lead, r.head) for r in thinned(leads, SPLITTERS, "lead", "head"))
    buckets = min(rows // BUCKET_ROWS + 1, len(sample) + 1)
    splitters = [sample[i * len(sample) // buckets] for i in range(1, buckets)]

    def with_text(which: DataFrame) -> DataFrame:
        lists = which.groupBy(*TEXT, "first").agg(
            F.collect_list(F.struct("pos", "most", "least", "head")).alias("list")
        )
        lists = lists.withColumnsRenamed({"t1": "a1", "t2": "a2"})
        return texts.join(
            lists,
            (F.col("t1") == F.col("a1"))
            & (F.col("t2") == F.col("a2"))
            & same(F.col("doc"), F.col("first")),
        ).select(*TEXT, "text", "list")

    found = solved(contexts(with_text(asked.where("NOT hot")), splitters, length), length)
    ranges = known.union(found)
    if asked.where("hot").limit(1).count():
        ranges = ranges.union(strings_of_hot(with_text(asked.where("hot")), length))
    return ranges, once.select(*TEXT, "copies")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that starts elsewhere, too.

    Texts are read as UTF-8 bytes, null as empty; matches stay inside a document, "elsewhere" is any
    other place of any document, overlapping places included. Strings are judged on the input. Rows
    that repeat a text repeat all its strings.

    Only suffixes at anchors are looked at: places that a string itself determines. An anchor is
    dropped if its head, the bytes that all its strings share, occurs once; if all anchors of a head
    cover the same bytes, all their strings are repeated. The others are range-partitioned by sampled
    splitters of their leading bytes and head, sorted in their bucket by multikey quicksort, forwards
    and backwards, and neighbours are compared. A head never straddles a boundary; one with over
    50,000 different surroundings is counted string by string in a shuffle instead.

    Returns ``doc, n_bytes, n_removed, n_spans, kept`` (binary), one row per input row.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings of {2 * GRAM} bytes or more are supported")
    python_path(docs.sparkSession)
    text = F.coalesce(docs[text_col], F.lit(""))
    texts = docs.select(
        docs[id_col].alias("doc"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        text.alias("text"),
    )
    ranges, copies = repeated_ranges(texts, length)
    lists = ranges.groupBy(*TEXT).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    marks = copies.where("copies > 1").join(lists, TEXT, "full").withColumnsRenamed(
        {"t1": "a1", "t2": "a2"}
    )
    rows = texts.join(
        marks, (F.col("t1") == F.col("a1")) & (F.col("t2") == F.col("a2")), "left"
    ).select("doc", "text", (F.coalesce("copies", F.lit(1)) > 1).alias("copied"), "ranges")

    def cut(data: bytes, ranges: list[dict]) -> tuple[int, int, bytes]:
        parts, at, spans, end = [], 0, 0, -1
        for low, high in sorted((r["low"], r["high"] + length) for r in ranges):
            if low > end:
                parts.append(data[at:low] if end < 0 else data[end:low])
                spans += 1
                at = end = high
            end = max(end, high)
        parts.append(data[max(end, 0) :])
        kept = b"".join(parts)
        return len(data) - len(kept), spans, kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                sizes, out = [], []
                for text, copied, ranges in zip(*[part.column(c) for c in ("text", "copied", "ranges")]):
                    data = text.as_buffer().to_pybytes()
                    sizes.append(len(data))
                    if copied.as_py() and len(data) >= length:
                        out.append((len(data), 1, b""))
                    else:
                        out.append(cut(data, ranges.as_py() or []))
                removed, spans, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
