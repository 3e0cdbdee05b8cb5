"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded, verified."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.bpe import chunks
from editstream.llm.common import packed, python_path, same, stage, table, unpacked

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
FEATURE_BITS = 20
PARTS = 64  # of the sieve of features
SHARE = 1_000  # a shingle is rare if fewer than one in so many documents hold it
CHUNK_CHARS = 4_000_000
GROUP_DOCS, GROUP_BYTES = 2_000, 32_000_000
SPEAKERS = 8

U64 = np.uint64
MULTIPLIER = U64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@cache
def word_points() -> np.ndarray:
    """For every code point, whether it is part of a word: a letter, a digit or ``_``."""
    return np.fromiter((chr(i).isalnum() or i == 95 for i in range(0x110000)), dtype=bool)


def all_shingles(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the distinct hashes of five neighbouring words, sorted, and how often each occurs.

    Words are lower-cased. A text of one to four words is one shingle, a text without words has none.
    The words of all texts are found and hashed together.
    """
    lower = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = word_points()[points]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    begin, sizes = edges[::2], edges[1::2] - edges[::2]
    powers = np.full(int(sizes.max(initial=0)), MULTIPLIER, dtype=U64).cumprod(dtype=U64)
    at = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    letters = points[inside] * powers[place]
    ids = mixed(np.add.reduceat(letters, at)) if len(at) else letters
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lower])])
    borders = np.searchsorted(begin, starts).tolist()

    def joined(ids: np.ndarray, width: int) -> np.ndarray:
        total = np.zeros(max(len(ids) - width + 1, 0), dtype=U64)
        for i in range(width):
            total = total * MULTIPLIER + ids[i : i + len(total)]
        return mixed(total + U64(width))

    whole, out = joined(ids, SHINGLE), []
    for first, last in zip(borders, borders[1:]):
        n = last - first
        own = whole[first : last - SHINGLE + 1] if n >= SHINGLE else joined(ids[first:last], n)[: min(n, 1)]
        out.append(np.unique(own, return_counts=True))
    return out


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    return all_shingles([text])[0]


def feature(hashes: np.ndarray, bits: int = FEATURE_BITS) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64)


class Sampler:
    """Improved consistent weighted sampling: the chance that two weighted sets have a sample in
    common is their weighted Jaccard similarity. The random numbers of a shingle come from its hash:
    12 bits for r, 12 for beta, 40 for c."""

    def __init__(self, samples: int):
        numbers = np.random.default_rng(20).integers(0, 2**63, samples, dtype=np.int64)
        self.seeds = mixed(numbers.astype(U64))
        # Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x).
        x = np.linspace(0, 30, 300_001)
        at = (np.arange(4096) + 0.5) / 4096
        self.r = np.interp(at, 1 - (1 + x) * np.exp(-x), x).astype(np.float32)

    def sample(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        log_weights = np.log(weights).astype(np.float32)[:, None]
        least = np.full(len(self.seeds), np.inf, dtype=np.float32)
        chosen = np.zeros(len(self.seeds), dtype=U64)
        column = np.arange(len(self.seeds))
        for at in range(0, len(hashes), 512):
            block = hashes[at : at + 512]
            bits = mixed(block[:, None] ^ self.seeds)
            r = self.r[(bits & U64(4095)).astype(np.int32)]
            beta = ((bits >> U64(12)) & U64(4095)).astype(np.float32) / np.float32(4096)
            u = ((bits >> U64(24)) & U64(0xFFFFF)).astype(np.float32) + np.float32(0.5)
            v = (bits >> U64(44)).astype(np.float32) + np.float32(0.5)
            c = -np.log(u * v * np.float32(2.0**-40))
            step = np.floor(log_weights[at : at + 512] / r + beta)
            a = np.log(c) - r * (step - beta) - r
            best = a.argmin(axis=0)
            value = a[best, column]
            better = value < least
            sample = block[best] + step[best, column].astype(np.int64).astype(U64) * MULTIPLIER
            chosen = np.where(better, sample, chosen)
            least = np.where(better, value, least)
        return chosen

    def bands(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        rows = self.sample(hashes, weights).reshape(BANDS, ROWS)
        joined = np.arange(1, BANDS + 1, dtype=U64)
        for i in range(ROWS):
            joined = mixed(joined * MULTIPLIER + rows[:, i])
        return joined


class Frequencies:
    """Inverse document frequencies of shingles: exact for those of ``hashes`` (sorted), all others are
    rare."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, docs: int):
        self.hashes, self.idf = hashes, inverse_frequencies(counts, docs)
        self.rare = float(inverse_frequencies(np.ones(1), docs)[0])

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.rare)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.idf[at[known]]
        return out


def document_frequencies(docs: DataFrame, n_docs: int) -> Frequencies:
    """In how many of ``docs`` each shingle occurs, exact for every shingle that is not rare.

    The documents are read twice. First each task counts features (hash prefixes) into one array;
    the arrays are summed in two steps, in parts. A feature occurs at least as often as each of its
    shingles, so only shingles of features that occur often enough are counted one by one, in a
    shuffle. Of the shingles that are not rare there are at most ``SHARE`` times as many as a document
    has on average.
    """
    least = max(2, -(-n_docs // SHARE))
    bits = FEATURE_BITS
    width = (1 << bits) // PARTS

    def narrow(counts: np.ndarray) -> bytes:
        top = int(counts.max(initial=0))
        return counts.astype(next(f"<u{n}" for n in (1, 2, 4, 8) if top < 1 << 8 * n)).tobytes()

    def wide(counts: bytes) -> np.ndarray:
        return np.frombuffer(counts, f"<u{len(counts) // width}").astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_CHARS):
                found = [h for h, _ in all_shingles(part.column("text").to_pylist())]
                total += np.bincount(feature(np.concatenate(found), bits), minlength=len(total))
        rows = [narrow(total[i * width : (i + 1) * width]) for i in range(PARTS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(PARTS), pa.int32()), pa.array(rows, pa.binary())], ["part", "counts"]
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (wide(c) for c in frame["counts"]))
        return frame.iloc[:1].assign(counts=[narrow(total)])

    def often(frame: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (wide(c) for c in frame["counts"]))
        return frame.iloc[:1].assign(counts=[np.packbits(total >= least).tobytes()])

    counted = docs.mapInArrow(count, "part int, counts binary").withColumn(
        "step", F.spark_partition_id() % 64
    )
    schema = "part int, counts binary, step int"
    summed = counted.groupBy("part", "step").applyInPandas(add, schema)
    sieve = summed.groupBy("part").applyInPandas(often, schema).orderBy("part").collect()
    if not sieve:
        return Frequencies(np.zeros(0, dtype=U64), np.zeros(0), n_docs)
    packed_sieve = docs.sparkSession.sparkContext.broadcast(b"".join(r.counts for r in sieve))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(packed_sieve.value, np.uint8)).astype(bool)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_CHARS):
                found = np.concatenate([h for h, _ in all_shingles(part.column("text").to_pylist())])
                hashes, n = np.unique(found[wanted[feature(found, bits)]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"]
                )

    frequent = (
        docs.mapInArrow(candidates, "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .toArrow()
    )
    hashes = frequent.column("hash").to_numpy().view(U64)
    order = np.argsort(hashes)
    return Frequencies(hashes[order], frequent.column("n").to_numpy()[order], n_docs)


def inverse_frequencies(counts: np.ndarray, docs: int) -> np.ndarray:
    """Between 1 (in every document) and 2 (in one of ``SHARE`` or less), by the share of documents
    only, so that it is the same at every size of the corpus. The damping keeps a large group of near
    copies similar: what they share is frequent just because they are many."""
    seen = np.maximum(counts, 1)
    return 1 + np.clip(np.log(max(docs, 1) / seen) / np.log(SHARE), 0, 1)


def weighted(texts: list[str], idf: Frequencies | np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles of each text with their weights. ``idf``: by shingle, or an array by feature."""
    known = idf.of if isinstance(idf, Frequencies) else lambda hashes: idf[feature(hashes)]
    return [(hashes, counts * known(hashes)) for hashes, counts in all_shingles(texts)]


def linked(texts: list[str], idf: Frequencies, similarity: float) -> tuple[np.ndarray, list]:
    """Clusters of texts by links of at least ``similarity``, and the links that hold them together.

    All are compared with the first; whoever is not linked to it is compared with all others. Two that
    are both linked to the first are in its cluster anyway.
    """
    sets = weighted(texts, idf)
    sizes = np.array([len(h) for h, _ in sets])
    flat, places = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
    weights = np.concatenate([w for _, w in sets])
    starts = np.cumsum(sizes) - sizes
    filled = sizes > 0
    totals = np.zeros(len(sets))
    totals[filled] = np.add.reduceat(weights, starts[filled])
    cluster = np.arange(len(sets))
    links = []
    dense = np.zeros(len(flat))

    def similar(i: int) -> np.ndarray:
        own = places[starts[i] : starts[i] + sizes[i]]
        dense[own] = weights[starts[i] : starts[i] + sizes[i]]
        common = np.zeros(len(sets))
        common[filled] = np.add.reduceat(np.minimum(weights, dense[places]), starts[filled])
        dense[own] = 0
        union = totals + totals[i] - common
        return np.flatnonzero((common >= similarity * union) & (union > 0))

    rest = [0]
    if len(sets) > 1:
        near = set(similar(0).tolist()) | {0}
        rest += [i for i in range(1, len(sets)) if i not in near]
    for i in rest:
        for j in similar(i):
            a, b = cluster[i], cluster[j]
            if a != b:
                cluster[cluster == max(a, b)] = min(a, b)
                links.append((i, int(j)))
    return cluster, links


def linked_across(
    left: list[tuple], right: list[tuple], idf: Frequencies, similarity: float
) -> list[tuple]:
    """Links of at least ``similarity`` between two lists of ``(node, class, text)``: of those between
    texts of different classes, as many as make one class of all classes that are linked."""
    sets = weighted([t for _, _, t in right], idf)
    sizes = np.array([len(h) for h, _ in sets])
    flat, places = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
    weights = np.concatenate([w for _, w in sets])
    starts = np.cumsum(sizes) - sizes
    filled = sizes > 0
    totals = np.zeros(len(sets))
    totals[filled] = np.add.reduceat(weights, starts[filled])
    names = sorted({c for _, c, _ in left} | {c for _, c, _ in right})
    number = {c: i for i, c in enumerate(names)}
    merged = np.arange(len(names))
    classes = np.array([number[c] for _, c, _ in right])
    dense, links = np.zeros(len(flat)), []
    for node, own_class, text in left:
        own = merged[number[own_class]]
        if (merged[classes] == own).all():
            continue
        [(hashes, own_weights)] = weighted([text], idf)
        at = np.minimum(np.searchsorted(flat, hashes), len(flat) - 1)
        known = flat[at] == hashes
        dense[at[known]] = own_weights[known]
        common = np.zeros(len(sets))
        common[filled] = np.add.reduceat(np.minimum(weights, dense[places]), starts[filled])
        dense[at[known]] = 0
        union = totals + own_weights.sum() - common
        for j in np.flatnonzero((common >= similarity * union) & (union > 0)):
            a, b = merged[number[own_class]], merged[classes[j]]
            if a != b:
                merged[merged == max(a, b)] = min(a, b)
                links.append((node, right[j][0]))
    return links


def crossed(rows: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """Links (``node, other``) between texts of different classes in each bucket, none left out.

    ``rows``: ``bucket, node, class, text`` of large buckets. Of two texts of different classes one at
    least is outside the bucket's largest class. The texts outside it are dealt into blocks; each block
    is compared with all texts of the bucket, block by block, in a shuffle.
    """
    per_class = rows.groupBy("bucket", "class").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")
    )
    main = per_class.groupBy("bucket").agg(F.max(F.struct("n", "class"))["class"].alias("main"))
    # One row per large bucket.
    sizes = (
        per_class.join(main, "bucket")
        .groupBy("bucket", "main")
        .agg(*[
            F.greatest(
                F.ceil(2 * F.sum(F.when(of, F.col("n"))) / GROUP_DOCS),
                F.ceil(2 * F.sum(F.when(of, F.col("bytes"))) / GROUP_BYTES),
            ).alias(name)
            for name, of in [
                ("mains", F.col("class") == F.col("main")),
                ("others", F.col("class") != F.col("main")),
            ]
        ])
        .where("others > 0")
    )
    dealt = rows.join(F.broadcast(sizes), "bucket").withColumn(
        "block",
        F.pmod(
            F.xxhash64("node", "bucket"),
            F.when(F.col("class") == F.col("main"), F.col("mains")).otherwise(F.col("others")),
        ),
    )
    columns = ["bucket", "node", "class", "text"]
    inside = dealt.where(F.col("class") == F.col("main"))
    outside = dealt.where(F.col("class") != F.col("main"))
    # Pairs of blocks: a block of the others with each of the largest class, and with itself and each
    # later one of the others.
    pair = lambda i, j, side: [
        *columns, F.expr(i).alias("i"), F.expr(j).alias("j"), F.lit(side).alias("side")
    ]
    pairs = (
        outside.select(*columns, "block", F.explode(F.expr("sequence(0, mains - 1)")).alias("to"))
        .select(*pair("block", "to", 0))
        .union(
            inside.select(*columns, "block", F.explode(F.expr("sequence(0, others - 1)")).alias("to"))
            .select(*pair("to", "block", 1))
        )
        .union(
            outside.select(*columns, "block", F.explode(F.expr("sequence(block, others - 1)")).alias("to"))
            .select(*pair("block", "-1 - to", 0))
        )
        .union(
            outside.select(*columns, "block", F.explode(F.expr("sequence(0, block)")).alias("to"))
            .select(*pair("to", "-1 - block", 1))
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])

        def solve() -> pa.RecordBatch:
            links = linked_across(*sides, idf.value, similarity) if all(sides) else []
            columns = list(zip(*links)) or [()] * 2
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary()) for c in columns], ["node", "other"]
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for bucket, i, j, side, node, name, text in zip(*columns):
                if (bucket, i, j) != key:
                    if key is not None:
                        yield solve()
                    key, sides = (bucket, i, j), ([], [])
                sides[side].append((node, name, text))
        if key is not None:
            yield solve()

    pairs = pairs.select("bucket", "i", "j", "side", "node", "class", "text")
    pairs = pairs.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return pairs.mapInArrow(run, "node binary, other binary")


def verified(groups: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """Links within each group (``bucket, part``), and the texts that speak for its clusters.

    ``groups``: ``bucket, part, node, text, many`` (whether the bucket has other parts). Rows of a
    link have ``other``; rows with ``text`` are for the next round: of the largest cluster, up to
    ``SPEAKERS`` texts, and all others.
    """

    def solve(key: tuple, rows: list[tuple]) -> list[tuple]:
        nodes = {node: (text, many) for node, text, many in rows}
        names = sorted(nodes)
        cluster, links = linked([nodes[n][0] for n in names], idf.value, similarity)
        out = [(key[0], names[i], names[j], None) for i, j in links]
        if nodes[names[0]][1]:
            largest = np.bincount(cluster).argmax()
            spoken = 0
            for name, c in zip(names, cluster):
                spoken += c == largest
                if c != largest or spoken <= SPEAKERS:
                    out.append((key[0], name, None, nodes[name][0]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for bucket, part, node, text, many in zip(*columns):
                if (bucket, part) != key:
                    if key is not None:
                        out += solve(key, rows)
                    key, rows = (bucket, part), []
                rows.append((node, text, many))
            yield result(out)
        if key is not None:
            yield result(solve(key, rows))

    def result(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "node", "other", "text"]
        )

    dealt = groups.select("bucket", "part", "node", "text", "many")
    dealt = dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return dealt.mapInArrow(run, "bucket long, node binary, other binary, text string")


def parted(rows: DataFrame, salt: int = 0) -> DataFrame:
    """Deal each bucket's rows into parts of about ``GROUP_DOCS`` texts or ``GROUP_BYTES`` bytes; which
    ones meet depends on ``salt``."""
    sizes = rows.groupBy("bucket").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / GROUP_DOCS), F.ceil(F.sum(F.octet_length("text")) / GROUP_BYTES)
        ).alias("parts")
    )
    return rows.join(sizes, "bucket").select(
        "bucket",
        F.pmod(F.xxhash64(F.lit(salt), "node", "bucket"), F.col("parts")).alias("part"),
        "node",
        "text",
        (F.col("parts") > 1).alias("many"),
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components: ``node`` and the smallest node of its component, for nodes with links.

    Each round makes the neighbours of every node neighbours of its smallest one: first the larger
    neighbours, then the smaller. Rounds are written to the shared folder; they end when nothing
    changes.
    """
    edges = stage(links.select("node", "other").where("node <> other").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("other", "node"))
        least = both.groupBy("node").agg(F.min("other").alias("low"))
        least = least.select("node", F.least("low", "node").alias("low"))
        large = (
            both.join(least, "node").where("other > node AND other <> low").select(
                F.col("other").alias("node"), F.col("low").alias("other")
            )
        ).distinct()
        lows = large.groupBy("node").agg(F.min("other").alias("low"))
        small = large.join(lows, "node")
        small = (
            small.select("node", F.col("low").alias("other"))
            .union(small.where("other <> low").select(F.col("other"), F.col("low")))
            .distinct()
        )
        edges = stage(small, "links")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == state:
            return edges.select("node", F.col("other").alias("class")).union(
                edges.select(F.col("other"), F.col("other")).distinct()
            )
        state = tuple(now)


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Classes of near-duplicate documents.

    Two texts are linked if the weighted Jaccard similarity of their shingles of five words is at
    least ``similarity``; the weight of a shingle is its count in the text times a damped inverse
    document frequency, exact but for rare shingles (in less than one of ``SHARE`` documents), which
    all weigh the same. Linked texts, directly or over others, are one class; equal texts always are.
    Candidates agree in one of 10 bands of 4 samples: a pair of similarity 0.8 is missed with a chance
    of 0.5 percent, one of 0.9 with 0.003 percent. Buckets with the same members are compared once.

    A bucket of over 2,000 texts is dealt into parts. Within a part all links are found; between
    parts, at first those of up to 8 texts of each part's largest cluster and of all texts outside it,
    in further rounds while these get fewer. Then all texts of such a bucket that are still in different
    classes are compared, block by block. The outcome does not depend on the sizes of parts.

    Returns ``doc, node, class`` (a 16-byte hash of the text, and the smallest of the class), one row
    per input row. Null texts count as empty; texts without words are alike only if equal.
    """
    spark = docs.sparkSession
    python_path(spark)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].alias("doc"), F.unhex(F.md5(text)).alias("node"), text.alias("text")
    )
    idf = spark.sparkContext.broadcast(document_frequencies(rows.select("text"), docs.count()))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_CHARS):
                bands = []
                for hashes, weights in weighted(part.column("text").to_pylist(), idf.value):
                    found = sampler.bands(hashes, weights) if len(hashes) else hashes
                    bands.append(found.view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("node"), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc", "node", "bands"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    sketches = stage(
        rows.mapInArrow(sketch, f"doc {kind}, node binary, bands array<long>"), "sketches"
    )
    members = sketches.select("node", F.explode("bands").alias("bucket")).distinct()
    buckets = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"),
        F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)")).alias("sum_2"),
    )
    # Buckets of the same members, told by number and sums of hashes, are one.
    unlike = buckets.where("n > 1").groupBy("n", "sum", "sum_2").agg(F.min("bucket").alias("bucket"))
    first = sketches.groupBy("node").agg(F.min("doc").alias("first"))
    wanted = members.join(unlike.select("bucket"), "bucket").join(first, "node")

    def texts(wanted: DataFrame) -> DataFrame:
        """The rows of ``wanted`` with the text of their node."""
        return rows.join(
            wanted.withColumnRenamed("node", "node_2"),
            (F.col("node") == F.col("node_2")) & same(F.col("doc"), F.col("first")),
        ).select("bucket", *[c for c in wanted.columns if c not in ("bucket", "first")], "text")

    found, left, sizes, large = [], parted(texts(wanted)), None, None
    while True:
        done = stage(verified(left, idf, similarity), "near-links")
        found.append(done.where(F.col("other").isNotNull()).select("node", "other"))
        speak = done.where(F.col("text").isNotNull()).select("bucket", "node", "text")
        before, sizes = sizes, speak.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        if before is None:
            large = sizes.select("bucket")
            going = speak
        else:
            # A bucket whose texts hardly get fewer leaves the rounds.
            fewer = sizes.join(before.withColumnRenamed("n", "n_2"), "bucket").where("n <= 0.9 * n_2")
            going = speak.join(F.broadcast(fewer.select("bucket")), "bucket", "left_semi")
        if going.isEmpty():
            break
        left = parted(going, len(found))
    links = reduce(DataFrame.union, found)
    classes = components(links)
    if not large.isEmpty():
        # The rounds only unite most of a large bucket cheaply; what they leave apart is compared here.
        apart = (
            wanted.join(F.broadcast(large), "bucket", "left_semi")
            .join(classes, "node", "left")
            .select("bucket", "node", F.coalesce("class", "node").alias("class"), "first")
        )
        more = crossed(stage(texts(apart), "near-large"), idf, similarity)
        united = classes.select("node", F.col("class").alias("other"))
        classes = components(united.union(stage(more, "near-links")))
    return (
        sketches.select("doc", "node")
        .join(classes, "node", "left")
        .select("doc", "node", F.coalesce("class", "node").alias("class"))
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, with the smallest id of its class and the size of the class."""
    rows = near_classes(table(spark, sf_dir, "documents"))
    sizes = rows.groupBy("class").agg(
        F.min("doc").alias("class_id"), F.count(F.lit(1)).alias("class_docs")
    )
    return rows.join(sizes, "class").select(
        F.col("doc").alias("doc_id"), "class_id", "class_docs"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """All columns of the documents, of each class only the one of the smallest id.

    Null ids come last; of rows that agree in id and text, one stays.
    """
    key = F.struct("doc")  # structs are equal also where what they hold is null
    rows = packed(docs, "doc_id", "text").select(
        "row", key.alias("key"), F.unhex(F.md5("text")).alias("node")
    )
    order = F.struct(F.col("doc").isNull(), F.col("doc"), F.col("node"))
    best = near_classes(docs).groupBy("class").agg(F.min(order).alias("best"))
    kept = best.select(F.struct(F.col("best.doc")).alias("key"), F.col("best.node").alias("node"))
    once = (
        rows.join(kept, ["key", "node"], "left_semi")
        .groupBy("key", "node")
        .agg(F.first("row").alias("row"))
    )
    return unpacked(once, docs.columns)
