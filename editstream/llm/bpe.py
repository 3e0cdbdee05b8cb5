"""Byte-level BPE, encoding with an index of pair occurrences, and decoding."""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.common import python_path, table

# Fixed pattern of the byte-level pre-tokenizer.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+"""
)
# The letters and numbers that Unicode 16.0 added to 15.1. Tokenizer files are read with
# the tables of 16.0, Python's are those of 15.1 and the regex module's newer than both.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
PIECES = regex.compile(PATTERN.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}"))
# Outside these blocks the tables may differ.
UNSETTLED = regex.compile(r"[^\x00-\u0557\u2000-\u206F\u3000-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3]")


def members(kind: str, added: list[tuple[int, int]]) -> str:
    """The code points of a general category as ranges of a character class."""
    inside = [unicodedata.category(chr(i))[0] == kind for i in range(0x110000)]
    for first, last in added:
        inside[first : last + 1] = [True] * (last + 1 - first)
    edges = [i for i in range(1, len(inside)) if inside[i] != inside[i - 1]]
    return "".join(f"\\U{a:08X}-\\U{b - 1:08X}" for a, b in zip(edges[::2], edges[1::2]))


@cache
def exact_pieces() -> regex.Pattern:
    letters, numbers = members("L", NEW_LETTERS), members("N", NEW_NUMBERS)
    return regex.compile(PATTERN.replace("{L}", letters).replace("{N}", numbers))


def split(text: str) -> list[str]:
    if text.isascii() or not UNSETTLED.search(text):
        return PIECES.findall(text)
    return exact_pieces().findall(text)


CHUNK_CHARS = 2_000_000
CACHED_PIECES = 800_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """A byte-level BPE tokenizer read from the JSON text of its file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        if before["add_prefix_space"] or not before.get("use_regex", True):
            raise ValueError("this pre-tokenizer is not supported")
        letters = byte_letters()
        vocab = {
            bytes(letters[c] for c in token): i for token, i in model["vocab"].items()
        }
        self.added = {}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError("added tokens that take their surroundings are not supported")
            self.added[token["content"]] = token["id"]
        self.first = [vocab[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], int] = {}  # pair: rank
        self.merged: list[tuple[int, int, int]] = []  # by rank: left, right, what they become
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (bytes(letters[c] for c in x) for x in (left, right))
            self.merges[vocab[a], vocab[b]] = rank
            self.merged.append((vocab[a], vocab[b], vocab[a + b]))
        spelt = {i: t for t, i in vocab.items()} | {
            i: t.encode() for t, i in self.added.items()
        }
        sizes = [len(spelt.get(i, b"")) for i in range(max(spelt) + 1)]
        self.sizes = np.array(sizes, dtype=np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(
            b"".join(spelt.get(i, b"") for i in range(len(sizes))), dtype=np.uint8
        )
        special = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, bytes] = {}

    def merge_all(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, all pieces at once.

        ``places`` maps the rank of each pair that occurs to the positions of its left parts in the
        joined symbols of all pieces. The lowest rank is applied at all its positions, from left to
        right; the pairs that this makes join the index. Entries whose symbols have changed since are
        passed over.
        """
        first, merges, merged = self.first, self.merges, self.merged
        symbols: list[int] = []
        ends = []
        for piece in pieces:
            symbols.extend([first[b] for b in piece.encode()])
            symbols.append(-1)  # a wall between pieces
            ends.append(len(symbols))
        before = list(range(-1, len(symbols) - 1))
        after = list(range(1, len(symbols) + 1))
        places: dict[int, list[int]] = {}
        for at, pair in enumerate(zip(symbols, symbols[1:])):
            rank = merges.get(pair)
            if rank is not None:
                places.setdefault(rank, []).append(at)
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            left, right, new = merged[rank]
            for at in sorted(places.pop(rank)):
                other = after[at]
                if symbols[at] != left or symbols[other] != right:
                    continue
                symbols[at], symbols[other] = new, -2
                follower = after[other]
                after[at] = follower
                if follower < len(symbols):
                    before[follower] = at
                    made = merges.get((new, symbols[follower]))
                    if made is not None:
                        if made in places:
                            places[made].append(at)
                        else:
                            places[made] = [at]
                            heapq.heappush(active, made)
                leader = before[at]
                if leader >= 0:
                    made = merges.get((symbols[leader], new))
                    if made is not None:
                        if made in places:
                            places[made].append(leader)
                        else:
                            places[made] = [leader]
                            heapq.heappush(active, made)
        out, begin = [], 0
        for end in ends:
            out.append(array("I", [s for s in symbols[begin:end] if s >= 0]).tobytes())
            begin = end
        return out

    def pieces(self, text: str) -> list[str | int]:
        """Pieces to be merged, and ids of added tokens."""
        if self.special is None or not self.special.search(text):
            return split(text)
        out: list[str | int] = []
        begin = 0
        for found in self.special.finditer(text):
            out += split(text[begin : found.start()])
            out.append(self.added[found.group()])
            begin = found.end()
        return out + split(text[begin:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        pieces = [self.pieces(t) for t in texts]
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        new = list(set().union(*pieces).difference(self.known))
        for piece in [p for p in new if isinstance(p, int)]:
            self.known[piece] = array("I", [piece]).tobytes()
        new = [p for p in new if isinstance(p, str)]
        self.known.update(zip(new, self.merge_all(new)))
        known = self.known.__getitem__
        return [b"".join(map(known, found)) for found in pieces]

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, dtype="<u4")
        sizes = self.sizes[tokens]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.places[tokens] - (ends - sizes), sizes) + np.arange(total)
        return self.bytes[places].tobytes().decode("utf-8", "replace")


LOADED: dict[int, ByteBPE] = {}


def loaded(text: str) -> ByteBPE:
    """The tokenizer of a file's text, kept in the worker process from task to task."""
    key = hash(text)
    if key not in LOADED:
        LOADED.clear()
        LOADED[key] = ByteBPE(text)
    return LOADED[key]


def chunks(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text, one row at least."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy()
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def encode_decode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """Token ids of every whole text, and the text decoded from them.

    ``path`` is a byte-level BPE tokenizer file, read by the driver; its text, a few MB, is
    broadcast. Strings of added tokens in a text become their ids. Null and empty texts have no
    tokens. Pieces of text are merged together, a few MB of a partition at a time, and kept (up to a bound)
    for repeats.
    Returns ``doc, ids`` (little-endian unsigned 32-bit integers) and ``decoded``.
    """
    spark = docs.sparkSession
    python_path(spark)
    with open(path or default_path(), encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    rows = docs.select(
        docs[id_col].alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(shared.value)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_CHARS):
                ids = bpe.encode(part.column("text").to_pylist())
                decoded = pa.array([bpe.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(ids, pa.binary()), decoded],
                    names=["doc", "ids", "decoded"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, ids binary, decoded string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def digests(docs: DataFrame) -> DataFrame:
    return encode_decode(docs).select(
        F.col("doc").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
