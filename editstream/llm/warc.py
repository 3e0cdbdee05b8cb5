"""WARC archives: writing pages with segments and chunked framing, and reading them back whole."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.common import python_path, same, stage, table
from editstream.session import scratch_dir

END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
MIN_REVISIT_BYTES = 100


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts.append(b"%x\r\n%b\r\n" % (len(part), part))
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of chunked framing; a ValueError if it is cut or malformed."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("no chunk size")
        size = int(body[at:line].split(b";")[0].strip(), 16)
        if size == 0:
            return b"".join(parts)
        at = line + 2 + size
        if size < 0 or body[at : at + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(body[line + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the HTTP header")
    coding = b""
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding":
            coding = value.strip().lower()
    return unchunked(body) if coding == b"chunked" else body


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A WARC record without the two line ends that close it. Fields of None are left out."""
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block


def records_of_page(
    page_id: object,
    url: str | None,
    payload: bytes,
    digest: str,
    refers_to: object,
    segment_bytes: int,
    chunk_bytes: int,
) -> Iterator[bytes]:
    """The records of a page: a revisit, or a response and as many continuations as it needs."""
    own = f"<urn:uuid:{uuid.uuid4()}>"
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": own,
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Page-ID": page_id,
        "Content-Type": "application/http;msgtype=response",
    }
    if refers_to is not None:
        more = {"WARC-Profile": PROFILE, "Refers-To-Page-ID": refers_to}
        yield record(fields | more, HTTP + b"\r\n")
        return
    block = HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield record(fields, block)
        return
    yield record(fields | {"WARC-Segment-Number": 1}, block[:segment_bytes])
    starts = range(segment_bytes, len(block), segment_bytes)
    for number, at in enumerate(starts, 2):
        more = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Date": DATE,
            "WARC-Segment-Origin-ID": own,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if at == starts[-1] else None,
        }
        yield record(more, block[at : at + segment_bytes])


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = 32_768,
    chunk_bytes: int = 4_096,
    records_per_file: int = 2_000,
) -> None:
    """Write a record per page to gzipped WARC files in the folder ``path``.

    Of pages with equal payloads of at least 100 bytes, the one of the smallest id is the response;
    the others revisit it. Rows that share that id, too, are all responses. Null ids come last: rows
    without one revisit a page that has one, or are all responses. Null payloads are empty. Blocks of
    over ``segment_bytes`` are cut into segments; files have ``records_per_file`` records at most, so
    that a reader can hold one.
    """
    python_path(pages.sparkSession)
    payload = F.encode(F.coalesce(pages[payload_col], F.lit("")), "UTF-8")
    rows = pages.select(
        pages[id_col].cast("string").alias("id"),
        pages[id_col].alias("order"),
        pages[url_col].alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    copies = (
        rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("order").alias("least"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("copied"), F.col("least").cast("string").alias("least"))
    )
    dealt = rows.join(copies, rows["digest"] == copies["copied"], "left").select(
        "id",
        "url",
        "payload",
        "digest",
        F.when(~same(F.col("id"), F.col("least")), F.col("least")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for row in zip(*[batch.column(i) for i in range(5)]):
                made = records_of_page(*[x.as_py() for x in row], segment_bytes, chunk_bytes)
                for one in made:
                    out.append(one)
                    size += len(one)
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (
        dealt.mapInArrow(write, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


FEED_BYTES = 65_536
BATCH_BYTES = 8_000_000
GZIP = b"\x1f\x8b\x08"


def inflated(data: bytes) -> Iterator[bytes | None]:
    """What a file holds, piece by piece; a file that is not gzipped as it is.

    A gzip member, of which archives may have one per record, costs its own size and no more. None
    stands for a member that is cut or damaged; reading goes on at the next that can be read.
    """
    view = memoryview(data)
    if not data.startswith(b"\x1f\x8b"):
        yield from (bytes(view[i : i + BATCH_BYTES]) for i in range(0, len(data), BATCH_BYTES))
        return
    at = 0
    while at < len(data):
        begin, member = at, zlib.decompressobj(31)
        try:
            while at < len(data) and not member.eof:
                part = view[at : at + FEED_BYTES]
                out = member.decompress(part)
                at += len(part) - len(member.unused_data)
                if out:
                    yield out
            broken = not member.eof
        except zlib.error:
            broken = True
        if broken:
            yield None
            at = data.find(GZIP, max(begin + 1, at - FEED_BYTES))
            at = len(data) if at < 0 else at


def parse(pieces: Iterator[bytes | None]) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Fields (names in lower case) and block of every record of a WARC file.

    The block is None if the record is cut or malformed; the next one is then looked for behind an
    empty line. No more than a record and a piece are held.
    """
    held, over, torn = bytearray(), False, False

    def more() -> bool:
        """Read on; False at the end, or where something is missing."""
        nonlocal over, torn
        piece = next(pieces, b"")
        if piece is None:
            torn = True
        elif not piece:
            over = True
        else:
            held.extend(piece)
        return bool(piece)

    def lost() -> None:
        """Go to the next record."""
        nonlocal torn
        while (found := held.find(END.encode() + b"WARC/", 1)) < 0:
            del held[: max(len(held) - 8, 0)]
            if torn or not more():
                # What follows a tear begins with a record, as a member does.
                held.clear()
                torn = False
                return
        del held[: found + len(END)]

    while held or not over:
        while held[:1] in (b"\r", b"\n"):
            del held[:1]
        if len(held) < 5 and not torn and not over and more():
            continue
        if not held and (over or torn):
            if torn:
                torn = False
                yield {}, None
            continue
        if not held.startswith(b"WARC/"):
            yield {}, None
            lost()
            continue
        while (end := held.find(END.encode())) < 0 and not torn and more():
            pass
        fields: dict[str, str] = {}
        for line in held[: end if end >= 0 else len(held)].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = fields.get("content-length", "")
        if end < 0 or not (length.isascii() and length.isdigit()):
            yield fields, None
            lost()
            continue
        begin, size = end + len(END), int(length)
        while len(held) < begin + size and not torn and more():
            pass
        if len(held) < begin + size:
            yield fields, None
            lost()
            continue
        yield fields, bytes(held[begin : begin + size])
        del held[: begin + size]


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    return parse(inflated(data))


HEADS = "page_id string, uri string, record_type string, digest string, refers_to string"
SEGMENTS = f"origin string, segment int, total long, {HEADS}, block binary"
RECORDS = f"{HEADS}, payload binary, complete boolean"


def head(fields: dict[str, str]) -> list[str | None]:
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    return [
        fields.get("page-id"),
        fields.get("warc-target-uri"),
        fields.get("warc-type"),
        digest,
        fields.get("refers-to-page-id"),
    ]


def decoded(heads: list[str | None], block: bytes | None, complete: bool) -> list[object]:
    """A record of ``RECORDS``; what is cut, malformed or unlike its digest is not complete."""
    complete = complete and block is not None
    if heads[2] == "revisit":
        return [*heads, None, complete]
    try:
        payload = payload_of(block) if complete else None
    except (ValueError, zlib.error):
        payload = None
    if payload is not None and heads[3] not in (None, hashlib.sha256(payload).hexdigest()):
        payload = None
    return [*heads, payload, payload is not None]


def batch_of(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


TEXTS = [pa.field(n.split()[0], pa.string()) for n in HEADS.split(", ")]
SEGMENT_SCHEMA = pa.schema(
    [("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), *TEXTS, ("block", pa.binary())]
)
RECORD_SCHEMA = pa.schema([*TEXTS, ("payload", pa.binary()), ("complete", pa.bool_())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The logical records of all WARC files in a folder, payloads whole and without framing.

    Records in one piece are decoded where they are read. Segments go to the task of the record that
    they continue (``WARC-Segment-Origin-ID``), in the order of their numbers; they make a record if
    the numbers run from 1 without a gap and the total length of the last one is that of the blocks
    together. Segments that came twice count once. A record that lacks a segment, is malformed or
    does not fit its payload digest has a null payload and ``complete`` false; so has one row for what
    is no record at all, and for a gzip member that is cut or damaged. Reading goes on behind it.
    A revisit has no payload of its own. Files are inflated piece by piece.
    """
    python_path(spark)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    )

    def in_batches(rows: Iterator[list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in rows:
            out.append(row)
            size += sum(len(x) for x in row if isinstance(x, bytes))
            if size > BATCH_BYTES:
                yield batch_of(out, schema)
                out, size = [], 0
        yield batch_of(out, schema)

    def number_of(fields: dict[str, str]) -> int | None:
        """The number of a segment, None for records in one piece."""
        number = fields.get("warc-segment-number")
        return int(number) if number and number.isascii() and number.isdigit() else None

    def all_records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes | None]]:
        for batch in batches:
            for content in batch.column(0):
                yield from records_in(content.as_py())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            decoded(head(fields), block, True)
            for fields, block in all_records(batches)
            if number_of(fields) is None
            and (block is None or fields.get("warc-type") in ("response", "revisit", None))
        )
        yield from in_batches(rows, RECORD_SCHEMA)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list]:
            for fields, block in all_records(batches):
                number = number_of(fields)
                if number is not None:
                    total = fields.get("warc-segment-total-length", "")
                    origin = fields.get("warc-segment-origin-id", fields.get("warc-record-id"))
                    yield [origin, number, int(total) if total.isdigit() else None, *head(fields), block]

        yield from in_batches(rows(), SEGMENT_SCHEMA)

    def joined(rows: list[list]) -> list[object]:
        """``rows``: the segments of one record by number."""
        rows = sorted(rows, key=lambda r: (r[1], r[-1] is None))  # a cut copy comes after a whole one
        once = [r for r, before in zip(rows, [[None, None], *rows]) if r[1] != before[1]]
        if any(r[-1] is None for r in once):
            return decoded(once[0][3:8], None, False)
        block = b"".join(r[-1] for r in once)
        numbers = [r[1] for r in once] == list(range(1, len(once) + 1))
        return decoded(once[0][3:8], block, numbers and once[-1][2] == len(block))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for batch in batches:
            out = []
            for row in zip(*[batch.column(i) for i in range(batch.num_columns)]):
                row = [x.as_py() for x in row]
                if rows and row[0] != rows[0][0]:
                    out.append(joined(rows))
                    rows = []
                rows.append(row)
            yield batch_of(out, RECORD_SCHEMA)
        if rows:
            yield batch_of([joined(rows)], RECORD_SCHEMA)

    parts = files.mapInArrow(segments, SEGMENTS)
    grouped = parts.repartition("origin").sortWithinPartitions("origin", "segment")
    return files.mapInArrow(whole, RECORDS).union(grouped.mapInArrow(assemble, RECORDS))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page, from the archives that were written of them."""
    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    read = stage(
        read_archives(spark, path).select(
            F.col("page_id").cast("long").alias("page_id"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"),
            "record_type",
            F.col("refers_to").cast("long").alias("refers_to"),
            "digest",
            "complete",
        ),
        "warc-records",
    )
    responses = (
        read.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("origin"), F.col("payload_digest").alias("origin_digest"))
        .agg(F.first("payload_bytes").alias("origin_bytes"))
    )
    return read.join(
        responses,
        (F.col("refers_to") == F.col("origin")) & (F.col("digest") == F.col("origin_digest")),
        "left",
    ).select(
        "page_id",
        F.coalesce("payload_bytes", "origin_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "origin_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


SQL = """
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN octet_length(encode(h)) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY h)
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(h)) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY h)
            THEN min(page_id) OVER (PARTITION BY h) END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)
"""
