"""Archives as others write them: a gzip member per record, cut files, broken records."""

import gzip
import hashlib
import random
import time
import zlib

from editstream.llm import warc


def member(i, payload=None, **more):
    payload = f"payload {i} ".encode() * 3 if payload is None else payload
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:{i}>", "Page-ID": i}
    fields["WARC-Payload-Digest"] = "sha256:" + hashlib.sha256(payload).hexdigest()
    made = warc.record(fields | more, warc.HTTP + b"\r\n" + payload)
    return made + warc.END.encode()


def read(data):
    found = [(f.get("page-id"), b) for f, b in warc.records_in(data)]
    return [(i, None if b is None else b.partition(b"\r\n\r\n")[2]) for i, b in found]


def test_a_member_per_record_is_read_in_linear_time():
    rng = random.Random(1)
    payloads = [rng.randbytes(8_000) for _ in range(4_000)]
    data = b"".join(gzip.compress(member(i, p), 1) for i, p in enumerate(payloads))
    assert len(data) > 32_000_000
    started = time.process_time()
    found = read(data)
    took = time.process_time() - started
    assert found == [(str(i), p) for i, p in enumerate(payloads)]
    assert took < 2


def test_plain_gzipped_and_mixed_members_are_equal():
    made = [member(i) for i in range(9)]
    whole = b"".join(made)
    want = read(whole)
    assert [i for i, _ in want] == [str(i) for i in range(9)]
    assert read(gzip.compress(whole)) == want
    assert read(b"".join(map(gzip.compress, made))) == want
    assert read(gzip.compress(b"".join(made[:4])) + gzip.compress(b"".join(made[4:]))) == want
    # Members that end within a record.
    assert read(gzip.compress(whole[:333]) + gzip.compress(whole[333:])) == want
    assert read(b"") == []


def test_records_after_a_broken_one_are_read():
    good = [member(i) for i in range(3)]
    no_length = b"WARC/1.1\r\nPage-ID: x\r\nWARC-Type: response\r\n\r\nabc" + warc.END.encode()
    odd_length = no_length.replace(b"Page-ID: x", b"Page-ID: y\r\nContent-Length: -5")
    no_record = b"something else altogether" + warc.END.encode()
    for broken, name in ((no_length, "x"), (odd_length, "y"), (no_record, None)):
        data = good[0] + broken + good[1] + good[2]
        for whole in (data, gzip.compress(data)):
            assert [(i, b is None) for i, b in read(whole)] == [("0", False), (name, True), ("1", False), ("2", False)]


def test_cut_and_damaged_members_are_told():
    made = [gzip.compress(member(i, random.Random(i).randbytes(3_000))) for i in range(4)]
    cut = made[0] + made[1] + made[2][: len(made[2]) // 2]
    assert [(i, b is None) for i, b in read(cut)] == [("0", False), ("1", False), ("2", True)]
    damaged = bytearray(made[1])
    damaged[len(damaged) // 2] ^= 0xFF
    found = read(made[0] + bytes(damaged) + made[2] + made[3])
    assert [i for i, b in found if b is not None] == ["0", "2", "3"]
    assert sum(b is None for _, b in found) >= 1
    plain = member(0) + member(1)[:-30]
    assert [(i, b is None) for i, b in read(plain)] == [("0", False), ("1", True)]


def test_broken_files_do_not_end_the_job(spark, tmp_path):
    (tmp_path / "part-0.gz").write_bytes(gzip.compress(member(1)) + gzip.compress(member(2))[:-40])
    (tmp_path / "part-1.warc").write_bytes(b"no archive at all")
    (tmp_path / "part-2.warc").write_bytes(member(3, **{"WARC-Type": None}) + member(4, **{"WARC-Segment-Number": "x"}))
    (tmp_path / "part-3.gz").write_bytes(b"")
    (tmp_path / "part-4.warc").write_bytes(member(5, **{"WARC-Type": "warcinfo"}) + member(6, **{"WARC-Payload-Digest": "sha256:0"}))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    found = sorted((str(r.page_id), r.complete, r.payload is None) for r in rows)
    assert found == [
        ("1", True, False), ("2", False, True), ("3", True, False), ("4", True, False),
        ("6", False, True), ("None", False, True),
    ]


def test_clashing_columns_of_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 200), (2, "v", "x" * 200), (3, None, None)], "page_id long, url string, html string")
    names = ["id", "order", "payload", "digest", "n", "copied", "least", "refers_to", "value"]
    pages = pages.withColumns({n: pages.url for n in names})
    warc.write_archives(pages, f"{tmp_path}/a")
    rows = {r.page_id: (r.record_type, r.complete, r.refers_to) for r in warc.read_archives(spark, f"{tmp_path}/a").collect()}
    assert rows == {"1": ("response", True, None), "2": ("revisit", True, "1"), "3": ("response", True, None)}


def test_inflating_holds_a_piece_at_a_time():
    data = gzip.compress(b"\0" * 50_000_000)
    assert max(len(p) for p in warc.inflated(data)) <= 50_000_000
    assert zlib.crc32(b"".join(warc.inflated(data))) == zlib.crc32(b"\0" * 50_000_000)
