import base64
import hashlib
import struct

import pytest
import zstandard
from llm_cases import prose

from millrace.cluster import shared_path
from millrace.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id bigint, url string, html string, sha string, size int")


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


ROWS = [
    (5, "http://a/1", "same"), (2, "http://a/2", "same"), (9, None, "same"), (3, "http://b/ x\r\ny", "ü" * 70_000), (4, "u", None),
    (6, "u", ""), (7, "u", "ü" * 70_000), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (2, "http://a/2", "same"), (None, "u", "same"),
    *((100 + i, f"http://c/{i}", prose(i, 200)) for i in range(40)),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    first = {}
    for i, _, h in ROWS:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        home = first.get(h or "")
        again = i is not None and home is not None and i != home
        want.append((i, len((h or "").encode()), sha(h or ""), "revisit" if again else "response", home if again else None))
    got = warc.archived(pages(spark, ROWS), least).drop("url")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_many_archives_and_urls(spark):
    folder = shared_path(spark, "warc-test")
    written = warc.write_archives(pages(spark, ROWS), folder, archive_bytes=10_000)
    assert written.count() > 3
    rows = warc.read_archives(spark, folder, written).collect()
    assert len(rows) == len(ROWS)
    assert {r.page_id: r.url for r in rows}[3] == "http://b/%20x%0D%0Ay" and {r.page_id: r.url for r in rows}[9] is None


def content():
    return warc.archive([warc.record(i, f"http://a/{i}", f"<p>{prose(i, 50)}".encode(), None) for i in range(30)])


def test_one_frame_per_record_after_the_dictionary():
    data = content()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    own = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    at = 8 + size
    frames = 0
    while at < len(data):
        length = warc.frame_size(memoryview(data)[at:])
        text = zstandard.ZstdDecompressor(dict_data=own).decompress(data[at : at + length])
        assert text.startswith(b"WARC/1.1\r\n")
        at, frames = at + length, frames + 1
    assert frames == 30 and [r["page_id"] for r in warc.read_archive(data, "a")] == list(range(30))


def test_compressed_dictionary_and_none():
    data = content()
    size = struct.unpack_from("<I", data, 4)[0]
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    again = struct.pack("<II", 0x184D2A5D, len(packed)) + packed + data[8 + size :]
    assert len(list(warc.read_archive(again, "a"))) == 30
    plain = zstandard.ZstdCompressor().compress(warc.record(1, None, b"x", None))
    assert [r["payload_bytes"] for r in warc.read_archive(plain, "a")] == [1]


def broken():
    good = warc.record(1, "u", b"payload", None)
    yield good.replace(b"WARC/1.1", b"HTTP/9.9")
    yield good.replace(b"WARC-Date", b"Date")
    yield good.replace(b"payload\r\n", b"pay\r\n")
    yield good.replace(b"payload\r\n", b"PAYLOAD\r\n")
    yield good[:-2]
    yield good.replace(b"WARC-Type: response", b"no colon here")


def test_broken_records_are_refused():
    data = content()
    with pytest.raises(ValueError, match="record 29"):
        list(warc.read_archive(data[:-3], "a"))
    for bad in broken():
        with pytest.raises(ValueError, match="record 0"):
            list(warc.read_archive(zstandard.ZstdCompressor().compress(bad), "a"))


def test_empty_table(spark):
    assert warc.archived(pages(spark, ROWS).limit(0)).count() == 0
