"""WARC archives compressed by Zstandard with a dictionary: writer and reader.

An archive is a skippable frame that holds the dictionary, then one frame for each record, so records
can be decoded one by one. The reader checks every record: version, headers, lengths and, where the
payload is there, its digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, shared_path

ARCHIVE_BYTES = 16 << 20  # payload in an archive, before compression
DICTIONARY_BYTES = 32 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 256, 4 << 10  # what a dictionary is trained on
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_FIELDS = "page_id {kind}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {kind}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: object) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit without the payload if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}"]
    headers.append(f"WARC-Date: {DATE}")
    if url is not None:
        headers.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    headers.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if refers_to is not None:
        headers += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}", "WARC-Truncated: length"]
    headers += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """Trained on the first records; too few or too uniform ones serve as they are."""
    samples = [r[:SAMPLE_BYTES] for r in records[:SAMPLE_RECORDS]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def archive(records: list[bytes]) -> bytes:
    own = dictionary(records)
    pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(own), write_checksum=True)
    head = struct.pack("<II", SKIPPABLE, len(own)) + own
    return head + b"".join(map(pack.compress, records))


def frame_size(data: memoryview) -> int:
    """Bytes of the Zstandard frame that ``data`` starts with, from its block headers."""
    if len(data) < 5 or struct.unpack_from("<I", data)[0] != FRAME:
        raise ValueError("no Zstandard frame")
    at = zstandard.frame_header_size(bytes(data[:18]))
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("frame is cut short")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
    at += 4 * (data[4] >> 2 & 1)
    if at > len(data):
        raise ValueError("frame is cut short")
    return at


def parse(data: bytes) -> dict:
    """Check a record and take it apart."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version or no end of headers")
    headers = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line[:80]!r}")
        headers[key.strip().lower()] = value.strip()
    if missing := [n for n in NEEDED if n not in headers]:
        raise ValueError(f"missing headers {missing}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"content length {headers['content-length']}, but the record has {len(rest) - 4} bytes")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:[ \t]*(\d+)\r?$", http)
    if not found or not http.startswith(b"HTTP/") or not size:
        raise ValueError("no HTTP headers with a length")
    kind, named = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(size[1]) or digest(payload) != named):
        raise ValueError("the payload does not have the stated length and digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in headers):
        raise ValueError("a revisit with payload or without the record it refers to")
    return {
        "page_id": _page(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": int(size[1]),
        "payload_digest": named,
        "record_type": kind,
        "refers_to": _page(headers.get("warc-refers-to")),
    }


def read_archive(content: bytes, path: str) -> Iterator[dict]:
    data, at, own = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise ValueError(f"{path}: the dictionary is cut short")
        raw = bytes(data[8 : 8 + size])
        if raw[:4] == struct.pack("<I", FRAME):  # the dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw)
        own, at = zstandard.ZstdCompressionDict(raw), 8 + size
    unpack = zstandard.ZstdDecompressor(dict_data=own) if own else zstandard.ZstdDecompressor()
    number = 0
    while at < len(data):
        try:
            size = frame_size(data[at:])
            yield parse(unpack.decompress(bytes(data[at : at + size])))
        except (ValueError, zstandard.ZstdError) as error:
            raise ValueError(f"{path}, record {number} at byte {at}: {error}") from error
        at, number = at + size, number + 1


def _write_batches(folder: str, archive_bytes: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        names, counts = [], []

        def close(records: list[bytes]) -> None:
            # A task that runs again has other names; the returned ones are those that count.
            name = f"{task.partitionId():06d}-{len(names):05d}-{task.taskAttemptId()}.warc.zst"
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(archive(records))
            names.append(name)
            counts.append(len(records))

        records, held = [], 0
        for batch in source:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                records.append(record(page_id, url, payload, refers_to))
                held += len(payload)
                if held >= archive_bytes:
                    close(records)
                    records, held = [], 0
        if records:
            close(records)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["name", "records"])

    return batches


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives below ``folder``; returns ``(name, records)`` of each.

    A null html is an empty payload, a null url leaves out the target header. Among equal payloads of at
    least ``min_bytes`` bytes the record with the smallest ``page_id`` is a response (rows that share that
    id too), others are revisits of it; rows without ``page_id`` are responses. Repeated rows are
    records of their own; other columns are ignored. Runs jobs.
    """
    spark = pages.sparkSession
    keyed = pages.select(
        "page_id",
        "url",
        "html",
        F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha"),
        F.coalesce(F.octet_length("html"), F.lit(0)).alias("size"),
    )
    key = ["sha", "size"]
    known = keyed.where(F.col("page_id").isNotNull() & (F.col("size") >= min_bytes)).select("page_id", *key)
    firsts = known.groupBy(*key).agg(F.min("page_id").alias("refers_to"))
    again = checkpointed(known.distinct().join(firsts, key).where("page_id <> refers_to"))
    rows = keyed.join(again, ["page_id", *key], "left").select("page_id", "url", "html", "refers_to")
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    return checkpointed(rows.mapInArrow(_write_batches(folder, archive_bytes), "name string, records long"))


def read_archives(spark: SparkSession, folder: str, written: DataFrame | None = None, kind: str = "bigint") -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)`` per record of a folder's archives.

    With ``written``, only the archives named there: a task that was run again may have left others.
    A record that breaks a rule of the format ends the job with the archive, record and reason.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    if written is not None:
        files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(written.select("name"), "name", "left_semi")
    number = pa.int64() if kind == "bigint" else pa.int32()
    schema = pa.schema(
        [("page_id", number), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", number)]
    )

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows = list(read_archive(content.as_buffer(), path.as_py()))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path", "content").mapInArrow(batches, RECORD_FIELDS.format(kind=kind))


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to the shared folder and read the records back. Without any row, there are no records."""
    spark = pages.sparkSession
    kind = dict(pages.dtypes)["page_id"]
    folder = shared_path(spark, "warc")
    written = write_archives(pages, folder, min_bytes)
    if not written.take(1):
        return spark.createDataFrame([], RECORD_FIELDS.format(kind=kind))
    return read_archives(spark, folder, written, kind)
