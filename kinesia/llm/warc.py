"""WARC archives compressed with an embedded Zstandard dictionary: writer and reader.

Each archive starts with a skippable frame holding a dictionary built from a bounded
sample of that archive's own records (the ``.warc.zst`` layout), then one frame per
record. Pages with equal payloads are written once as a response; the others are
``revisit`` records that name it. Tasks write under a temporary name and rename, so
a repeated task leaves one whole archive. Archives go to and come from the shared
folder only.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_FRAME = 0x184D2A5D  # fixed value: skippable frame that holds a dictionary
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20  # records the dictionary is built from, from the front of an archive
ARCHIVE_BYTES = 8 << 20  # an archive is closed once it is this large
WINDOW_BYTES = 16 << 10
LEVEL = 6
EPOCH = "1970-01-01T00:00:00Z"  # fixed date: reruns write the same bytes
PAGE = "urn:x-page:"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def build_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head (with the full length) without the body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>",
        f"WARC-Date: {EPOCH}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{PAGE}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record: page_id, url, record_type, refers_to, digest, payload, payload_bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = fields["WARC-Type"]
    if kind == "response" and len(body) != length:
        raise ValueError("a record's payload is not whole")
    page = lambda name: (lambda v: int(v) if v else None)(fields[name].strip("<>").removeprefix(PAGE)) if name in fields else None
    return {
        "page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind,
        "refers_to": page("WARC-Refers-To"), "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": body if kind == "response" else None, "payload_bytes": length,
    }


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; with too few to train on, their last bytes as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:].rjust(8, b"\0"), zstandard.DICT_TYPE_RAWCONTENT)


def archive_bytes(records: list[bytes], sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A whole archive: skippable frame with the dictionary, then a frame per record."""
    samples, size = [], 0
    for r in records:
        if size >= sample_bytes:
            break
        samples.append(r[: sample_bytes - size])  # a sample only; records are compressed whole
        size += len(samples[-1])
    dictionary = build_dictionary(samples)
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
    frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(packed)), packed, *(frames.compress(r) for r in records)])


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    raw = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    dictionary = zstandard.ZstdCompressionDict(raw, kind)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    view, at = memoryview(data), 8 + size
    while at < len(data):
        frame, record = decompressor.decompressobj(), []
        while not frame.eof:  # a window at a time: what lies behind the frame is copied
            if at >= len(data):
                raise ValueError("the archive ends within a record")
            window = view[at : at + WINDOW_BYTES]
            record.append(frame.decompress(window))
            at += len(window) - len(frame.unused_data)
        yield b"".join(record)


def make_folder(spark: SparkSession, folder: str) -> None:
    """Make the folder, so that an empty table leaves a folder that can be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def _open_folder(folder: str):
    """(filesystem, path) of a shared folder given as a path or a URI."""
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, archive_limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages; returns the manifest (archive, records), not yet run.

    ``pages`` has page_id, url, html. Payload: the html in UTF-8, null is empty. Of
    records with equal payloads of at least ``min_revisit_bytes`` the smallest page_id
    is the response. Rows without a page_id are responses of their own unless another
    row has their payload; then they revisit it.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    strong = F.sha2("html", 256)
    first = (
        rows.filter(F.octet_length("html") >= min_revisit_bytes)
        .groupBy(strong.alias("k"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("k", "first_id")
    )
    # only payloads that occur again are looked up; the key is 256 bits of the payload
    marked = rows.withColumn("k", strong).join(first, "k", "left")
    marked = marked.withColumn("refers_to", F.when(F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(None)).otherwise(F.col("first_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = _open_folder(folder)
        filesystem.create_dir(path, recursive=True)
        task, count = TaskContext.get().partitionId(), 0

        def close(records: list[bytes]) -> pa.RecordBatch:
            nonlocal count
            name = f"part-{task:06d}-{count:05d}.warc.zst"
            count += 1
            hidden = f"{path}/_{name}.{uuid.uuid4().hex}"
            with filesystem.open_output_stream(hidden) as out:
                out.write(archive_bytes(records))
            filesystem.move(hidden, f"{path}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(records)], pa.int64())], ["archive", "records"])

        records, size = [], 0
        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(i) for i in range(4))):
                payload = html.as_py().encode("utf-8")
                records.append(build_record(page_id.as_py(), url.as_py(), payload, payload_digest(payload), refers.as_py()))
                size += len(records[-1])
                if size >= archive_limit:
                    yield close(records)
                    records, size = [], 0
        if records:
            yield close(records)

    return marked.select("page_id", "url", "html", "refers_to").mapInArrow(run, "archive string, records long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest.

    Of a response length and digest are taken from the payload read back, of a revisit
    from its header. A response whose payload does not have its digest is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out, size = [], 0
                for data in read_archive(batch.column(0)[i].as_buffer()):
                    r = parse_record(data)
                    if r["record_type"] == "response":
                        r["payload_bytes"] = len(r["payload"])
                        if payload_digest(r["payload"]) != r["digest"]:
                            raise ValueError(f"page {r['page_id']}: the payload read back does not have its digest")
                    out.append(r)
                    size += len(data)
                    if size >= 4 << 20:
                        yield _batch(out)
                        out, size = [], 0
                if out:
                    yield _batch(out)

    return files.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64()}
    columns = [pa.array([r[k] for r in rows], t) for k, t in kinds.items()]
    return pa.RecordBatch.from_arrays([*columns, pa.array([r["digest"] for r in rows], pa.string())], [*kinds, "payload_digest"])
