"""WARC archives in Zstandard with an embedded dictionary, and their reader.

Every partition becomes archives of bounded size. Its writer holds the first ``sample_bytes`` of its
records, builds a dictionary from them, writes the dictionary in a leading skippable frame of each archive,
and then every record as a frame of its own, so any record can be read alone. Archives are written by Spark
itself: each row is a block of frames, a file takes a fixed number of rows, and the "line end" between rows
is an empty skippable frame, which readers pass over.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest page id is a
response; the others are revisits that refer to it and carry no payload. The first id of a payload is
found by aggregation, so a payload with many copies is not gathered anywhere.

A null html is an empty payload; a null url leaves out the target header. A null page id counts after
all others. Repeated rows with the smallest page id are all responses. No pages, no archives.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Magic numbers and names of the file formats; fixed values.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
BETWEEN = "P*M\x18\x00\x00\x00\x00"  # an empty skippable frame
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NULL_ID = "null"


def record(page: str, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record; a revisit has the HTTP headers of its payload, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[str, int, str, str, str | None]:
    """Page, payload size, digest, type and what it refers to, read from a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
    kind = fields["WARC-Type"]
    if kind == "response":
        return page, len(payload), hashlib.sha256(payload).hexdigest(), kind, None
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    return page, size, digest, kind, fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">")


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples' last bytes."""
    if len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def skippable(magic: int, data: bytes) -> bytes:
    return magic.to_bytes(4, "little") + len(data).to_bytes(4, "little") + data


def frames(archive: memoryview) -> Iterator[tuple[int, memoryview]]:
    """The magic number and bytes of each frame; skippable frames without their header."""
    at = 0
    while at < len(archive):
        magic = int.from_bytes(archive[at : at + 4], "little")
        if magic in SKIPPABLE:
            size = int.from_bytes(archive[at + 4 : at + 8], "little")
            yield magic, archive[at + 8 : at + 8 + size]
            at += 8 + size
            continue
        start = at
        checksum = archive[at + 4] >> 2 & 1
        at += zstandard.frame_header_size(archive[at : at + 18])
        last = False
        while not last:
            block = int.from_bytes(archive[at : at + 3], "little")
            last = bool(block & 1)
            at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)  # a run-length block holds one byte
        at += 4 * checksum
        yield magic, archive[start:at]


def records(archive: bytes) -> Iterator[bytes]:
    """All records of an archive."""
    reader = zstandard.ZstdDecompressor()
    for magic, data in frames(memoryview(archive)):
        if magic == DICTIONARY_MAGIC:
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data)))
        elif magic not in SKIPPABLE:
            yield reader.decompress(data)


def write_archives(
    pages: DataFrame,
    path: str,
    least: int = 100,
    date: str = "2024-01-01T00:00:00Z",
    sample_bytes: int = 1 << 20,
    dictionary_bytes: int = 64 << 10,
    level: int = 3,
    block_bytes: int = 4 << 20,
    blocks: int = 16,
) -> None:
    """Write ``page_id``, ``url`` and ``html`` of all pages as archives under ``path``.

    An archive is at most ``blocks`` blocks of frames; a block is closed once it has ``block_bytes``. So an archive is
    no larger than 64 MB and ``blocks`` records, however much a task holds, and each begins with the dictionary.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id"),
        F.col("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    copied = (
        rows.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    later = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    typed = rows.join(copied, "digest", "left").select(
        F.coalesce(F.col("page_id").cast("string"), F.lit(NULL_ID)).alias("page"),
        "url",
        F.when(later, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "size",
        "digest",
        F.when(later, F.col("first").cast("string")).alias("refers_to"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_records() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*batch.columns):
                    yield record(*(x.as_py() for x in row), date=date)

        source = all_records()
        held, size = [], 0
        for raw in source:
            held.append(raw)
            size += len(raw)
            if size >= sample_bytes:
                break
        if not held:
            return
        trained = dictionary(held, dictionary_bytes)
        writer = zstandard.ZstdCompressor(
            level, dict_data=zstandard.ZstdCompressionDict(trained), write_checksum=True, write_content_size=True
        )
        head = skippable(DICTIONARY_MAGIC, trained)
        out, size, written = [head], 0, 0
        for part in (held, source):
            for raw in part:
                if size >= block_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], names=["block"])
                    written += 1
                    # The writer begins a new file after this many rows of a task.
                    out, size = ([] if written % blocks else [head]), 0
                out.append(writer.compress(raw))
                size += len(out[-1])
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], names=["block"])

    framed = typed.mapInArrow(run, "block binary").select(F.col("block").cast("string"))
    framed.write.option("lineSep", BETWEEN).option("maxRecordsPerFile", blocks).text(path)


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """One row per record of all archives under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = [parsed(raw) for raw in records(content.as_buffer())]
                if found:
                    columns = list(zip(*found))
                    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = files.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.withColumns(
        {
            "page_id": F.when(F.col("page_id") != NULL_ID, F.col("page_id")).cast(id_type),
            "refers_to": F.col("refers_to").cast(id_type),
        }
    )
