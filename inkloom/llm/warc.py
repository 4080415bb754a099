"""WARC archives compressed record by record with a Zstandard dictionary of their own."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, col
from pyspark.sql.types import StringType

DICTIONARY_FRAME = 0x184D2A5D  # magic number of the skippable frame that holds the dictionary
DICTIONARY_BYTES = 64 * 1024
ARCHIVE_BYTES = 4_000_000  # records of an archive before compression; a longer record is one of its own
LEVEL = 3
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of names that are URLs
DATE = "2024-01-01T00:00:00Z"  # where the caller has none


@arrow_udf(StringType())
def payload_digest(payloads: pa.Array) -> pa.Array:
    """Bare upper-case base32 SHA-1 of a text in UTF-8; of nothing for a null."""
    return pa.array([base64.b32encode(hashlib.sha1((p.as_py() or "").encode()).digest()).decode() for p in payloads], pa.string())


def record(kind: str, key: str, url: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record with its headers.  A revisit holds no payload but says its length and what it repeats."""
    body = payload if kind == "response" else b""
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, key)}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-Id", key),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(body))),
    ]
    if refers_to is not None:
        headers.insert(5, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.insert(6, ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, refers_to)}>"))
        headers.insert(7, ("X-Refers-To-Page", refers_to))
    lines = "".join(f"{name}: {' '.join(value.split())}\r\n" for name, value in headers)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def compress_archive(records: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES, level: int = LEVEL) -> bytes:
    """An archive: the dictionary in a leading skippable frame, then a frame for each record.

    The dictionary is built from the archive's own records.  Too few or too
    small records for one give an empty dictionary frame and plain frames.
    """
    total = sum(map(len, records))
    try:
        size = min(dictionary_bytes, total // 8)
        # pieces of long records, so that one of them doesn't make the whole dictionary
        trained = zstandard.train_dictionary(size, [r[i : i + 16384] for r in records for i in range(0, len(r), 16384)], level=level)
        raw = trained.as_bytes()
    except (zstandard.ZstdError, ValueError):
        trained, raw = None, b""
    press = zstandard.ZstdCompressor(level=level, dict_data=trained) if trained else zstandard.ZstdCompressor(level=level)
    return struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw + b"".join(map(press.compress, records))


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each record of an archive, one frame after another."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    raw = content[8 : 8 + size]
    options = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
    rest = content[8 + size :]
    while rest:
        frame = zstandard.ZstdDecompressor(**options).decompressobj()
        plain = frame.decompress(rest)
        rest = frame.unused_data
        head, _, body = plain.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines if ": " in line)
        if not version.startswith("WARC/") or len(body) != int(headers["Content-Length"]) + 4:
            raise ValueError(f"a broken record: {version}")
        yield headers, body[:-4]


def with_revisits(
    pages: DataFrame, id_column: str = "page_id", payload_column: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Add ``payload_digest``, ``record_type`` and ``refers_to``.

    Of pages with equal payloads of at least ``min_bytes`` bytes that with the
    largest id is the response and the others revisit it; rows that repeat that
    id are responses too.  Smaller payloads are all responses.  Null payloads
    are empty ones.  Among pages without any id all are responses.
    """
    size = F.coalesce(F.octet_length(payload_column), F.lit(0))
    named = pages.withColumn("payload_digest", payload_digest(F.col(payload_column)))
    # digests that occur once need no partner: only the others, counted before the shuffle, are joined
    groups = pages.where(size >= min_bytes).select(payload_digest(F.col(payload_column)).alias("payload_digest"), F.col(id_column).alias("id"))
    groups = groups.groupBy("payload_digest").agg(F.max("id").alias("__latest"), F.count(F.lit(1)).alias("n"))
    repeated = groups.where("n > 1 and __latest is not null").select("payload_digest", "__latest")
    joined = named.join(repeated, "payload_digest", "left")
    latest = F.when(size >= min_bytes, F.col("__latest"))
    revisit = latest.isNotNull() & ~F.col(id_column).eqNullSafe(latest)
    kind = F.when(revisit, "revisit").otherwise("response")
    return joined.withColumns({"record_type": kind, "refers_to": F.when(revisit, latest)}).drop("__latest")


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> None:
    """Write a record per page into archives, one row each: ``archive_id``, ``records``, ``content``.

    ``content`` is a complete ``.warc.zst`` file.  The rows go to Parquet, whose
    commit keeps the output whole when an executor is lost; the folder may be in
    any store that Spark writes.  A task fills one archive after another and
    holds one, so its memory is bounded by ``archive_bytes`` or the longest
    record.  Null urls are empty, null ids are written as empty ones.  An empty
    table writes no archive.
    """
    marked = with_revisits(
        pages.select(col(id_column).cast("string").alias("text_id"), col(id_column).alias("id"), col(url_column).alias("url"), col(payload_column).alias("payload")),
        "id", "payload", min_bytes,
    )
    rows = marked.select("text_id", "url", "payload", "payload_digest", "record_type", col("refers_to").cast("string"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def done() -> pa.RecordBatch:
            content = compress_archive(held, dictionary_bytes)
            name = hashlib.sha1(content).hexdigest()  # the same again when a task is repeated
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(held)], pa.int64()), pa.array([content], pa.binary())],
                ["archive_id", "records", "content"],
            )

        for batch in batches:
            for key, url, payload, digest, kind, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                made = record(kind, key or "", url or "", (payload or "").encode(), digest, refers_to, DATE)
                if held and size + len(made) > archive_bytes:
                    yield done()
                    held, size = [], 0
                held.append(made)
                size += len(made)
        if held:
            yield done()

    rows.mapInArrow(write, "archive_id string, records long, content binary").write.parquet(path)


def read_records(archives: DataFrame) -> DataFrame:
    """The records of archives: ids and urls as written, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to``, ``body``.

    The body of each response is checked against its digest.  Archives are read
    one at a time and their records handed on in small batches.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "body"]
    schema = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, body binary"

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        text = pa.string()
        kinds = [text, text, text, pa.int64(), text, text, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, body in read_archive(content.as_py()):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError(f"the payload of page {head['X-Page-Id']} does not have its digest")
                    rows.append((
                        head["X-Page-Id"] or None, head["WARC-Target-URI"], head["WARC-Type"], int(head["X-Payload-Length"]),
                        digest, head.get("X-Refers-To-Page"), body,
                    ))
                    if len(rows) == 256:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return archives.select("content").mapInArrow(read, schema)
