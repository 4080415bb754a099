"""Landed responses: reading, parsing, setting bad ones aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions.payload import with_document

CAPTURE_SCHEMA = """
    capture_id STRING, url STRING, kind STRING, book_slug STRING, chapter_slug STRING,
    page BIGINT, route STRING, build_id STRING, status INT, retry_after STRING,
    fetched_at TIMESTAMP, body STRING
"""

MAX_RESPONSE_BYTES = 64 * 1024 * 1024
PREVIEW_CHARS = 500


def read_captures(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Captures landed as parquet, JSON lines or ORC; no schema inference."""
    return spark.read.schema(CAPTURE_SCHEMA).format(file_format).load(path)


def load_captures(captures: DataFrame) -> DataFrame:
    """Add ``doc``: the parsed body of each JSON capture, null if malformed.

    Page HTML is kept as text and not parsed; a capture of unknown kind is.
    """
    return with_document(captures, when=~F.col("kind").eqNullSafe("page_html"))


def quarantine_payloads(captures: DataFrame, max_bytes: int = MAX_RESPONSE_BYTES) -> DataFrame:
    """Add ``doc``, ``error_code`` and ``preview``; rows without a code are good.

    The size is checked first, so a body over the limit is never parsed.
    """
    fits = F.octet_length("body") <= max_bytes
    parsed = with_document(captures, when=fits)
    code = F.when(~fits, F.lit("RESPONSE_TOO_LARGE")).when(F.col("doc").isNull(), F.lit("INVALID_PAYLOAD"))
    return parsed.withColumn("error_code", code).withColumn(
        "preview", F.when(F.col("error_code") == "INVALID_PAYLOAD", F.left("body", F.lit(PREVIEW_CHARS)))
    )
