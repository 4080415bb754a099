"""Document fingerprints: quartile bucket digests of hashed byte triplets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

BUCKETS = 256
# Offsets of the bytes of a triplet in its window: near and far ones, so that word endings and beginnings count too.
SPANS = ((0, 1, 2), (0, 2, 5), (0, 3, 7))
LENGTH_STEP = 1.1  # ratio of lengths with neighbouring codes
# What a pair of quartile codes adds to the difference: opposite ends count double.
APART = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])
LENGTH_CODES = 24  # differences of the length code count up to here


def _buckets(data: np.ndarray, buckets: int) -> np.ndarray:
    """Counts of the hashed triplets of the bytes."""
    counts = np.zeros(buckets, np.int64)
    wide = data.astype(np.uint32)
    for number, (a, b, c) in enumerate(SPANS):
        if len(wide) > c:
            end = len(wide) - c
            mixed = wide[a : a + end] << 16 | wide[b : b + end] << 8 | wide[c : c + end]
            mixed = (mixed + np.uint32(number << 24)) * np.uint32(2654435761)
            mixed ^= mixed >> 15
            mixed *= np.uint32(2246822519)
            counts += np.bincount(mixed >> np.uint32(32 - buckets.bit_length() + 1), minlength=buckets)
    return counts


def digest(data: bytes, buckets: int = BUCKETS) -> str:
    """Hex digest: two digits for the logarithm of the length, then two bits for each bucket's quartile.

    A bucket's code is the number of quartiles of all bucket counts that it
    exceeds.  Empty data has length code 0 and all codes 0.
    """
    length = 1 + min(254, int(math.log(len(data), LENGTH_STEP))) if data else 0
    counts = _buckets(np.frombuffer(data, np.uint8), buckets)
    ranked = np.sort(counts)
    codes = np.searchsorted(ranked[[buckets // 4 - 1, buckets // 2 - 1, 3 * buckets // 4 - 1]], counts, "left").astype(np.uint8)
    four = codes.reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return f"{length:02x}" + packed.tobytes().hex()


def _codes(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8)
    return np.stack([raw >> 6, raw >> 4 & 3, raw >> 2 & 3, raw & 3], axis=1).ravel()


def likeness(one: str, other: str) -> float:
    """1 for equal digests, falling with their difference to 0, its bound.

    The difference adds what each bucket's two codes lie apart and, for a
    twelfth at most, the distance of the length codes.  It is measured against
    what buckets with these codes give when they are dealt out anew, and bounded
    by twice that, so unrelated data, short or long, is at about one half.
    """
    a, b = bytes.fromhex(one), bytes.fromhex(other)
    if a == b:
        return 1.0
    first, second = _codes(a[1:]), _codes(b[1:])
    apart = APART[first, second].sum()
    unrelated = np.bincount(first, minlength=4) @ APART @ np.bincount(second, minlength=4) / len(first)
    lengths = min(abs(a[0] - b[0]), LENGTH_CODES) / LENGTH_CODES / 12
    return float(max(0.0, 1 - apart / max(2 * unrelated, 1.0) - lengths))


def with_next(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranges: int | None = None
) -> DataFrame:
    """(id, text, next_text): each document beside the one that follows by descending id; the first follows the last.

    Ids are cut into ranges of about equal counts, and each range is sorted.
    The first document of the range below is sent along, so every neighbour is
    met in one pass without a join of texts.  Null ids come last; equal ids are
    ordered by their text.  Null texts count as empty.  A single document
    follows itself.
    """
    spark = docs.sparkSession
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    # a bounded number of cuts reaches the driver
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.where("id is not null").approxQuantile("id", shares, 0.25 / ranges) if shares else []
    cuts = sorted({int(c) for c in cuts}, reverse=True)
    level = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda cut: col("id") <= cut)) if cuts else F.lit(0)
    rows = rows.withColumn("range", F.when(col("id").isNull(), len(cuts) + 1).otherwise(level))
    first = rows.groupBy("range").agg(F.max("id").alias("id")).orderBy("range").collect()  # one row a range
    # the first document of a range also ends the range before it; that table has a row a range
    tops = [(r["range"], r["id"], first[i - 1]["range"]) for i, r in enumerate(first)]
    tops = spark.createDataFrame(tops, f"top_range int, top_id {kind}, to int")
    is_top = (col("range") == col("top_range")) & col("id").eqNullSafe(col("top_id"))
    rows = rows.join(F.broadcast(tops), is_top, "left")
    here, there = [F.struct(r.alias("range"), F.lit(t).alias("tail")) for r, t in ((col("range"), 0), (col("to"), 1))]
    places = F.explode(F.when(col("to").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("place")
    dealt = rows.select("id", "text", places).select("place.range", "place.tail", "id", "text")
    order = [col("range"), col("tail"), F.desc_nulls_last("id"), col("text")]
    dealt = dealt.repartition(ranges, "range").sortWithinPartitions(*order)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, id, text) of a document that waits for the next
        for batch in batches:
            ids, texts, following = [], [], []
            for own, tail, key, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0] == own:
                    ids.append(held[1])
                    texts.append(held[2])
                    following.append(text)
                held = None if tail else (own, key, text)
            columns = [pa.array(ids, batch.schema.field("id").type), pa.array(texts, pa.string()), pa.array(following, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "text", "next_text"])

    return dealt.mapInArrow(pair, f"`{id_column}` {kind}, text string, next_text string")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of another."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprint_neighbors(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Fingerprint each document, its edited text (see ``edited``) and the document that follows it (see ``with_next``).

    Returns per row: id, ``n_chars``, ``edited_text``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (likeness of the
    first to the second and to the next document's).  Equal texts have equal
    fingerprints.  Repeated rows follow one another; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, str] = {}  # the next document's digest is used again as its own
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for text, following in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    own = made.get(text) or digest(text.encode(), buckets)
                    after = digest(following.encode(), buckets)
                    made = {following: after}
                    changed = edited(text, following)
                    other = digest(changed.encode(), buckets)
                    rows.append((len(text), changed, own, other, likeness(own, other), likeness(own, after)))
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                names = ["n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], [id_column, *names])

    return with_next(docs, id_column, text_column).mapInArrow(measure, schema)
