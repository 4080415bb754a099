"""Catalog search for tables of needles: a written index of three-character grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions.html import html_text
from inkloom.functions.text import search_form
from inkloom.session import through_storage

GRAM = 3
BETWEEN = "\u0000"  # stands between the fields of a book; no needle reaches over it
LISTS = 3  # of a needle's grams, so many of the rarest are intersected
FEW = 32  # texts that are verified without another list
SLICE_CHARS = 2_000_000  # characters of the texts that share an index
SLICE_TEXTS = 1 << 16  # their number at most; places are kept in 16 bits
NEEDLES = 100_000  # needles that meet a slice at once
CHAR_BITS = 21


@dataclass
class SearchIndex:
    """``slices``: some books each, with their keys and searched texts, their distinct ``grams``, and the ``places`` of each gram's books in the slice."""

    slices: DataFrame


def _codes(text: str, size: int) -> np.ndarray:
    """The runs of ``size`` characters as numbers, by place."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = points[: max(0, len(points) - size + 1)]
    for i in range(1, size):
        codes = (codes << CHAR_BITS) | points[i : len(points) - size + 1 + i]
    return codes


def _grams(text: str) -> np.ndarray:
    """Distinct grams that lie in one field, found a part of the text at a time."""
    found = [np.unique(_codes(part[at : at + SLICE_CHARS + GRAM - 1], GRAM)) for part in text.split(BETWEEN) for at in range(0, len(part), SLICE_CHARS)]
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0] if found else np.empty(0, np.int64)


def searchable(books: DataFrame, key: str = "key", include_description: bool = True) -> DataFrame:
    """(key, form): what a book is searched by: titles and the text of the description, each in search form."""
    fields = [F.col("title"), F.col("title_en")] + ([html_text(F.col("description_html"))] if include_description else [])
    forms = [F.coalesce(F.replace(search_form(f), F.lit(BETWEEN), F.lit(" ")), F.lit("")) for f in fields]
    return books.select(F.col(key).alias("key"), F.concat_ws(BETWEEN, *forms).alias("form"))


def write_search_index(books: DataFrame, path: str, key: str = "key", include_description: bool = True) -> SearchIndex:
    """Write the index of all books to a folder.

    A slice of the books is indexed where it lies, so nothing is shuffled: each
    distinct gram of a slice has the places of its books, two bytes each.  A
    text longer than a slice is one of its own.
    """
    forms = searchable(books, key, include_description)
    kind = forms.schema["key"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, grams, held = [], [], [], 0

        def done() -> pa.RecordBatch:
            code, place = np.concatenate(grams), np.repeat(np.arange(len(grams)).astype(np.uint16), [len(g) for g in grams])
            order = np.argsort(code, kind="stable")
            distinct, starts = np.unique(code[order], return_index=True)
            row = [pa.array([keys], pa.list_(key_type)), pa.array([texts], pa.list_(pa.string()))]
            row += [pa.array([a.tobytes()], pa.binary()) for a in (distinct, np.append(starts, len(code)).astype(np.int64), place[order])]
            for held_rows in (keys, texts, grams):
                held_rows.clear()
            return pa.RecordBatch.from_arrays(row, ["keys", "forms", "grams", "starts", "places"])

        for batch in batches:
            key_type = batch.column(0).type
            for own, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if texts and (held + len(text) > SLICE_CHARS or len(texts) == SLICE_TEXTS):
                    yield done()
                    held = 0
                keys.append(own.as_py())
                texts.append(text)
                grams.append(_grams(text))
                held += len(text)
        if texts:
            yield done()

    schema = f"keys array<{kind}>, forms array<string>, grams binary, starts binary, places binary"
    forms.mapInArrow(index, schema).write.parquet(f"{path}/slices")
    return read_search_index(books.sparkSession, path)


def read_search_index(spark: SparkSession, path: str) -> SearchIndex:
    return SearchIndex(spark.read.parquet(f"{path}/slices"))


class _Needles:
    """A block of needles with the numbers of their grams."""

    def __init__(self, block: pa.StructArray):
        self.needles, wanted = block.field("needle"), block.field("wanted").to_pylist()
        self.wanted = wanted
        self.long = [i for i, w in enumerate(wanted) if len(w) >= GRAM]
        codes = [np.unique(_codes(wanted[i], GRAM)) for i in self.long]
        self.codes = np.concatenate(codes) if codes else np.empty(0, np.int64)
        self.starts = np.cumsum([0, *[len(c) for c in codes]])
        self.short = {}
        for size in range(1, GRAM):
            own = np.array([i for i, w in enumerate(wanted) if len(w) == size], np.int64)
            code = np.array([_codes(wanted[i], size)[0] for i in own], np.int64)
            order = np.argsort(code, kind="stable")
            self.short[size] = own[order], code[order]


def _meet(texts: list[str], grams: np.ndarray, starts: np.ndarray, places: np.ndarray, asked: _Needles, lists: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of needles, places of texts that hold them) of a slice."""
    if len(asked.codes) and len(grams):
        at = np.minimum(np.searchsorted(grams, asked.codes), len(grams) - 1)
        every = np.logical_and.reduceat(grams[at] == asked.codes, asked.starts[:-1])
        sizes = starts[at + 1] - starts[at]
        for j in np.flatnonzero(every).tolist():
            low, high = asked.starts[j], asked.starts[j + 1]
            rarest = low + np.argsort(sizes[low:high], kind="stable")[:lists]
            own = places[starts[at[rarest[0]]] : starts[at[rarest[0]] + 1]]
            for k in rarest[1:].tolist():
                if len(own) <= FEW:
                    break
                own = np.intersect1d(own, places[starts[at[k]] : starts[at[k] + 1]], assume_unique=True)
            number = asked.long[j]
            wanted = asked.wanted[number]
            found = [p for p in own.tolist() if wanted in texts[p]]
            if found:
                yield np.full(len(found), number), np.array(found, np.int64)
    for size, (own, codes) in asked.short.items():
        if not len(own):
            continue
        for p, text in enumerate(texts):
            found = [np.unique(_codes(text[a : a + SLICE_CHARS + size - 1], size)) for a in range(0, len(text), SLICE_CHARS)]
            here = np.unique(np.concatenate(found)) if found else codes[:0]
            # equal codes belong to several needles
            low, high = np.searchsorted(here, codes), np.searchsorted(here, codes, "right")
            met = own[low < high]
            if len(met):
                yield met, np.full(len(met), p)


def search_many(index: SearchIndex, needles: DataFrame, needle: str = "needle", lists: int = LISTS) -> DataFrame:
    """(needle, key) for each distinct needle and book that holds it, case and white space aside.

    Blocks of needles meet each slice of the index where it lies.  Of a needle's
    grams the ``lists`` rarest of the slice are looked up and their lists
    intersected; the books left are verified on their whole text, so the result
    is that of a scan.  A needle with a gram that no book of the slice has is
    done at once.  Needles under three characters have no gram and are found by
    a scan of the texts' characters and pairs.  Blank and null needles are in no
    book.
    """
    wanted = needles.select(F.col(needle).alias("needle")).distinct().withColumn("wanted", search_form(F.col("needle")))
    wanted = through_storage(wanted.where(F.col("wanted") != ""), "needles")
    number = F.pmod(F.xxhash64("needle"), F.lit(-(-wanted.count() // NEEDLES) or 1)).alias("block")
    blocks = wanted.groupBy(number).agg(F.collect_list(F.struct("needle", "wanted")).alias("needles"))
    kind = index.slices.schema["keys"].dataType.elementType.simpleString()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, asked = None, None
        for batch in batches:
            row = {name: batch.column(name) for name in batch.schema.names}
            for i in range(batch.num_rows):
                if row["block"][i].as_py() != held:
                    held, asked = row["block"][i].as_py(), _Needles(row["needles"][i].values)
                numbers = [np.frombuffer(row[name][i].as_buffer(), width) for name, width in (("grams", np.int64), ("starts", np.int64), ("places", np.uint16))]
                found = list(_meet(row["forms"][i].as_py(), *numbers, asked, lists))
                if found:
                    which, place = (pa.array(np.concatenate(column)) for column in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([asked.needles.take(which), row["keys"][i].values.take(place)], ["needle", "key"])

    return index.slices.crossJoin(blocks).mapInArrow(meet, f"needle string, key {kind}")
