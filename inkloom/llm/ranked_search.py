"""Ranked lexical search over bags: documents with equal term counts and length are scored once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from inkloom.llm.tables import written

BLOCK_TERMS = 400_000  # terms, repeats included, of the items that one pass over the documents serves
SALTS = 16  # parts of a bag whose first members are sought apart
BATCH = 512  # bags scored at once

# Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z change case.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8; none for a null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Items:
    """A block of items: their vocabulary, and how often each item holds each term."""

    def __init__(self, rows: list[tuple[object, str | None]]):
        self.ids = [key for key, _ in rows]
        number: dict[bytes, int] = {}
        held = [(number.setdefault(t, len(number)), i) for i, (_, text) in enumerate(rows) for t in terms_of(text)]
        pairs, counts = np.unique(np.array(held, np.int64).reshape(-1, 2), axis=0, return_counts=True)
        self.vocabulary = number
        self.cuts = np.searchsorted(pairs[:, 0], np.arange(len(number) + 1))  # per term, where its items stand
        self.items, self.counts = pairs[:, 1], counts.astype(np.int64)


def _bags(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """(id, n, bag): each document's number of terms, and its vocabulary terms with their counts, ascending, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column(1):
                terms = terms_of(text.as_py())
                found = np.array([t for t in map(known, terms) if t is not None], "<i8")
                bag = np.stack(np.unique(found, return_counts=True), axis=1).astype("<i8")
                sizes.append(len(terms))
                bags.append(bag.tobytes())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "bag"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(col(f"`{id_column}`").alias("id"), col(f"`{text_column}`").alias("text"))
    return rows.mapInArrow(restrict, f"id {kind}, n long, bag binary")


def _held_by(bags: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each vocabulary term; a number per term reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            joined = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")
            held += np.bincount(joined[::2], minlength=terms)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term", "held"])

    found = np.zeros(terms, np.int64)
    for row in bags.select("bag").mapInArrow(count, "term long, held long").groupBy("term").sum("held").collect():
        found[row[0]] = row[1]
    return found


def bag_classes(bags: DataFrame, top: int, salts: int = SALTS) -> DataFrame:
    """(bag, m, members): documents of equal bag and m, with the ``top`` least ids of each.

    Rows are dealt by the hash of (bag, m); within a hash the bags themselves are
    compared, so equal hashes of different bags make no class.  Members of a
    class tie everywhere, so no more than ``top`` of them can be in a result.
    Only these leave a partition, and a class is split over ``salts`` parts
    first, so a class that holds most rows is never gathered.
    """
    rows = bags.where("length(bag) > 0").select("id", "bag", "m", F.xxhash64("bag", "m").alias("hash"))
    for keys in (["hash", "m", "bag", "salt"], ["hash", "m", "bag"]):
        source = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts))) if "salt" in keys else rows
        first = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("id"))
        rows = source.withColumn("place", F.row_number().over(first)).where(col("place") <= top).drop("place", "salt")
    members = F.array_sort(F.collect_list(F.struct(col("id").isNull().alias("none"), "id")))
    return rows.groupBy("hash", "m", "bag").agg(members.alias("members")).select("bag", "m", "members.id")


def _best(classes: DataFrame, items: Items, weights: np.ndarray, top: int, id_kind: str) -> DataFrame:
    """(item, id, score): for each task and item the best documents, at most ``top`` of a task."""
    shared = classes.sparkSession.sparkContext.broadcast((items.cuts, items.items, items.counts, weights, len(items.ids)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, owners, counts, weight, n_items = shared.value
        best: list[list[tuple]] = [[] for _ in range(n_items)]  # (-score, id is null, id), ascending
        least = np.ones(n_items, np.int64)  # a document needs this score to enter
        kind = None
        for batch in batches:
            kind = batch.schema.field(2).type.value_type
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                vectors = [np.frombuffer(b, "<i8").reshape(-1, 2) for b in part.column(0).to_pylist()]
                lengths = [len(v) for v in vectors]
                term, tf = np.concatenate(vectors).T
                row = np.repeat(np.arange(len(vectors)), lengths)
                m = np.repeat(part.column(1).to_numpy(), lengths)
                impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                order = np.argsort(term, kind="stable")
                term, row, impact = term[order], row[order], impact[order]
                starts = np.flatnonzero(np.diff(term, prepend=-1))
                table = np.zeros((len(vectors), n_items), np.int64)
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(term)], strict=True):
                    own = slice(cuts[term[a]], cuts[term[a] + 1])
                    table[np.ix_(row[a:b], owners[own])] += impact[a:b, None] * counts[own]
                members = part.column(2).to_pylist()
                rows, found = np.nonzero(table >= least)
                for r, i in zip(rows.tolist(), found.tolist(), strict=True):
                    points = int(table[r, i])
                    if points < least[i]:
                        continue
                    best[i] = sorted(best[i] + [(-points, key is None, key) for key in members[r]])[:top]
                    if len(best[i]) == top:
                        least[i] = -best[i][-1][0]
        if kind is None:
            return
        rows = [(i, key, -points) for i, found in enumerate(best) for points, _, key in found]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = [pa.int64(), kind, pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item", "id", "score"])

    return classes.mapInArrow(score, f"item long, id {id_kind}, score long")


def _blocks(items: DataFrame, id_column: str, text_column: str, block_terms: int) -> Iterator[list[tuple[object, str | None]]]:
    """Items in blocks of about ``block_terms`` terms, one block in the driver at a time."""
    block, held = [], 0
    for row in items.select(id_column, text_column).orderBy(id_column, text_column).toLocalIterator():
        size = len(terms_of(row[1]))
        if block and held + size > block_terms:
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += size
    if block:
        yield block


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``top`` best documents of each item: (item, ``rank`` from 1, id, ``score``).

    With N documents of at least a term, L terms in all, n of a document, df
    documents holding a term and tf its count in one: a term weighs
    floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 25 + 75 n N div L, and
    its score sums weight * (10^9 tf div (1000 tf + 8 m)) over the item's terms,
    repeats included, in 64-bit integers.  Documents without a score are left
    out; equal scores rank by ascending id, a null id last.

    Items are the stated queries: they are taken in blocks of a bounded number of
    terms, and only a block and its vocabulary are broadcast.  Documents are
    restricted to that vocabulary in one pass over their whole texts; those of
    equal counts and m are one class, scored once.  A task keeps ``top``
    documents for each item, whose least score is the bound for the next.

    Null and empty texts hold no terms and are in no result.  Repeated rows
    rank each for itself; items with the same id likewise, one after the other
    by their text.  Empty tables give no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    kinds = [f.dataType.simpleString() for f in (items.schema[item_column], docs.schema[id_column])]
    schema = f"`{item_column}` {kinds[0]}, rank int, `{id_column}` {kinds[1]}, score long"
    result = spark.createDataFrame([], schema)
    for rows in _blocks(items, item_column, item_text_column, block_terms):
        block = Items(rows)
        bags = written(_bags(docs, block.vocabulary, id_column, text_column), "bags")
        documents, terms = bags.agg(F.count_if(col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not terms or not block.vocabulary:
            continue
        held = _held_by(bags, len(block.vocabulary))
        weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)
        lengths = bags.where("n > 0").withColumn("m", F.expr(f"25 + (75 * n * {documents}L) div {terms}L"))
        classes = bag_classes(lengths, top)
        best = _best(classes, block, weights, top, kinds[1])
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, name {kinds[0]}")
        named = best.join(names, "item").select(col("name").alias(item_column), "rank", col("id").alias(id_column), "score")
        result = result.unionByName(named)
    return result
