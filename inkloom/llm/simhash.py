"""SimHash near-duplicates: byte-position inverted index with count filtering.

Two 64-bit fingerprints at most four bits apart differ in at most four of
their eight bytes, so they share at least four positional bytes.  Posting lists
of single bytes would hold 1/256 of all fingerprints each, and tallying their
pairs would grow with the square of the input.  The index is therefore keyed by
three positional bytes at once, for a family of 20 position triples such that
any four positions contain one of them: a pair sharing four bytes meets in at
least one list.  In a list the shared positional bytes of pairs are tallied,
pairs below the guaranteed minimum are left out, and the rest is verified by
the bit distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from inkloom.llm.components import components
from inkloom.llm.tables import written

BITS, BYTES = 64, 8
SEED = 42  # of the shingle hash XXH64
LIST_LIMIT = 4096  # longer posting lists are keyed by more of the fingerprint


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of a text's word shingles, each occurrence one vote.

    Words are what ASCII white space leaves, with A-Z lower-cased.  A text of
    fewer words than a shingle has one shingle, all of it; one without words
    (or a null) has the fingerprint 0.  A bit is set if over half the hashes
    have it.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) > shingle:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-1]))
        spans = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype=">u8")
    else:
        hashes = np.array([digest(line, SEED)], dtype=">u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory for very long texts
        block = hashes[at : at + 65536].view(np.uint8).reshape(-1, BYTES)
        votes += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True)


def fingerprint_udf(shingle: int):
    """Column function: the fingerprint of a text as a signed long."""

    @arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    return simhash


# ------------------------------------------------------------ posting keys


def _mask(nibbles: Iterable[int]) -> int:
    value = sum(0xF << (60 - 4 * n) for n in nibbles)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _nibbles(positions: Iterable[int]) -> frozenset[int]:
    return frozenset(n for p in positions for n in (2 * p, 2 * p + 1))


def _triples() -> list[frozenset[int]]:
    """20 byte triples of which every four bytes contain one.

    The positions form three classes in a ring; a triple lies in one class, or
    has two positions in a class and one in the next.
    """
    ring = [(0, 1, 2), (3, 4, 5), (6, 7)]
    found = [t for own in ring for t in combinations(own, 3)]
    for own, following in zip(ring, ring[1:] + ring[:1], strict=True):
        found += [(*two, one) for two in combinations(own, 2) for one in following]
    return [_nibbles(t) for t in found]


def _finer(nibbles: frozenset[int]) -> list[frozenset[int]]:
    """Keys that any pair of a list with this key and four shared bytes meets in again.

    Three bytes get each fourth one.  Four bytes get each four of the eight
    nibbles left: four differing bits leave at least four of them equal.  The
    16 bits then left bound a list of distinct fingerprints by 65,536.
    """
    rest = [n for n in range(2 * BYTES) if n not in nibbles]
    if len(nibbles) == 6:
        return [nibbles | {n, n + 1} for n in rest[::2]]
    return [nibbles | set(four) for four in combinations(rest, 4)]


def _posting_rows(prints: DataFrame, keys: list[frozenset[int]]) -> DataFrame:
    """(mask, key, print) of each fingerprint and key."""
    masks = F.explode(F.array(*[F.lit(_mask(k)).cast("long") for k in keys]))
    rows = prints.select("print", masks.alias("mask"))
    return rows.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")


# ------------------------------------------------------------------- links


def _stars(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The links inside one posting list, as one star per connected part of it.

    From each part's first member the search takes, for every member reached,
    those not yet reached that share enough positional bytes with it and are
    close enough.
    """
    centers, members = [], []
    waiting = prints
    while len(waiting) > 1:
        center, waiting = waiting[0], waiting[1:]
        front = [center]
        while front and len(waiting):
            apart = waiting ^ front.pop()
            shared = (apart.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)  # the tally
            close = shared >= BYTES - max_bits
            close[close] = np.bitwise_count(apart[close]) <= max_bits  # the check
            if close.any():
                reached = waiting[close]
                centers.append(np.full(len(reached), center))
                members.append(reached)
                front.extend(reached)
                waiting = waiting[~close]
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *centers]), np.concatenate([empty, *members])


def _link_lists(max_bits: int):
    """Links of posting lists that arrive one after another, sorted by key."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        held = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            cuts = np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(axis=0)) + 1
            last = cuts[-1] if len(cuts) else 0
            held = rows[:, last:]  # may go on in the next batch
            starts = np.concatenate(([0], cuts))
            for i in np.flatnonzero(np.diff(starts) > 1):
                yield rows[2, starts[i] : starts[i + 1]]
        if held is not None:
            yield held[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in lists(batches):
            a, b = _stars(members.view(np.uint64), max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def links(prints: DataFrame, max_bits: int = 4, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints of column ``print`` into their groups.

    All pairs at most ``max_bits`` apart end up connected; a posting list gives
    a star per connected part, not all its pairs.  A list longer than
    ``list_limit`` is never gathered: partial counts find it first, and its
    fingerprints are keyed anew by more of their bits (see ``_finer``).
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees pairs of at most 4 differing bits")
    spark, found = prints.sparkSession, None
    coarse, rows = _triples(), _posting_rows(prints, _triples())
    for level in range(3):
        hot = None
        if level < 2:
            sizes = rows.groupBy("mask", "key").count().where(F.col("count") > list_limit).select("mask", "key")
            hot = written(sizes, "hot-postings")
            if hot.isEmpty():
                hot = None
        cold = rows if hot is None else rows.join(hot, ["mask", "key"], "left_anti")
        dealt = cold.repartition("mask", "key").sortWithinPartitions("mask", "key", "print")
        part = dealt.mapInArrow(_link_lists(max_bits), "a long, b long")
        found = part if found is None else found.union(part)
        if hot is None:
            return found
        kept = rows.join(hot, ["mask", "key"], "left_semi")
        finer = {_mask(k): _finer(k) for k in coarse}
        new = [F.array(*[F.lit(_mask(k)).cast("long") for k in keys]) for keys in finer.values()]
        by_mask = F.create_map(*[x for m, arr in zip(finer, new, strict=True) for x in (F.lit(m).cast("long"), arr)])
        rows = kept.select("print", F.explode(by_mask[F.col("mask")]).alias("mask")).distinct()
        rows = rows.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")
        rows = written(rows, "postings")
        coarse = list({k for keys in finer.values() for k in keys})
    return found


# --------------------------------------------------------------- operators


def simhash_groups(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    list_limit: int = LIST_LIMIT,
) -> DataFrame:
    """Fingerprint and near-duplicate group of each document.

    Returns one row per input row: the id column, ``text_hash`` (XXH64 of the
    text), ``print`` (signed long), ``root`` (the group's least fingerprint) and
    ``component``, the least id reachable over links of at most ``max_bits``
    differing bits, the document itself included.

    Null and empty texts have the fingerprint 0 and are linked like others.
    Repeated rows give repeated rows.  A null id never names a group, unless
    all its members have none.  Other columns are not read.
    """
    docs = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    prints = docs.select(id_column, F.xxhash64("text").alias("text_hash"), fingerprint_udf(shingle)("text").alias("print"))
    prints = written(prints, "prints")
    distinct = written(prints.groupBy("print").agg(F.min(id_column).alias("least")), "distinct-prints")
    roots = components(links(distinct, max_bits, list_limit))
    rooted = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left")
    rooted = rooted.select("print", "least", F.coalesce("root", "print").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    names = rooted.join(named, "root").select("print", "root", "component")
    return prints.join(names, "print").select(id_column, "text_hash", "print", "root", "component")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One document of each near-duplicate group, with all its columns: that with the least id.

    Ids that are null come last.  Among rows of the same id the least text hash
    stays, and of fully repeated rows one.
    """
    groups = simhash_groups(docs, shingle, max_bits, id_column, text_column)
    rank = F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), "text_hash")
    best = groups.select("root", rank.alias("rank")).groupBy("root").agg(F.min("rank").alias("best"))
    keys = [F.coalesce(F.col("best.id"), F.lit(0)), F.col("best.no_id"), F.col("best.text_hash")]
    best = best.select(*[k.alias(f"__key{i}") for i, k in enumerate(keys)]).distinct()
    own = [F.coalesce(F.col(id_column), F.lit(0)), F.col(id_column).isNull(), F.xxhash64(text_column)]
    keyed = docs.withColumns({f"__key{i}": k for i, k in enumerate(own)})
    names = [f"__key{i}" for i in range(3)]
    return keyed.join(best, names, "left_semi").dropDuplicates(names).select(*docs.columns)
