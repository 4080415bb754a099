"""Byte-level BPE: corpus-level merge replay, and decoding.

The texts of a slice of the corpus are split into pieces, and each distinct
piece is encoded once.  All new pieces of the slice lie side by side in one
array of tokens; an inverted index from token pair (by the rank its merge has)
to positions drives the replay: the lowest rank is taken, all its places are
merged, and only the pairs with the touched neighbours enter the index again.
Pieces merge independently, so slices give the ids that one replay over all of
the corpus would; their number is bounded, and no text is shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

SLICE_BYTES = 4_000_000  # text encoded at once in a task
KNOWN_BYTES = 64_000_000  # about what the encoded chunks that a worker remembers between slices may take
LONGEST_KNOWN = 64  # characters; longer chunks are not remembered
ENTRY_BYTES = 200  # of a remembered chunk besides its characters and ids
_KNOWN: dict[str, tuple[dict, dict, list[int]]] = {}  # per rank table, for the tasks of one Python worker
NO_MERGE = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 token and number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The rank table with all pairs of tokens that make a token, for lookups of many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.of_byte = np.array([ranks[bytes((b,))] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        keys, found = np.array(pairs, np.int64).reshape(-1, 2).T
        order = np.argsort(keys)
        self.keys, self.found = np.append(keys[order], -1), np.append(found[order], NO_MERGE).astype(np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes, else NO_MERGE."""
        pairs = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys[:-1], pairs)
        return np.where(self.keys[at] == pairs, self.found[at], NO_MERGE)


class _Index:
    """Positions by the rank of the merge that their pair of tokens waits for."""

    def __init__(self):
        self.places: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []

    def enter(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        starts = np.flatnonzero(np.diff(ranks, prepend=-1))
        cuts = [*starts.tolist(), len(ranks)]
        for rank, begin, end in zip(ranks[starts].tolist(), cuts, cuts[1:], strict=False):
            if rank != NO_MERGE:
                if rank not in self.places:
                    heappush(self.heap, rank)
                self.places.setdefault(rank, []).append(positions[begin:end])

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heappop(self.heap)
        found = self.places.pop(rank)
        return rank, found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the ids of all pieces one after another, and where each piece's end.

    A piece that is a token is that token.  Otherwise, within a piece, the
    lowest rank is merged first, and of equal ones the leftmost.
    """
    whole = np.array([merges.ranks.get(p, -1) for p in pieces], np.int32)
    work = np.flatnonzero(whole < 0)
    sizes = np.array([len(pieces[i]) for i in work], np.int64)
    token = merges.of_byte[np.frombuffer(b"".join([pieces[i] for i in work]), np.uint8)]
    n = len(token)
    piece = np.append(np.repeat(work, sizes), -1)
    token = np.append(token, 0)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    waits = np.full(n + 1, NO_MERGE, np.int32)
    inner = np.flatnonzero(piece[:-1] == piece[1:])
    waits[inner] = merges.rank(token[inner], token[inner + 1])
    index = _Index()
    index.enter(inner, waits[inner])
    while index.heap:
        rank, at = index.pop()
        at = at[waits[at] == rank]
        if not len(at):
            continue
        # overlapping places: of a run, each second one is eaten by the one before it
        chained = np.append(False, at[1:] == after[at[:-1]])
        if chained.any():
            run = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        own = piece[at]
        again = np.append(False, own[1:] == own[:-1])
        if again.any():  # where the merge makes a pair that comes before the next place, only the first is merged now
            right = after[after[at]]
            both = np.full(len(at), rank)
            low = np.minimum(merges.rank(both, token[right]), merges.rank(both, both))
            low = np.minimum(low, merges.rank(token[before[at]], both))
            wait = again & np.isin(own, own[low <= rank])
            if wait.any():
                index.enter(at[wait], np.full(wait.sum(), rank))
                at, own = at[~wait], own[~wait]
        eaten = after[at]
        right = after[eaten]
        token[at], waits[eaten] = rank, NO_MERGE
        token[eaten] = -1
        after[at] = right
        before[right] = at
        left = before[at]
        left = left[(left >= 0) & (piece[left] == own)]
        both = np.full(len(at), rank)
        waits[at] = np.where(piece[right] == own, merges.rank(both, token[right]), NO_MERGE)
        waits[left] = merges.rank(token[left], token[after[left]])
        touched = np.concatenate([at, left])
        index.enter(touched, waits[touched])
    counts = np.zeros(len(pieces), np.int64)
    counts[whole >= 0] = 1
    alive = np.flatnonzero(token[:-1] >= 0)
    counts += np.bincount(piece[alive], minlength=len(pieces))
    ends = np.cumsum(counts)
    ids = np.empty(ends[-1] if len(ends) else 0, np.int32)
    single = np.zeros(len(ids), bool)
    single[(ends - 1)[whole >= 0]] = True
    ids[single], ids[~single] = whole[whole >= 0], token[alive]
    return ids, ends


class _Encoder:
    """Encodes slices of texts; remembers the chunks of earlier ones.

    A text is cut at its blanks.  Where a blank stands alone between other
    characters it goes with what follows, so the pieces of the text are those
    of the chunks; a text with any other blank is split as a whole.
    """

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.split = merges, regex.compile(pattern).findall
        # ids of chunks at a text's beginning, and after a blank; None: the text must be split as a whole
        name = f"{pattern} {len(merges.ranks)} {hash(merges.keys.tobytes())}"
        self.first, self.later, self.taken = _KNOWN.setdefault(name, ({}, {}, [0]))

    def _learn(self, texts: list[str]) -> list[bytes]:
        """Split the texts into pieces and encode each distinct piece once."""
        number: dict[str, int] = {}
        parts = [[number.setdefault(p, len(number)) for p in self.split(t)] for t in texts]
        ids, ends = replay([p.encode() for p in number], self.merges)
        cuts = [0, *ends.tolist()]
        encoded = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        return [b"".join(map(encoded.__getitem__, found)) for found in parts]

    def _settle(self, added: list[tuple[dict, list[str]]]) -> None:
        """Forget the long ones of the chunks that a slice added, or all chunks once they take too much."""
        for known, chunks in added:
            for chunk in chunks:
                if len(chunk) > LONGEST_KNOWN:
                    del known[chunk]
                else:
                    self.taken[0] += ENTRY_BYTES + 2 * len(chunk) + len(known[chunk] or b"")
        if self.taken[0] > KNOWN_BYTES:
            self.first.clear()
            self.later.clear()
            self.taken[0] = 0

    def __call__(self, texts: list[str | None]) -> pa.Array:
        parts = [(t or "").split(" ") for t in texts]
        added: list[tuple[dict, list[str]]] = []
        for known, lead, chunks in (
            (self.first, "", {found[0] for found in parts}),
            (self.later, " ", {c for found in parts for c in found[1:]}),
        ):
            new = [c for c in chunks if c not in known]
            added.append((known, new))
            odd = {c for c in new if c[-1:].isspace() or lead and (not c or c[0].isspace())}
            known.update(dict.fromkeys(odd))
            new = [c for c in new if c not in odd]
            known.update(zip(new, self._learn([lead + c for c in new]), strict=True))
        rows: list[bytes | None] = []
        for found in parts:
            own = [self.first[found[0]], *map(self.later.__getitem__, found[1:])]
            rows.append(None if None in own or not found[0] and len(found) > 1 else b"".join(own))
        whole = [i for i, r in enumerate(rows) if r is None]
        for i, r in zip(whole, self._learn([texts[i] for i in whole]), strict=True):
            rows[i] = r
        self._settle(added)
        offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows])))
        values = np.frombuffer(b"".join(rows), np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def slices(batches: Iterator[pa.RecordBatch], column: str | int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``size`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(column).fill_null("")).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            gone = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, gone + size, "right")))
            yield batch.slice(at, end - at)
            at = end


def _decoded(ids: pa.ListArray, token_of: dict[int, bytes]) -> pa.Array:
    token = token_of.__getitem__
    values, cuts = ids.values.to_numpy(), ids.offsets.to_pylist()
    texts = [b"".join(map(token, values[a:b].tolist())) for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.array(texts, pa.binary(), mask=ids.is_null().to_numpy(zero_copy_only=False))


def bpe_encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_decoded: bool = False,
) -> DataFrame:
    """(id, ids) of each document: the ids of its pieces in order, no special tokens.

    ``pattern`` splits a text into the pieces that are merged separately.
    ``with_decoded`` adds ``decoded``, the bytes that the ids give again.  Null
    and empty texts have no ids; repeated rows give repeated rows; other columns
    are not read.  The rank table is broadcast: its size is that of the file,
    whatever the corpus.
    """
    table = docs.sparkSession.sparkContext.broadcast(Merges(ranks))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(table.value, pattern)
        for part in slices(batches, "text"):
            ids = encoder(part.column("text").to_pylist())
            again = [_decoded(ids, encoder.merges.bytes_of)] if with_decoded else []
            yield pa.RecordBatch.from_arrays([part.column(0), ids, *again], [id_column, "ids", "decoded"][: 2 + with_decoded])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    return rows.mapInArrow(encode, f"`{id_column}` {kind}, ids array<int>" + ", decoded binary" * with_decoded)


def bpe_decode(ids: Column, spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids; null for a null array.  An unknown id is an error."""
    table = spark.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    @arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        return _decoded(rows, table.value)

    return decode(ids)
