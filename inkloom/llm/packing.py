"""Bounded-space online best-fit packing of token sequences."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, compress
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from inkloom.llm.bpe import slices
from inkloom.llm.tables import written

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 1024  # bins a packer keeps open
PIECES_PER_PACKER = 250_000  # rows of one packer; more rows get more packers
KNOWN_BYTES = 64_000_000  # about what the tokenized chunks that a worker remembers may take
LONGEST_KNOWN = 64  # characters; longer chunks are not remembered
AT_ONCE = 4_000_000  # bytes of texts that are tokenized together; a longer text stands for itself
ENCODED_AT_ONCE = 5_000  # new chunks that go to the tokenizer together
_TAIL = ".,!?;:*%&$#"  # signs that always are tokens apart from a word before them
_KNOWN: dict[str, tuple[Any, Any, "_Memory"]] = {}  # per tokenizer, for the tasks of one Python worker
_WORD = re.compile("[a-z]+")
# how a tokenizer finds its words, if one of small Latin letters surely is one and goes to the model unchanged
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _word_tokenizer(tokenizer_json: str) -> str | None:
    """The same model for blank-separated words of ``a`` to ``z``, without the work that changes nothing in them."""
    parts = json.loads(tokenizer_json)
    split, *after = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    usual = (parts["normalizer"] or {}).get("normalizers") == _NORMAL and split.get("pattern") == {"Regex": _SPLIT}
    usual = usual and split["invert"] and split["behavior"] == "Removed" and [a["type"] for a in after] == ["ByteLevel"]
    usual = usual and not after[0]["add_prefix_space"] and not after[0]["use_regex"] and parts["model"]["type"] == "BPE"
    if not usual or any(re.search("[a-z]", a["content"]) and "|" not in a["content"] for a in parts["added_tokens"]):
        return None
    return json.dumps(parts | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}})


class _Memory(dict):
    """Ids of chunks.  Each call may add any; what stays is bounded in bytes.

    The dict holds the chunks of one call.  Those that stay lie in Arrow arrays,
    some 40 bytes each, and are found by their hash; texts are compared too.
    """

    def __init__(self):
        super().__init__()
        self._forget()

    def _forget(self) -> None:
        self.chunks, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.hashes, self.places = np.empty(0, np.int64), np.empty(0, np.int32)  # ascending hashes

    @property
    def taken(self) -> int:
        return self.chunks.nbytes + self.ids.nbytes + self.hashes.nbytes + self.places.nbytes

    def _found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is or would be, and whether it is there."""
        at = np.searchsorted(self.hashes, hashes)
        there = at < len(self.hashes)
        there[there] = self.hashes[at[there]] == hashes[there]
        return at, there

    def recall(self, chunks: Iterable[str]) -> list[str]:
        """Bring back those of some distinct chunks that are remembered; tells the others."""
        missing = [c for c in chunks if c not in self]
        at, there = self._found(_hashes(missing))
        asked = [*compress(missing, there.tolist())]
        places = pa.array(self.places[at[there]])
        same = pc.equal(self.chunks.take(places), pa.array(asked, pa.string()))
        found = self.ids.take(places.filter(same))
        if len(found):
            cuts, data = np.frombuffer(found.buffers()[1], np.int32).tolist(), found.buffers()[2].to_pybytes()
            self.update((c, data[a:b]) for c, a, b in zip(compress(asked, same.to_pylist()), cuts, cuts[1:], strict=False))
        return [c for c in missing if c not in self]

    def settle(self, new: list[str]) -> None:
        """Forget all but the short ones of the chunks that were added, and all earlier ones once they take too much."""
        kept = [chunk for chunk in new if len(chunk) <= LONGEST_KNOWN]
        hashes, first = np.unique(_hashes(kept), return_index=True)
        at, there = self._found(hashes)  # two chunks of one hash: the first stays
        hashes, at, kept = hashes[~there], at[~there], [kept[i] for i in first[~there].tolist()]
        chunks, ids = pa.array(kept, pa.string()), pa.array([*map(self.__getitem__, kept)], pa.binary())
        self.clear()
        if self.taken + chunks.nbytes + ids.nbytes + 12 * len(kept) > KNOWN_BYTES:
            self._forget()
            if chunks.nbytes + ids.nbytes + 12 * len(kept) > KNOWN_BYTES:
                return
            at = np.zeros(len(kept), np.int64)
        places = np.arange(len(self.chunks), len(self.chunks) + len(kept), dtype=np.int32)
        self.hashes, self.places = np.insert(self.hashes, at, hashes), np.insert(self.places, at, places)
        self.chunks, self.ids = pa.concat_arrays([self.chunks, chunks]), pa.concat_arrays([self.ids, ids])


def _hashes(chunks: list[str]) -> np.ndarray:
    return np.fromiter(map(hash, chunks), np.int64, len(chunks))


class _Tokens:
    """Token ids of texts, as little-endian unsigned 32-bit numbers.

    White space separates tokens and is dropped, so the ids of a text are those
    of its blank-separated chunks; chunks seen before are looked up.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        name = str(hash(tokenizer_json))
        if name not in _KNOWN:
            words = _word_tokenizer(tokenizer_json)
            _KNOWN[name] = Tokenizer.from_str(tokenizer_json), words and Tokenizer.from_str(words), _Memory()
        self.tokenizer, self.words, self.known = _KNOWN[name]

    @staticmethod
    def _parts(chunk: str) -> tuple[str, str]:
        """A word and the signs after it, which are tokenized apart; the tokenizer ignores case.

        They are only where the word surely ends in a letter or digit for the
        tokenizer too, after composing and lower-casing: ASCII, or a letter of the
        scripts up to Cyrillic whose lower case is one letter.
        """
        if "<|" in chunk:  # may hold a special token
            return chunk, ""
        word = chunk.rstrip(_TAIL)
        if word.isascii():
            ends = word[-1:].isalnum()
        else:
            last = unicodedata.normalize("NFC", word)[-1].lower()
            ends = len(last) == 1 and last < "\u0530" and last.isalpha() and unicodedata.category(last)[0] == "L"
        if not ends:
            word = chunk
        return (word.lower() if word.isascii() else word), chunk[len(word) :]

    def _learn(self, chunks: list[str]) -> list[str]:
        """Add the ids of new chunks; tells what was added."""
        plain = [c for c in chunks if c.isascii() and c.isalnum()]
        lower = [c.lower() for c in plain]
        rest = [c for c in chunks if not (c.isascii() and c.isalnum())]
        parts = [self._parts(c) for c in rest]
        pieces = set(self.known.recall({*lower, *chain.from_iterable(parts)}))
        words = [p for p in pieces if _WORD.fullmatch(p)] if self.words else []
        self._encode_words(words)
        self._encode(list(pieces.difference(words)))
        known = self.known
        known.update(zip(plain, map(known.__getitem__, lower), strict=True))
        known.update((c, known[word] + known[tail]) for c, (word, tail) in zip(rest, parts, strict=True))
        return list(pieces.union(chunks))

    def _encode_words(self, words: list[str]) -> None:
        for at in range(0, len(words), ENCODED_AT_ONCE):
            block = words[at : at + ENCODED_AT_ONCE]
            found = self.words.encode(" ".join(block), add_special_tokens=False)
            data, ends = np.array(found.ids, "<u4").tobytes(), np.cumsum(np.bincount(found.word_ids, minlength=len(block)))
            begin = 0
            for word, end in zip(block, (4 * ends).tolist(), strict=True):
                self.known[word] = data[begin:end]
                begin = end

    def _encode(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), ENCODED_AT_ONCE):
            block = chunks[at : at + ENCODED_AT_ONCE]
            found = self.tokenizer.encode(" ".join(block), add_special_tokens=False)
            ends = np.cumsum([len(c) + 1 for c in block])
            ids, offsets = found.ids, found.offsets
            starts = np.fromiter((a for a, _ in offsets), np.int64, len(ids))
            data = np.array(ids, "<u4").tobytes()
            cuts = (4 * np.searchsorted(starts, ends)).tolist()
            begin = 0
            for chunk, end in zip(block, cuts, strict=True):
                self.known[chunk] = data[begin:end]
                begin = end

    def __call__(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text, from some texts at a time, of which each distinct chunk is looked up once."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        groups = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
        rows = []
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if begin < end:
                rows += self._rows(pc.split_pattern(texts.slice(begin, end - begin), " "))
                pa.default_memory_pool().release_unused()  # else the pool keeps more than all that is in use
        return rows

    def _rows(self, texts: pa.ListArray) -> Iterator[bytes]:
        chunks = texts.flatten().dictionary_encode()
        which = chunks.indices.to_numpy()
        # no chunk holds a blank; one string is read much faster than an array of them
        whole = pa.ListArray.from_arrays(pa.array([0, len(chunks.dictionary)], pa.int32()), chunks.dictionary)
        distinct = pc.binary_join(whole, " ")[0].as_py().split(" ")
        new = self._learn(self.known.recall(distinct))
        found = [*map(self.known.__getitem__, distinct)]
        self.known.settle(new)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), "<u4")
        begin = 0
        for end in np.cumsum(pc.list_value_length(texts).to_numpy()).tolist():
            own = which[begin:end]
            lengths = sizes[own]
            # the places of a chunk's ids are those before it here, moved to where it stands among all ids
            places = np.repeat(starts[own] - np.cumsum(lengths) + lengths, lengths)
            places += np.arange(len(places))
            yield ids[places].tobytes()
            begin = end


def token_pieces(
    docs: DataFrame,
    tokenizer_json: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Tokenize each document, end it with ``end_id`` and cut it where it exceeds the capacity.

    Returns per piece: the id, ``piece`` (from 0), ``start`` (ids before it),
    ``length``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit
    numbers) and, if asked for, ``ids`` (those bytes).  A null or empty text is
    one piece, the end id alone.  Repeated rows give repeated pieces; other
    columns are not read.  ``tokenizer_json`` is sent to the tasks; its size
    does not depend on the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = _Tokens(shared.value), np.array([end_id], "<u4").tobytes()
        names = [id_column, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        for part in slices(batches, 1, AT_ONCE):
            rows = []
            for i, ids in enumerate(tokens(part.column(1))):
                ids += end
                for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[begin : begin + 4 * capacity]
                    rows.append((i, piece, begin // 4, len(own) // 4, zlib.crc32(own), own))
            columns = [list(c) for c in zip(*rows, strict=True)]
            keys = part.column(0).take(pa.array(columns[0]))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
            values = [pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([keys, *values], names)

    return docs.select(col(id_column), col(text_column).alias("text")).mapInArrow(tokenize, schema)


class BestFit:
    """Online best-fit into bins of one capacity, a fixed number of them open.

    An integer serves as bitset: bit f is set while some open bin has f units
    free.  An item goes to the open bin with the least free space that takes it,
    found as the lowest set bit from its size on.  Where none takes it a new bin
    is opened; if all are in use, the fullest closes first.  A full bin closes
    at once.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free_sizes = 0  # the bitset
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space
        self.count = self.made = 0

    def _leave(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.free_sizes &= ~(1 << free)
        self.count -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """(bin number, offset in it) for an item of 1 to ``capacity`` units."""
        fitting = self.free_sizes >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._leave(free)
        else:
            if self.count == self.open_bins:  # the fullest has the least free space
                self._leave((self.free_sizes & -self.free_sizes).bit_length() - 1)
            free, number = self.capacity, self.made
            self.made += 1
        rest = free - size
        if rest:
            self.bins[rest].append(number)
            self.free_sizes |= 1 << rest
            self.count += 1
        return number, self.capacity - free


def best_fit_pack(
    items: DataFrame,
    length_column: str = "length",
    order: tuple[str, ...] = ("doc_id", "piece"),
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    per_packer: int = PIECES_PER_PACKER,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: each item's sequence and its place there.

    Items are dealt by the hash of their order columns to packers of about
    ``per_packer`` rows, so their number grows with the input, and arrive at each in
    the order of that hash.  A packer streams: it holds its open bins only,
    and leaves at most ``open_bins`` of them unfilled at its end.  Sequence
    numbers are distinct over all packers.

    Repeated rows are packed each for itself.  An empty table gives no rows.  A
    length that is null, below 1 or above the capacity is an error.
    """
    items = written(items, "items")
    packers = -(-items.count() // per_packer) or 1
    hashed = F.xxhash64(*order)
    dealt = items.withColumns({"__arrival": hashed, "__packer": F.pmod(hashed, F.lit(packers))})
    dealt = dealt.repartition(packers, "__packer").sortWithinPartitions("__packer", "__arrival", *order)
    schema = items.schema.add("sequence_id", "long").add("offset", "long")
    at = items.columns.index(length_column)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, bins = None, None
        for batch in batches:
            owners = batch.column(batch.num_columns - 1).to_pylist()
            sequences, offsets = [], []
            for owner, size in zip(owners, batch.column(at).to_pylist(), strict=True):
                if owner != packer:
                    packer, bins = owner, BestFit(capacity, open_bins)
                if size is None or not 1 <= size <= capacity:
                    raise ValueError(f"a length of {size} does not fit 1 to {capacity}")
                number, offset = bins.place(size)
                sequences.append((packer << 40) + number)
                offsets.append(offset)
            columns = batch.columns[:-2] + [pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return dealt.mapInArrow(pack, schema)
