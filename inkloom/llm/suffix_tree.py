"""Language-model scores from a probabilistic suffix tree over words.

The tree's states are word contexts of up to ``depth`` words.  A context is kept
if the words that follow it diverge enough from those that follow its suffix
without the first word; its distribution is smoothed with that of the suffix,
down to single words.  A token is scored in the longest kept suffix of what
stands before it.

Counting is by windows of the corpus: a task reduces each window to its distinct
grams, packs them, and deals them by hash to parts whose number follows the
corpus.  Only grams of enough support leave a part, and a longer gram is
considered where both shorter ones in it have support, so tables shrink with the
depth.  Scoring broadcasts the most frequent words and states, up to a bound;
the tokens that need any other are joined with the written tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from inkloom.llm.tables import write_freed, written_freed
from inkloom.session import scratch_path

START, END = 0, 1  # ids of the beginning, a context only, and of the end, a token; words have their XXH64
WINDOW = 2_000_000  # tokens that a task holds at once
BATCH_TOKENS = 300_000_000  # training tokens for each batch of the texts to score
SCORE_WINDOW = 500_000  # the same for a task that scores, beside the broadcast words and states
PIECE = 1 << 22  # bytes of text that are split at once
PART_TOKENS = 1_000_000  # training tokens for each part of the grams
HOT_WORDS = 1_000_000  # words whose counts are broadcast
HOT_STATES = 2_000_000  # contexts and successors that are broadcast
FILTER_BITS = 25  # of the fixed-size filters, by their logarithm
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class TreeRules:
    """What the tree keeps: successors with ``min_count`` places, contexts that diverge by ``min_gain`` nats in all."""

    depth: int = 2
    min_count: int = 8
    min_gain: float = 6.0
    discount: float = 0.75


# ------------------------------------------------------------------ windows


@dataclass
class Window:
    """Tokens of some texts, one after another; ``real`` leaves out what only stands before them."""

    known: np.ndarray  # ids of the distinct words, ascending
    local: np.ndarray  # per place, which of these stands there
    real: np.ndarray
    row: np.ndarray  # per place, the text's number in ``keys``
    keys: list

    def __post_init__(self):
        self.word = self.known[self.local]


def _pieces(text: str | None, size: int) -> Iterator[bytes]:
    """A text cut at white space into pieces of a bounded length; of an empty one, an empty piece."""
    data, at = (text or "").encode("utf-8", "surrogatepass"), 0
    while at < len(data) or at == 0:
        gap = _SPACE.search(data, at + size) if len(data) - at > size else None
        end = gap.start() if gap else len(data)
        yield data[at:end]
        at = max(end, 1)


def _words(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of the distinct words, per place which of these stands there, number of words of each piece)."""
    texts = pa.array(pieces, pa.large_binary()).view(pa.large_utf8())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    real = pc.greater(pc.binary_length(lists.values), 0)  # white space at either end leaves an empty word
    ends = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))[lists.offsets.to_numpy()]
    coded = lists.values.filter(real).dictionary_encode()
    _, offsets, data = coded.dictionary.buffers()
    data, offsets = data.to_pybytes() if data else b"", np.frombuffer(offsets, np.int64, len(coded.dictionary) + 1).tolist()
    hashed = (xxhash.xxh64_intdigest(data[a:b]) for a, b in pairwise(offsets))
    ids = np.fromiter(hashed, np.uint64, len(offsets) - 1) >> np.uint64(1)
    return np.maximum(ids, np.uint64(2)), coded.indices.to_numpy(), np.diff(ends)


def windows(texts: Iterator[tuple[object, str | None]], depth: int, size: int = WINDOW) -> Iterator[Window]:
    """Windows of about ``size`` tokens; a text may go on in the next, which then begins with the words before."""
    chunk = min(PIECE, 8 * size)  # bytes that are split at once
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    keys, held = [], 0
    before = np.empty(0, np.uint64)  # the last tokens of a text that goes on

    def add(rows: list[tuple[object, bytes, bool, bool]]) -> None:
        nonlocal before, held
        goes_on = not rows[0][2]
        if goes_on and not keys:
            keys.append(rows[0][0])
            parts.append((before, np.arange(len(before)), np.zeros(len(before), bool), np.zeros(len(before), np.int64)))
        first, last = (np.array([r[i] for r in rows]) for i in (2, 3))
        number = len(keys) - 1 + np.cumsum(first)
        keys.extend(r[0] for r in rows if r[2])
        ids, local, n = _words([r[1] for r in rows])
        ends = np.cumsum(first + n + last)
        starts = ends - (first + n + last)
        known = np.concatenate((np.array([START, END], np.uint64), ids))
        place, word = np.empty(ends[-1], np.int64), np.ones(ends[-1], bool)
        for at, mark in ((starts[first], START), (ends[last] - 1, END)):
            place[at], word[at] = mark, False
        place[word] = local + 2
        real = np.ones(len(place), bool)
        real[starts[first]] = False
        parts.append((known, place, real, np.repeat(number, first + n + last)))
        held += len(place)
        own = known[place[starts[np.flatnonzero(number == number[-1])[0]] :]]
        before = np.concatenate((before if goes_on and number[0] == number[-1] else own[:0], own))
        before = before[len(before) - min(depth, len(before)) :]

    def flush() -> Window:
        offsets = np.cumsum([0, *[len(p[0]) for p in parts]])
        known, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        local = number[np.concatenate([p[1] + o for p, o in zip(parts, offsets, strict=False)])]
        done = Window(known, local, np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]), list(keys))
        parts.clear()
        keys.clear()
        return done

    rows, waiting = [], 0
    for key, text in texts:
        first, piece = True, None
        for following in chain(_pieces(text, chunk), [None]):
            if piece is not None:
                rows.append((key, piece, first, following is None))
                first, waiting = False, waiting + len(piece) + 1
                if waiting >= chunk:
                    add(rows)
                    rows, waiting = [], 0
                    if held >= size:
                        yield flush()
                        held = 0
            piece = following
    if rows:
        add(rows)
    if parts:
        yield flush()


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def gram_keys(window: Window, depth: int) -> list[np.ndarray]:
    """Per length, the 64-bit key of the gram that ends at each place; a gram's context is the shorter one before it."""
    keys = [window.word]
    begin = window.word == START
    for _ in range(depth):
        before = np.concatenate(([np.uint64(START)], keys[-1][:-1]))
        keys.append(np.where(begin, np.uint64(START), _mix(before, window.word)))
    return keys


# ----------------------------------------------------------------- counting


def _texts(batches: Iterator[pa.RecordBatch], skip: int = 0) -> Iterator[tuple[object, str | None]]:
    for batch in batches:
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            yield tuple(batch.column(c)[i] for c in range(skip)), text.as_py()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, where each stands first, its summed count)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.empty(0, np.int64)
    return ranked[starts], order[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, -1 for others."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def vocabulary(texts: DataFrame) -> DataFrame:
    """(w0, n): the training tokens with their counts; the row of the beginning has the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window in windows(_texts(batches), 0):
            counted = window.real | (window.word == START)
            n = np.bincount(window.local[counted], minlength=len(window.known))
            yield pa.RecordBatch.from_arrays([_signed(window.known), pa.array(n)], ["w0", "n"])

    return texts.mapInArrow(count, "w0 long, n long").groupBy("w0").agg(F.sum("n").alias("n"))


class Words:
    """The most frequent words by id, for lookups of many at once."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.counts = ids[order], counts[order]

    def place(self, ids: np.ndarray) -> np.ndarray:
        """Number of each word here, -1 for others."""
        return _find(self.ids, ids)


class Filter:
    """A bitmap of fixed size over keys: never misses one, may take others for one."""

    def __init__(self, bits: int, ones: np.ndarray | None = None):
        self.shift = np.uint64(64 - bits)
        self.flags = np.zeros(1 << bits, bool)
        if ones is not None:
            self.flags[ones] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return self.flags[keys >> self.shift]


def _filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter over column ``key`` as packed bits; its size, whatever the table's, is what reaches the driver."""
    place = F.shiftrightunsigned("key", 64 - bits)
    rows = keys.select(place.alias("place")).select(F.shiftright("place", 6).alias("word"), col("place").bitwiseAND(63).cast("int").alias("bit"))
    words = rows.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    table = words.toArrow()
    packed = np.zeros(1 << (bits - 6), np.uint64)
    packed[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return packed


def _unpacked(packed: np.ndarray, bits: int = FILTER_BITS) -> Filter:
    found = Filter(bits)
    found.flags = np.unpackbits(packed.view(np.uint8), bitorder="little").view(bool)
    return found


def _pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of 64-bit numbers, byte planes side by side, compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T) for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def _unpack(data: bytes, columns: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(raw.transpose(0, 2, 1)).view(np.uint64).reshape(columns, -1)


def _level_keys(words: np.ndarray) -> np.ndarray:
    """Keys of grams given as rows of words, the first word first."""
    key = words[0]
    for word in words[1:]:
        key = np.where(word == START, np.uint64(START), _mix(key, word))
    return key


def grams(texts: DataFrame, level: int, rules: TreeRules, hot, least_hot: int, support, parts: int) -> DataFrame:
    """(w<level>, ..., w0, n, key): grams of ``level`` context words and a token that occur ``min_count`` times.

    ``hot`` is the broadcast of the frequent words, ``support`` that of the filter
    over the shorter grams.  A word that is not hot has no support if even the
    hot ones' least count is below it; else it is kept by its id.
    """
    names = [f"w{i}" for i in range(level, -1, -1)]
    top = np.uint64(1 << 63)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shorter = hot.value, _unpacked(support.value) if support is not None else None
        for window in windows(_texts(batches), level):
            keys_of = gram_keys(window, level)
            place = words.place(window.known)
            code = np.where(place >= 0, place.astype(np.uint64), window.known | top)
            fine = np.where(place >= 0, words.counts[place] >= rules.min_count, least_hot >= rules.min_count)
            special = window.known <= END
            code[special], fine[special] = window.known[special] | top, True
            code, fine = code[window.local], fine[window.local]
            good = window.real & fine
            good[1:] &= fine[:-1]
            if shorter is not None:
                good &= shorter(keys_of[level - 1])
                good[1:] &= shorter(keys_of[level - 1][:-1]) | (window.word[:-1] == START)
            at = np.flatnonzero(good)
            keys, first, n = _summed(keys_of[level][at], np.ones(len(at), np.int64))
            at = at[first]
            columns = [code[np.maximum(at - i, 0)] for i in range(level, -1, -1)]
            # what stands before a text's beginning is the beginning again
            for back in range(1, level):
                begins = (window.word[np.maximum(at - back, 0)] == START)
                for further in range(back + 1, level + 1):
                    columns[level - further] = np.where(begins, top | np.uint64(START), columns[level - further])
            part = (keys % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            blocks, numbers = [], np.flatnonzero(np.diff(cuts))
            for p in numbers.tolist():
                own = order[cuts[p] : cuts[p + 1]]
                blocks.append(_pack([*[c[own] for c in columns], n[own].view(np.uint64)]))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blocks, pa.binary())], ["part", "block"])

    def merge(table: pa.Table) -> pa.Table:
        words = hot.value
        merged = np.concatenate([_unpack(b, level + 2) for b in table.column("block").to_pylist()], axis=1)
        ids, n = merged[:-1], merged[-1].view(np.int64)
        is_hot = ids < top
        # the highest bit marks the ids of words that are not hot
        ids = np.where(is_hot, words.ids[np.where(is_hot, ids, 0)] if len(words.ids) else 0, ids & ~top)
        keys, first, n = _summed(_level_keys(ids), n)
        kept = n >= rules.min_count
        columns = [_signed(w) for w in ids[:, first[kept]]]
        return pa.table([*columns, pa.array(n[kept]), _signed(keys[kept])], names=[*names, "n", "key"])

    schema = ", ".join(f"{n} long" for n in [*names, "n", "key"])
    blocks = texts.mapInArrow(count, "part long, block binary")
    return blocks.groupBy("part").applyInArrow(merge, schema)


# -------------------------------------------------------------------- model


@dataclass
class SuffixTree:
    """Written tables: ``words`` (w0, n), and per length of context the kept contexts and their successors.

    ``contexts[k - 1]`` has (w<k>, ..., w1, ckey, total, rest), ``successors[k - 1]``
    (w<k>, ..., w0, key, total, share): a token has the probability share (0 if it is no
    successor) plus rest times that in the context without its first word.
    """

    rules: TreeRules
    tokens: int  # N
    distinct: int  # V
    words: DataFrame
    contexts: list[DataFrame]
    successors: list[DataFrame]

    def base(self, count: Column) -> Column:
        return (count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))


def fit_suffix_tree(texts: DataFrame, rules: TreeRules = TreeRules(), hot_words: int = HOT_WORDS) -> SuffixTree:
    """Learn the tree from all texts of column ``text``.

    Counts are of all tokens; nothing but the ``hot_words`` most frequent words'
    counts and filters of a fixed size reach the driver.
    """
    spark, depth = texts.sparkSession, rules.depth
    texts = texts.select("text")
    words, _ = written_freed(vocabulary(texts), "words")
    tokens, distinct = words.where(col("w0") != START).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tree = SuffixTree(rules, tokens, distinct, words, [], [])
    if not tokens:
        return tree
    hot, least_hot = hot_counts(tree, hot_words)
    hot = spark.sparkContext.broadcast(hot)
    begins = words.where(col("w0") == START).first()["n"]
    below = words.where(col("w0") != START).select("w0", "n", col("w0").alias("key"), tree.base(col("n")).alias("p"))
    support = None
    for level in range(1, depth + 1):
        names = [f"w{i}" for i in range(level, -1, -1)]
        context, shorter = names[:-1], names[1:]
        found, drop_found = written_freed(grams(texts, level, rules, hot, least_hot, support, -(-tokens // PART_TOKENS)), "grams")
        # a context's places are those of the gram that it is
        totals = below.select(*[col(f"w{i - 1}").alias(f"w{i}") for i in range(level, 0, -1)], col("n").alias("total"), col("key").alias("ckey"))
        start = spark.range(1).select(*[F.lit(START).cast("long").alias(c) for c in context], F.lit(begins).alias("total"), F.lit(START).cast("long").alias("ckey"))
        joined = found.join(totals.unionByName(start), context).join(below.select(*shorter, col("p").alias("below")), shorter)
        joined, drop_joined = written_freed(joined.select(*names, "n", "key", "total", "ckey", "below"), "grams-below")
        drop_found()
        gain, kept = F.sum(col("n") * F.log(col("n") / col("total") / col("below"))), F.sum(col("n") - rules.discount)
        judged = joined.groupBy(*context, "ckey", "total").agg(gain.alias("gain"), kept.alias("kept"))
        judged = judged.where(col("gain") >= rules.min_gain).select(*context, "ckey", "total", (1 - col("kept") / col("total")).alias("rest"))
        contexts, _ = written_freed(judged, "contexts")
        share = F.when(col("rest").isNotNull(), (col("n") - rules.discount) / col("total"))
        # at the last length nothing is asked of grams in contexts that are not kept
        rows = joined.join(contexts.select(*context, "rest"), context, "left" if level < depth else "inner").withColumn("share", share)
        rows = rows.withColumn("p", F.coalesce(col("share") + col("rest") * col("below"), "below"))
        below, _ = written_freed(rows.select(*names, "n", "key", "total", "share", "p"), "states")
        drop_joined()
        tree.contexts.append(contexts)
        tree.successors.append(below.where("share is not null").select(*names, "key", "total", "share"))
        if level < depth:
            support = spark.sparkContext.broadcast(_filter(below))
    return tree


def hot_counts(tree: SuffixTree, hot_words: int) -> tuple[Words, int]:
    """The most frequent words, and the count that no other word exceeds."""
    ranked = tree.words.where(col("w0") != START).orderBy(F.desc("n"), "w0").limit(hot_words).toArrow()
    ids, counts = ranked.column("w0").to_numpy(), ranked.column("n").to_numpy()
    least = int(counts.min()) if tree.distinct > len(counts) else 0
    return Words(ids.view(np.uint64), counts), least


class _States:
    """Broadcast contexts and successors of one length, by key, and a filter over all other contexts."""

    def __init__(self, contexts: pa.Table, successors: pa.Table, others: np.ndarray | None):
        self.others = others
        for name, table, value in (("contexts", contexts, "rest"), ("successors", successors, "share")):
            keys = table.column(0).to_numpy().view(np.uint64)
            order = np.argsort(keys)
            setattr(self, name, (keys[order], table.column(value).to_numpy()[order]))

    def prepare(self) -> None:
        self.starts = []
        for keys, _ in (self.contexts, self.successors):
            bits = max(1, len(keys).bit_length())
            shift = np.uint64(64 - bits)
            counts = np.bincount((keys >> shift).astype(np.int64), minlength=1 << bits)
            self.starts.append((shift, np.concatenate(([0], np.cumsum(counts))).astype(np.int32)))
        self.other = None if self.others is None else _unpacked(self.others)

    def find(self, which: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of ``keys`` that are here, their values); keys are looked for among those of equal first bits."""
        ranked, values = (self.contexts, self.successors)[which]
        shift, starts = self.starts[which]
        first = keys >> shift
        low, high = starts[first], starts[first + np.uint64(1)]
        at = np.flatnonzero(low < high)
        found = np.full(len(keys), -1, np.int32)
        while len(at):
            place = low[at]
            same = ranked[place] == keys[at]
            found[at[same]] = place[same]
            at = at[~same]
            low[at] += 1
            at = at[low[at] < high[at]]
        at = np.flatnonzero(found >= 0)
        return at, values[found[at]]


def _hot_states(tree: SuffixTree, bound: int) -> list[_States]:
    """States of the most frequent contexts, ``bound`` of them at most, taken by powers of two of their places."""
    size = F.floor(F.log2("total")).cast("int").alias("size")
    tables = [t.select(size) for t in (*tree.contexts, *tree.successors)]
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    least, held = 64, 0
    for row in sorted(every.groupBy("size").count().collect(), key=lambda r: -r["size"]):  # at most 64 rows
        held += row["count"]
        if held > bound:
            break
        least = row["size"]
    hot = F.floor(F.log2("total")) >= least
    found = []
    for contexts, successors in zip(tree.contexts, tree.successors, strict=True):
        own = contexts.where(hot).select("ckey", "rest").toArrow(), successors.where(hot).select("key", "share").toArrow()
        cold = contexts.where(~hot).select(col("ckey").alias("key"))
        found.append(_States(*own, None if cold.isEmpty() else _filter(cold)))
    return found


# ------------------------------------------------------------------ scoring


def score_texts(
    docs: DataFrame, tree: SuffixTree, hot_words: int = HOT_WORDS, hot_states: int = HOT_STATES, id_column: str = "doc_id", text_column: str = "text",
    carry: tuple[str, ...] = (), window_tokens: int = SCORE_WINDOW, batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """Score each document: id, the carried columns, ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    A token is a word or the end.  Scores are sums of log10 probabilities: of
    single words, and in the tree's states.  Tokens whose word or state is not
    broadcast are written and joined with the tree's tables; texts are not
    shuffled.  That takes several times the texts' disk, so texts are scored in
    batches, by hash of the id, one for ``batch_tokens`` training tokens, and
    what a batch wrote and shuffled is deleted before the next.  A null or empty
    text is its end alone.  Repeated rows are scored each for itself; an empty
    table gives no rows.  ``window_tokens`` bounds what a task holds at once.
    """
    spark, depth = docs.sparkSession, tree.rules.depth if tree.contexts else 0
    words, _ = hot_counts(tree, hot_words)
    shared = spark.sparkContext.broadcast((words, _hot_states(tree, hot_states) if depth else []))
    norm = tree.tokens + 0.5 * (tree.distinct + 1)
    all_hot = tree.distinct <= hot_words
    plain = [id_column, *carry]
    batches = max(1, -(-tree.tokens // batch_tokens))
    batch = F.pmod(F.xxhash64(col(f"`{id_column}`"), F.length(f"`{text_column}`")), F.lit(batches))
    head = lambda texts: texts.select(F.monotonically_increasing_id().alias("row"), *[col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(plain)], col(f"`{text_column}`").alias("text"))
    context_names = [f"w{i}" for i in range(depth, -1, -1)]
    numbers = "n_tokens long, n_known long, base double, score double"
    cells = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(plain))
    schema = f"row long, {cells}, {numbers}, n0 long, add double, mul double, " + ", ".join(f"{n} long" for n in context_names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, states = shared.value
        for state in states:
            state.prepare()
        first = next(batches, None)
        if first is None:
            return
        fields = first.schema
        empty = lambda n, names: {c: pa.nulls(n, k) for c, k in names.items()}
        kinds = {f"c{i}": fields.field(f"c{i}").type for i in range(len(plain))}
        longs = dict.fromkeys(context_names, pa.int64())
        for window in windows(_texts(chain([first], batches), 1 + len(plain)), depth, window_tokens):
            place = words.place(window.known)
            count = np.where(place >= 0, words.counts[place] if len(words.counts) else 0, 0 if all_hot else -1)
            real = window.real
            token, row = window.local[real], window.row[real]
            keys = gram_keys(window, depth)
            add, mul, other = np.zeros(len(token)), np.ones(len(token)), np.zeros(len(token), bool)
            for level, state in enumerate(states, 1):
                if level == 1:  # a context is a word: each is looked up once
                    before = np.concatenate(([0], window.local[:-1]))[real]
                    here, values = state.find(0, window.known)
                    found = np.full(len(window.known), -1)
                    found[here] = np.arange(len(here))
                    at = np.flatnonzero(found[before] >= 0)
                    rest = values[found[before[at]]]
                else:
                    context = np.concatenate(([np.uint64(START)], keys[level - 1][:-1]))[real]
                    at, rest = state.find(0, context)
                add[at] *= rest
                mul[at] *= rest
                # successors are found in contexts that are here
                inside, share = state.find(1, keys[level][real][at])
                add[at[inside]] += share
                if state.other is not None:
                    strange = state.other(window.known)[before] if level == 1 else state.other(context)
                    strange[at] = False
                    other |= strange
            n0 = count[token]
            base = (np.maximum(n0, 0) + 0.5) / norm
            sure = ~other & (n0 >= 0)
            total = lambda values: np.bincount(row[sure], values[sure], len(window.keys)).astype(np.float64)  # noqa: E731  (whole numbers if there are none)
            result = {"row": pa.array([k[0].as_py() for k in window.keys], pa.int64())}
            result |= {f"c{i}": pa.array([k[i + 1].as_py() for k in window.keys], kinds[f"c{i}"]) for i in range(len(plain))}
            result["n_tokens"] = pa.array(np.bincount(row, minlength=len(window.keys)))
            result["n_known"] = pa.array(np.bincount(row[sure & (n0 > 0)], minlength=len(window.keys)))
            result["base"], result["score"] = pa.array(total(np.log10(base))), pa.array(total(np.log10(add + mul * base)))
            result |= empty(len(window.keys), {"n0": pa.int64(), "add": pa.float64(), "mul": pa.float64()} | longs)
            yield pa.RecordBatch.from_pydict(result)
            left = np.flatnonzero(~sure)
            if len(left):
                number = result["row"].take(pa.array(row[left]))
                rows = {"row": number} | empty(len(left), kinds)
                rows |= empty(len(left), {"n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "score": pa.float64()})
                rows["n0"] = pa.array(n0[left], mask=n0[left] < 0)
                rows["add"], rows["mul"] = pa.array(add[left]), pa.array(mul[left])
                at, state = np.flatnonzero(real)[left], other[left]
                before = np.zeros(len(at), bool)
                columns = []
                for back in range(depth + 1):
                    word = np.where(before, np.uint64(START), window.word[np.maximum(at - back, 0)])
                    before = word == START
                    columns.append(pa.array(word.view(np.int64), mask=(~state if back else np.zeros(len(at), bool))))
                rows |= {f"w{i}": c for i, c in enumerate(columns)}
                yield pa.RecordBatch.from_pydict({n: rows[n] for n in result})

    path = scratch_path(spark, "scores")
    for number in range(batches):
        scored, drop_scored = written_freed(head(docs.where(batch == number) if batches > 1 else docs).mapInArrow(score, schema), "scored")
        result = _summed_scores(scored, tree, depth, plain)
        write_freed(result, path, "append")
        drop_scored()
    return spark.read.schema(result.schema).parquet(path)


def _summed_scores(scored: DataFrame, tree: SuffixTree, depth: int, plain: list[str]) -> DataFrame:
    """The scores of each text, from the sums of its sure tokens and from its open ones, which meet the tree's tables."""
    context_names = [f"w{i}" for i in range(depth, -1, -1)]
    sums = ["n_tokens", "n_known", "base", "score"]
    whole = scored.where("w0 is null").select("row", *[f"c{i}" for i in range(len(plain))], *sums)
    open_rows = scored.where("w0 is not null").select("row", "n0", "add", "mul", *context_names)
    counts = tree.words.where(col("w0") != START).select("w0", col("n").alias("n0"))
    unknown = open_rows.where("n0 is null").drop("n0").join(counts, "w0", "left")
    named = open_rows.where("n0 is not null").unionByName(unknown.withColumn("n0", F.coalesce("n0", F.lit(0))))
    named = named.withColumn("base", tree.base(col("n0")))
    score_of = lambda rows, p: rows.select(
        "row", (col("n0") > 0).cast("long").alias("n_known"), F.log10("base").alias("base"), F.log10(p).alias("score")
    )
    if depth:
        by_word = score_of(named.where("w1 is null"), col("add") + col("mul") * col("base"))
        rows = named.where("w1 is not null").withColumn("p", col("base"))
        for level in range(1, depth + 1):
            names = [f"w{i}" for i in range(level, -1, -1)]
            contexts = tree.contexts[level - 1].select(*names[:-1], "rest")
            successors = tree.successors[level - 1].select(*names, "share")
            rows = rows.join(contexts, names[:-1], "left").join(successors, names, "left")
            p = F.coalesce(col("rest") * col("p") + F.coalesce("share", F.lit(0.0)), "p")
            rows = rows.withColumn("p", p).drop("rest", "share")
        parts = by_word.unionByName(score_of(rows, col("p")))
    else:
        parts = score_of(named, col("base"))
    parts = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in sums[1:]])
    every = whole.unionByName(parts, allowMissingColumns=True).groupBy("row")
    # a text in several windows has its columns in each, and the sums of the joined tokens have none
    every = every.agg(*[F.max_by(f"c{i}", F.struct(col("n_tokens").isNotNull(), F.coalesce("n_tokens", F.lit(0)))).alias(f"c{i}") for i in range(len(plain))], *[F.sum(c).alias(c) for c in sums])
    return every.select(
        *[col(f"c{i}").alias(c) for i, c in enumerate(plain)], "n_tokens", F.coalesce("n_known", F.lit(0)).alias("n_known"),
        F.coalesce("base", F.lit(0.0)).alias("base_score"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
