"""Encoding, packing, fingerprints and archives against plain versions."""

import random
import tracemalloc
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from inkloom.llm import bpe, fingerprints, packing, warc
from tests.llm.cases import ROWS, documents

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PARTS = ["a", "b", " ", "  ", "\n", "\t", "1", "23", "'s", "'ll", "é", "é", "ß", "日本", "😀", " ", "\u0085", "\x1c", "aaaaaaa", "!!", "...", "the", "ing", "İ", "K", "Σ", "<|endoftext|>", "\r\n"]


def random_texts(n: int) -> list[str]:
    dice = random.Random(5)
    return ["".join(dice.choice(PARTS) for _ in range(dice.randint(0, 40))) for _ in range(n)]


def test_replay_gives_the_ids_of_the_library():
    texts = random_texts(2000) + ["a" * 3000, "ab" * 2000, "!" * 1001 + "?", "ahahaha" * 300] + [t for _, t in ROWS if t]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    got = bpe._Encoder(bpe.Merges(RANKS), public_tokenizers.PATTERN)(texts).to_pylist()
    assert got == [library.encode_ordinary(t) for t in texts]


def test_encode_and_decode_tables(spark):
    encoded = bpe.bpe_encode(documents(spark), RANKS, public_tokenizers.PATTERN, with_decoded=True)
    rows = encoded.withColumn("again", bpe.bpe_decode(encoded["ids"], spark, RANKS)).collect()
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in rows) == Counter((i, t or "") for i, t in ROWS)
    assert all(r.again == r.decoded for r in rows)
    assert bpe.bpe_encode(documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


WORDS_JSON = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


def test_tokens_equal_the_whole_text_encoding():
    texts = random_texts(2000)
    plain = Tokenizer.from_str(WORDS_JSON).encode_batch(texts, add_special_tokens=False)
    assert packing._Tokens(WORDS_JSON)(texts) == [np.array(e.ids, "<u4").tobytes() for e in plain]


def test_pieces_and_sequences(spark):
    pieces = packing.token_pieces(documents(spark), WORDS_JSON, capacity=64, with_ids=True)
    packed = packing.best_fit_pack(pieces, capacity=64, open_bins=4, per_packer=5).toPandas()
    own = Tokenizer.from_str(WORDS_JSON)
    want = Counter()
    for key, text in ROWS:
        ids = own.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 64)):
            want[key, n, at, np.array(ids[at : at + 64], "<u4").tobytes()] += 1
    keys = [None if k != k else int(k) for k in packed.doc_id]
    assert Counter(zip(keys, packed.piece, packed.start, packed.ids)) == want
    for _, rows in packed.sort_values("offset").groupby("sequence_id"):
        ends = (rows.offset + rows.length).tolist()
        assert rows.offset.tolist() == [0, *ends[:-1]] and ends[-1] <= 64
    empty = packing.token_pieces(documents(spark, []), WORDS_JSON)
    assert packing.best_fit_pack(empty).count() == 0


@pytest.mark.parametrize("open_bins", [1, 3, 50])
def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest(open_bins):
    dice, bins, open_now = random.Random(1), packing.BestFit(100, open_bins), {}
    for _ in range(3000):
        size = dice.randint(1, 100)
        fitting = [free for free in open_now.values() if free >= size]
        number, offset = bins.place(size)
        if fitting:
            assert open_now[number] == min(fitting) == 100 - offset
        else:
            assert offset == 0 and number not in open_now
            if len(open_now) == open_bins:
                del open_now[min(open_now, key=lambda n: (open_now[n], n not in [x for b in bins.bins for x in b]))]
            open_now[number] = 100
        open_now[number] -= size
        open_now = {n: f for n, f in open_now.items() if f}
        if {x for b in bins.bins for x in b} != set(open_now):  # equally full bins may differ in which one closed
            open_now = {x: f for f, b in enumerate(bins.bins) for x in b}
        assert len(open_now) <= open_bins


def test_digest_is_that_of_plain_counting():
    data = ("grüße an alle " * 9).encode()
    counts = [0] * 64
    for number, (a, b, c) in enumerate(fingerprints.SPANS):
        for i in range(len(data) - c):
            x = (data[i + a] << 16 | data[i + b] << 8 | data[i + c]) + (number << 24)
            x = x * 2654435761 % 2**32
            x = (x ^ x >> 15) * 2246822519 % 2**32
            counts[x >> 26] += 1
    ranked = sorted(counts)
    codes = [sum(n > ranked[q] for q in (15, 31, 47)) for n in counts]
    packed = "".join(f"{codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3]:02x}" for i in range(0, 64, 4))
    assert fingerprints.digest(data, 64)[2:] == packed
    assert fingerprints.likeness(fingerprints.digest(data), fingerprints.digest(data)) == 1.0
    assert 0 <= fingerprints.likeness(fingerprints.digest(b""), fingerprints.digest(b"x" * 9000)) < 1


@pytest.mark.parametrize("ranges", [1, 3, 80])
def test_each_document_meets_the_next(spark, ranges):
    rows = [(i * 3, f"text {i} " * (i % 7)) for i in range(100)] + [(None, "x"), (None, None), (30, "again")]
    got = fingerprints.with_next(documents(spark, rows), ranges=ranges).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = [(k, t or "", order[(n + 1) % len(order)][1] or "") for n, (k, t) in enumerate(order)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_fingerprints_of_odd_documents(spark):
    rows = fingerprints.fingerprint_neighbors(documents(spark)).collect()
    assert Counter((r.doc_id, r.n_chars) for r in rows) == Counter((i, len(t or "")) for i, t in ROWS)
    assert len({r.fingerprint for r in rows if r.doc_id == 6}) == 1
    assert fingerprints.fingerprint_neighbors(documents(spark, [])).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, refers_to string").repartition(2)


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "u1", "<p>same</p>"), (2, "u2", "<p>same</p>"), (3, None, None), (4, "u4", ""), (5, "u5", "ü" * 300_000), (5, "u5", "ü" * 300_000)]
    rows += [(None, "n", "<p>same</p>")] + [(10 + i, f"http://h/{i}", f"<html><body>common words {i} in a page</body></html>") for i in range(300)]
    warc.write_archives(pages(spark, rows), f"{tmp_path}/a", archive_bytes=20_000)
    archives = spark.read.parquet(f"{tmp_path}/a")
    assert archives.count() > 3
    assert all(bytes(r.content[:4]) == b"\x5d\x2a\x4d\x18" for r in archives.collect())
    got = Counter((r.page_id, r.url, r.record_type, r.payload_bytes, r.refers_to, bytes(r.body).decode()) for r in warc.read_records(archives).collect())
    last: dict[str, int] = {}
    for key, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if key is None else key)
    want = Counter()
    for key, url, html in rows:
        html = html or ""
        first = last[html] == key
        text = None if key is None else str(key)
        want[text, url or "", "response" if first else "revisit", len(html.encode()), None if first else str(last[html]), html if first else ""] += 1
    assert got == want
    warc.write_archives(pages(spark, []), f"{tmp_path}/b")
    assert warc.read_records(spark.read.schema(archives.schema).parquet(f"{tmp_path}/b")).count() == 0


def test_small_payloads_are_all_responses(spark):
    marked = warc.with_revisits(pages(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")]).drop("refers_to"), min_bytes=5)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in marked.collect()) == [
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None),
    ]


def test_a_dictionary_helps_small_records():
    records = [f"<html><head><title>page {i}</title></head><body>the same frame around {i * 7}</body></html>".encode() for i in range(500)]
    assert len(warc.compress_archive(records)) < 0.7 * len(warc.compress_archive(records, dictionary_bytes=0))


def test_tokens_of_any_letters_equal_the_tokenizer():
    """Words of letters, marks and numbers of all scripts, with signs behind them."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        made = file.read()
    dice = random.Random(4)
    every = [chr(c) for c in range(0x21, 0x30000) if unicodedata.category(chr(c))[0] in "LMN"]
    near = [chr(c) for c in range(0xC0, 0x530)] + list("abcdIİıſKẞǅ")
    word = lambda: "".join(dice.choice(dice.choice((every, near))) for _ in range(dice.randint(1, 4)))
    signs = lambda: "".join(dice.choice(".,!?;:*%&$#'\"-()") for _ in range(dice.randint(0, 3)))
    texts = ["ख़! x"] + [dice.choice((" ", "\n", "  ")).join(word() + signs() for _ in range(dice.randint(1, 4))) for _ in range(20_000)]
    ids = [np.frombuffer(i, "<u4").tolist() for i in packing._Tokens(made)(texts)]
    assert ids == [e.ids for e in Tokenizer.from_str(made).encode_batch(texts, add_special_tokens=False)]


def test_remembered_chunks_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_BYTES", 50_000)
    memory = packing._Memory()
    for n in range(200):
        new = [f"w{n}-{i}" for i in range(10)] + ["x" * 500 + str(n)]
        memory.update((c, b"1234") for c in new)
        memory.settle(new)
        assert memory.taken <= 50_000 and len(memory) <= 300 and max(map(len, memory), default=0) <= packing.LONGEST_KNOWN


def test_plain_words_go_straight_to_the_model():
    """Words of Latin letters need no general tokenizer; their ids are those of the whole text."""
    dice = random.Random(5)
    texts = [" ".join("".join(dice.choices("abcdeghinorstTI", k=dice.randint(1, 9))) for _ in range(300)) for _ in range(20)]
    texts += [None, "", "\n", "ab  cd\nab", *texts[:2]]
    tokens = packing._Tokens(WORDS_JSON)
    general, asked = tokens.tokenizer, []
    packing._KNOWN.clear()
    tokens.known, tokens.tokenizer = packing._Memory(), None
    tokens._encode = lambda chunks: asked.extend(chunks) or tokens.known.update((c, b"") for c in chunks)
    found = [np.frombuffer(i, "<u4").tolist() for i in tokens(texts)]
    assert set(asked) <= {""}
    assert found == [e.ids for e in general.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_a_worker_that_tokenizes_takes_bounded_memory():
    """Many distinct words are remembered in little memory, and what a call took is given back."""
    packing._KNOWN.clear()
    tokens, dice = packing._Tokens(WORDS_JSON), random.Random(6)
    texts = [" ".join(f"{dice.getrandbits(48):x}," for _ in range(1000)) for _ in range(150)]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        first = [zlib.crc32(ids) for at in range(0, 150, 15) for ids in tokens(texts[at : at + 15])]
        taken = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert taken < 32_000_000  # 300,000 words, with and without the sign behind them
    tokens.tokenizer = tokens.words = None  # nothing is tokenized again
    assert [zlib.crc32(ids) for at in range(0, 150, 15) for ids in tokens(texts[at : at + 15])] == first


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(packing, "_hashes", lambda chunks: np.array([len(c) for c in chunks], np.int64))
    memory = packing._Memory()
    for new in (["ab", "cd", "", "xyz"], ["cd", "q"]):
        assert memory.recall(new) == new
        memory.update((c, c.encode()) for c in new)
        memory.settle(new)
    assert memory.recall(["", "ab", "cd", "ef", "q", "r", "xyz", "long"]) == ["cd", "ef", "r", "long"]
    assert dict(memory) == {c: c.encode() for c in ("", "ab", "q", "xyz")}
