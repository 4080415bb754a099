"""Manifests, ranked search and the suffix tree against plain versions."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkloom.llm.manifest import build_manifest, folded_root, leaf_digest, numbered, proof_digest
from inkloom.llm.queries import ORACLES, QUERIES
from inkloom.llm.ranked_search import ranked_search, terms_of
from inkloom.llm.suffix_tree import TreeRules, fit_suffix_tree, score_texts, windows
from inkloom.session import scratch_path
from tests.compare import connect, difference
from tests.llm.cases import documents


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_ranked_search"])
def test_queries_against_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""


# ----------------------------------------------------------------- manifests


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves, fan):
    """(root, per leaf the siblings left and right of each node up to the root)."""
    paths, below = [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        nodes, groups = [], []
        for a in range(0, len(leaves), fan):
            run = leaves[a : a + fan]
            for k, members in enumerate(below[a : a + fan]):
                for i in members:
                    paths[i].append((run[:k], run[k + 1 :]))
            nodes.append(digest("".join(run)))
            groups.append([i for members in below[a : a + fan] for i in members])
        leaves, below = nodes, groups
    return leaves[0], paths


def plain_manifest(rows, fan=3):
    """Rows (source, id, text) -> sorted (id, leaf, subroot, root, proof digest)."""
    framed = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for source, key, text in rows:
        groups[source].append(((key is not None, key or 0), digest("".join(map(framed, (key, source, text)))), key))
    trees = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        members = sorted(groups[source], key=lambda m: m[:2])
        trees.append((members, *plain_tree([m[1] for m in members], fan)))
    root, above = plain_tree([t[1] for t in trees], fan)
    out = []
    for (members, subroot, paths), top in zip(trees, above, strict=True):
        for (_, leaf, key), path in zip(members, paths, strict=True):
            out.append((key, leaf, subroot, root, digest("".join("".join(a) + "".join(b) for a, b in path + top))))
    return sorted(out, key=repr)


def manifest_rows(docs, **settings):
    leaf = leaf_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    made = build_manifest(docs, leaf, **settings)
    folded = folded_root(F.col("leaf"), F.col("path"))
    rows = made.leaves.select("doc_id", "leaf", "subroot", F.lit(made.root).alias("root"), proof_digest(F.col("path")).alias("proof"), folded.alias("folded"))
    rows = rows.collect()
    assert all(r.folded == made.root for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=repr)


SOURCES = {
    "many": [("hot", i, f"text {i}") for i in range(40)] + [(None, i, None) for i in (5, 7)] + [("ä", 3, "x"), ("z", None, ""), ("hot", None, "y")],
    "repeated": [("a", 1, "same")] * 11 + [("a", 1, "other"), ("", 2, "empty name"), ("-", 4, "sign"), ("=", 5, "sign")],
    "one group": [("a", i, "t") for i in range(10)],
    "one row": [("a", 1, "t")],
    "single rows": [(f"s{i}", i, "t") for i in range(5)],
}


@pytest.mark.parametrize("case", SOURCES)
@pytest.mark.parametrize("fan", [2, 3])
def test_manifest(spark, case, fan):
    rows = SOURCES[case]
    docs = spark.createDataFrame(rows, "source string, doc_id long, text string").repartition(3)
    docs = docs.withColumns({c: F.lit("clash") for c in ("tree", "index", "n", "leaf", "path", "row")})
    assert manifest_rows(docs, fan=fan, rows_per_range=4) == plain_manifest(rows, fan)


def test_manifest_without_rows(spark):
    docs = spark.createDataFrame([], "source string, doc_id long, text string")
    made = build_manifest(docs, leaf_digest(F.col("doc_id")))
    assert made.root is None and made.leaves.columns == ["doc_id", "leaf", "subroot", "path"] and made.leaves.count() == 0


def test_manifest_odd_documents(spark):
    docs = documents(spark).withColumn("source", F.col("word"))
    rows = [(r.source, r.doc_id, r.text) for r in docs.collect()]
    assert manifest_rows(docs, rows_per_range=5) == plain_manifest(rows)


def test_positions_of_one_group_use_many_ranges(spark):
    rows = spark.range(1000).select(F.lit("=hot").alias("tree"), "id")
    placed = numbered(rows, ["id"], rows_per_range=50)
    assert sorted((r["id"], r["index"], r["n"]) for r in placed.collect()) == [(i, i, 1000) for i in range(1000)]


def test_tampered_row_is_told(spark):
    docs = spark.createDataFrame([("a", i, f"t\n{i}") for i in range(9)], "source string, doc_id long, text string")
    made = build_manifest(docs, leaf_digest(F.col("text")))
    wrong = made.leaves.select(folded_root(F.sha2(F.lit("x").cast("binary"), 256), F.col("path")).alias("r"))
    assert made.root not in {r.r for r in wrong.collect()}


# -------------------------------------------------------------------- search


def plain_search(docs, items, top):
    terms = [(key, Counter(terms_of(text))) for key, text in docs]
    terms = [(key, c, sum(c.values())) for key, c in terms if c]
    n, total, held = len(terms), sum(t[2] for t in terms), Counter(t for _, c, _ in terms for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, counts, size in terms:
            m = 25 + 75 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms_of(text) if counts[t]
            )
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_terms", [5, 1000])
def test_ranked_search(spark, block_terms):
    dice = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)] + ["Ünï", "B-c"]
    docs = [(i, " ".join(dice.choice(words, dice.integers(0, 9)))) for i in range(150)]
    docs += [(1000 + i, "w1 w2 w2") for i in range(60)] + [(None, "w1 W2 w2"), (None, None), (7, "w1 w2 w2"), (7, "w1 w2 w2")]
    items = [(i, " ".join(dice.choice(words, dice.integers(1, 6)))) for i in range(9)] + [(3, "w2 w2 b"), (50, None), (51, "unseen")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns({c: F.lit(1) for c in ("n", "bag", "m", "hash", "score", "rank")})
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x"))
    got = ranked_search(frame, queries, top=4, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(docs, items, 4)


def test_ranked_search_odd_documents(spark):
    docs = documents(spark)
    items = spark.createDataFrame([(1, "quick text"), (2, "ALL rights 日本語")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = plain_search(rows, [(r.item_id, r.text) for r in items.collect()], 10)
    assert sorted(map(tuple, ranked_search(docs, items).collect()), key=repr) == wanted
    assert ranked_search(docs.limit(0), items).count() == 0 and ranked_search(docs, items.limit(0)).count() == 0


# --------------------------------------------------------------- suffix tree


def plain_scores(rows, rules):
    """(id, held out, n_tokens, n_known, base, score) of rows (id, text, held out), by counting all grams."""
    tokens = lambda text: [*(text or "").encode().lower().split(), 1]
    depth, train = rules.depth, [tokens(t) for _, t, out in rows if not out]
    single = Counter(w for t in train for w in t)
    n, distinct = sum(single.values()), len(single)
    base = lambda w: (single[w] + 0.5) / (n + 0.5 * (distinct + 1))
    places, held = defaultdict(Counter), defaultdict(Counter)
    for t in train:
        padded = [0] * depth + t
        for i in range(depth, len(padded)):
            for k in range(1, depth + 1):
                places[k][tuple(padded[i - k : i + 1])] += 1
                held[k][tuple(padded[i - k : i])] += 1
    share, rest = defaultdict(dict), defaultdict(dict)

    def chance(context, word, level):
        p = base(word)
        for k in range(1, level + 1):
            own = context[len(context) - k :]
            if own in rest[k]:
                p = share[k].get((*own, word), 0) + rest[k][own] * p
        return p

    for k in range(1, depth + 1):
        found = defaultdict(list)
        for gram, count in places[k].items():
            if count >= rules.min_count:
                found[gram[:-1]].append((gram, count))
        for own, grams in found.items():
            total = held[k][own]
            if sum(c * math.log(c / total / chance(own[1:], g[-1], k - 1)) for g, c in grams) >= rules.min_gain:
                rest[k][own] = 1 - sum(c - rules.discount for _, c in grams) / total
                share[k].update((g, (c - rules.discount) / total) for g, c in grams)
    out = []
    for key, text, is_out in rows:
        own = tokens(text)
        padded = [0] * depth + own
        score = sum(math.log10(chance(tuple(padded[i - depth : i]), padded[i], depth)) for i in range(depth, len(padded)))
        out.append((key, is_out, len(own), sum(single[w] > 0 for w in own), sum(math.log10(base(w)) for w in own), score))
    return sorted(out, key=repr), sum(map(len, rest.values())), sum(map(len, share.values()))


def scored_rows(docs, rules, **bounds):
    hot = {k: v for k, v in bounds.items() if k == "hot_words"}
    tree = fit_suffix_tree(docs.where("not held_out"), rules, **hot)
    rows = score_texts(docs, tree, carry=("held_out",), **bounds)
    assert rows.columns == ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    sizes = [sum(t.count() for t in tables) for tables in (tree.contexts, tree.successors)]
    return sorted(map(tuple, rows.collect()), key=repr), *sizes


def assert_same(got, wanted):
    assert got[1:] == wanted[1:] and [g[:4] for g in got[0]] == [w[:4] for w in wanted[0]]
    assert [g[4:] for g in got[0]] == [pytest.approx(w[4:], rel=1e-9) for w in wanted[0]]


@pytest.mark.parametrize(
    ("rules", "bounds"),
    [
        (TreeRules(min_count=3, min_gain=2.0), {}),
        (TreeRules(min_count=3, min_gain=2.0), {"hot_words": 40, "hot_states": 30}),
        (TreeRules(depth=3, min_count=2, min_gain=1.0), {"hot_words": 5, "hot_states": 0}),
        (TreeRules(depth=1), {"hot_words": 100}),
    ],
)
def test_suffix_tree(spark, sf_dir, rules, bounds):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1).alias("held_out"))
    rows = [tuple(r) for r in docs.collect()]
    wanted = plain_scores(rows, rules)
    assert wanted[1] > 0
    assert_same(scored_rows(docs, rules, **bounds), wanted)


def test_suffix_tree_beats_single_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", F.col("doc_id") % 4 == 0)
    rows, *_ = scored_rows(docs, TreeRules(min_count=3, min_gain=2.0))
    held = [r for r in rows if r[1]]
    assert sum(r[5] for r in held) > sum(r[4] for r in held)


def test_suffix_tree_probabilities_sum_to_one(spark):
    """The successors' shares and the weight of the shorter context are one in each state."""
    texts = ["a b a b c", "a b c a b", "a b a b a b", "c c a b", "a b"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    tree = fit_suffix_tree(docs, TreeRules(min_count=2, min_gain=0.1))
    assert all(contexts.count() for contexts in tree.contexts)
    for contexts, successors in zip(tree.contexts, tree.successors, strict=True):
        names = [c for c in contexts.columns if c.startswith("w")]
        whole = contexts.join(successors.groupBy(*names).agg(F.sum("share").alias("share")), names)
        assert whole.count() == contexts.count() and all(r.share + r.rest == pytest.approx(1) for r in whole.collect())


def test_suffix_tree_odd_documents(spark):
    docs = documents(spark).withColumn("held_out", F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)))
    rows = [(r.doc_id, r.text, r.held_out) for r in docs.collect()]
    rules = TreeRules(min_count=2, min_gain=0.5)
    assert_same(scored_rows(docs, rules), plain_scores(rows, rules))
    empty, *_ = scored_rows(docs.limit(0), rules)
    assert empty == []
    # nothing to learn from: each token is as likely as any
    unlearned = score_texts(docs.withColumn("held_out", F.lit(True)), fit_suffix_tree(docs.limit(0)))
    assert all(r.n_known == 0 and r.score == 0 for r in unlearned.collect())


@pytest.mark.parametrize("size", [3, 10, 1000])
def test_windows_hand_texts_on(size, monkeypatch):
    monkeypatch.setattr("inkloom.llm.suffix_tree.PIECE", 4)
    texts = [("a", "one two three four five six"), ("b", None), ("c", "  "), ("d", "x " * 20)]
    found = defaultdict(list)
    for window in windows(iter(texts), 2, size):
        for i in np.flatnonzero(window.real):
            found[window.keys[window.row[i]]].append(tuple(window.word[max(0, i - 2) : i + 1].tolist()))
    whole = defaultdict(list)
    for window in windows(iter(texts), 2, 10**9):
        for i in np.flatnonzero(window.real):
            whole[window.keys[window.row[i]]].append(tuple(window.word[max(0, i - 2) : i + 1].tolist()))
    for key in whole:
        assert [g[-1] for g in found[key]] == [g[-1] for g in whole[key]]
        assert [g[-3:] for g in found[key][2:]] == [g[-3:] for g in whole[key][2:]]


def test_a_window_has_each_word_once_in_order(monkeypatch):
    """Split in many pieces or in one, words are told by id and looked up once."""
    texts = [("a", "B c\x1cd  \t é"), ("b", " x B\x0b" * 30), ("c", None), ("d", "c" * 50)]
    found = []
    for piece in (4, 1 << 20):
        monkeypatch.setattr("inkloom.llm.suffix_tree.PIECE", piece)
        [window] = windows(iter(texts), 2, 10**9)
        assert (np.diff(window.known.astype(object)) > 0).all() and len(window.known) == 7
        found.append((window.word.tolist(), window.real.tolist(), window.row.tolist(), window.keys))
    assert found[0] == found[1] and found[0][3] == ["a", "b", "c", "d"]


def test_scores_do_not_depend_on_what_a_task_holds_at_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tree = fit_suffix_tree(docs, TreeRules(min_count=3, min_gain=2.0))
    whole, small = ({r.doc_id: tuple(r) for r in score_texts(docs, tree, **b).collect()} for b in ({}, {"window_tokens": 50}))
    assert whole.keys() == small.keys()
    assert all(small[k][:3] == w[:3] and small[k][3:] == pytest.approx(w[3:], rel=1e-9) for k, w in whole.items())


def test_suffix_tree_scores_in_batches(spark, monkeypatch):
    """Batches give the scores of one run, and what they wrote and shuffled is gone when they are done."""
    import os

    rows = [(f"d{i % 30}" if i % 7 else None, " ".join(f"w{(i * j) % 11}" for j in range(i % 20)) or None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    tree = fit_suffix_tree(docs, TreeRules(min_count=2, min_gain=0.5))
    folders = []
    monkeypatch.setattr("inkloom.llm.tables.scratch_path", lambda s, name, f=scratch_path: folders.append((name, f(s, name))) or folders[-1][1])
    bounds = {"hot_words": 2, "hot_states": 2}
    whole = score_texts(docs, tree, **bounds)
    assert [n for n, _ in folders] == ["scored"]
    parts = score_texts(docs, tree, batch_tokens=-(-tree.tokens // 4), **bounds)
    assert [n for n, _ in folders] == ["scored"] * 5 and not any(os.path.exists(p) for _, p in folders)
    assert parts.schema == whole.schema
    rounded = lambda df: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    assert rounded(parts) == rounded(whole) and len(rounded(parts)) == 60
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
