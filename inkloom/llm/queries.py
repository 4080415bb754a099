"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.llm.bpe import bpe_encode, read_ranks
from inkloom.llm.fingerprints import fingerprint_neighbors
from inkloom.llm.licenses import scan_licenses
from inkloom.llm.manifest import build_manifest, folded_root, leaf_digest, proof_digest
from inkloom.llm.packing import best_fit_pack, token_pieces
from inkloom.llm.pii import replace_pii
from inkloom.llm.quality import fit_quality, quality_score
from inkloom.llm.quality_rules import apply_rules, language_references
from inkloom.llm.ranked_search import ranked_search
from inkloom.llm.simhash import simhash_groups
from inkloom.llm.suffix_tree import fit_suffix_tree, score_texts
from inkloom.llm.tables import fold_of
from inkloom.llm.toxicity import fit_toxicity, toxicity_score
from inkloom.llm.warc import read_records, write_archives
from inkloom.session import scratch_path

PII_KEY = "corpus surrogates"  # a real corpus gets a secret one


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _predictions(docs: DataFrame, score: Column, held_out: Column, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents`` by a lexicon learned from four folds of five; null and empty texts have no match, repeated rows stay."""
    docs, held_out = _table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 5) == 0
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels").where(~held_out))
    return _predictions(docs, toxicity_score(F.col("text"), spark, model), held_out, 0.5)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all ``pages``, written and read back; a null html is an empty payload, repeated rows are records each for itself."""
    folder = scratch_path(spark, "archives")
    write_archives(_table(spark, sf_dir, "pages"), folder, min_bytes=0)
    archives = spark.read.schema("archive_id string, records long, content binary").parquet(folder)
    return read_records(archives).select(
        F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents``, their edited texts and the next document's; null texts are empty, a long text is taken whole."""
    prints = fingerprint_neighbors(_table(spark, sf_dir, "documents"))
    edited = F.sha2(F.col("edited_text"), 256).alias("edited_sha256")
    return prints.select("doc_id", "n_chars", edited, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all ``documents`` in sequences; a null or empty text is its end id, longer ones than a sequence are cut."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        pieces = token_pieces(_table(spark, sf_dir, "documents"), file.read())
    return best_fit_pack(pieces)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of all ``documents``; null and empty texts have no words and fail the base rules."""
    docs = _table(spark, sf_dir, "documents")
    judged = docs.select("doc_id", apply_rules(F.col("text"), language_references(docs)).alias("r"))
    return judged.select("doc_id", "r.*")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in all ``documents``; null and empty texts have none, repeated rows stay."""
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all ``documents`` and what they decode to; null and empty texts have no ids."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe_encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_decoded=True)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all ``documents``; texts without words have the fingerprint zero and are linked like others."""
    groups = simhash_groups(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with surrogates for personal data; clean, null and empty texts are handed on as they are."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_pii(docs, key=PII_KEY, kinds_column="kinds").withColumn("n_entities", F.size("kinds").cast("long"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all ``documents`` by a ranking learned from three folds of four; null and empty texts have zero features."""
    docs, held_out = _table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 4) == 2
    model = fit_quality(docs, _table(spark, sf_dir, "labels").where(~held_out))
    return _predictions(docs, quality_score(F.col("text"), model, at_threshold=0.7), held_out, 0.7)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` by source; half of the rows are checked after their line feeds are gone.

    Null values are leaves' parts like others; a table without rows gives none.
    """
    docs = _table(spark, sf_dir, "documents")
    head, text = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampered, leaf_digest(*head, F.replace(text, F.lit("\n"), F.lit(""))))
    manifest = build_manifest(docs.withColumn("changed", changed), leaf_digest(*head, text), carry=("changed",))
    root, folded = F.lit(manifest.root), folded_root(F.coalesce("changed", "leaf"), F.col("path"))
    rows = manifest.leaves.select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each ``benchmark`` item; texts without terms are in no result."""
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), top=10)


def op13_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents`` by a suffix tree learned from four folds of five; a null id would be learned from."""
    held_out = F.coalesce(fold_of(F.col("doc_id"), 5) == 1, F.lit(False))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    tree = fit_suffix_tree(docs.where(~F.col("held_out")))
    scored = score_texts(docs, tree, carry=("held_out",))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tree.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op2_warc": op2_warc,
    "op3_fingerprints": op3_fingerprints,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_licenses": op6_licenses,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_simhash": op8_simhash,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_ranked_search": op12_ranked_search,
    "op13_suffix_tree": op13_suffix_tree,
}

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# five hexadecimal digits of the SHA-1 at a time are four digits of base 32
_BASE32 = " || ".join(
    f"substr('{_ALPHABET}', CAST((('0x' || substr(sha, {5 * block + 1}, 5))::INT >> {shift}) & 31 AS INT) + 1, 1)"
    for block in range(8)
    for shift in (15, 10, 5, 0)
)



def _framed(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_HEAD = " || ".join(map(_framed, ("doc_id", "source", "lang", "n_chars")))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = r"regexp_extract_all(translate(text, '%s', '%s'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')" % (_UPPER, _LOWER)

# The other operators have no SQL: trained scores, tokenizers, digests and XXH64 fingerprints.
# CRC-32 has no function in DuckDB: each byte is folded in by eight shifts.
ORACLES: dict[str, str] = {
    "op2_warc": f"""
SELECT page_id, strlen(payload) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM (
  SELECT page_id, payload, sha1(payload) AS sha, max(page_id) OVER (PARTITION BY payload) AS last
  FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages)
)
""",
    "op12_ranked_search": f"""
WITH held AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM held GROUP BY ALL),
totals AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM sizes),
counts AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(all_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term
),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256({_HEAD} || {_framed("text")}) AS h,
         sha256({_HEAD} || {_framed("CASE WHEN CRC % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS seen,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT *, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
               lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)) + 1 AS CRC FROM documents)
),
nodes(source, level, i, n, h) AS (
  SELECT source, 0, i, n, h FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY source, level, i // 3, n
),
subroots AS (SELECT source, h, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, i, n, h) AS (
  SELECT 0, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 3, n
),
every AS (SELECT 0 AS part, source, level, i, h FROM nodes UNION ALL SELECT 1, NULL, level, i, h FROM tops),
places AS (
  SELECT doc_id, 0 AS part, leaves.source AS source, level, (i // (3 ** level)::BIGINT) AS own FROM leaves JOIN (SELECT DISTINCT source, level FROM nodes WHERE n > 1) AS up
  ON leaves.source IS NOT DISTINCT FROM up.source
  UNION ALL
  SELECT doc_id, 1, NULL, level, (subroots.i // (3 ** level)::BIGINT)
  FROM leaves JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source, (SELECT DISTINCT level FROM tops WHERE n > 1) AS up
),
steps AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part, level) AS step, before, after FROM (
    SELECT doc_id, p.part, p.level, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS before,
           coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS after
    FROM places AS p JOIN every AS e ON p.part = e.part AND p.level = e.level AND p.source IS NOT DISTINCT FROM e.source AND i // 3 = own // 3
    GROUP BY doc_id, p.part, p.level
  )
),
folds(doc_id, step, h) AS (
  SELECT doc_id, 0, seen FROM leaves
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(before || h || after) FROM folds AS f JOIN steps AS s ON f.doc_id = s.doc_id AND s.step = f.step + 1
),
proofs AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY doc_id),
root AS (SELECT h FROM tops WHERE n = 1)
SELECT doc_id, leaves.h AS leaf, subroots.h AS subroot, root.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       last AS folded_root, last = root.h AS verified
FROM leaves JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source
JOIN (SELECT doc_id, arg_max(h, step) AS last FROM folds GROUP BY doc_id) USING (doc_id) LEFT JOIN proofs USING (doc_id), root
""",
}
