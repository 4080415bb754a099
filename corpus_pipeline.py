"""The corpus pipeline: from documents to packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.llm.packing import best_fit_pack, token_pieces
from inkloom.llm.pii import replace_pii
from inkloom.llm.quality import fit_quality, quality_score
from inkloom.llm.queries import PII_KEY
from inkloom.llm.simhash import drop_near_duplicates
from inkloom.llm.tables import written
from inkloom.llm.toxicity import fit_toxicity, toxicity_score


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the lexicon learned from their labels.

    Null and empty texts have no match and stay; repeated rows share their fate;
    without labelled toxic rows all stay, and an empty table stays empty.
    Columns are handed on as they are.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity_score(F.col("text"), spark, model) < 0.5)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose ranking score reaches the learned quantile.

    Null and empty texts have zero features and are scored like others; ties
    with the threshold and repeated rows stay; without labels all stay.
    Columns are handed on as they are.
    """
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_score(F.col("text"), model, at_threshold=0.7) >= 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that with the least id.

    Null and empty texts are one group; of repeated rows one stays; a null id
    comes last.  Texts are read whole, columns handed on as they are.
    """
    return drop_near_duplicates(docs, shingle=4, max_bits=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows the new text.

    Null, empty and clean texts stay as they are, repeated rows stay repeated,
    and ``n_chars`` of a null text keeps its value.  Other columns are handed on.
    """
    masked = replace_pii(docs, key=PII_KEY)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of at most 4096 tokens.

    A null or empty text is its end id alone; a text of more than 4096 ids is cut
    into pieces; repeated rows are packed each for itself.  The result has the
    columns of pieces, others are not read.
    """
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return best_fit_pack(token_pieces(docs, file.read()))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

ORACLE_SQL = None  # the trained scores, the similarity search and the tokenizer have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
