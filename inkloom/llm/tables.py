"""Small helpers the operators share: written intermediate tables, folds, repetition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back.

    This cuts the lineage and keeps the rows of every later read the same,
    whatever executors are lost meanwhile.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Removes what a statement shuffled when it is done; else it lies on disk until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_freed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table and free the disk that its shuffles took."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def written_freed(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """As :func:`written`, with the disk of the shuffles freed, and a call that deletes the table once nothing needs it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_freed(df, path)

    def delete() -> None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    return spark.read.schema(df.schema).parquet(path), delete


def fold_of(key: Column, folds: int) -> Column:
    """Fold number: CRC-32 of the key as text, modulo the number of folds."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_column: str, id_column: str, text_column: str, max_rows: int
) -> DataFrame:
    """(text, label) of at most ``max_rows`` labelled documents, those with the least hashes of their ids.

    A smaller table is taken whole.  Equal texts count once; where labels of one
    id or text differ the greater stays.  Null ids and labels are left out.
    The chosen ids are broadcast: ``max_rows`` bounds them.
    """
    known = labels.select(F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("label"))
    known = known.where("__id is not null and label is not null").groupBy("__id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    rows = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text"))
    return rows.join(F.broadcast(chosen), "__id").groupBy("text").agg(F.max("label").alias("label"))
