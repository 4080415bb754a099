"""The library: books, chapters and counts in versions that are published as a whole.

A writer adds the files of a version beside those of older ones, under a path of
its own, and then appends one row to the manifest.  Readers take their files
from the manifest, so they see a version's tables together or not at all: one
that is being written, or whose writer failed, is not there.  Nothing is
rewritten but by a compaction, which publishes what it found as one new version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkloom.operators.fetches import latest_captures
from inkloom.operators.ordering import download_summary

BUCKETS = 64
_MANIFEST = "version string, seq long, is_base boolean, upto long, schemas string"
_OWN = ("version", "book_bucket", "_seq")


def book_bucket(slug: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(slug), F.lit(buckets)).cast("int")


def published(spark: SparkSession, path: str) -> list[Row]:
    """Versions that make up the library, oldest first: the newest base and what came after it."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").collect()  # one narrow row a version
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    firsts: dict[str, Row] = {}  # a replayed version keeps its first place
    for row in sorted(rows, key=lambda r: (r.seq, r.version)):
        firsts.setdefault(row.version, row)
    bases = [r for r in firsts.values() if r.is_base]
    base = max(bases, key=lambda r: (r.upto, r.seq), default=None)
    return [r for r in firsts.values() if r is base or not r.is_base and (base is None or r.seq > base.upto)]


def _write(rows: DataFrame, path: str, name: str, version: str, by: str, buckets: int) -> DataFrame:
    """Write a table of a version, and give the rows as they were written."""
    rows = rows.drop(*_OWN).withColumn("book_bucket", book_bucket(F.col(by), buckets))
    folder = f"{path}/{name}/version={version}"
    rows.hint("rebalance", "book_bucket").write.mode("overwrite").partitionBy("book_bucket").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder).drop("book_bucket")


def publish(
    spark: SparkSession,
    path: str,
    tables: dict[str, DataFrame],
    version: str | None = None,
    by: str = "book_slug",
    buckets: int = BUCKETS,
    upto: int | None = None,
    derived: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] | None = None,
) -> str:
    """Write the tables of a version, then make them visible together.

    A table lies under ``<name>/version=<v>/book_bucket=<n>``, rebalanced at run
    time: a bucket of much data is split over as many tasks as it asks for.
    ``derived`` tables (name: source table and function) are made from what was
    written of another.  Writing the same version again, as a replayed batch
    does, gives the same files and changes nothing for readers.  With ``upto``
    the version stands for all that were published up to that place.
    """
    version = version or f"v-{uuid.uuid4().hex}"
    done = {name: _write(rows, path, name, version, by, buckets) for name, rows in tables.items()}
    for name, (source, make) in (derived or {}).items():
        done[name] = _write(make(done[source]), path, name, version, by, buckets)
    schemas = json.dumps({name: rows.schema.json() for name, rows in done.items()})
    seq = max((r.seq for r in published(spark, path)), default=0) + 1
    row = [(version, seq, upto is not None, upto, schemas)]
    spark.createDataFrame(row, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def read_table(spark: SparkSession, path: str, name: str, versions: list[Row] | None = None) -> DataFrame:
    """Rows of a table in all versions, with ``version`` and ``_seq``, its place among them."""
    versions = published(spark, path) if versions is None else versions
    schemas = {r.version: json.loads(r.schemas).get(name) for r in versions}
    versions = [r for r in versions if schemas[r.version]]
    if not versions:
        raise ValueError(f"nothing is published as {name} in {path}")
    schema = StructType.fromJson(json.loads(schemas[versions[-1].version]))
    folders = [f"{path}/{name}/version={r.version}" for r in versions]
    rows = spark.read.schema(schema.add("version", "string").add("book_bucket", "integer")).option("basePath", f"{path}/{name}").parquet(*folders)
    places = spark.createDataFrame([(r.version, r.upto if r.is_base else r.seq) for r in versions], "version string, _seq long")
    return rows.join(F.broadcast(places), "version")  # a row a version


def write_library(chapters: DataFrame, path: str, books: DataFrame | None = None, by: str = "book_slug", buckets: int = BUCKETS) -> str:
    """Publish whole books: their rows, chapters and counts as one version.

    A book replaces all that older versions have of it.  Without ``books`` these
    are the books of ``chapters`` with their counts.
    """
    tables = {"chapters": chapters} if books is None else {"chapters": chapters, "books": books}
    counts = {"books": ("chapters", lambda rows: download_summary(rows, by))} if books is None else None
    return publish(chapters.sparkSession, path, tables, by=by, buckets=buckets, derived=counts)


def _newest_books(spark: SparkSession, path: str, by: str, versions: list[Row]) -> DataFrame:
    books = read_table(spark, path, "books", versions)
    last = F.max(F.struct("_seq", "version")).alias("_last")
    return books.select(by, "_seq", "version").groupBy(by).agg(last).select(by, "_last.version")


def read_library(spark: SparkSession, path: str, table: str = "chapters", by: str = "book_slug") -> DataFrame:
    """Chapters (or ``books``) of the newest version of each book."""
    versions = published(spark, path)
    rows = read_table(spark, path, table, versions)
    if len(versions) > 1:
        rows = rows.join(_newest_books(spark, path, by, versions), [by, "version"], "left_semi")
    return rows.drop(*_OWN)


def read_chapters(spark: SparkSession, path: str, keys: tuple[str, ...] = ("book_slug", "chapter_slug")) -> DataFrame:
    """The newest capture of each chapter, for a library that was published in single chapters."""
    return latest_captures(read_table(spark, path, "chapters"), keys).drop(*_OWN)


def compact_library(spark: SparkSession, path: str, single_chapters: bool = False, by: str = "book_slug") -> str | None:
    """Publish what readers see now as one version; versions that come meanwhile stay on top of it.

    Returns the version, or nothing where there is none.  Files of older
    versions stay for readers that have begun; ``superseded`` names them.
    """
    seen = published(spark, path)
    if not seen:
        return None
    upto = max(r.upto if r.is_base else r.seq for r in seen)
    if single_chapters:
        tables = {"chapters": latest_captures(read_table(spark, path, "chapters", seen), ("book_slug", "chapter_slug"))}
    else:
        newest = _newest_books(spark, path, by, seen)
        tables = {t: read_table(spark, path, t, seen).join(newest, [by, "version"], "left_semi") for t in ("chapters", "books")}
    return publish(spark, path, tables, by=by, upto=upto)


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Folders of versions that no reader of the present library needs."""
    live = {r.version for r in published(spark, path)}
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").select("version", "schemas").distinct().collect()
    return sorted(f"{path}/{name}/version={r.version}" for r in rows if r.version not in live for name in json.loads(r.schemas))
