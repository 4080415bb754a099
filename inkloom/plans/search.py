"""Catalog search from captures to matching books."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.functions.html import drop_unsafe_html
from inkloom.functions.text import numbered
from inkloom.operators.catalog import (
    book_summaries, catalog_pages, catalog_source_select, catalog_traverse, search_books,
)
from inkloom.session import through_storage
from inkloom.sources.captures import load_captures


def search_catalog(
    captures: DataFrame,
    needle: str,
    base: str,
    mode: str = "auto",
    start_page: int = 1,
    max_pages: int | None = None,
    include_description: bool = True,
) -> DataFrame:
    """Books of the catalog pages a reader reaches that match the needle.

    Bodies are parsed once for a narrow summary of each capture, which is
    written; choosing and traversing read that.  Then only the bodies of the
    pages reached are parsed for their items, found by their unique capture id.
    """
    pages = catalog_pages(load_captures(captures))
    narrow = ("capture_id", "page", "route", "status", "fetched_at", "n_items", "page_count", "total_count")
    parsed = F.when(F.col("doc").isNotNull(), F.lit(True)).alias("doc")
    summary = through_storage(pages.select(*narrow, parsed), "catalog-summary")
    chosen = catalog_source_select(summary, mode).filter(F.col("error_code").isNull()).select("capture_id", "source")
    picked = summary.join(chosen, "capture_id").select("capture_id", "page", "n_items", "page_count", "source")
    reached = catalog_traverse(picked, start_page, max_pages).select("capture_id")
    bodies = catalog_pages(load_captures(captures.join(reached, "capture_id", "left_semi")))
    items = numbered(bodies, ["page"], F.col("items"), "item")
    return search_books(book_summaries(items, base), needle, include_description)


def searchable_pages(pages: DataFrame) -> DataFrame:
    """Page HTML as books to search: title of the page, body as description."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return pages.select(
        F.col("page_id"),
        title.alias("title"),
        F.lit(None).cast("string").alias("title_en"),
        drop_unsafe_html(F.col("html")).alias("description_html"),
    )
