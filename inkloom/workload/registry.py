"""Every job, run over the given tables: ``name -> (spark, sf_dir) -> rows``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions.html import clean_html, drop_unsafe_html, html_images, html_text
from inkloom.functions.payload import as_id, as_text, at, first_id_at, within
from inkloom.functions.text import numbered, parse_chapter_number
from inkloom.operators import books as B
from inkloom.operators import catalog as C
from inkloom.operators import chapters as CH
from inkloom.operators import fetches as FE
from inkloom.operators import links as L
from inkloom.operators import ordering as O
from inkloom.operators import search_index as IX
from inkloom.plans.books import download_books as download
from inkloom.plans.chapters import assembled_books, fetched_chapters
from inkloom.plans.search import search_catalog, searchable_pages
from inkloom.session import configure, scratch_path
from inkloom.sources.captures import load_captures as load
from inkloom.sources.captures import quarantine_payloads as quarantine
from inkloom.sources.library import read_chapters, read_library
from inkloom.sources.library import write_library as write
from inkloom.streaming import jobs as S
from inkloom.workload import payloads as P
from inkloom.workload.payloads import BASE, table

KEYS_BASE = "http://blog.ththan.example.net"
SEARCH = "  DE   La "
CATALOG_SEARCH = "Small\tgizmo"
SIZE_LIMIT = 4096
DAY_MS = 24 * 3_600_000
DEDUPE_TTL_MS = {"build_id": 5 * DAY_MS, "catalog": 2 * DAY_MS, "book": 10 * DAY_MS, "chapter": 3 * DAY_MS, "page_html": DAY_MS}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query, name: str | None = None) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    QUERIES[name or run.__name__] = configured
    return run


def named(name: str) -> Callable[[Query], Query]:
    """Register under a name that would hide an imported function here."""
    return lambda run: query(run, name)


# -------------------------------------------------- captures and fetch log


@query
def load_captures(spark, d):
    doc = F.col("doc")
    landed = (
        P.page_captures(table(spark, d, "pages"))
        .unionByName(P.book_captures(table(spark, d, "orders")))
        .unionByName(P.chapter_captures(table(spark, d, "lineitem")))
    )
    places = [f"pageProps.{p}id" for p in ("book.", "chapter.", "data.", "totalData.book.", "totalData.chapter.")]
    return load(landed).select(
        "capture_id",
        "kind",
        doc.isNotNull().alias("is_json"),
        as_id(F.coalesce(*[within(doc, p) for p in places]))["value"].alias("object_id"),
        F.when(F.col("kind") == "page_html", F.octet_length("body")).alias("html_bytes"),
    )


@query
def quarantine_payloads(spark, d):
    docs = table(spark, d, "documents").select(F.concat(F.lit("d"), "doc_id").alias("capture_id"), F.col("text").alias("body"))
    props = table(spark, d, "events").select(F.concat(F.lit("e"), "event_id").alias("capture_id"), F.col("props").alias("body"))
    rows = quarantine(docs.unionByName(props), SIZE_LIMIT)
    k = as_id(within(F.col("doc"), "k"))
    return rows.select("capture_id", "error_code", "preview", k["value"].alias("k"), k["is_num"].alias("k_is_num"))


@query
def classify_fetches(spark, d):
    rows = FE.classify_fetches(P.fetch_attempts(table(spark, d, "events")))
    return rows.select("event_id", "code", "retryable", "retry_after_ms", "delay_low_ms", "delay_high_ms")


@query
def latest_per_url(spark, d):
    rows = FE.latest_captures(P.event_captures(table(spark, d, "events")))
    return rows.select("url", "event_id", "status", F.unix_micros("fetched_at").alias("fetched_us"))


@query
def stale_captures(spark, d):
    log = P.event_captures(table(spark, d, "events"))
    as_of = log.agg(F.max("fetched_at").alias("m")).scalar()
    rows = FE.stale_captures(log, as_of)
    return rows.select("kind", "url", F.unix_micros("fetched_at").alias("fetched_us"), F.unix_millis("expires_at").alias("expires_ms"))


@query
def page_embedded_data(spark, d):
    rows = FE.page_embedded_data(P.pages_with_data(table(spark, d, "pages")))
    return rows.select(
        "page_id",
        "build_id",
        "error_code",
        as_text(at(F.col("data"), "page")).alias("data_page"),
        as_text(at(F.col("data"), "note")).alias("data_note"),
        F.col("data").isNotNull().alias("has_data"),
    )


@query
def current_build_captures(spark, d):
    rows = FE.current_build_captures(P.event_captures(table(spark, d, "events")))
    return rows.select("route", "event_id", "build_id", "status")


@query
def captures_by_build(spark, d):
    """The fetch log of two sites, whose builds change with the weeks."""
    rows = FE.captures_by_build(P.site_captures(table(spark, d, "events")))
    return rows.select("site", "route", "event_id", "build_id", "current_build", "retry_build", "status")


@query
def fetch_plan(spark, d):
    books = table(spark, d, "orders").select(F.concat(F.lit("order-"), "o_orderkey").alias("book_slug"))
    chapters = table(spark, d, "lineitem").select(
        F.concat(F.lit("order-"), "l_orderkey").alias("book_slug"),
        F.concat(F.lit("глава "), "l_linenumber", F.lit("!")).alias("chapter_slug"),
    )
    pages = table(spark, d, "part").select((F.floor(F.col("p_partkey") / P.PAGE_SIZE) + 1).alias("page"))
    params = F.array(FE.entry("genre", F.lit("a b"), F.lit(None), F.lit("c")), FE.entry("page", F.lit(9)))
    plan = FE.fetch_plan(books, chapters, F.lit("build 1"))
    lists = FE.catalog_requests(pages, params=params)
    data = FE.catalog_requests(pages, order="new", build_id=F.lit("build 1"), route="/books/all")
    return plan.unionByName(lists).unionByName(data).unionByName(FE.page_html_requests(chapters, BASE))


# ------------------------------------------------------------------ catalog


def _catalog(spark, d):
    return load(P.catalog_captures(table(spark, d, "part")))


@query
def catalog_items(spark, d):
    rows = C.catalog_items(_catalog(spark, d))
    id_ = first_id_at(F.col("item"), "id bookId")
    return rows.select("page", "pos", id_["value"].alias("id"), id_["is_num"].alias("id_is_num"))


@query
def catalog_page_info(spark, d):
    return C.catalog_page_info(_catalog(spark, d))


@query
def catalog_source_select(spark, d):
    pages = C.catalog_pages(load(P.catalog_source_captures(table(spark, d, "part"))))
    narrow = pages.select("page", "route", "status", "fetched_at", "capture_id", "doc", "n_items", "total_count")
    modes = [C.catalog_source_select(narrow, m).withColumn("mode", F.lit(m)) for m in ("auto", "v3", "next")]
    return modes[0].unionByName(modes[1]).unionByName(modes[2])


@query
def catalog_traverse(spark, d):
    pages = C.catalog_pages(_catalog(spark, d)).select(
        "page", "n_items", F.when(F.col("page") > 2, F.col("page_count") - 2).alias("page_count")
    )
    return C.catalog_traverse(pages, start_page=2).select("page", "n_items")


@query
def traverse_catalogs(spark, d):
    """Every brand and size is a catalog of its own, with gaps and page counts."""
    parts = table(spark, d, "part")
    key = F.col("p_partkey")
    pages = parts.groupBy("p_brand", "p_size", (key % 4 + 1).alias("page")).agg(
        F.count_if(key % 11 > 0).alias("n_items"), F.max(F.when(key % 13 == 0, 2)).cast("bigint").alias("page_count")
    )
    return C.catalog_traverse(pages, by=("p_brand", "p_size")).select("p_brand", "p_size", "page", "n_items")


@query
def book_summaries(spark, d):
    rows = C.book_summaries(C.catalog_items(_catalog(spark, d)), BASE)
    last = [F.col(f"last_chapter.{n}").alias(f"last_{n}") for n in CH.CHAPTER_FIELDS]
    return rows.select(
        "page", "pos", "id", "id_is_num", "slug", "url", "title", "title_en", "description_html", "status",
        "views", "likes", "dislikes", *last,
    )


def _searched(spark, d):
    pages = searchable_pages(table(spark, d, "pages")).select(
        F.concat(F.lit("p"), "page_id").alias("key"), "title", "title_en", "description_html"
    )
    none = F.lit(None).cast("string")
    docs = table(spark, d, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("key"), F.col("source").alias("title"), none.alias("title_en"),
        F.col("text").alias("description_html"),
    )
    return pages.unionByName(docs)


@query
def search_books(spark, d):
    return C.search_books(_searched(spark, d), SEARCH).select("key", "title")


@query
def search_many_needles(spark, d):
    """Pages and documents that hold each needle: a piece of every twentieth document, and words of the parts' names."""
    path = scratch_path(spark, "search-index")
    index = IX.write_search_index(_searched(spark, d), path)
    at = F.col("doc_id")
    docs = table(spark, d, "documents").where("doc_id % 20 = 0")
    pieces = docs.select(F.substr("text", (at % 50 + 1).cast("int"), F.when(at % 3 == 0, 2).otherwise(9)).alias("needle"))
    words = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("needle"))
    return IX.search_many(index, pieces.unionByName(words))


@query
def search_catalog_captures(spark, d):
    rows = search_catalog(P.catalog_source_captures(table(spark, d, "part")), CATALOG_SEARCH, BASE)
    return rows.select("page", "pos", "id", "title")


# -------------------------------------------------------------------- books


def _books(spark, d):
    return B.book_objects(load(P.book_captures(table(spark, d, "orders"))))


def _parts_as_books(spark, d):
    return C.catalog_items(_catalog(spark, d)).select(
        first_id_at(F.col("item"), "id bookId")["value"].alias("book_id"), F.col("item").alias("book")
    )


@query
def book_details(spark, d):
    rows = B.book_details(_books(spark, d), BASE)
    country = [F.col(f"country.{n}").alias(f"country_{n}") for n in ("id", "id_is_num", "title", "code")]
    return rows.select(
        "book_slug", "error_code", "id", "slug", "url", "title", "status", "views", "full_title", "author",
        *country, "additional_info_html", "important_info_html", "chapter_cost",
    )


@query
def book_genres(spark, d):
    return B.book_genres(_parts_as_books(spark, d), keep=("book_id",))


@query
def book_images(spark, d):
    return B.book_images(_parts_as_books(spark, d), BASE, keep=("book_id",))


@query
def book_people(spark, d):
    return B.book_people(_books(spark, d))


@query
def book_chapters(spark, d):
    """The chapter list of each order: all its lines."""
    captures = P.book_captures(table(spark, d, "orders"), table(spark, d, "lineitem"))
    books = B.book_details(B.book_objects(load(captures)), BASE)
    return B.book_chapters(books, BASE, source="raw")


# ----------------------------------------------------------------- chapters


def _line_details(spark, d):
    return CH.chapter_details(load(P.chapter_captures(table(spark, d, "lineitem"))), BASE)


def _line_objects(spark, d):
    return CH.chapter_objects(load(P.chapter_captures(table(spark, d, "lineitem"))))


def _flat(names, struct="chapter"):
    return [F.col(f"{struct}.{n}").alias(n) for n in names]


@query
def chapter_details(spark, d):
    book = [F.col(f"book.{n}").alias(f"ref_{n}") for n in ("id", "slug", "url", "title", "title_en")]
    return _line_details(spark, d).select(
        F.col("chapter_slug").alias("request_slug"), "error_code", *_flat(CH.CHAPTER_FIELDS), "status",
        "translator_id", "translator_id_is_num", "editor_id", "editor_id_is_num", *book, "symbols_count",
    )


@query
def chapter_numbers(spark, d):
    line = F.col("l_linenumber")
    word = F.when(line % 3 == 0, "ГЛАВА ").when(line % 3 == 1, "x Chapter").otherwise("часть ")
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("book"), F.concat(word, F.col("l_linenumber").cast("string"), F.lit(","), F.col("l_suppkey").cast("string")).alias("label")
    )
    talks = table(spark, d, "conversations").select(
        F.col("conv_id").alias("book"), F.concat(F.lit("глава "), F.col("turn").cast("string"), F.lit(". "), "role").alias("label")
    )
    rows = lines.unionByName(talks)
    return rows.select("book", "label", parse_chapter_number(F.col("label")).alias("number"))


@query
def chapter_people(spark, d):
    return CH.chapter_people(_line_objects(spark, d))


@query
def chapter_neighbors(spark, d):
    rows = CH.chapter_neighbors(_line_objects(spark, d), BASE)
    names = ("id", "id_is_num", "slug", "book_slug", "url", "title")
    flat = [F.col(f"chapter.{n}").alias(f"to_{n}") for n in names]
    return rows.select("book_slug", "chapter_slug", "direction", *flat)


@query
def chapter_availability(spark, d):
    lines = _line_details(spark, d).select("book_slug", "chapter_slug", "error_code", "chapter", "raw_html")
    newest = FE.latest_captures(P.talk_captures(table(spark, d, "conversations")), ("book_slug", "chapter_slug"))
    # failed captures keep their error and are not available
    talks = fetched_chapters(newest, BASE, allow_unavailable=True, clean=False)
    both = lines.unionByName(talks.select("book_slug", "chapter_slug", "error_code", "chapter", "raw_html"))
    # both modes are told of one row, so each body is read once, and newest captures are chosen once
    rows = CH.chapter_availability(both.withColumn("_own", F.col("error_code")), False).withColumn("_strict", F.col("error_code"))
    rows = CH.chapter_availability(rows.withColumn("error_code", F.col("_own")), True)
    rows = rows.withColumn("allowed", F.explode(F.array(F.lit(False), F.lit(True))))
    return rows.withColumn("error_code", F.when(F.col("allowed"), F.col("error_code")).otherwise(F.col("_strict"))).select(
        "allowed", "book_slug", "chapter_slug", "available", "error_code",
        *_flat(("is_donate", "is_subscription", "price")),
    )


@query
def select_chapters(spark, d):
    lines = P.line_chapters(table(spark, d, "lineitem"))
    runs = [("source", 0, None), ("ascending", 1, 3), ("descending", 0, 4)]
    parts = [
        O.select_chapters(lines, order, start, to).withColumn("wanted", F.lit(order)) for order, start, to in runs
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select("wanted", "book_slug", "pos", "title", "rank", "index")


@query
def last_free_chapter(spark, d):
    rows = CH.last_free_chapter(P.line_chapters(table(spark, d, "lineitem")))
    return rows.select("book_slug", "pos", "title", "number", "volume")


def _assembled(spark, d, order="ascending", **options):
    talks = table(spark, d, "conversations")
    return assembled_books(P.talk_chapters(talks), P.talk_captures(talks), BASE, order, **options)


def _content():
    urls = F.array_join(F.transform(F.col("content.images"), lambda i: i["url"]), " ")
    return [*[F.col(f"content.{n}").alias(n) for n in ("raw_html", "formatted_html", "text")], urls.alias("image_urls")]


@query
def assemble_book(spark, d):
    rows = _assembled(spark, d)
    return rows.select("book_slug", "index", "slug", "error_code", *_content())


@query
def until_first_error(spark, d):
    return O.until_first_error(_assembled(spark, d)).select("book_slug", "index", "slug")


@query
def download_summary(spark, d):
    """Counts of whole books; content is not cleaned for them."""
    return O.download_summary(_assembled(spark, d, order="source", clean=False))


@query
def download_books(spark, d):
    """Whole books of orders and lines: a row for each book and for each of its chapters."""
    captures = P.download_captures(table(spark, d, "orders"), table(spark, d, "lineitem"))
    found = download(captures, BASE, order="ascending")
    return _library_rows(found.books, found.chapters)


def _library_rows(books, chapters):
    none = lambda kind: F.lit(None).cast(kind)
    of_books = books.select(
        F.lit("book").alias("row"), "book_slug", none("bigint").alias("index"), "slug", "title", "error_code",
        none("string").alias("formatted_html"), none("string").alias("text"), "succeeded", "failed",
    )
    of_chapters = chapters.select(
        F.lit("chapter").alias("row"), "book_slug", "index", "slug", "title", "error_code",
        F.col("content.formatted_html").alias("formatted_html"), F.col("content.text").alias("text"),
        none("bigint").alias("succeeded"), none("bigint").alias("failed"),
    )
    return of_books.unionByName(of_chapters)


@query
def write_library(spark, d):
    """Two versions, the second of every third book: what a reader sees."""
    path, rows = scratch_path(spark, "library"), _assembled(spark, d)
    write(rows, path)
    again = F.element_at(F.split("book_slug", "-"), -1).cast("bigint") % 3 == 0
    write(read_library(spark, path).where(again), path)
    rows = read_library(spark, path)
    return rows.select("book_slug", "index", "slug", "error_code", *_content())


@query
def read_library_books(spark, d):
    """Books and counts that a reader of the library sees beside the chapters."""
    path = scratch_path(spark, "library")
    write(_assembled(spark, d, clean=False), path)
    return read_library(spark, path, "books").select("book_slug", "succeeded", "failed")


# --------------------------------------------------------------------- HTML


@named("drop_unsafe_html")
def drop_unsafe(spark, d):
    return table(spark, d, "pages").select("page_id", drop_unsafe_html(F.col("html")).alias("html"))


@named("clean_html")
def clean_page_html(spark, d):
    pages = P.pages_with_markup(table(spark, d, "pages"))
    return pages.select("page_id", clean_html(F.col("html"), BASE).alias("html"))


@named("html_images")
def page_images(spark, d):
    pages = P.pages_with_markup(table(spark, d, "pages"))
    images = html_images(F.col("html"), BASE)
    rows = numbered(pages, ["page_id"], images, "i", "rank")
    return rows.select("page_id", "rank", "i.pos", "i.url", "i.name", "i.alt")


@named("html_text")
def page_text(spark, d):
    pages = P.pages_with_markup(table(spark, d, "pages"))
    return pages.select("page_id", html_text(drop_unsafe_html(F.col("html"))).alias("text"))


@query
def chapter_content(spark, d):
    urls = F.array_join(F.transform(F.col("images"), lambda i: i["url"]), " ").alias("image_urls")
    pages = P.pages_with_markup(table(spark, d, "pages"))
    chapters = pages.select(
        F.lit("page").alias("book_slug"), F.col("page_id").cast("string").alias("chapter_slug"),
        F.col("html").alias("raw_html"), F.lit(None).cast("bigint").alias("symbols_count"),
    )
    lines = _line_details(spark, d).select("book_slug", "chapter_slug", "raw_html", "symbols_count")
    full = table(spark, d, "pages").select(
        F.lit("page").alias("book_slug"), F.col("page_id").cast("string").alias("chapter_slug"),
        F.octet_length("html").alias("page_html"),
    )
    rows = CH.chapter_content(chapters.unionByName(lines), BASE, page_html=full)
    return rows.select("book_slug", "chapter_slug", "raw_html", "formatted_html", "text", urls, "symbols_count", F.col("page_html").alias("page_html_bytes"))


# --------------------------------------------------------------------- URLs


@query
def resolve_urls(spark, d):
    pages = table(spark, d, "pages")
    hrefs = L.page_links(pages)
    own = pages.select("page_id", F.lit(-1).alias("pos"), F.col("url").alias("link"))
    return L.resolve_urls(hrefs.unionByName(own), BASE)


@query
def url_keys(spark, d):
    pages = table(spark, d, "pages")
    none = F.lit(None).cast("string")
    full = pages.select("page_id", F.lit("url").alias("form"), F.col("url").alias("book_input"), none.alias("chapter_input"))
    path = F.regexp_replace("url", "^https?://[^/]*|[?#].*", "")
    bare = pages.select("page_id", F.lit("path").alias("form"), path.alias("book_input"), none.alias("chapter_input"))
    pair = pages.select("page_id", F.lit("pair").alias("form"), path.alias("book_input"), F.concat(F.lit(" /x/глава%20"), "page_id").alias("chapter_input"))
    rows = L.url_keys(full.unionByName(bare).unionByName(pair), KEYS_BASE)
    return rows.select("page_id", "form", "book_slug", "chapter_slug", "error_code")


# ------------------------------------------------------------------ streams


def _stream(spark, d, name):
    # as a pattern the path may be one file or a folder of files
    return S.read_stream(spark, f"{d}/{name}.parque[t]", table(spark, d, name).schema)


@query
def stream_captures(spark, d):
    out, checkpoint = S.new_run(spark, "stream-captures")
    S.stream_captures(P.talk_captures(_stream(spark, d, "conversations")), out, checkpoint, BASE)
    return spark.read.parquet(out).select("capture_id", "error_code", "formatted_html", "text")


@query
def stream_dedupe(spark, d):
    """The fetch log in three arrivals, by time."""
    landing, (out, checkpoint) = scratch_path(spark, "arrivals"), S.new_run(spark, "stream-dedupe")
    log = P.event_captures(table(spark, d, "events")).select("url", "kind", "fetched_at", "capture_id")
    at = F.unix_micros("fetched_at")
    low, high = log.agg(F.min(at), F.max(at)).first()
    for part in range(3):
        log.where(F.floor(3 * (at - low) / ((high or 0) - (low or 0) + 1)) == part).write.mode("append").parquet(landing)
        S.stream_dedupe(S.read_stream(spark, landing, log.schema), out, checkpoint, DEDUPE_TTL_MS)
    return spark.read.parquet(out).select("url", "kind", F.unix_micros("fetched_at").alias("fetched_us"), "capture_id")


@query
def stream_library(spark, d):
    library, checkpoint = S.new_run(spark, "stream-library")
    S.stream_library(P.talk_captures(_stream(spark, d, "conversations")), library, checkpoint, BASE)
    return O.download_summary(read_chapters(spark, library)).select("book_slug", "succeeded", "failed")
