"""Chapters: normalized fields, people, neighbors, availability, content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.html import clean_html, html_images, html_text
from inkloom.functions.payload import at, at_place, first_place, is_object, read_fields, with_first_object, without_fields
from inkloom.functions.text import finite, labelled_number, non_blank, numbered, staged
from inkloom.functions.urls import column_url, path_segments
from inkloom.operators.people import ROLE_KEYS, people_among, unique_people, with_id_only

CHAPTER_FIELDS = (
    "id id_is_num book_id book_id_is_num slug book_slug url title number_label number volume "
    "published_at created_at updated_at views price is_donate is_subscription is_sponsored is_edited is_user_paid"
).split()


# Where a payload may hold the chapter object, and the keys of its fields.
PLACES = ("pageProps.chapter", "pageProps.data", "pageProps.totalData.chapter")
SUMMARY = {
    "ids": {"id": "id chapterId", "book_id": "bookId book.id"},
    "texts": {
        "slug": "slug",
        "named_book": "book.slug",
        "title": "title name",
        "number_label": "numberChapter numberLabel",
        "number_text": "numberChapter title",
        "published_at": "publishedAt published_at",
        "created_at": "createdAt created_at",
        "updated_at": "updatedAt updated_at",
    },
    "raw_texts": {"url": "url"},
    "numbers": {"number": "chapterShortNumber number", "volume": "tom volume", "price": "price"},
    "integers": {"views": "views"},
    "flags": {"is_donate": "isDonate", "is_subscription": "isSubscription", "is_sponsored": "isSponsored"},
    "maybe_flags": {"is_edited": "isEdited", "is_user_paid": "isUserPaid"},
}
DETAILS = {
    "ids": {"translator": "translatorId translator.id", "editor": "editorId editor.id", "ref_id": "book.id bookId"},
    "texts": {"ref_title": "book.title book.name", "ref_title_en": "book.titleEn book.title_en"},
    "raw_texts": {"status": "status", "html": "content.text", "ref_url": "book.url"},
    "integers": {"symbols": "content.symbolsCount"},
    "filled": {"has_book": "book"},
}


def chapter_columns(
    df: DataFrame, base: str, source: str = "raw", parent_slug: str = "book_slug", out: str = "chapter"
) -> DataFrame:
    """Add ``out``: the summary struct of the chapter object in ``source``.

    ``parent_slug`` names the column with the book slug to fall back on.
    """
    read, f = read_fields(df, F.col(source), "_c_", **SUMMARY)
    return without_fields(_with_summary(read, f, base, parent_slug, out), "_c_")


def _with_summary(read: DataFrame, f: dict[str, Column], base: str, parent_slug: str, out: str) -> DataFrame:
    empty = F.lit("")
    path = staged(read, "_c_segments", f["url"], path_segments)
    first, last = F.get("_c_segments", F.lit(0)), F.try_element_at("_c_segments", F.lit(-1))
    keyed = path.withColumns(
        {
            "_c_own_slug": F.coalesce(f["slug"], non_blank(last), empty),
            "_c_book": F.coalesce(f["named_book"], non_blank(first), non_blank(F.col(parent_slug)), empty),
            "_c_told": F.when(f["number"].isNull(), labelled_number(f["number_text"])),
        }
    )
    own_path = F.concat(F.lit("/"), F.col("_c_book"), F.lit("/"), F.col("_c_own_slug"))
    linked = staged(keyed, "_c_link", F.coalesce(f["url"], own_path), column_url, base)
    derived = {
        "id": f["id"]["value"],
        "id_is_num": f["id"]["is_num"],
        "book_id": f["book_id"]["value"],
        "book_id_is_num": f["book_id"]["is_num"],
        "slug": F.col("_c_own_slug"),
        "book_slug": F.col("_c_book"),
        "url": F.coalesce("_c_link", F.concat(F.lit(base.rstrip("/")), own_path)),
        "title": F.coalesce(f["title"], "_c_own_slug"),
        "number": F.coalesce(f["number"], finite(F.col("_c_told"))),
    }
    fields = [(derived[n] if n in derived else f[n]).alias(n) for n in CHAPTER_FIELDS]
    return linked.withColumn(out, F.struct(*fields))


def chapter_objects(loaded: DataFrame) -> DataFrame:
    """Add ``raw`` (the chapter object) and ``error_code`` where there is none.

    Needs ``doc``; a body that did not parse has no chapter either.
    """
    return with_first_object(loaded, F.col("doc"), PLACES, "raw").withColumn(
        "error_code", F.when(F.col("raw").isNull(), F.lit("INVALID_PAYLOAD"))
    )


def chapter_details(loaded: DataFrame, base: str, keep: tuple[str, ...] = ("book_slug", "chapter_slug")) -> DataFrame:
    """Full chapter fields of each chapter capture.

    Result: the ``keep`` columns of the capture, ``error_code``, ``chapter``
    (summary struct), ``status``, translator and editor ids, ``book`` (struct,
    null if the chapter names none), ``raw_html``, ``symbols_count`` and the
    object itself as ``raw``.  The fields are read where the object lies in the
    body; it is copied out only for those who ask for ``raw``.
    """
    request_slug = F.col("book_slug")
    kept = [F.col(c).alias(f"_k_{c}") for c in keep]
    placed = loaded.select(*kept, "book_slug", "doc", first_place(F.col("doc"), PLACES).alias("_place"))
    found = at_place(F.col("_place"), F.col("doc"), PLACES)
    read, f = read_fields(placed, found, "_c_", **{kind: SUMMARY.get(kind, {}) | DETAILS.get(kind, {}) for kind in SUMMARY | DETAILS})
    read = _with_summary(read, f, base, "book_slug", "chapter")
    path = staged(read, "_d_segments", f["ref_url"], path_segments)
    slugged = path.withColumn(
        "_slug", F.coalesce(f["named_book"], non_blank(F.get("_d_segments", F.lit(0))), request_slug)
    )
    own_path = F.concat(F.lit("/"), F.col("_slug"))
    book = F.when(
        f["has_book"],
        F.struct(
            f["ref_id"]["value"].alias("id"),
            f["ref_id"]["is_num"].alias("id_is_num"),
            F.col("_slug").alias("slug"),
            F.coalesce("_d_link", F.concat(F.lit(base.rstrip("/")), own_path)).alias("url"),
            F.coalesce(f["ref_title"], request_slug).alias("title"),
            f["ref_title_en"].alias("title_en"),
        ),
    )
    linked = staged(slugged, "_d_link", F.coalesce(f["ref_url"], own_path), column_url, base)
    return linked.select(
        *[F.col(f"_k_{c}").alias(c) for c in keep],
        F.when(F.col("_place").isNull(), F.lit("INVALID_PAYLOAD")).alias("error_code"),
        F.when(F.col("_place").isNotNull(), F.col("chapter")).alias("chapter"),
        f["status"].alias("status"),
        f["translator"]["value"].alias("translator_id"),
        f["translator"]["is_num"].alias("translator_id_is_num"),
        f["editor"]["value"].alias("editor_id"),
        f["editor"]["is_num"].alias("editor_id_is_num"),
        book.alias("book"),
        f["html"].alias("raw_html"),
        f["symbols"].alias("symbols_count"),
        found().alias("raw"),
    )


def chapter_people(chapters: DataFrame, keep: tuple[str, ...] = ("book_slug", "chapter_slug")) -> DataFrame:
    """Translators and editors of each chapter object in ``raw``, one row each."""
    roles = ("translator", "editor")
    kept = chapters.select(*[F.col(c).alias(f"_k_{c}") for c in keep], "raw")
    rows, f = read_fields(
        kept, F.col("raw"), "_p_",
        ids={role: f"{role}Id {role}.id" for role in roles},
        variants={f"of_{key}": key for role in roles for key in ROLE_KEYS[role]},
    )
    # each step is a column of its own: written into one another they would be done several times
    for role in roles:
        rows = rows.withColumn(f"_{role}s", people_among(F.array(*[f[f"of_{key}"] for key in ROLE_KEYS[role]]), role))
        rows = rows.withColumn(f"_{role}s", with_id_only(F.col(f"_{role}s"), role, f[role]))
        people = F.col(f"_{role}s")
        rows = rows.withColumn(f"_{role}s", F.when(F.size(people) <= 1, people).otherwise(unique_people(people)))
    people = F.concat(*[F.col(f"_{role}s") for role in roles])
    return numbered(rows, [F.col(f"_k_{c}").alias(c) for c in keep], people, "person").select(*keep, "pos", "person.*")


def chapter_neighbors(chapters: DataFrame, base: str, keep: tuple[str, ...] = ("book_slug", "chapter_slug")) -> DataFrame:
    """Next and previous chapter of each chapter object, one row each."""
    raw = F.col("raw")
    side = lambda name, key: F.struct(F.lit(name).alias("direction"), at(raw, key).alias("neighbor"))
    edges = chapters.select(
        *dict.fromkeys([*keep, "book_slug"]),
        F.inline(F.array(side("next", "nextChapter"), side("previous", "previousChapter"))),
    ).filter(is_object(F.col("neighbor")))
    return chapter_columns(edges, base, source="neighbor").select(*keep, "direction", "chapter")


def chapter_availability(chapters: DataFrame, allow_unavailable: bool = False) -> DataFrame:
    """Add ``available`` and the error of chapters without content.

    With ``allow_unavailable`` such chapters keep their metadata and have no
    error.  Needs the columns of :func:`chapter_details`.
    """
    here = F.col("raw_html").isNotNull()
    closed = F.when(F.lit(not allow_unavailable) & ~here, F.lit("CHAPTER_UNAVAILABLE"))
    return chapters.withColumn("available", here).withColumn("error_code", F.coalesce(F.col("error_code"), closed))


def last_free_chapter(chapters: DataFrame, by: str = "book_slug", position: str = "pos") -> DataFrame:
    """Last chapter in source order that needs no payment, per book."""
    free = ~F.col("is_donate") & ~F.col("is_subscription")
    rest = [c for c in chapters.columns if c != by]
    last = F.max_by(F.struct(*rest), F.col(position))
    return chapters.filter(free).groupBy(by).agg(last.alias("_c")).select(by, "_c.*")


def chapter_content(
    chapters: DataFrame,
    base: str,
    html: str = "raw_html",
    page_html: DataFrame | None = None,
    on: tuple[str, ...] = ("book_slug", "chapter_slug"),
) -> DataFrame:
    """Add ``formatted_html``, ``text`` and ``images`` of the chapter HTML.

    ``page_html`` (the ``on`` columns and ``page_html``) is joined only if
    asked for, and before cleaning, so that only what was captured is shuffled.
    """
    joined = chapters if page_html is None else chapters.join(page_html, list(on), "left")
    out = staged(joined, "formatted_html", F.col(html), clean_html, base)
    out = staged(out, "text", F.col("formatted_html"), html_text)
    out = staged(out, "images", F.col(html), html_images, base)
    if page_html is None:
        return out
    own, asked = ([c for c in df.columns if c not in on] for df in (chapters, page_html))
    return out.select(*on, *own, "formatted_html", "text", "images", *asked)
