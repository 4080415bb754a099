"""Small cases of the jobs: edges the given tables do not reach."""

import json
import os
import random
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from inkloom.functions.html import drop_unsafe_html
from inkloom.functions.payload import read_fields
from inkloom.operators import books as B
from inkloom.operators import catalog as C
from inkloom.operators import chapters as CH
from inkloom.operators import fetches as FE
from inkloom.operators import links as L
from inkloom.operators import ordering as O
from inkloom.operators.search_index import SLICE_CHARS, search_many, write_search_index
from inkloom.plans.books import download_books
from inkloom.plans.chapters import assembled_books, fetched_chapters
from inkloom.plans.search import search_catalog
from inkloom.session import scratch_path
from inkloom.sources import library
from inkloom.sources.captures import CAPTURE_SCHEMA, load_captures, quarantine_payloads, read_captures
from inkloom.sources.library import read_library, write_library
from inkloom.streaming import jobs as S
from inkloom.workload import payloads as P
from inkloom.workload.payloads import BASE


def captures(spark, rows):
    names = [c.strip().split()[0] for c in CAPTURE_SCHEMA.strip().split(",")]
    defaults = {"status": 200, "fetched_at": "2024-01-01 00:00:00"}
    data = [tuple({**defaults, **r}.get(n) for n in names) for r in rows]
    text_schema = CAPTURE_SCHEMA.replace("TIMESTAMP", "STRING")
    return spark.createDataFrame(data, text_schema).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def chapter(slug, html="<p>x</p>", wrap="chapter", **fields):
    body = {"id": 1, "slug": slug, "content": None if html is None else {"text": html, "symbolsCount": 3}, **fields}
    return json.dumps({"pageProps": {wrap: body}}, ensure_ascii=False)


def test_build_id_sources(spark):
    pages = [
        ('<script id="__NEXT_DATA__" type="application/json">{"buildId":"abc-123","page":"/"}</script>', "abc-123"),
        ('<script src="/_next/static/static-build/_buildManifest.js"></script>', "static-build"),
        ("<script id='__NEXT_DATA__'>{\"buildId\":\" \"}</script>", None),
        ("<p>none</p>", None),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)], "page_id int, html string")
    got = {r.page_id: r.build_id for r in FE.page_embedded_data(df).select("page_id", "build_id").collect()}
    assert got == {i: b for i, (_, b) in enumerate(pages)}


def test_stale_build_gives_way(spark):
    rows = captures(
        spark,
        [
            {"capture_id": "1", "route": "/b", "build_id": "old", "status": 404},
            {"capture_id": "2", "route": "/b", "build_id": "new", "status": 200, "fetched_at": "2024-01-01 00:00:05"},
            {"capture_id": "3", "route": "/gone", "build_id": "old", "status": 404},
            {"capture_id": "4", "route": "/kept", "build_id": "old", "status": 200},
        ],
    )
    got = {r.route: r.capture_id for r in FE.current_build_captures(rows).collect()}
    assert got == {"/b": "2", "/gone": "3", "/kept": "4"}


def test_retry_delays(spark):
    rows = [
        (1, 429, "0", 0), (2, 429, "3.5", 0), (3, 429, "Mon, 01 Jan 2024 00:00:07 GMT", 1), (4, 500, None, 2), (5, 503, None, 4), (6, 404, "5", 0),
        (7, 408, "x", 10**1), (8, 429, "-4", 0), (9, 425, "99", 3), (10, 403, None, 0), (11, 429, "Sun, 31 Dec 2023 00:00:00 GMT", 0),
        (12, None, None, 0), (13, 429, "2024-01-01T00:00:02Z", 0), (14, 429, "Mon, 01 Jan 2024 03:00:05 +0300", 0), (15, None, None, 4),
    ]
    df = spark.createDataFrame(rows, "id int, status int, retry_after string, attempt int").withColumn(
        "fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    got = {r.id: (r.code, r.retryable, r.delay_low_ms, r.delay_high_ms) for r in FE.classify_fetches(df).collect()}
    assert got[1] == ("HTTP_ERROR", True, 0.0, 0.0)
    assert got[2] == ("HTTP_ERROR", True, 3500.0, 3500.0)
    assert got[3] == ("HTTP_ERROR", True, 7000.0, 7000.0)
    assert got[4] == ("HTTP_ERROR", True, 800.0, 1200.0)
    assert got[5] == ("HTTP_ERROR", False, None, None)
    assert got[6] == ("NOT_FOUND", False, None, None)
    assert got[7] == ("HTTP_ERROR", False, None, None)
    assert got[8] == ("HTTP_ERROR", True, 0.0, 0.0)
    assert got[9] == ("HTTP_ERROR", True, 8000.0, 8000.0)
    assert got[10] == ("HTTP_ERROR", False, None, None)
    assert got[11] == ("HTTP_ERROR", True, 0.0, 0.0)
    assert got[12] == ("NETWORK_ERROR", True, 200.0, 300.0)
    assert got[13] == ("HTTP_ERROR", True, 2000.0, 2000.0)
    assert got[14] == ("HTTP_ERROR", True, 5000.0, 5000.0)
    assert got[15] == ("NETWORK_ERROR", False, None, None)


def test_quarantine_limits(spark):
    df = spark.createDataFrame([("a", "{}"), ("b", "{" + " " * 20 + "}"), ("c", "oops" * 200)], "capture_id string, body string")
    got = {r.capture_id: (r.error_code, r.preview) for r in quarantine_payloads(df, 900).collect()}
    assert got == {"a": (None, None), "b": (None, None), "c": ("INVALID_PAYLOAD", ("oops" * 200)[:500])}
    assert quarantine_payloads(df, 10).filter("error_code = 'RESPONSE_TOO_LARGE'").count() == 2


def test_routes_and_queries(spark):
    df = spark.createDataFrame([(" /a b/я/ ",), ("/",), ("",), ("//x//",), ("a%2Fb",), ("a%zz",)], "r string")
    got = [r.f for r in df.select(FE.route_file(F.col("r")).alias("f")).collect()]
    assert got == ["a%20b/%D1%8F.json", "index.json", "index.json", "x.json", "a%2Fb.json", None]
    base = F.array(FE.entry("a", F.lit("1"), F.lit("2")), FE.entry("b", F.lit("x y")), FE.entry("c", F.lit("3")))
    more = F.array(FE.entry("a", F.lit(None)), FE.entry("b", F.lit("n"), F.lit(None)), FE.entry("d", F.lit("&")))
    text = df.select(FE.query_text(base, more).alias("t")).first().t
    assert text == "a=1&a=2&c=3&b=n&d=%26"


def pages_df(spark, rows):
    return spark.createDataFrame(rows, "page long, n_items int, page_count long")


@pytest.mark.parametrize(
    "rows, start, most, want",
    [
        ([(1, 2, None), (2, 0, None), (3, 2, None)], 1, None, [1, 2]),
        ([(1, 2, 2), (2, 2, 2), (3, 2, 2)], 1, None, [1, 2]),
        ([(1, 2, None), (3, 2, None)], 1, None, [1]),
        ([(2, 2, None), (3, 2, None)], 1, None, []),
        ([(1, 2, None), (2, 2, None), (3, 2, None)], 2, None, [2, 3]),
        ([(1, 2, None), (2, 2, None), (3, 2, None)], 1, 2, [1, 2]),
        ([(5, 1, 3)], 5, None, [5]),
    ],
)
def test_traversal_stops(spark, rows, start, most, want):
    got = C.catalog_traverse(pages_df(spark, rows), start, most)
    assert sorted(r.page for r in got.collect()) == want


def test_search_ignores_case_and_space(spark):
    df = spark.createDataFrame(
        [(1, "Тёмный  МАГ", None, None), (2, "x", "Dark Mage", None), (3, "y", None, "<p>the <b>dark</b>&nbsp;mage</p>"), (4, "z", None, None)],
        "id int, title string, title_en string, description_html string",
    )
    ids = lambda needle, **o: sorted(r.id for r in C.search_books(df, needle, **o).collect())
    assert ids("  тёмный маг ") == [1]
    assert ids("DARK  MAGE") == [2, 3]
    assert ids("dark mage", include_description=False) == [2]
    assert ids("   ") == []


def test_catalog_to_search(spark):
    item = {"id": 4270, "title": "Бездна небес", "slug": "bezdna", "description": "<p>Описание</p>", "lastChapter": {"id": 1}}
    empty = json.dumps({"items": []})
    full = json.dumps({"pageProps": {"books": {"items": [item, 5], "pagesData": {"totalCount": "1", "pageCount": 1.9}}}})
    rows = captures(
        spark,
        [
            {"capture_id": "1", "kind": "catalog", "page": 1, "route": "/v3/books", "body": empty},
            {"capture_id": "2", "kind": "catalog", "page": 1, "route": "/books", "body": full},
        ],
    )
    got = search_catalog(rows, "ОПИСАНИЕ", BASE).collect()
    assert [(r.slug, r.url, r.last_chapter.book_slug) for r in got] == [("bezdna", f"{BASE}/bezdna", "bezdna")]
    everything = C.book_summaries(C.catalog_items(load_captures(rows)), BASE).collect()
    assert {r.slug for r in everything} == {"bezdna", "unknown-book"}


def test_book_people_dedupe(spark):
    book = {"translator": {"id": 5, "name": "A"}, "translators": [{"id": "5", "name": "A"}, {"id": 5, "name": "A", "login": "a"}, 7, {}], "redactor": {"name": "A"}}
    rows = captures(spark, [{"capture_id": "1", "kind": "book", "book_slug": "b", "body": json.dumps({"pageProps": {"book": book}})}])
    got = B.book_people(B.book_objects(load_captures(rows))).orderBy("pos").collect()
    assert [(r.role, r.id, r.id_is_num, r.username) for r in got] == [
        ("translator", "5", True, None), ("translator", "5", True, "a"), ("editor", None, None, None),
    ]


def test_id_only_people(spark):
    rows = captures(
        spark,
        [
            {"capture_id": "1", "kind": "chapter", "book_slug": "b", "chapter_slug": "c", "body": chapter("c", translatorId=10954, editorId=55)},
            {"capture_id": "2", "kind": "chapter", "book_slug": "b", "chapter_slug": "d", "body": chapter("d", translatorId=5, translator={"id": "5"})},
        ],
    )
    got = CH.chapter_people(CH.chapter_objects(load_captures(rows))).orderBy("chapter_slug", "pos").collect()
    assert [(r.chapter_slug, r.role, r.id, r.id_is_num, r.name) for r in got] == [
        ("c", "translator", "10954", True, None), ("c", "editor", "55", True, None), ("d", "translator", "5", False, None),
    ]


def test_paid_chapter(spark):
    rows = captures(spark, [{"capture_id": "1", "kind": "chapter", "book_slug": "b", "chapter_slug": "paid", "body": chapter("paid", None, isDonate=True, price=4)}])
    [closed] = fetched_chapters(rows, BASE).collect()
    assert (closed.error_code, closed.available, closed.chapter.price) == ("CHAPTER_UNAVAILABLE", False, 4.0)
    [meta] = fetched_chapters(rows, BASE, allow_unavailable=True).collect()
    assert (meta.error_code, meta.available, meta.chapter.is_donate, meta.raw_html) == (None, False, True, None)


def test_availability_parses_each_body_once(spark, sf_dir):
    """Both modes are told of the same rows: bodies of lines and of talks are each parsed in one place of the plan."""
    from inkloom.workload.registry import QUERIES

    plan = QUERIES["chapter_availability"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2


def test_cleaned_content_is_not_shuffled(spark):
    rows = spark.createDataFrame([("b", "1", "<p>x</p>"), ("b", "2", None), (None, "3", "y")], "book_slug string, chapter_slug string, raw_html string")
    pages = spark.createDataFrame([("b", "1", 5), ("b", "1", 6), (None, "3", 7)], "book_slug string, chapter_slug string, page_html int")
    out = CH.chapter_content(rows, BASE, page_html=pages)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "formatted_html" in plan and "formatted_html" not in plan[plan.index("Join LeftOuter") :]
    assert out.columns == ["book_slug", "chapter_slug", "raw_html", "formatted_html", "text", "images", "page_html"]
    got = sorted((r.chapter_slug, r.text, r.page_html) for r in out.select("chapter_slug", "text", "page_html").collect())
    assert got == [("1", "x", 5), ("1", "x", 6), ("2", None, None), ("3", "y", None)]


def test_people_are_read_once(spark):
    rows = captures(spark, [{"book_slug": "b", "chapter_slug": "c", "body": '{"pageProps":{"chapter":{"translators":[{"id":1},{"id":1,"name":""},4]}}}'}])
    out = CH.chapter_people(CH.chapter_objects(load_captures(rows)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the lists of both roles are made in one place each
    assert plan.count("flatten(") == 2
    assert [(r.role, r.id) for r in out.collect()] == [("translator", "1")]


def test_assembly_keeps_failures_in_order(spark):
    listed = spark.createDataFrame(
        [("b", i, s, None, float(n), s) for i, (s, n) in enumerate([("c3", 3), ("c1", 1), ("", 4), ("c2", 2), ("c5", 5)])],
        "book_slug string, pos long, slug string, volume double, number double, title string",
    )
    rows = captures(
        spark,
        [
            {"capture_id": "1", "kind": "chapter", "book_slug": "b", "chapter_slug": "c3", "body": chapter("c3")},
            {"capture_id": "2", "kind": "chapter", "book_slug": "b", "chapter_slug": "c1", "body": chapter("c1", wrap="data")},
            {"capture_id": "3", "kind": "chapter", "book_slug": "b", "chapter_slug": "c2", "body": "{", "fetched_at": "2024-01-01 00:00:09"},
            {"capture_id": "4", "kind": "chapter", "book_slug": "b", "chapter_slug": "c2", "body": chapter("c2")},
        ],
    )
    books = assembled_books(listed, rows, BASE, "ascending")
    got = [(r["index"], r.slug, r.error_code) for r in books.orderBy("index").collect()]
    assert got == [(0, "c1", None), (1, "c2", "INVALID_PAYLOAD"), (2, "c3", None), (3, "", "INVALID_INPUT"), (4, "c5", "NOT_FOUND")]
    assert [r.slug for r in O.until_first_error(books).collect()] == ["c1"]
    assert O.download_summary(books).first()[1:] == (2, 3)
    failing_first = books.filter("slug <> 'c1'")
    assert O.until_first_error(failing_first).count() == 0


def test_assembly_finds_listed_paths_and_keeps_what_failures_said(spark):
    slugs = ["v1/c2", "a%20b", f"{BASE}/b/c4", "c5", "%zz"]
    listed = spark.createDataFrame(
        [("b", i, s, None, float(i), s) for i, s in enumerate(slugs)],
        "book_slug string, pos long, slug string, volume double, number double, title string",
    )
    rows = captures(
        spark,
        [{"capture_id": s, "kind": "chapter", "book_slug": "b", "chapter_slug": s, "body": chapter(s)} for s in ("c2", "a b", "c4")]
        + [{"capture_id": "5", "kind": "chapter", "book_slug": "b", "chapter_slug": "c5", "status": 502, "body": "bad gateway"}],
    )
    got = {r.slug: r.error_code for r in assembled_books(listed, rows, BASE).collect()}
    assert got == dict(zip(slugs, [None, None, None, "HTTP_ERROR", "INVALID_INPUT"], strict=True))
    [failed] = fetched_chapters(rows, BASE).where("capture_id = '5'").collect()
    assert failed.preview == "bad gateway"


ORDER_ROWS = [
    ("b", 0, None, None, "я"), ("b", 1, None, 2.0, "ё"), ("b", 2, None, 2.0, "е"), ("b", 3, 1.0, 1.0, "a"), ("b", 4, None, 2.0, "ё"), ("b", 5, 0.0, 2.0, "ж"),
    ("c", 0, None, None, "x"),
]


@pytest.mark.parametrize(
    "order, want", [("source", [0, 1, 2, 3, 4, 5]), ("ascending", [2, 1, 4, 5, 0, 3]), ("descending", [3, 0, 5, 1, 4, 2])]
)
def test_chapter_order(spark, order, want):
    df = spark.createDataFrame(ORDER_ROWS, "book_slug string, pos long, volume double, number double, title string")
    for upto in (None, 5):
        rows = O.select_chapters(df, order, to=upto).filter("book_slug = 'b'").orderBy("index").collect()
        assert [r.pos for r in rows] == want
    slice_ = O.select_chapters(df, order, 1, 2).filter("book_slug = 'b'").orderBy("index").collect()
    assert [(r["index"], r.pos) for r in slice_] == [(0, want[1]), (1, want[2])]


def test_one_huge_book_is_spread(spark, sf_dir):
    lines = P.line_chapters(P.table(spark, sf_dir, "lineitem"))
    hot = lines.withColumn("book_slug", F.when(F.col("book_slug") % 3 == 0, 0).otherwise(F.col("book_slug")))
    hot = hot.withColumn("pos", F.xxhash64("pos", "title", "volume", "number"))
    place = F.row_number().over(Window.partitionBy("book_slug").orderBy(*O.chapter_order("ascending"))) - 1
    plain = hot.select("book_slug", "pos", place.cast("bigint").alias("rank"))
    spread = O.select_chapters(hot, "ascending").select("book_slug", "pos", "rank")
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0


def test_positions_run_no_job_while_planning(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(1000).selectExpr("'b' AS book_slug", "id AS pos", "0D AS volume", "1D AS number", "'t' AS title", "id AS pos2")
    spark.sparkContext.setJobGroup("plan", "plan")
    try:
        rows = O.select_chapters(df, "descending", 10, 20)
        assert not tracker.getJobIdsForGroup("plan")
        assert sorted((r["index"], r["rank"], r.pos) for r in rows.collect()) == [(i, i + 10, i + 10) for i in range(11)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_books_meet_no_cuts(spark):
    """Only rows of large books get ranges; all rows move once, for the window."""
    rows = [(f"s{i}", i % 3, None, float(-i), "t") for i in range(9000)] + [("big", i, None, float(i % 7), "t") for i in range(9000)] + [(None, 1, None, 1.0, "t")]
    df = spark.createDataFrame(rows, "book_slug string, pos long, volume double, number double, title string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = O.select_chapters(df, "descending", 1, 2000)
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        found = got.select("book_slug", "pos", "rank").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = sorted(range(9000), key=lambda i: (-(i % 7), i))
    assert [r.pos for r in sorted(found, key=lambda r: r["rank"])] == want[1:2001] and {r.book_slug for r in found} == {"big"}


def test_fields_are_read_in_one_pass(spark):
    """An object is gone through once for all its fields, whose readers need no function over arrays."""
    body = {"id": 5, "chapterId": "x", "book": {"id": " ", "slug": "b"}, "title": 7, "name": "N", "price": None, "n": "0x1F", "views": True, "isDonate": "true", "url": ""}
    df = spark.createDataFrame([(json.dumps(body),), ('{"id":" ","chapterId":1.50,"book":[1],"n":"","views":"7.9","price":3}',), ("[1]",), ("5",), (None,)], "body string")
    docs = df.select(F.try_parse_json("body").alias("raw"))
    read, f = read_fields(
        docs, F.col("raw"), "_t_", ids={"id": "id chapterId", "book_id": "book.id"}, texts={"title": "title name", "slug": "book.slug"}, raw_texts={"url": "url"},
        numbers={"price": "price n"}, integers={"views": "views"}, flags={"paid": "isDonate"}, maybe_flags={"edited": "isEdited"}, variants={"book": "book"},
    )
    names = ("title", "slug", "url", "price", "views", "paid", "edited")
    out = read.select(f["id"]["value"].alias("id"), f["id"]["is_num"].alias("num"), f["book_id"].alias("book_id"), *[f[n].alias(n) for n in names], F.to_json(f["book"]).alias("book"))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_variant_get(raw") == 2
    assert [tuple(r) for r in out.collect()] == [
        ("5", True, None, "N", "b", "", 31.0, None, True, None, '{"id":" ","slug":"b"}'),
        ("1.5", True, None, None, None, None, 3.0, 7, False, None, "[1]"),
        *[(None, None, None, None, None, None, None, None, False, None, None)] * 3,
    ]


def test_search_index_equals_the_scan(spark):
    dice = random.Random(11)
    texts = ["".join(dice.choice("abcd  Éя") for _ in range(dice.randrange(40))) for _ in range(200)] + ["", None, "ab" * 50]
    rows = [(f"k{i}", t, texts[-i - 1], None if t is None else f"<p>{t}</p>x") for i, t in enumerate(texts)]
    books = spark.createDataFrame(rows, "key string, title string, title_en string, description_html string").repartition(4)
    needles = ["".join(dice.choice("abcd éЯ") for _ in range(dice.randrange(7))) for _ in range(60)] + ["", "  ", None, "A  B", "zzz", "ab" * 20, "b", "bx"]
    index = write_search_index(books, scratch_path(spark, "index"))
    got = search_many(index, spark.createDataFrame([(n,) for n in needles], "needle string"))
    want = set()
    for n in set(needles) - {None}:
        want |= {(n, r.key) for r in C.search_books(books, n).collect()} if n.strip() in ("b", "bx", "A  B", "zzz") else set()
    form = lambda t: re.sub(r"\s+", " ", (t or "").lower()).strip(" ")
    plain = {
        (n, k) for n in set(needles) - {None} if form(n)
        for k, title, en, html in rows if any(form(n) in form(f) for f in (title, en, re.sub("<[^>]+>", "\n", html or "").strip()))
    }
    rows_ = [tuple(r) for r in got.collect()]
    assert len(rows_) == len(set(rows_)) and set(rows_) == plain and want <= plain


def test_search_index_of_long_texts_and_repeated_keys(spark):
    """Books of one key count each; a text longer than a slice is found by what stands over the edges of its parts."""
    edge = SLICE_CHARS
    rows = [("a", "moon rise"), ("a", "full moon"), ("b", "x" * (edge - 3) + "sunmoonset" + "é" * 50), ("c", "mo on")]
    books = spark.createDataFrame([(k, t, None, None) for k, t in rows], "key string, title string, title_en string, description_html string").coalesce(1)
    index = write_search_index(books, scratch_path(spark, "index"))
    got = search_many(index, spark.createDataFrame([("moon",), ("MOON",), ("nm",), ("nmo",), ("x" * 40 + "sun",)], "needle string"))
    held = [("moon", k) for k in "aab"] + [("MOON", k) for k in "aab"] + [("nm", "b"), ("nmo", "b"), ("x" * 40 + "sun", "b")]
    assert sorted(tuple(r) for r in got.collect()) == sorted(held)
    # a book lies in one slice, and the index was written without a shuffle of its grams
    assert sorted(k for r in index.slices.select("keys").collect() for k in r["keys"]) == ["a", "a", "b", "c"]


def test_traverse_thousands_of_catalogs(spark):
    """Catalog c has pages 1 to c % 7 + 1 without page c % 5, one of null name among them; some say how many they have."""
    rows = []
    for c in range(3000):
        name = None if c == 0 else f"c{c}"
        rows += [(name, c % 3, p, 1 if p != 6 else 0, 3 if c % 11 == 0 else None) for p in range(1, c % 7 + 2) if p != c % 5]
    df = spark.createDataFrame(rows, "catalog string, ordering long, page long, n_items long, page_count long").repartition(8)
    got = {(r.catalog, r.page) for r in C.catalog_traverse(df, by=("catalog", "ordering")).collect()}
    want = set()
    for c in range(3000):
        for p in range(1, c % 7 + 2):
            if p == c % 5:
                break
            want.add((None if c == 0 else f"c{c}", p))
            if p == 6 or c % 11 == 0 and p >= 3:
                break
    assert got == want


def test_captures_by_build(spark):
    rows = [  # site, route, build, status, minute
        ("a", "/1", "b1", 200, 0), ("a", "/1", "b1", 404, 30), ("a", "/1", "b2", 200, 31),  # the old build is gone, the new one answers
        ("a", "/2", "b1", 404, 32),  # never asked for under b2
        ("a", "/3", "b2", 404, 40), ("a", "/4", "b3", 404, 60),  # the latest build has no such route
        ("b", "/1", "b9", 200, 5), ("b", "/2", "b1", 404, 6), ("b", "/2", "b9", 404, 7),
    ]
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "capture_id string, site string, route string, build_id string, status int, m int")
    df = df.withColumn("fetched_at", F.timestamp_seconds(F.lit(1_700_000_000) + 60 * F.col("m")))
    got = {(r.site, r.route): (r.capture_id, r.current_build, r.retry_build) for r in FE.captures_by_build(df).collect()}
    assert got == {
        ("a", "/1"): ("2", "b2", None), ("a", "/2"): ("3", "b2", "b2"), ("a", "/3"): ("4", "b2", "b3"), ("a", "/4"): ("5", "b3", None),
        ("b", "/1"): ("6", "b9", None), ("b", "/2"): ("7", "b1", None),
    }


def test_unsafe_html_in_linear_time(spark):
    for opening in ("<svg>x ", "<svg x ", "<!-- x ", "<!DOCTYPE x ", "<p x ", "<svg><style></svg> "):
        begun = time.perf_counter()
        html = F.repeat(F.lit(opening), 10_000_000 // len(opening))
        row = spark.range(1).select(F.length(drop_unsafe_html(html)).alias("n")).first()
        kept = 1 if "</svg>" in opening else len(opening)  # of the closed ones a blank is left
        assert row.n == kept * (10_000_000 // len(opening)) and time.perf_counter() - begun < 60


def test_unsafe_html_as_by_the_plain_pattern(spark):
    """One pattern that tries every opening tag, against the guarded ones, on texts made of their parts."""
    dice = random.Random(5)
    parts = ["<svg>", "<svg ", "</svg>", "</SVG  >", "<script a>", "</script>", "</script", "<style>", "</style\n>", "<p>", "x", " ", ">", "<", "<!--", "-->", "<!DOCTYPE", "<form>", "</form>", "<scripty>", "\ue000", "é"]
    rows = [("".join(dice.choice(parts) for _ in range(dice.randrange(30))),) for _ in range(3000)]
    blocks = r"(?is)<(script|style|iframe|object|embed|noscript|form|svg|canvas|video|audio)(?![A-Za-z0-9_])[^>]*>.*?</\1\s*>"
    wanted = [re.sub(r"(?is)<!DOCTYPE.*?>", "", re.sub(r"(?s)<!--.*?-->", "", re.sub(blocks, "", h))) for (h,) in rows]
    df = spark.createDataFrame([(i, h) for i, (h,) in enumerate(rows)], "i int, h string").repartition(4)
    got = [r.h for r in df.select("i", drop_unsafe_html(F.col("h")).alias("h")).orderBy("i").collect()]
    assert got == wanted


def test_url_keys(spark):
    base = "https://novels.example"
    rows = [
        ("https://novels.example/b/c/d?x", None, ("b", "c")), ("https://other.example/b/c", None, None), (" /b%20k/ ", "https://novels.example/z/ch%2B1", ("b k", "ch+1")),
        ("/b", None, None), ("b/c", None, ("b", "c")), ("/b/%zz", None, None), ("/", "/c", None), ("HTTPS://NOVELS.example/b/c", None, ("b", "c")),
    ]
    df = spark.createDataFrame([(i, b, c) for i, (b, c, _) in enumerate(rows)], "i int, book_input string, chapter_input string")
    for r in L.url_keys(df, base).collect():
        want = rows[r.i][2]
        assert (r.book_slug, r.chapter_slug) == (want or (None, None)), rows[r.i]
        assert r.error_code == (None if want else "INVALID_INPUT")


@pytest.mark.parametrize("file_format", ["parquet", "json", "orc"])
def test_captures_read_back(spark, file_format):
    rows = captures(spark, [{"capture_id": "1", "kind": "chapter", "body": chapter("c")}, {"capture_id": "2", "kind": "page_html", "body": "<p>"}])
    path = scratch_path(spark, "landed")
    rows.write.format(file_format).save(path)
    got = load_captures(read_captures(spark, path, file_format)).orderBy("capture_id")
    assert [r.ok for r in got.select(F.col("doc").isNotNull().alias("ok")).collect()] == [True, False]


def library_rows(books, text, code=None):
    return [(b, 0, f"{b}-0", text, code) for b in books]


LIBRARY = "book_slug string, index long, chapter_slug string, text string, error_code string"


def test_library_versions_replace_whole_books(spark):
    path = scratch_path(spark, "library")
    write_library(spark.createDataFrame(library_rows("abcd", "old") + [("b", 1, "b-1", "old", None)], LIBRARY), path)
    write_library(spark.createDataFrame(library_rows("b", "new", "NOT_FOUND"), LIBRARY), path)
    got = sorted((r.book_slug, r["index"], r.text) for r in read_library(spark, path).collect())
    assert got == [("a", 0, "old"), ("b", 0, "new"), ("c", 0, "old"), ("d", 0, "old")]
    counts = {r.book_slug: (r.succeeded, r.failed) for r in read_library(spark, path, "books").collect()}
    assert counts == {"a": (1, 0), "b": (0, 1), "c": (1, 0), "d": (1, 0)}


def files_of(path):
    return sorted(os.path.join(folder, f) for folder, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_library_reader_sees_whole_versions_only(spark, monkeypatch):
    path = scratch_path(spark, "library")
    write_library(spark.createDataFrame(library_rows("ab", "old"), LIBRARY), path)
    before = files_of(path)
    seen = []
    writer = library._write

    def between(rows, path_, name, *rest):
        done = writer(rows, path_, name, *rest)
        seen.append({r.text for r in read_library(spark, path).collect()})
        return done

    monkeypatch.setattr(library, "_write", between)
    write_library(spark.createDataFrame(library_rows("ab", "new"), LIBRARY), path)
    assert seen == [{"old"}, {"old"}] and {r.text for r in read_library(spark, path).collect()} == {"new"}
    # a writer that fails between its tables leaves what was there
    failing = spark.createDataFrame(library_rows("ab", "lost"), LIBRARY)
    bad = failing.select("book_slug", F.raise_error(F.lit("no counts")).cast("long").alias("succeeded"))
    with pytest.raises(Exception, match="no counts"):
        write_library(failing, path, books=bad)
    assert {r.text for r in read_library(spark, path).collect()} == {"new"}
    assert set(before) <= set(files_of(path))  # nothing was rewritten


def test_library_compaction(spark):
    path = scratch_path(spark, "library")
    assert library.compact_library(spark, path) is None
    for n in range(3):
        write_library(spark.createDataFrame(library_rows("ab"[: 2 - n % 2], f"v{n}"), LIBRARY), path)
    before = sorted(map(tuple, read_library(spark, path).collect()))
    library.compact_library(spark, path)
    assert len(library.published(spark, path)) == 1 and sorted(map(tuple, read_library(spark, path).collect())) == before
    assert len(library.superseded(spark, path)) == 6
    write_library(spark.createDataFrame(library_rows("c", "later"), LIBRARY), path)
    assert {r.book_slug for r in read_library(spark, path).collect()} == set("abc")
    library.compact_library(spark, path)
    assert {r.book_slug for r in read_library(spark, path, "books").collect()} == set("abc")


def test_library_without_chapters(spark):
    path = scratch_path(spark, "library")
    write_library(spark.createDataFrame([], LIBRARY), path)
    assert read_library(spark, path).count() == 0 and read_library(spark, path, "books").columns == ["book_slug", "succeeded", "failed"]


# ------------------------------------------------------------- whole books


def book(slug, chapters, **fields):
    return json.dumps({"pageProps": {"book": {"id": 1, "title": f"Book {slug}", "slug": slug, "chapters": chapters, **fields}}})


def test_download_books(spark):
    listed = [{"id": i, "slug": s, "title": s, "number": n} for i, (s, n) in enumerate([("c3", 3), ("c1", 1), ("c2", 2), ("c4", 4)])]
    other = {**listed[1], "book": {"slug": "elsewhere"}, "url": "/elsewhere/c1"}
    rows = [
        # asked for under an old name; one chapter names another book
        {"capture_id": "b1", "kind": "book", "book_slug": "old-name", "body": book("own", [listed[0], other, *listed[2:]])},
        {"capture_id": "b2", "kind": "book", "book_slug": "gone", "status": 404},
        {"capture_id": "b3", "kind": "book", "book_slug": "broken", "body": "<html>"},
        {"capture_id": "b4", "kind": "book", "book_slug": "empty", "body": book("empty", [])},
        {"capture_id": "b5", "kind": "book", "book_slug": "down", "status": 503},
        {"capture_id": "k1", "kind": "chapter", "book_slug": "own", "chapter_slug": "c1", "body": chapter("c1")},
        {"capture_id": "k2", "kind": "chapter", "book_slug": "own", "chapter_slug": "c2", "status": 500},
        {"capture_id": "k3", "kind": "chapter", "book_slug": "own", "chapter_slug": "c3", "body": chapter("c3")},
        {"capture_id": "k9", "kind": "chapter", "book_slug": "elsewhere", "chapter_slug": "c1", "status": 500},
    ]
    found = download_books(captures(spark, rows), BASE, order="ascending")
    books = {r.book_slug: (r.error_code, r.slug, r.succeeded, r.failed, r.stopped_by) for r in found.books.collect()}
    assert books == {
        "old-name": (None, "own", 2, 2, None), "gone": ("NOT_FOUND", None, None, None, None), "broken": ("INVALID_PAYLOAD", None, None, None, None),
        "empty": (None, "empty", 0, 0, None), "down": ("HTTP_ERROR", None, None, None, None),
    }
    rows_of = lambda d: sorted((r["index"], r.slug, r.error_code, r.content is not None and r.content.text is not None) for r in d.chapters.collect())
    assert rows_of(found) == [(0, "c1", None, True), (1, "c2", "HTTP_ERROR", False), (2, "c3", None, True), (3, "c4", "NOT_FOUND", False)]
    stopped = download_books(captures(spark, rows), BASE, order="ascending", stop_on_error=True)
    assert rows_of(stopped) == [(0, "c1", None, True)]
    assert {r.book_slug: (r.succeeded, r.failed, r.stopped_by) for r in stopped.books.collect()}["old-name"] == (1, 0, "HTTP_ERROR")
    part = download_books(captures(spark, rows), BASE, order="descending", start=1, to=2)
    assert rows_of(part) == [(0, "c3", None, True), (1, "c2", "HTTP_ERROR", False)]
    path = scratch_path(spark, "library")
    write_library(found.chapters, path, books=found.books)
    assert read_library(spark, path, "books").count() == 5 and read_library(spark, path).count() == 4


def test_download_book_of_thousands_of_chapters(spark):
    n = 5000
    listed = [{"id": i, "slug": f"c{i}", "title": f"T{i}", "number": n - i} for i in range(n)]
    big = captures(spark, [{"capture_id": "b", "kind": "book", "book_slug": "big", "body": book("big", listed)}])
    one = captures(spark, [{"capture_id": "x", "kind": "chapter", "book_slug": "big", "chapter_slug": "c", "body": chapter("c")}])
    many = one.crossJoin(spark.range(n).where("id % 5 <> 0")).withColumns(
        {"capture_id": F.concat(F.lit("k"), "id"), "chapter_slug": F.concat(F.lit("c"), "id")}
    )
    found = download_books(big.unionByName(many.drop("id")), BASE, order="ascending", clean=False)
    rows = sorted((r["index"], r.slug, r.error_code) for r in found.chapters.select("index", "slug", "error_code").collect())
    assert rows == [(k, f"c{n - 1 - k}", "NOT_FOUND" if (n - 1 - k) % 5 == 0 else None) for k in range(n)]
    [counts] = found.books.select("succeeded", "failed").collect()
    assert tuple(counts) == (4 * n // 5, n // 5)


def test_stream_dedupe_over_batches(spark):
    root = scratch_path(spark, "dedupe")
    schema = "capture_id string, url string, kind string, fetched_at timestamp"
    batches = [[("a", 0), ("b", 10), ("c", 31)], [("d", 40), ("e", 61), ("f", 61)], [("g", 91)]]
    for rows in batches:
        data = [(i, "/u", "catalog", s) for i, s in rows]
        df = spark.createDataFrame(data, "capture_id string, url string, kind string, s long")
        df.select("capture_id", "url", "kind", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("fetched_at")).coalesce(1).write.mode(
            "append"
        ).parquet(f"{root}/in")
        S.stream_dedupe(S.read_stream(spark, f"{root}/in", schema), f"{root}/out", f"{root}/checkpoint")
    assert sorted(r.capture_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "c", "e", "g"]


def test_stream_dedupe_keeps_late_and_early_captures(spark):
    root = scratch_path(spark, "dedupe-late")
    schema = "capture_id string, url string, kind string, fetched_at timestamp"
    # a key first seen far behind the others, captures before a kept one, and a late repeat
    batches = [[("a", "/u", 10_000)], [("b", "/v", 20_000)], [("c", "/w", 5), ("d", "/u", 9_000), ("e", "/u", 9_990)], [("f", "/u", 9_010), ("g", "/u", 10_100)]]
    for rows in batches:
        df = spark.createDataFrame([(i, u, "catalog", s) for i, u, s in rows], "capture_id string, url string, kind string, s long")
        at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("fetched_at")
        df.select("capture_id", "url", "kind", at).coalesce(1).write.mode("append").parquet(f"{root}/in")
        S.stream_dedupe(S.read_stream(spark, f"{root}/in", schema), f"{root}/out", f"{root}/checkpoint")
    assert sorted(r.capture_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c", "d", "g"]


def test_stream_dedupe_of_a_hot_key(spark):
    """A third of all captures under one key, over thousands of periods; all of them come again, late."""
    root, period, n = scratch_path(spark, "dedupe-hot"), 30, 1_000_000
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("fetched_at")
    id_, kind = F.format_string("%07d", "id").alias("capture_id"), F.lit("catalog").alias("kind")
    # one capture a second in no order, on 400,000 seconds twice or three times
    hot = spark.range(n).select(id_, F.lit("/hot").alias("url"), kind, (F.col("id") * 7919 % 400_000).alias("s"))
    rest = spark.range(2000).select(id_, F.concat(F.lit("/u"), F.col("id") % 500).alias("url"), kind, (F.col("id") * 11).alias("s"))
    for rows in (hot.unionByName(rest), hot.where("s % 3 = 0")):
        rows.select("capture_id", "url", "kind", at).repartition(4).write.mode("append").parquet(f"{root}/in")
        S.stream_dedupe(S.read_stream(spark, f"{root}/in", "capture_id string, url string, kind string, fetched_at timestamp"), f"{root}/out", f"{root}/checkpoint", {"catalog": 1000 * period})
    kept = spark.read.parquet(f"{root}/out").where("url = '/hot'").select(F.unix_seconds("fetched_at").alias("s")).orderBy("s").collect()
    assert [r.s - 1_700_000_000 for r in kept] == list(range(0, 400_000, period))


def test_stream_dedupe_of_many_keys(spark):
    """Many addresses are one call and one entry of a stretch; over two batches each keeps its own first captures."""
    root, n = scratch_path(spark, "dedupe-many"), 20_000
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("fetched_at")
    url = F.when(F.col("id") % n > 0, F.concat(F.lit("/u"), F.col("id") % n)).alias("url")  # one address is null
    began = time.time()
    # batch one: seconds 0 and 20; batch two: seconds 10, 25, 31 and 70
    for seconds in ([20, 0], [10, 31, 70, 25]):
        moment = F.element_at(F.array(*map(F.lit, seconds)), (F.col("id") / n).cast("int") + 1)
        rows = spark.range(n * len(seconds)).select(F.concat(F.lit("c"), moment).alias("capture_id"), url, F.lit("catalog").alias("kind"), moment.alias("s"))
        rows.select("capture_id", "url", "kind", at).repartition(4).write.mode("append").parquet(f"{root}/in")
        S.stream_dedupe(S.read_stream(spark, f"{root}/in", "capture_id string, url string, kind string, fetched_at timestamp"), f"{root}/out", f"{root}/checkpoint", {"catalog": 30_000})
    kept = spark.read.parquet(f"{root}/out").groupBy("url").agg(F.sort_array(F.collect_list("capture_id")).alias("ids"))
    assert [(tuple(r.ids), r["count"]) for r in kept.groupBy("ids").count().collect()] == [(("c0", "c31", "c70"), n)]
    assert time.time() - began < 60  # a call for each key took minutes


def test_stream_dedupe_forgets_when_told(spark):
    root, schema = scratch_path(spark, "dedupe-ttl"), "capture_id string, url string, kind string, fetched_at timestamp"
    for name in "ab":
        row = spark.createDataFrame([(name, "/u", "catalog")], "capture_id string, url string, kind string")
        row.withColumn("fetched_at", F.timestamp_seconds(F.lit(1_700_000_000))).coalesce(1).write.mode("append").parquet(f"{root}/in")
        S.stream_dedupe(S.read_stream(spark, f"{root}/in", schema), f"{root}/out", f"{root}/checkpoint", state_ms=1)
    assert sorted(r.capture_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b"]


def test_stream_library_replay_and_growth(spark):
    root = scratch_path(spark, "replayed")
    rows = [{"capture_id": str(i), "kind": "chapter", "book_slug": f"b{i}", "chapter_slug": "c", "body": chapter("c")} for i in range(20)]
    add = S._add_batch(BASE, f"{root}/out", "batch-x")
    add(captures(spark, rows), 0)
    before, whole = files_of(f"{root}/out"), sorted(map(repr, library.read_chapters(spark, f"{root}/out").collect()))
    add(captures(spark, rows), 0)
    assert sorted(map(repr, library.read_chapters(spark, f"{root}/out").collect())) == whole
    kept = [f for f in files_of(f"{root}/out") if "version=batch-x-0" in f]
    add(captures(spark, [{**rows[3], "capture_id": "99", "status": 404, "fetched_at": "2024-02-01 00:00:00"}]), 1)
    # a batch of one chapter adds files of its own and touches no other
    assert set(kept) <= set(files_of(f"{root}/out")) and len(before) <= len(files_of(f"{root}/out"))
    after = {r.book_slug: r.error_code for r in library.read_chapters(spark, f"{root}/out").collect()}
    assert len(after) == 20 and after["b3"] == "NOT_FOUND"
    library.compact_library(spark, f"{root}/out", single_chapters=True)
    assert {r.book_slug: r.error_code for r in library.read_chapters(spark, f"{root}/out").collect()} == after
    assert len(library.published(spark, f"{root}/out")) == 1


def test_large_strings_and_deep_values_are_good(spark):
    bodies = [("1", '{"a":"' + "x" * 30_000_000 + '"}'), ("2", "[" * 1500 + "]" * 1500), ("3", '{"a":1} x'), ("4", '{"a":')]
    rows = captures(spark, [{"capture_id": i, "kind": None, "body": b} for i, b in bodies])
    assert {r.capture_id: r.error_code for r in quarantine_payloads(rows).select("capture_id", "error_code").collect()} == {
        "1": None, "2": None, "3": "INVALID_PAYLOAD", "4": "INVALID_PAYLOAD",
    }
    assert load_captures(rows).where("doc IS NOT NULL").count() == 2


def test_stream_library_over_batches(spark):
    root = scratch_path(spark, "streamed")
    first = [
        {"capture_id": "1", "kind": "chapter", "book_slug": "b", "chapter_slug": "c1", "status": 500},
        {"capture_id": "2", "kind": "chapter", "book_slug": "b", "chapter_slug": "c2", "body": chapter("c2")},
        {"capture_id": "3", "kind": "chapter", "book_slug": "x", "chapter_slug": "c1", "status": 404},
    ]
    second = [{"capture_id": "4", "kind": "chapter", "book_slug": "b", "chapter_slug": "c1", "body": chapter("c1"), "fetched_at": "2024-01-02 00:00:00"}]
    want = [{"b": (1, 1), "x": (0, 1)}, {"b": (2, 0), "x": (0, 1)}]
    for rows, counts in zip((first, second), want, strict=True):
        captures(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
        S.stream_library(S.read_stream(spark, f"{root}/in", CAPTURE_SCHEMA), f"{root}/out", f"{root}/checkpoint", BASE)
        got = {r.book_slug: (r.succeeded, r.failed) for r in O.download_summary(library.read_chapters(spark, f"{root}/out")).collect()}
        assert got == counts


def test_stream_equals_batch(spark, sf_dir):
    talks = P.table(spark, sf_dir, "conversations")
    out, checkpoint = S.new_run(spark, "same")
    stream = S.read_stream(spark, sf_dir, talks.schema, "conversations.parquet")
    S.stream_captures(P.talk_captures(stream), out, checkpoint, BASE)
    columns = ("capture_id", "error_code", "formatted_html", "text")
    batch = fetched_chapters(P.talk_captures(talks), BASE).select(*columns)
    streamed = spark.read.parquet(out).select(*columns)
    assert batch.exceptAll(streamed).count() == 0 and streamed.exceptAll(batch).count() == 0
