"""Captures built from the given tables.

Spark derives every payload row by row from relational columns, so its size
grows with the tables and the expected result is plain SQL over them.  Keys
take turns between the spellings and places a real payload may use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "https://novels.example"
PAGE_SIZE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _capture(df: DataFrame, keep: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """Captures with the given columns; the others are null."""
    kinds = {
        "capture_id": "string", "url": "string", "kind": "string", "book_slug": "string",
        "chapter_slug": "string", "page": "bigint", "route": "string", "build_id": "string",
        "status": "int", "retry_after": "string", "fetched_at": "timestamp", "body": "string",
    }
    return df.select(
        *keep, *[columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()]
    )


def _seconds(n: Column) -> Column:
    return F.timestamp_seconds(F.lit(1_700_000_000) + n)


# ------------------------------------------------------------------- pages


def page_captures(pages: DataFrame) -> DataFrame:
    return _capture(
        pages,
        capture_id=_text("page-", F.col("page_id")),
        url=F.col("url"),
        kind=F.lit("page_html"),
        status=F.lit(200),
        fetched_at=_seconds(F.col("page_id")),
        body=F.col("html"),
    )


def pages_with_data(pages: DataFrame) -> DataFrame:
    """Pages with an embedded JSON script, a broken one, or a manifest only."""
    n = F.col("page_id")
    data = _text('{"buildId":"build-', n, '","page":"/a&amp;b","note":"&lt;&quot;}')
    data = F.replace(data, F.lit('&quot;}'), F.lit('"}'))
    script = F.when(n % 4 == 0, _text('<script id="__NEXT_DATA__" type="application/json">', data, "</script>"))
    script = script.when(n % 4 == 1, _text("<SCRIPT async id='__NEXT_DATA__' >{&quot;buildId&quot;:&quot;q", n, "&quot;}</SCRIPT>"))
    script = script.when(
        n % 4 == 2, _text('<script id="__NEXT_DATA__" x>[1]</script><script src="/_next/static/static%20', n, '/_buildManifest.js"></script>')
    )
    return pages.select("page_id", F.concat(F.coalesce(script, F.lit("")), F.col("html")).alias("html"))


def pages_with_markup(pages: DataFrame) -> DataFrame:
    """Pages with images, styles, handlers and numeric entities added."""
    n = F.col("page_id")
    extra = F.concat(
        _text('<p style="text-align:center;color:red; Font-Weight : bold;position:x" onclick="bad()">No&#46; ', n, " &#x41;&#160;&lt;b&gt;</p>"),
        _text('<img data-lazy-src="/images/', n, '.jpg" onerror="bad()" alt="pic &amp; ', n, '" width="120" height="x">'),
        _text("<IMG src='' data-src='/images/", n % 7, ".png'><img src=/images/", n, ".jpg>"),
        F.lit('<img data-src="javascript:bad"><td colspan="2" rowspan=1000 align=RIGHT>c</td><ol start="-3"><del>d</del></ol>'),
        F.lit('<a href="mailto:a@b.example" title="A &quot;q&quot;">m</a><a href="javascript:x()">j</a><hr/></br><blink>k</blink>'),
    )
    return pages.select("page_id", "url", F.concat(extra, F.col("html")).alias("html"))


# ----------------------------------------------------------------- catalog


def part_item() -> Column:
    """JSON text of the book object of one part."""
    key, size = F.col("p_partkey"), F.col("p_size")
    only = lambda cond, value: F.when(cond, value)
    title = F.when(key % 7 == 0, F.lit("  ")).otherwise(F.col("p_name"))
    image = lambda url, path: F.struct(
        key.alias("id"), url.alias("url"), path.alias("path"), F.col("p_type").alias("name"), F.col("p_name").alias("alt")
    )
    none = F.lit(None).cast("string")
    cover = _text("/img/", F.col("p_brand"), ".png")
    genre = lambda w, i: F.struct(
        i.alias("id"),
        F.when(i % 2 == 0, w).alias("title"),
        F.when(i % 2 == 1, w).alias("name"),
        F.when(i % 2 == 0, F.upper(w)).alias("slug"),
        F.when(i % 2 == 1, F.lower(w)).alias("code"),
    )
    words = F.concat(F.split("p_name", " "), F.array(F.lit(" "), F.col("p_type")))
    last = F.struct(
        (key * 10).alias("id"),
        _text("Chapter ", size, ",5 end").alias("title"),
        _text("/part-", key, "/last-", size).alias("url"),
        _text(size).alias("tom"),
        F.lit(1).alias("isDonate"),
        F.lit("no").alias("isSponsored"),
    )
    return F.to_json(
        F.struct(
            only(size % 2 == 0, key).alias("id"),
            only(size % 2 == 1, _text("B", key)).alias("bookId"),
            only(key % 3 == 0, _text("part-", key)).alias("slug"),
            only(key % 3 == 1, _text("/part-", key, "/about?x=1")).alias("url"),
            only(size % 2 == 0, title).alias("title"),
            only(size % 2 == 1, title).alias("name"),
            only(size % 3 == 0, _text("En ", F.col("p_name"))).alias("titleEn"),
            only(size % 3 == 1, _text("En ", F.col("p_name"))).alias("title_en"),
            only(size % 3 == 2, _text("En ", F.col("p_name"))).alias("englishTitle"),
            _text("<p>", F.col("p_type"), " &amp; ", F.col("p_brand"), "</p>").alias("description"),
            F.col("p_type").alias("status"),
            _text(size, ".7").alias("views"),
            F.col("p_retailprice").alias("likes"),
            F.lit(True).alias("dislikes"),
            only(key % 4 == 0, last).alias("lastChapter"),
            F.transform(words, genre).alias("genres"),
            image(cover, none).alias("verticalImage"),
            image(none, _text("/img/h/", key, ".jpg")).alias("horizontalImage"),
            image(cover, none).alias("squareImage"),
            image(F.lit("javascript:x"), none).alias("imageVertical"),
            only(key % 2 == 0, image(_text("//cdn.example/", key, " v.png"), none)).alias("imageHorizontal"),
        )
    )


def part_pages(part: DataFrame) -> DataFrame:
    """``page``, item list and page info as JSON text; a page has 20 parts.

    Parts are keyed densely, so a page gathers at most PAGE_SIZE rows.
    """
    page = (F.floor(F.col("p_partkey") / PAGE_SIZE) + 1).cast("bigint")
    total = part.agg(F.max("p_partkey").alias("m")).scalar()
    pages = part.select(page.alias("page"), F.struct("p_partkey", part_item().alias("json")).alias("i")).groupBy("page")
    ordered = F.transform(F.array_sort(F.collect_list("i")), lambda i: i["json"])
    return pages.agg(
        F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")).alias("items"),
        F.max(total).alias("last_key"),
    )


def catalog_captures(part: DataFrame) -> DataFrame:
    """One good capture per page; the list sits in a different place by page."""
    page = F.col("page")
    pages = (F.floor(F.col("last_key") / PAGE_SIZE) + 1).cast("bigint")
    long_info = _text('{"totalCount":', F.col("last_key") + 1, ',"pageCount":"', pages, '","currentPage":', page, ',"perPage":20.9}')
    short_info = _text('{"total":"', F.col("last_key") + 1, '","pages":', pages, ',"page":null,"limit":"20"}')
    items = lambda name, info: _text('"', name, '":', F.col("items"), ',"', info[0], '":', info[1])
    long, short = ("pagesData", long_info), ("pagination", short_info)
    body = (
        F.when(page % 7 == 0, _text("{", items("items", long), "}"))
        .when(page % 7 == 1, _text('{"data":5,"totalData":{', items("data", short), "}}"))
        .when(page % 7 == 2, _text('{"pageProps":{"totalData":{', items("items", long), "}}}"))
        .when(page % 7 == 3, _text('{"pageProps":{"books":{', items("data", short), '}},"items":{}}'))
        .when(page % 7 == 4, _text('{"pageProps":{"data":{', items("items", short), "}}}"))
        .when(page % 7 == 5, _text('{"pageProps":{"catalog":{', items("data", long), "}}}"))
        .otherwise(_text('{"pageProps":{', items("items", short), "}}"))
    )
    return _capture(
        part_pages(part),
        capture_id=_text("catalog-", page),
        url=_text(BASE, "/v3/books?page=", page),
        kind=F.lit("catalog"),
        page=page,
        route=F.lit("/v3/books"),
        status=F.lit(200),
        fetched_at=_seconds(page),
        body=body,
    )


def catalog_source_captures(part: DataFrame) -> DataFrame:
    """Captures of each page under all three routes, some failed or empty.

    v3 answers well on pages 3k, emptily on 3k+1 and with an error on 3k+2; an
    older v3 error precedes each.  '/books' is gone on pages 5k.
    """
    page, tag, body = F.col("page"), F.col("tag"), F.col("body")
    tags = F.array(*[F.lit(t) for t in ("old", "v3", "books", "home")])
    tagged = catalog_captures(part).withColumn("tag", F.explode(tags))
    delay = F.when(tag == "old", 0).when(tag == "v3", 10).otherwise(20)
    failed = (
        F.when(tag == "old", 503)
        .when((tag == "v3") & (page % 3 == 2), 500)
        .when((tag == "books") & (page % 5 == 0), 404)
    )
    return tagged.withColumns(
        {
            "capture_id": _text(tag, "-", page),
            "route": F.when(tag.isin("old", "v3"), "/v3/books").when(tag == "books", "/books").otherwise("/"),
            "status": F.coalesce(failed, F.lit(200)),
            "fetched_at": _seconds(page + delay),
            "body": F.when(tag == "old", F.lit("")).when((tag == "v3") & (page % 3 == 1), F.lit('{"items":[]}')).otherwise(body),
        }
    ).drop("tag")


# ------------------------------------------------------------------- books


def listed_lines(lineitem: DataFrame) -> DataFrame:
    """Lines of each order as an array in the order of their price; an order has a handful."""
    line = F.struct(
        _line_position().alias("pos"), "l_partkey", "l_linenumber", "l_returnflag", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )
    return lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line)).alias("lines"))


def book_captures(orders: DataFrame, lineitem: DataFrame | None = None) -> DataFrame:
    """Book payload of each order; every tenth book object is empty.

    With ``lineitem`` a book's chapters are the lines of its order, else some
    made from its key.
    """
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    odd = key % 2 == 1
    only = lambda cond, value: F.when(cond, value)
    name = _text("Customer#", F.lpad(cust.cast("string"), 9, "0"))
    price = F.col("o_totalprice")
    chapter = lambda i: F.struct(
        (key * 10 + i).alias("id"),
        only(i % 2 == 1, _text("Chapter ", i)).alias("title"),
        only(i % 2 == 0, _text("chapter ", i, ".5")).alias("name"),
        only(i % 3 != 2, _text("ch-", i)).alias("slug"),
        only(i % 3 == 2, _text("/order-", key, "/глава-", i)).alias("url"),
        only(i % 2 == 1, i).alias("chapterShortNumber"),
        only(i % 2 == 0, _text("chapter ", i, ",5")).alias("numberChapter"),
        (i % 3).alias("volume"),
        _text(i == 2).alias("isDonate"),
        (i % 2).alias("isSubscription"),
        price.alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("published_at"),
    )
    listed = lambda line, i: F.struct(
        (key * 100 + i + 1).alias("id"),
        only(i % 2 == 0, _text("Chapter ", i + 1)).alias("title"),
        only(i % 2 == 1, _text("chapter ", i + 1, ".5")).alias("name"),
        only(i % 3 != 1, _text("line-", line["l_linenumber"], "-", line["l_partkey"])).alias("slug"),
        only(i % 3 == 1, _text("/order-", key, "/line-", line["l_linenumber"], "-", line["l_partkey"], "?a=1")).alias("url"),
        only(i % 2 == 0, i + 1).alias("chapterShortNumber"),
        only(i % 2 == 1, _text("chapter ", i + 1, ",5")).alias("numberChapter"),
        ((i + 1) % 3).alias("volume"),
        _text(line["l_returnflag"] == "R").alias("isDonate"),
        ((i + 1) % 2).alias("isSubscription"),
        line["l_extendedprice"].alias("price"),
        line["shipped"].alias("published_at"),
    )
    if lineitem is None:
        chapters = F.when(key % 5 > 0, F.transform(F.sequence(F.lit(1), (key % 5).cast("int")), chapter))
    else:
        orders = orders.join(listed_lines(lineitem), "o_orderkey", "left")
        chapters = F.transform("lines", listed)
    person = F.struct(cust.alias("id"), name.alias("name"))
    book = F.to_json(
        F.struct(
            key.alias("id"),
            _text(F.col("o_orderpriority"), " ", key).alias("title"),
            only(key % 4 != 3, _text("order-", key)).alias("slug"),
            only(key % 4 == 3, _text("https://novels.example/order-", key, "/")).alias("url"),
            only(odd, _text("Full ", key)).alias("fullTitle"),
            only(~odd, _text("Full ", key)).alias("full_title"),
            only(odd, name).alias("author"),
            only(~odd, name).alias("authorName"),
            only(
                key % 3 == 0,
                F.struct(
                    (cust % 25).alias("id"),
                    only(odd, _text("NATION_", cust % 25)).alias("title"),
                    only(~odd, _text("NATION_", cust % 25)).alias("name"),
                    _text("n", cust % 25).alias("code"),
                ),
            ).alias("country"),
            F.col("o_orderstatus").alias("status"),
            _text("<b>", F.col("o_orderpriority"), "</b>").alias("additionalInfo"),
            _text(" ", price, " ").alias("chapterCost"),
            F.col("o_totalprice").alias("views"),
            only(odd, person).alias("translator"),
            # the same person under a text id, one without an id, one unknown
            F.array(
                F.struct(_text(cust).alias("id"), name.alias("displayName"), F.lit(None).cast("string").alias("login")),
                F.struct(F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("displayName"), _text("u", cust % 10).alias("login")),
                F.struct(F.lit(" ").alias("id"), F.lit("").alias("displayName"), F.lit(None).cast("string").alias("login")),
            ).alias("translators"),
            F.struct(cust.alias("userId"), name.alias("fullName"), _text("/u/", cust).alias("profileUrl")).alias("creator"),
            F.array(F.struct((key % 100).alias("teamId"), _text("Clerk ", key % 100).alias("title"))).alias("teams"),
            chapters.alias("chapters"),
        )
    )
    book = F.when(key % 10 == 9, F.lit("{}")).otherwise(book)
    body = (
        F.when(key % 3 == 0, _text('{"pageProps":{"book":', book, "}}"))
        .when(key % 3 == 1, _text('{"pageProps":{"book":{},"data":', book, "}}"))
        .otherwise(_text('{"pageProps":{"book":[],"totalData":{"book":', book, "}}}"))
    )
    return _capture(
        orders,
        capture_id=_text("book-", key),
        url=_text(BASE, "/order-", key),
        kind=F.lit("book"),
        book_slug=_text("order-", key),
        status=F.lit(200),
        fetched_at=F.col("o_orderdate"),
        body=body,
    )


# ---------------------------------------------------------------- chapters


def _line_position() -> Column:
    return F.round(F.col("l_extendedprice") * 100).cast("bigint") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")


def line_chapters(lineitem: DataFrame) -> DataFrame:
    """Chapter list in which a book is an order and a chapter is a line.

    Lines of an order have no key of their own, so the source position is made
    of the columns that tell them apart.
    """
    return lineitem.select(
        F.col("l_orderkey").alias("book_slug"),
        _line_position().alias("pos"),
        F.floor(F.col("l_quantity") / 10).cast("double").alias("volume"),
        F.when(F.col("l_linenumber") < 6, F.col("l_linenumber").cast("double")).alias("number"),
        _text("part-", F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("title"),
        (F.col("l_returnflag") == "R").alias("is_donate"),
        (F.col("l_linestatus") == "O").alias("is_subscription"),
    )


def chapter_captures(lineitem: DataFrame) -> DataFrame:
    """Chapter payload of each line; returned lines are paid, without content."""
    line, part, supp, order = (F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_orderkey"))
    only = lambda cond, value: F.when(cond, value)
    book_slug, slug = _text("order-", order), _text("line-", line, "-", part)
    paid = F.col("l_returnflag") == "R"
    # a translator listed under the number, under the text, or by another id
    translator = F.when(
        supp % 4 == 0, _text(',"translator":{"id":', supp, ',"name":"S', supp, '"}')
    ).when(supp % 4 == 1, _text(',"translator":{"id":"', supp, '","name":"S', supp, '"}')).when(
        supp % 4 == 2, _text(',"translators":[{"id":', supp, "},5,{\"id\":", supp, "},{\"name\":\"T\"}]")
    ).otherwise(F.lit(',"translator":null'))
    editor = F.when(line % 2 == 0, _text(',"editor":{"id":"e', line, '","login":"ed"}')).otherwise(F.lit(',"editorId":"  "'))
    flags = F.when(line % 3 == 0, F.lit(',"isEdited":null,"isUserPaid":1')).when(line % 3 == 1, F.lit(',"isEdited":true')).otherwise(F.lit(',"isEdited":5'))
    near = F.concat(
        F.when(line < 7, _text(',"nextChapter":{"id":', line + 1, ',"title":"Next ', line + 1, '","slug":"line-', line + 1, '"}')).otherwise(F.lit(',"nextChapter":null')),
        F.when(line > 1, _text(',"previousChapter":{"chapterId":"p', line - 1, '","url":"/', book_slug, "/line-", line - 1, '?a=1"}')).otherwise(F.lit("")),
    )
    fields = F.to_json(
        F.struct(
            part.alias("id"),
            order.alias("bookId"),
            supp.alias("translatorId"),
            only(line % 2 == 1, _text("Part ", part)).alias("title"),
            only(line % 2 == 0, _text("Part ", part)).alias("name"),
            slug.alias("slug"),
            only(line % 5 != 0, _text("/", book_slug, "/", slug)).alias("url"),
            F.col("l_linestatus").alias("status"),
            only(line % 2 == 1, line).alias("chapterShortNumber"),
            _text("Глава ", line, ",5").alias("numberChapter"),
            F.floor(F.col("l_quantity") / 10).cast("int").alias("tom"),
            paid.alias("isDonate"),
            _text(F.col("l_linestatus") == "O").alias("isSubscription"),
            F.col("l_extendedprice").alias("price"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("publishedAt"),
            F.struct(
                only(~paid, _text("<p>Line <b>", line, "</b> of&nbsp;", order, "</p><img src=\"/i/", part, ".png\">")).alias("text"),
                F.col("l_quantity").alias("symbolsCount"),
            ).alias("content"),
        )
    )
    book = F.when(
        line > 2, _text(',"book":{"id":', order, ',"name":"Order ', order, '","titleEn":"En ', order, '","url":"/', book_slug, '/x"}')
    ).otherwise(F.lit(',"book":{}'))
    chapter = F.concat(F.substring(fields, F.lit(1), F.length(fields) - 1), translator, editor, flags, near, book, F.lit("}"))
    body = (
        F.when(line % 3 == 0, _text('{"pageProps":{"chapter":', chapter, "}}"))
        .when(line % 3 == 1, _text('{"pageProps":{"data":', chapter, "}}"))
        .otherwise(_text('{"pageProps":{"totalData":{"chapter":', chapter, "}}}"))
    )
    return _capture(
        lineitem,
        capture_id=_text("line-", order, "-", line, "-", part, "-", supp),
        url=_text(BASE, "/", book_slug, "/", slug),
        kind=F.lit("chapter"),
        book_slug=book_slug,
        chapter_slug=slug,
        status=F.lit(200),
        fetched_at=F.col("l_shipdate"),
        body=body,
    )


def download_captures(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Captures of books and of the chapters they list, some failed or missing.

    Orders 10k + 8 are gone, though an older capture has the book; lines of
    suppliers 7k were never fetched, those of 11k failed.
    """
    books = book_captures(orders, lineitem)
    gone = F.col("book_slug").endswith("8")
    newer = books.withColumns({"status": F.when(gone, 404).otherwise(200), "body": F.when(gone, F.lit("gone")).otherwise(F.col("body"))})
    older = books.where(gone).withColumns(
        {"capture_id": _text("old-", F.col("capture_id")), "fetched_at": F.timestamp_seconds(F.unix_seconds("fetched_at") - 3600)}
    )
    failed = F.element_at(F.split("capture_id", "-"), -1).cast("bigint") % 11 == 0
    chapters = chapter_captures(lineitem.where("l_suppkey % 7 <> 0")).withColumn("status", F.when(failed, 500).otherwise(200))
    return newer.unionByName(older).unionByName(chapters)


# ----------------------------------------------------------- conversations


def talk_chapters(conversations: DataFrame) -> DataFrame:
    """Chapter list in which a book is a conversation and a chapter a turn."""
    return conversations.select(
        _text("conv-", F.col("conv_id")).alias("book_slug"),
        F.col("turn").alias("pos"),
        _text("turn-", F.col("turn")).alias("slug"),
        F.lit(None).cast("double").alias("volume"),
        (F.lit(1000.0) - F.col("turn")).alias("number"),
        F.col("role").alias("title"),
    )


def talk_captures(conversations: DataFrame) -> DataFrame:
    """Chapter captures of each turn but the system's, with older failures.

    Every turn was first answered with an error.  Assistant turns of even
    length are paid; user turns 6 and 7 are gone; other turns have content.
    """
    conv, turn, role = F.col("conv_id"), F.col("turn"), F.col("role")
    paid = (role == "assistant") & (F.length("text") % 2 == 0)
    gone = (role == "user") & (turn >= 6)
    content = F.struct(F.when(~paid, _text("<p>", F.col("text"), "</p>")).alias("text"))
    chapter = F.to_json(
        F.struct(turn.alias("id"), role.alias("title"), paid.alias("isDonate"), F.lit(4).alias("price"), content.alias("content"))
    )
    newer = _capture(
        conversations.filter(role != "system"),
        capture_id=_text("talk-", conv, "-", turn, "-b"),
        url=_text(BASE, "/conv-", conv, "/turn-", turn),
        kind=F.lit("chapter"),
        book_slug=_text("conv-", conv),
        chapter_slug=_text("turn-", turn),
        status=F.when(gone, 404).otherwise(200),
        fetched_at=_seconds(conv * 100 + turn),
        body=F.when(gone, F.lit("missing")).otherwise(_text('{"pageProps":{"chapter":', chapter, "}}")),
    )
    older = newer.withColumns(
        {
            "capture_id": F.replace(F.col("capture_id"), F.lit("-b"), F.lit("-a")),
            "status": F.lit(500),
            "fetched_at": F.timestamp_seconds(F.unix_seconds("fetched_at") - 3600),
            "body": F.lit("oops"),
        }
    )
    return newer.unionByName(older)


# ------------------------------------------------------------------ events


def event_captures(events: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The event table as a fetch log, with the attempt number of each fetch."""
    kind, value = F.col("event_type"), F.col("value")
    ts = F.col("ts").cast("timestamp")
    status = F.when(kind == "error", 500).when(kind == "signup", 404).when(kind == "click", 429).otherwise(200)
    log_kind = (
        F.when(kind == "view", "chapter").when(kind == "click", "catalog").when(kind == "purchase", "book")
        .when(kind == "signup", "page_html").otherwise("build_id")
    )
    # a third of the waits is an HTTP date five seconds after the fetch
    date = F.concat(
        F.date_format(F.timestamp_seconds(F.unix_seconds(ts) + 5), "E, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")
    )
    wait = F.when(F.col("event_id") % 3 == 0, date).when(F.col("event_id") % 3 == 1, value.cast("string"))
    return _capture(
        events,
        keep=("event_id", *more),
        capture_id=F.lpad(F.col("event_id").cast("string"), 12, "0"),
        url=_text("/u/", F.col("user_id")),
        kind=log_kind,
        route=_text("/u/", F.col("user_id")),
        build_id=_text("build-", F.date_format(ts, "D")),
        status=status,
        retry_after=F.when(kind == "click", wait),
        fetched_at=ts,
        body=F.col("props"),
    )


def site_captures(events: DataFrame) -> DataFrame:
    """The fetch log of two sites; a site's build changes every ten days, and every fifth fetch still names the one before."""
    user, day = F.col("user_id"), F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / (10 * 86_400))
    build = day - F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    log = event_captures(events.withColumns({"_site": _text("site", user % 2), "_build": _text("b", build)}), more=("_site", "_build", "user_id"))
    return log.withColumns({"site": F.col("_site"), "build_id": F.col("_build"), "route": _text("/r/", F.col("user_id") % 97)}).drop("_site", "_build", "user_id")


def fetch_attempts(events: DataFrame) -> DataFrame:
    return event_captures(events).withColumn("attempt", (F.col("event_id") % 6).cast("int"))
