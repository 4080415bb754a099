"""The fetch log: outcomes, newest captures, freshness, builds, requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkloom.functions.payload import as_text, at, is_object, with_document, within
from inkloom.functions.text import WS, decode_component, encode_component, encode_path, let, non_blank, parse_number, trim
from inkloom.functions.urls import column_url, segments

# Retry rules and freshness limits.
RETRYABLE_STATUSES = (408, 425, 429)
RETRY_BASE_MS = 250
RETRY_MAX_MS = 8_000
MAX_RETRIES = 4
TTL_MS = {"build_id": 300_000, "catalog": 30_000, "book": 300_000, "chapter": 900_000, "page_html": 300_000}
CATALOG_EXPAND = "lastChapter,verticalImage,horizontalImage,squareImage,userRating"


def retry_after_ms(header: Column, now: Column) -> Column:
    """Wait asked for by a Retry-After header: seconds or an HTTP date."""
    blank = (header != "") & (trim(header) == "")
    seconds = F.when(blank, F.lit(0.0)).otherwise(parse_number(header))
    # after the day name comes the HTTP form, with a zone in digits or none; else an ISO date may stand there
    zone = F.regexp_extract(header, r"([+-]\d{4})$", 1)
    http = F.concat(F.substring(header, 6, 20), F.lit(" "), F.when(zone != "", zone).otherwise("+0000"))
    iso = F.when(header.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(header))
    date = F.coalesce(F.try_to_timestamp(http, F.lit("dd MMM yyyy HH:mm:ss Z")), iso)
    wait = (F.unix_millis(date) - F.unix_millis(now)).cast("double")
    asked = F.coalesce(seconds * 1000, wait)
    return F.when(asked < 0, F.lit(0.0)).otherwise(asked)


def classify_fetches(
    fetches: DataFrame,
    base_ms: int = RETRY_BASE_MS,
    max_ms: int = RETRY_MAX_MS,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Outcome of each fetch and, where a retry is due, the range of its delay.

    Needs ``status, retry_after, fetched_at, attempt``.  A fetch without a status
    failed on the way (timeout, lost connection) and is retried.  Without a
    Retry-After the delay doubles per attempt and is spread by up to 20% either way.
    """
    status, attempt = F.col("status"), F.col("attempt")
    code = F.when(status.between(200, 299), "OK").when(status == 404, "NOT_FOUND").otherwise("HTTP_ERROR")
    code = F.when(status.isNull(), "NETWORK_ERROR").otherwise(code)
    retryable = (status.isNull() | status.isin(*RETRYABLE_STATUSES) | (status >= 500)) & (attempt < max_retries)
    asked = F.when(F.col("code") == "HTTP_ERROR", retry_after_ms(F.col("retry_after"), F.col("fetched_at")))
    backoff = F.least(F.lit(float(max_ms)), F.lit(float(base_ms)) * F.pow(F.lit(2.0), attempt))
    asked_ms = F.col("retry_after_ms")
    capped = F.when(asked_ms > max_ms, F.lit(float(max_ms))).otherwise(asked_ms)
    bound = lambda share: F.when(
        F.col("retryable"), F.coalesce(capped, F.floor(backoff * share + 0.5).cast("double"))
    )
    return (
        fetches.withColumn("code", code)
        .withColumn("retryable", retryable)
        .withColumn("retry_after_ms", asked)
        .withColumn("delay_low_ms", bound(0.8))
        .withColumn("delay_high_ms", bound(1.2))
    )


def latest_captures(captures: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Newest capture of each key; ties go to the highest capture id.

    Only the first rank is kept, so Spark trims each key to one row per input
    partition before the shuffle: a hot key moves no more rows than a rare one.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc("fetched_at"), F.desc("capture_id"))
    return captures.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def stale_captures(captures: DataFrame, as_of: Column, ttl_ms: Mapping[str, int] = TTL_MS) -> DataFrame:
    """Keys whose newest capture has outlived its kind's limit.

    Expiry is inclusive.  Kinds without a limit are never kept, so always stale.
    """
    limits = F.create_map(*[F.lit(x) for pair in ttl_ms.items() for x in pair])
    newest = captures.groupBy("kind", "url").agg(F.max("fetched_at").alias("fetched_at"))
    limit = F.coalesce(F.try_element_at(limits, F.col("kind")), F.lit(0))
    expiry = F.timestamp_millis(F.unix_millis("fetched_at") + limit)
    return newest.withColumn("expires_at", expiry).filter(F.col("expires_at") <= as_of)


def current_build_captures(captures: DataFrame) -> DataFrame:
    """One capture per route: that of the newest build if there is one.

    A 404 under an old build gives way to the same route under the new build;
    where no build has the route, the 404 stays.
    """
    current = captures.agg(F.max_by("build_id", F.struct("fetched_at", "capture_id")).alias("b"))
    best = Window.partitionBy("route").orderBy(
        F.desc(F.col("is_current")), F.desc(F.col("status") == 200), F.desc("fetched_at"), F.desc("capture_id")
    )
    flagged = captures.withColumn("is_current", F.col("build_id").eqNullSafe(current.scalar()))
    return flagged.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


# ------------------------------------------------------------------- builds

DAY = 86_400


def build_history(captures: DataFrame, site: str = "site") -> DataFrame:
    """When each build of a site was current: ``site, build_id, since, until``, the newest without an end.

    A build begins with the first capture that names it.  The order is taken over
    the builds, one row each, and not over the captures.
    """
    seen = captures.filter(F.col("build_id").isNotNull())
    firsts = seen.groupBy(site, "build_id").agg(F.min(F.struct("fetched_at", "capture_id")).alias("first"))
    following = F.lead("first.fetched_at").over(Window.partitionBy(site).orderBy("first"))
    return firsts.withColumn("until", following).select(site, "build_id", F.col("first.fetched_at").alias("since"), "until")


def build_outcomes(captures: DataFrame, site: str = "site") -> DataFrame:
    """Add to each capture ``current_build``, that of its site at its time, and ``next_build``, the one after its own.

    ``retry_build`` is where a 404 is to be asked for again: the build that
    followed its own, if there was one.  History and captures are joined on the
    site and the day, so a site with most captures is spread over its days; of a
    day's builds the one whose span holds the moment is taken.
    """
    history = build_history(captures, site)
    day = lambda at: F.floor(F.unix_seconds(at) / DAY)
    newest = captures.agg(F.max("fetched_at").alias("m")).scalar()
    days = F.sequence(day("since"), day(F.coalesce("until", F.greatest("since", newest))))
    spans = history.select(F.col(site).alias("_site"), F.col("build_id").alias("current_build"), "since", "until", F.explode(days).alias("_day"))
    within = (F.col("fetched_at") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until")))
    at = captures.withColumn("_at_day", day("fetched_at"))
    dated = at.join(spans, (F.col(site) == F.col("_site")) & (F.col("_at_day") == F.col("_day")) & within, "left")
    dated = dated.drop("_site", "_day", "_at_day", "since", "until")
    follows = F.lead("build_id").over(Window.partitionBy(site).orderBy("since", "build_id"))
    after = history.withColumn("next_build", follows).select(site, "build_id", "next_build")
    told = dated.join(after, [site, "build_id"], "left")
    return told.withColumn("retry_build", F.when(F.col("status") == 404, F.col("next_build")))


def captures_by_build(captures: DataFrame, site: str = "site") -> DataFrame:
    """One capture for each site and route, with ``retry_build`` where it is still to be asked for again.

    The newest good capture under the latest build that has the route wins; a
    404 gives way to a capture of the route under the build that followed, and
    stays, with that build as ``retry_build``, where no such capture was landed.
    Only ranks are kept, so a hot route sends a row from each partition.
    """
    told = build_outcomes(captures, site)
    since = build_history(captures, site).select(site, "build_id", F.col("since").alias("_since"))
    best = Window.partitionBy(site, "route").orderBy(
        F.desc(F.col("status") != 404), F.desc_nulls_last("_since"), F.desc(F.col("status") == 200), F.desc("fetched_at"), F.desc("capture_id")
    )
    ranked = told.join(since, [site, "build_id"], "left").withColumn("_rank", F.row_number().over(best))
    return ranked.filter("_rank = 1").drop("_rank", "_since")


# ---------------------------------------------------------------- page data


def _script_text(raw: Column) -> Column:
    # Entities of embedded scripts; '&amp;' last.
    out = F.replace(raw, F.lit("&quot;"), F.lit('"'))
    out = F.regexp_replace(out, "&#39;|&apos;", "'")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def page_embedded_data(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``data`` (the JSON object a page embeds), ``build_id``, and ``error_code`` of pages without a build.

    The build falls back to the path of the page's build manifest script.
    """
    script = F.regexp_extract(
        html, r"""(?is)<script[^>]+id=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""", 1
    )
    manifest = F.regexp_extract(html, r"""(?i)/_next/static/([^/"']+)/_buildManifest\.js""", 1)
    taken = pages.withColumn("_script", _script_text(script)).withColumn("_manifest", manifest)
    parsed = with_document(taken, "_script", "_doc", when=F.col("_script") != "")
    whole = within(F.col("_doc"))
    build = F.coalesce(
        non_blank(as_text(at(F.col("data"), "buildId"))),
        F.when(F.col("_manifest") != "", decode_component(F.col("_manifest"))),
    )
    built = parsed.withColumn("data", F.when(is_object(whole), whole)).withColumn("build_id", build)
    code = F.when(F.col("build_id").isNull(), F.lit("BUILD_ID_NOT_FOUND"))
    return built.withColumn("error_code", code).drop("_script", "_manifest", "_doc")


# ----------------------------------------------------------------- requests


def normal_path(value: Column) -> Column:
    """Rooted path without a closing slash; blank is the root."""
    return F.concat(F.lit("/"), F.regexp_replace(trim(value), "^/+|(?<!/)/+\\z", ""))


# segments without an escape, none empty, no white space at the end: encoded as one text
_PLAIN_ROUTE = rf"^(?:/[^/%]++)++(?<![{WS}])\z"


def route_file(route: Column) -> Column:
    """Data file of a route: segments decoded, encoded again, '.json'."""
    encoded = F.transform(segments(normal_path(route)), lambda s: encode_component(decode_component(s)))
    general = let(
        encoded,
        lambda parts: F.when(F.exists(parts, lambda p: p.isNull()), F.lit(None).cast("string")).otherwise(
            F.concat(F.when(F.size(parts) == 0, F.lit("index")).otherwise(F.array_join(parts, "/")), F.lit(".json"))
        ),
    )
    plain = F.concat(F.substring(encode_path(route), 2, 2_000_000_000), F.lit(".json"))
    return F.when(route.rlike(_PLAIN_ROUTE), plain).otherwise(general)


def query_text(base: Column, additions: Column) -> Column:
    """Query string of two lists of ``struct(name, values)``.

    An addition with a value replaces every value of its name and goes last;
    one without leaves the base alone.  Null values are never written.
    """
    filled = F.filter(additions, lambda a: F.exists(a["values"], lambda v: v.isNotNull()))
    kept = F.filter(base, lambda b: ~F.exists(filled, lambda a: a["name"] == b["name"]))

    def written(entry: Column) -> Column:
        values = F.filter(entry["values"], lambda v: v.isNotNull())
        return F.transform(values, lambda v: F.concat(F.url_encode(entry["name"]), F.lit("="), F.url_encode(v)))

    return F.array_join(F.flatten(F.transform(F.concat(kept, filled), written)), "&")


def entry(name: str, *values: Column) -> Column:
    """One ``struct(name, values)`` of a query."""
    return F.struct(F.lit(name).alias("name"), F.array(*[v.cast("string") for v in values]).alias("values"))


def catalog_requests(
    pages: DataFrame,
    page_size: int = 100,
    order: str | None = None,
    params: Column | None = None,
    build_id: Column | None = None,
    route: str = "/books",
) -> DataFrame:
    """Catalog request of each page number in ``page``.

    Without ``build_id`` these go to the list service; with it to the data file
    of the site's own page at ``route``, with the same query.
    """
    if pages.columns == ["page"]:  # one row a page before its request is written
        pages = pages.distinct()
    none = F.array().cast("array<struct<name: string, values: array<string>>>")
    base = none if params is None else params
    own_expand = F.filter(base, lambda b: b["name"] == "expand")
    expand = F.when(F.size(own_expand) == 0, F.array(F.lit(CATALOG_EXPAND))).otherwise(
        F.coalesce(F.try_element_at(own_expand, F.lit(1))["values"], F.array().cast("array<string>"))
    )
    additions = F.array(
        entry("page", F.greatest(F.col("page"), F.lit(1))),
        entry("pageSize", F.lit(max(1, page_size))),
        entry("order", F.lit(order)),
        F.struct(F.lit("expand").alias("name"), expand.alias("values")),
    )
    query = query_text(base, additions)
    place = F.lit("/v3/books") if build_id is None else F.concat(_data_folder(build_id), route_file(F.lit(route)))
    return pages.select(
        F.lit("catalog" if build_id is None else "catalog_data").alias("kind"),
        F.lit(None).cast("string").alias("book_slug"),
        F.lit(None).cast("string").alias("chapter_slug"),
        F.concat(place, F.lit("?"), query).alias("request"),
    ).distinct()


def page_html_requests(chapters: DataFrame, base: str) -> DataFrame:
    """Request of the page of each chapter, asked for beside its data where the page itself is wanted."""
    request = F.replace(column_url(F.col("_path"), base), F.lit(base.rstrip("/")), F.lit(""))
    wanted = chapters.select("book_slug", "chapter_slug").distinct()
    wanted = wanted.withColumn("_path", F.concat_ws("/", F.lit(""), "book_slug", "chapter_slug"))
    return wanted.select(F.lit("page_html").alias("kind"), "book_slug", "chapter_slug", request.alias("request"))


def _data_folder(build_id: Column) -> Column:
    return F.concat(F.lit("/_next/data/"), encode_component(build_id), F.lit("/"))


def fetch_plan(books: DataFrame, chapters: DataFrame, build_id: Column) -> DataFrame:
    """Distinct data requests: one per book and one per chapter."""
    prefix = _data_folder(build_id)
    none = F.lit(None).cast("string")
    wanted = (
        books.select("book_slug", none.alias("chapter_slug"))
        .unionByName(chapters.select("book_slug", "chapter_slug"))
        .distinct()
    )
    wanted = wanted.withColumn("_route", F.concat_ws("/", F.lit(""), "book_slug", "chapter_slug"))
    return wanted.select(
        F.when(F.col("chapter_slug").isNull(), "book").otherwise("chapter").alias("kind"),
        "book_slug",
        "chapter_slug",
        F.concat(prefix, route_file(F.col("_route"))).alias("request"),
    )
