"""Absolute web addresses as column expressions.

Plain absolute links and plain rooted paths are recognized by one regex each;
everything else takes the general route: scheme, host, dot segments, escaping.
"""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkloom.functions.text import decode_component, encode_path, let, trim

# Characters escaped in each part of an address.
PATH_ESCAPES = r"[\x00-\x20\"#<>?`{}\x7F-\x{10FFFF}]"
QUERY_ESCAPES = r"[\x00-\x20\"#<>'\x7F-\x{10FFFF}]"
FRAGMENT_ESCAPES = r"[\x00-\x20\"<>`\x7F-\x{10FFFF}]"
BAD_HOST = r"[\x00-\x20#%/:<>?@\[\\\]^|\x7F]"

_PLAIN_TAIL = (
    r"/[A-Za-z0-9\-._~!$&'()*+,;=:@%|/]*(\?[A-Za-z0-9\-._~!$&()*+,;=:@%|/?]*)?(#[A-Za-z0-9\-._~!$&'()*+,;=:@%|/?]*)?\z"
)
_PATH = r"^[a-z]+://[^/?#]*([^?#]*)"
_NO_DOTS = r"(?![^?#]*/(?:\.|%2[eE]){1,2}(?:[/?#]|\z))"
_PLAIN_ABSOLUTE = r"^https?://(?:[a-z0-9][a-z0-9\-]*\.)*[a-z][a-z0-9\-]*(?=/)" + _NO_DOTS + _PLAIN_TAIL
_PLAIN_ROOTED = r"^(?![/\\]{2})" + _NO_DOTS + _PLAIN_TAIL
# rooted paths of names with letters of the scripts below U+1680, or blanks inside: they need escaping and no more
_NAMED_ROOTED = r"^(?!//)" + _NO_DOTS + r"(?=/)[A-Za-z0-9\-._!'()/ \u00A1-\u167F]*+(?<! )\z"


def _escape(text: Column, escapes: str) -> Column:
    one = lambda c: F.when(
        c.rlike(escapes), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", r"%$1")
    ).otherwise(c)
    return F.when(text.rlike(escapes), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def _walk(path: Column) -> Column:
    """Resolve '.' and '..' segments of a rooted path."""
    one_dot, two_dots = r"(?i)^(\.|%2e)\z", r"(?i)^(\.|%2e){2}\z"

    def step(done: Column, part: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return (
            F.when(part.rlike(two_dots), shorter)
            .when(part.rlike(one_dot), done)
            .otherwise(F.concat(done, F.array(part)))
        )

    def resolve(parts: Column) -> Column:
        start = F.array().cast("array<string>")
        ends_open = F.element_at(parts, -1).rlike(r"(?i)^(\.|%2e){1,2}\z")
        kept = F.aggregate(parts, start, step)
        kept = F.when(ends_open, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
        return F.concat(F.lit("/"), F.array_join(kept, "/"))

    walked = let(F.split(F.substring(path, 2, 2_000_000_000), "/"), resolve)
    return F.when(path.rlike(r"(?i)/(\.|%2e){1,2}(/|\z)"), walked).otherwise(path)


def _host(raw: Column) -> Column:
    """Lower-case ASCII host, or null if it cannot be one."""
    decoded = let(
        decode_component(raw),
        lambda h: F.when(h.rlike(r"[^\x00-\x7F]"), F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), h)).otherwise(h),
    )
    name = let(F.lower(decoded), lambda h: F.when((h != "") & ~h.rlike(BAD_HOST), h))
    return F.when(raw.rlike(r"^\[[0-9A-Fa-f:.]+\]\z"), F.lower(raw)).otherwise(name)


def _parts(value: Column, base: str) -> Column:
    """struct(origin, path, rest) of a link, or null if it is no web address."""
    b = urlsplit(base.rstrip("/") + "/")
    base_scheme = b.scheme.lower()
    base_dir = b.path
    rest_of = lambda s, n: F.substring(s, n, F.lit(2_000_000_000))

    def located(s: Column) -> Column:
        # s: cleaned link -> struct(scheme, authority or null, tail)
        scheme = F.lower(F.regexp_extract(s, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
        after = F.when(scheme == "", s).otherwise(rest_of(s, F.length(scheme) + 2))
        has_host = ((scheme != "") & (scheme != base_scheme)) | after.rlike(r"^[/\\]{2}")
        remote = F.regexp_replace(after, r"^[/\\]+", "")
        authority = F.regexp_extract(remote, r"^[^/\\?#]*", 0)
        rooted = F.when(after.rlike(r"^[/\\]"), after).otherwise(
            F.concat(F.lit(base_dir), after)
        )
        return F.when(
            scheme.isin("", "http", "https"),
            F.struct(
                F.when(scheme == "", F.lit(base_scheme)).otherwise(scheme).alias("scheme"),
                F.when(has_host, authority).alias("authority"),
                F.when(has_host, rest_of(remote, F.length(authority) + 1)).otherwise(rooted).alias("tail"),
            ),
        )

    def origin(loc: Column) -> Column:
        server = F.regexp_extract(loc["authority"], r"([^@]*)\z", 1)
        user = F.regexp_extract(loc["authority"], r"(?s)^(.*)@", 1)
        port = F.regexp_extract(server, r":([0-9]*)\z", 1)
        number = port.try_cast("int")
        usual = F.when(loc["scheme"] == "http", 80).otherwise(443)
        shown = F.when((port == "") | (number == usual), F.lit("")).when(
            number <= 65535, F.concat(F.lit(":"), number.cast("string"))
        )
        login = F.when(user.rlike("^:?\\z"), F.lit("")).otherwise(
            F.concat(_escape(F.replace(user, F.lit("@"), F.lit("%40")), PATH_ESCAPES), F.lit("@"))
        )
        host = _host(F.regexp_replace(server, r":[0-9]*\z", ""))
        own = F.concat(loc["scheme"], F.lit("://"), login, host, shown)
        return F.when(loc["authority"].isNull(), F.lit(f"{base_scheme}://{b.netloc.lower()}")).otherwise(own)

    def assembled(loc: Column) -> Column:
        tail = loc["tail"]
        path = F.replace(F.regexp_extract(tail, r"^[^?#]*", 0), F.lit("\\"), F.lit("/"))
        path = F.when(path == "", F.lit("/")).otherwise(path)
        query = F.regexp_extract(tail, r"(?s)^[^?#]*(\?[^#]*)", 1)
        fragment = F.regexp_extract(tail, r"(?s)^[^#]*(#.*)\z", 1)
        marked = lambda part, esc: F.when(part == "", F.lit("")).otherwise(
            F.concat(F.substring(part, 1, 1), _escape(rest_of(part, F.lit(2)), esc))
        )
        return F.struct(
            origin(loc).alias("origin"),
            _walk(_escape(path, PATH_ESCAPES)).alias("path"),
            F.concat(marked(query, QUERY_ESCAPES), marked(fragment, FRAGMENT_ESCAPES)).alias("rest"),
        )

    cleaned = F.regexp_replace(F.regexp_replace(trim(value), r"^[\x00-\x20]+|(?<![\x00-\x20])[\x00-\x20]+\z", ""), r"[\t\n\r]", "")
    return let(F.when(cleaned != "", cleaned), lambda s: let(located(s), lambda loc: F.when(loc.isNotNull(), assembled(loc))))


def absolute_url(value: Column, base: str) -> Column:
    """Absolute http(s) address of a link, or null."""
    return let(value, lambda link: column_url(link, base))


def column_url(link: Column, base: str) -> Column:
    """As :func:`absolute_url`, for a link that is in a column: plain forms need no function over arrays."""
    b = urlsplit(base.rstrip("/") + "/")
    root = f"{b.scheme.lower()}://{b.netloc.lower()}"

    general = let(_parts(link, base), lambda p: F.concat(p["origin"], p["path"], p["rest"]))
    return (
        F.when(link.rlike(_PLAIN_ROOTED), F.concat(F.lit(root), link))
        .when(link.rlike(_PLAIN_ABSOLUTE), link)
        .when(link.rlike(_NAMED_ROOTED), F.concat(F.lit(root), encode_path(link)))
        .when(link.isNotNull(), general)
    )


def url_path(value: Column, base: str) -> Column:
    """Path of the absolute address, or null."""
    return let(absolute_url(value, base), lambda url: F.when(url.isNotNull(), F.regexp_extract(url, _PATH, 1)))


def segments(path: Column) -> Column:
    """Non-empty segments of a path, still encoded."""
    return F.filter(F.split(path, "/"), lambda s: s != "")


def decoded_segments(path: Column) -> Column:
    """Decoded segments, or null if any of them is malformed."""
    return let(
        F.transform(segments(path), decode_component),
        lambda parts: F.when(~F.exists(parts, lambda p: p.isNull()), parts),
    )


# any base serves: only the path is read
_PATH_BASE = "https://path.invalid"


# names between slashes, in which nothing is to be resolved or decoded
_PLAIN_NAMES = r"^(?:/[A-Za-z0-9\-_]+)++\z"


def path_segments(url: Column) -> Column:
    """Decoded path segments of any link."""
    plain = F.split(F.substring(url, 2, 2_000_000_000), "/")
    general = decoded_segments(url_path(url, _PATH_BASE))
    return F.when(url.rlike(_PLAIN_NAMES), plain).when(url.isNotNull(), general)


def file_name(url: Column) -> Column:
    """Decoded last path segment of an absolute address; null without one."""
    last = F.try_element_at(segments(F.regexp_extract(url, _PATH, 1)), F.lit(-1))
    return let(last, decode_component)
