"""HTML cleaning, text and images as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkloom.functions.text import WORD_END, WS, let, non_blank, trim
from inkloom.functions.urls import absolute_url, file_name

# What the cleaner keeps, renames, breaks lines at and removes.
ALLOWED_TAGS = (
    "p br hr strong b em i u s del a img ul ol li blockquote pre code h1 h2 h3 h4 h5 h6 "
    "table thead tbody tfoot tr th td sup sub span div"
).split()
VOID_TAGS = "br hr img".split()
BLOCK_TAGS = "p br hr li blockquote pre h1 h2 h3 h4 h5 h6 tr table ul ol div".split()
UNSAFE_TAGS = "script style iframe object embed noscript form svg canvas video audio".split()
RENAMED_TAGS = {"b": "strong", "i": "em", "del": "s"}
IMAGE_SOURCES = "src data-src data-lazy-src data-original data-url data-lazy".split()
STYLE_PROPERTIES = "text-align font-weight font-style text-decoration vertical-align white-space".split()
ALIGNMENTS = "left right center justify".split()
NAMED_ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "ndash": "–", "mdash": "—", "hellip": "…", "laquo": "«", "raquo": "»",
}

_ATTRIBUTE = rf"([^{WS}=/>]+)(?:[{WS}]*=[{WS}]*(?:\"([^\"]*)\"|'([^']*)'|([^{WS}\"'=<>`]+)))?"
_TAG = rf"(?s)^<[{WS}]*(/?)[{WS}]*([a-zA-Z0-9]+)(.*?)/?[{WS}]*>\z"


def _is_one_of(value: Column, names) -> Column:
    return value.isin(*names)


# ---------------------------------------------------------------- entities


def _code_point(digits: Column, radix: int) -> Column:
    """Character of a numeric entity; null above the last code point."""
    short = F.regexp_extract(digits, "^0*(.{1,7})\\z", 1)
    number = F.conv(F.when(short != "", short), radix, 10).cast("bigint")

    def char(n: Column) -> Column:
        text = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(n.between(0xD800, 0xDFFF), F.lit("\uFFFD")).when(n <= 0x10FFFF, text)

    return let(number, char)


def _decode_token(token: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in NAMED_ENTITIES.items() for x in pair])

    def decode(name: Column) -> Column:
        numeric = F.when(
            name.startswith("#x"), _code_point(F.regexp_extract(name, "^#x([0-9a-f]+);", 1), 16)
        ).otherwise(_code_point(F.regexp_extract(name, "^#([0-9]+);", 1), 10))
        char = F.when(name.startswith("#"), numeric).otherwise(F.try_element_at(names, F.rtrim(name, F.lit(";"))))
        return F.coalesce(char, token)

    return F.when(~token.rlike(r"^&.+;\z"), token).otherwise(
        let(F.lower(F.substring(token, 2, 2_000_000_000)), decode)
    )


def decode_entities(value: Column) -> Column:
    """Replace each known entity once; unknown ones stay as they are."""
    pattern = F.lit(r"(?i)&(?:#x[0-9a-f]+|#[0-9]+|[a-z][a-z0-9]+);|[^&]+|&")

    def decode(text: Column) -> Column:
        tokens = F.regexp_extract_all(text, pattern, F.lit(0))
        return F.when(~F.contains(text, F.lit("&")), text).otherwise(
            F.array_join(F.transform(tokens, _decode_token), "")
        )

    return let(value, decode)


# -------------------------------------------------------------------- text


def html_text(html: Column) -> Column:
    """Plain text: block tags break lines, other tags vanish, entities decoded."""
    any_block = rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)}){WORD_END}[^>]*>"
    # a '<' inside a tag makes the result depend on the order of tag names
    lines = lambda h: F.when(~h.rlike("<[^<>]*<"), F.regexp_replace(h, any_block, "\n")).otherwise(
        reduce(lambda text, tag: F.regexp_replace(text, rf"(?i)</?{tag}{WORD_END}[^>]*>", "\n"), BLOCK_TAGS, h)
    )
    broken = _split_after_last(html, ">", lambda head, tail: F.concat(let(head, lines), tail))
    text = decode_entities(_remove_up_to(broken, "<[^>]+>", ">", "<"))
    text = F.replace(text, F.lit("\r"), F.lit(""))
    text = F.regexp_replace(text, r"(?<![\t ])[\t ]++\n", "\n")
    text = F.regexp_replace(text, r"\n[\t ]+", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, r"[\t ]{2,}", " ")
    return trim(text)


# ---------------------------------------------------------------- cleaning


def _split_after_last(value: Column, mark: str, use) -> Column:
    """``use(head, tail)`` of a text cut behind the last ``mark``; without one all of it is tail.

    A pattern that ends in ``mark`` finds nothing that begins in the tail, so it
    need not look there: each of its beginnings would search to the end in vain.
    """

    def cut(text: Column) -> Column:
        # searched from the end; without a mark it is the whole text
        behind = F.substring_index(text, mark, -1)
        return let(behind, lambda tail: let(F.left(text, F.length(text) - F.length(tail)), lambda head: use(head, tail)))

    return let(value, cut)


def _remove_up_to(value: Column, pattern: str, mark: str, sign: str) -> Column:
    """Without what the pattern finds, which begins with ``sign``."""
    removed = lambda text: _split_after_last(text, mark, lambda head, tail: F.concat(F.regexp_replace(head, pattern, ""), tail))
    return let(value, lambda text: F.when(F.contains(text, F.lit(sign)), removed(text)).otherwise(text))


def _spare_unclosed(text: Column, marker: Column) -> Column:
    """Put ``marker`` into the opening tags of dangerous elements that no closing tag follows."""

    def spare(done: Column, name: Column) -> Column:
        closing = F.concat(F.lit("(?is)^(.*</"), name, F.lit(f"[{WS}]*>)"))
        opening = F.concat(F.lit("(?i)<(?="), name, F.lit(f"{WORD_END})"))

        def mark(closed: Column) -> Column:
            rest = F.substr(done, F.length(closed) + 1)
            return F.concat(closed, F.regexp_replace(rest, opening, F.concat(F.lit("<"), marker)))

        return let(F.call_function("regexp_extract", done, closing, F.lit(1)), mark)

    present = let(
        F.lower(text), lambda low: F.filter(F.array(*[F.lit(t) for t in UNSAFE_TAGS]), lambda t: F.contains(low, F.concat(F.lit("<"), t)))
    )
    return F.aggregate(present, text, spare)


def drop_unsafe_html(html: Column) -> Column:
    """Remove dangerous elements with their content, comments and doctypes.

    The time is linear in the text: opening tags that are never closed are told
    first, and patterns are not tried behind the last place where they can end.
    """
    blocks = rf"(?is)<({'|'.join(UNSAFE_TAGS)}){WORD_END}[^>]*>.*?</\1[{WS}]*>"
    anything = rf"(?i)<(?:{'|'.join(UNSAFE_TAGS)}){WORD_END}"
    # a sign that the text does not hold
    signs = F.array(*[F.lit(chr(c)) for c in range(0xE000, 0xE008)])

    def without_blocks(head: Column, tail: Column) -> Column:
        def cleaned(marker: Column) -> Column:
            closed = F.regexp_replace(_spare_unclosed(head, marker), blocks, "")
            return F.concat(F.replace(closed, F.concat(F.lit("<"), marker), F.lit("<")), tail)

        free = F.get(F.filter(signs, lambda c: ~F.contains(head, c)), F.lit(0))
        return let(free, cleaned)

    out = let(html, lambda text: F.when(text.rlike(anything), _split_after_last(text, ">", without_blocks)).otherwise(text))
    out = _remove_up_to(out, r"(?s)<!--.*?-->", "-->", "<!--")
    return _remove_up_to(out, r"(?is)<!DOCTYPE.*?>", ">", "<!")


def _attributes(raw: Column) -> Column:
    """Attribute names and decoded values, last one first."""
    group = lambda n: F.regexp_extract_all(raw, F.lit(_ATTRIBUTE), F.lit(n))
    both = lambda x, y: F.concat(x, y)
    values = F.zip_with(F.zip_with(group(2), group(3), both), group(4), both)
    return F.struct(
        F.reverse(F.transform(group(1), lambda n: F.lower(n))).alias("names"),
        F.reverse(F.transform(values, decode_entities)).alias("values"),
    )


def _attribute(attributes: Column, name: str) -> Column:
    """Value of the last attribute of that name; null without one."""
    place = F.array_position(attributes["names"], F.lit(name)).cast("int") - 1
    return F.get(attributes["values"], place)


def _image_source(attributes: Column) -> Column:
    return F.coalesce(*[let(_attribute(attributes, n), non_blank) for n in IMAGE_SOURCES])


def _quoted(name: str, value: Column) -> Column:
    out = value
    for char, entity in (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return F.concat(F.lit(f'{name}="'), out, F.lit('"'))


def _filled(value: Column) -> Column:
    return let(value, lambda v: F.when(v != "", v))


def _style(raw: Column, align: Column) -> Column:
    """Allowed style declarations, then the old align attribute."""
    pairs = F.transform(
        F.filter(F.split(raw, ";"), lambda d: F.contains(d, F.lit(":"))),
        lambda d: F.struct(
            F.lower(trim(F.substring_index(d, ":", 1))).alias("property"),
            trim(F.regexp_extract(d, "(?s)^[^:]*:(.*)\\z", 1)).alias("value"),
        ),
    )
    kept = F.filter(
        pairs,
        lambda d: _is_one_of(d["property"], STYLE_PROPERTIES) & d["value"].rlike(rf"^[A-Za-z0-9_{WS}.,%#()\-]+\z"),
    )
    own = F.array_join(F.transform(kept, lambda d: F.concat_ws(":", d["property"], d["value"])), ";")
    old = let(F.lower(align), lambda a: F.when(_is_one_of(a, ALIGNMENTS), F.concat(F.lit("text-align:"), a)))
    return _filled(F.concat_ws(";", _filled(own), old))


def _opening(name: Column, raw: Column, base: str) -> Column:
    """Opening tag with its safe attributes; empty for an image without source."""

    def attributes_text(attrs: Column) -> Column:
        value = lambda n: _attribute(attrs, n)
        matching = lambda n, pattern: let(
            value(n), lambda v: F.when(v.rlike(pattern), F.concat(F.lit(f'{n}="'), v, F.lit('"')))
        )
        title = _quoted("title", _filled(value("title")))
        # one address per tag: the link of an anchor, the source of an image
        target = F.when(name == "a", _filled(value("href"))).when(name == "img", _image_source(attrs))
        address = F.when((name == "a") & target.rlike("(?i)^(mailto:|tel:)"), target).otherwise(absolute_url(target, base))
        with_address = let(
            address,
            lambda url: F.when(
                name == "a",
                F.concat_ws(
                    " ",
                    _quoted("href", url),
                    title,
                    F.when(url.startswith("http"), F.lit('rel="noopener noreferrer nofollow"')),
                ),
            ).when(
                url.isNotNull(),
                F.concat_ws(
                    " ",
                    _quoted("src", url),
                    _quoted("alt", F.coalesce(value("alt"), F.lit(""))),
                    title,
                    matching("width", r"^[0-9]{1,5}\z"),
                    matching("height", r"^[0-9]{1,5}\z"),
                    F.lit('loading="lazy" decoding="async"'),
                ),
            ),
        )
        cell = F.concat_ws(" ", matching("colspan", r"^[0-9]{1,3}\z"), matching("rowspan", r"^[0-9]{1,3}\z"))
        special = (
            F.when(_is_one_of(name, ["a", "img"]), with_address)
            .when(name == "ol", matching("start", r"^-?[0-9]{1,8}\z"))
            .when(_is_one_of(name, ["th", "td"]), cell)
        )
        style = _style(F.coalesce(value("style"), F.lit("")), value("align"))
        return let(
            special,
            lambda own: F.when((name == "img") & own.isNull(), F.lit("")).otherwise(
                F.concat(
                    F.lit("<"),
                    _renamed(name),
                    F.regexp_replace(F.concat_ws(" ", F.lit(""), _filled(own), _quoted("style", style)), "^ \\z", ""),
                    F.lit(">"),
                )
            ),
        )

    plain = F.concat(F.lit("<"), _renamed(name), F.lit(">"))
    matters = (_is_one_of(name, ["a", "img", "ol", "th", "td"]) | raw.rlike("(?i)style|align")) & (
        (name == "img") | (trim(raw) != "")
    )
    return F.when(~matters, plain).otherwise(let(_attributes(raw), attributes_text))


def _renamed(name: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in RENAMED_TAGS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, name), name)


def _clean_tag(token: Column, base: str) -> Column:
    def rebuilt(name: Column) -> Column:
        closing = token.rlike(rf"^<[{WS}]*/")
        ended = F.when(_is_one_of(name, VOID_TAGS), F.lit("")).otherwise(
            F.concat(F.lit("</"), _renamed(name), F.lit(">"))
        )
        opened = let(F.regexp_extract(token, _TAG, 3), lambda raw: _opening(name, raw, base))
        return F.when(~_is_one_of(name, ALLOWED_TAGS), F.lit("")).when(closing, ended).otherwise(opened)

    return let(F.lower(F.regexp_extract(token, rf"^<[{WS}]*/?[{WS}]*([a-zA-Z0-9]+)", 1)), rebuilt)


def clean_html(html: Column, base: str) -> Column:
    """Safe HTML: allowed tags only, attributes rebuilt, unsafe blocks gone."""
    both = lambda head, tail: F.concat(
        F.regexp_extract_all(head, F.lit("<[^>]*>|[^<]+"), F.lit(0)), F.regexp_extract_all(tail, F.lit("[^<]+"), F.lit(0))
    )
    tokens = _split_after_last(drop_unsafe_html(html), ">", both)
    cleaned = F.transform(tokens, lambda t: F.when(~t.startswith("<"), t).otherwise(_clean_tag(t, base)))
    return trim(F.array_join(cleaned, ""))


# ------------------------------------------------------------------ images


def first_per_key(items: Column, key: str, position: str = "pos") -> Column:
    """Items of an array in order, only the first of each key.

    Two sorts inside the row instead of a shuffle: the array comes from one
    captured body, and n log n steps suffice.
    """
    names = lambda x, first, second: F.struct(x[first].alias("a"), x[second].alias("b"), x.alias("item"))

    def firsts_of(several: Column) -> Column:
        by_key = F.array_sort(F.transform(several, lambda x: names(x, key, position)))
        firsts = let(
            by_key,
            lambda s: F.filter(s, lambda x, i: ~F.get(s, i - 1)["a"].eqNullSafe(x["a"])),
        )
        in_order = F.array_sort(F.transform(firsts, lambda x: names(x["item"], position, key)))
        return F.transform(in_order, lambda x: x["item"])

    return let(items, lambda own: F.when(F.size(own) <= 1, own).otherwise(firsts_of(own)))


def html_images(html: Column, base: str) -> Column:
    """Images of raw HTML in document order, first per address."""
    tags = _split_after_last(html, ">", lambda head, _: F.regexp_extract_all(head, F.lit(rf"(?i)<img{WORD_END}[^>]*>"), F.lit(0)))

    def image(tag: Column, position: Column) -> Column:
        return let(
            _attributes(F.regexp_extract(tag, r"(?is)^<img(.*)>\z", 1)),
            lambda attrs: let(
                absolute_url(_image_source(attrs), base),
                lambda url: F.struct(
                    position.alias("pos"),
                    url.alias("url"),
                    file_name(url).alias("name"),
                    _attribute(attrs, "alt").alias("alt"),
                    tag.alias("raw"),
                ),
            ),
        )

    found = F.filter(F.transform(tags, image), lambda x: x["url"].isNotNull())
    return first_per_key(found, "url")
