"""String expressions with the web's rules for white space and numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters a browser's trim() and \s treat as white space.
WHITE_SPACE = (
    "\t\n\x0b\f\r \u00A0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
)
# The same set, to stand inside a regex character class.
WS = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
# \b after a tag name, ASCII only: Java's own \b also counts letters like 'é'.
WORD_END = r"(?![A-Za-z0-9_])"

_MAX_DOUBLE = 1.7976931348623157e308
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_RADIX = (("^0[xX][0-9A-Fa-f]+\\z", 16), ("^0[oO][0-7]+\\z", 8), ("^0[bB][01]+\\z", 2))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def staged(df: DataFrame, out: str, value: Column, body: Callable, *options) -> DataFrame:
    """Add ``out``: ``body`` of a value, which is staged in a column first.

    The expression over the staging column is built once per application and
    used again: building a large one costs thousands of calls to the JVM.
    """
    app = df.sparkSession.sparkContext.applicationId
    built = _over_staging_column(app, body, options)
    return df.withColumn("_staged", value).withColumn(out, built).drop("_staged")


@lru_cache(maxsize=256)
def _over_staging_column(app: str, body: Callable, options: tuple) -> Column:
    return body(F.col("_staged"), *options)


def numbered(df: DataFrame, keep: Sequence[str | Column], items: Column, item: str, pos: str = "pos") -> DataFrame:
    """One row per array element with its position.

    The outer form with a filter on its result: for the inner form the planner
    adds a filter on the array itself below everything the array comes from,
    and so would parse or clean each body twice.
    """
    rows = df.select(*keep, F.posexplode_outer(items).alias(pos, item))
    return rows.filter(F.col(pos).isNotNull())


def trim(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def is_filled(value: Column) -> Column:
    """Whether a text has more than white space; most begin with a printable ASCII character, which is told first."""
    return ((value >= "!") & (value < "\x7f")) | (F.length(trim(value)) > 0)


def non_blank(value: Column) -> Column:
    """The text itself, untrimmed, or null if it is blank."""
    return F.when(is_filled(value), value)


def first_text(*values: Column) -> Column:
    return F.coalesce(*[non_blank(v) for v in values])


def search_form(value: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.btrim(F.regexp_replace(F.lower(value), f"[{WS}]+", " "), F.lit(" "))


def finite(value: Column) -> Column:
    return F.when(F.abs(value) <= F.lit(_MAX_DOUBLE), value)


def _from_digits(digits: Column, radix: int) -> Column:
    place = lambda d: F.conv(d, radix, 10).cast("double")
    return F.aggregate(F.split(digits, ""), F.lit(0.0), lambda acc, d: acc * F.lit(float(radix)) + place(d))


def parse_number(value: Column) -> Column:
    """Number written in a text, or null: decimal, 0x, 0o and 0b forms."""

    def parse(t: Column) -> Column:
        out = F.when(t.rlike(_DECIMAL), t.try_cast("double"))
        for pattern, radix in _RADIX:
            out = out.when(t.rlike(pattern), _from_digits(F.substring(t, 3, 2_000_000_000), radix))
        return out

    plain = value.rlike(r"^-?[0-9]{1,15}(?:\.[0-9]{1,15})?\z")
    return F.when(plain, value.try_cast("double")).when(value.isNotNull(), finite(let(trim(value), parse)))


def decode_component(value: Column) -> Column:
    """Percent-decoding in which '+' is a plain plus; null if malformed."""

    def checked(decoded: Column) -> Column:
        broken = F.contains(decoded, F.lit("\uFFFD")) & ~value.rlike(r"(?i)%EF%BF%BD|\uFFFD")
        return F.when(~broken, decoded)

    decoded = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(~F.contains(value, F.lit("%")), value).otherwise(let(decoded, checked))


def encode_component(value: Column) -> Column:
    """Percent-encoding of one path segment or query value."""
    out = F.url_encode(value)
    # What a form encoder writes differently.
    for form, plain in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(form), F.lit(plain))
    return out


def encode_path(path: Column) -> Column:
    """Percent-encoding of the segments of a path."""
    return F.replace(encode_component(path), F.lit("%2F"), F.lit("/"))


def labelled_number(label: Column) -> Column:
    """Number after the word 'глава' or 'chapter', comma or point decimal; infinite if it has too many digits."""
    found = F.regexp_extract(label, rf"(?iu)(?:глава|chapter)[{WS}]*([0-9]+(?:[.,][0-9]+)?)", 1)
    return F.replace(found, F.lit(","), F.lit(".")).try_cast("double")


def parse_chapter_number(label: Column) -> Column:
    """Number after the word 'глава' or 'chapter', comma or point decimal."""
    return finite(labelled_number(label))
