"""Reading loosely typed JSON: expressions over VARIANT values.

A value counts only if it has the JSON type asked for.  A bare cast would turn
the number 5 into the string '5' and ``true`` into 1.0.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.text import finite, is_filled, let, non_blank, parse_number


# A body of the largest size may hold one string, one number or brackets in brackets; NaN is no JSON.
JSON_LIMITS = {"maxStringLen": str(1 << 28), "maxNestingDepth": "100000", "maxNumLen": str(1 << 28), "allowNonNumericNumbers": "false"}


def with_document(df: DataFrame, body: str = "body", out: str = "doc", when: Column | None = None) -> DataFrame:
    """Add the parsed body, or null if it is not exactly one JSON value.

    The JSON reader stops after the first value and ignores what follows, so
    the body is parsed as the first element of an array closed by its own hash:
    with trailing text the array is malformed or the hash is elsewhere.  The
    result stays in that array, which saves copying it out; read it with
    :func:`within`.  ``when`` limits parsing to rows worth it.
    """
    bom = "\ufeff"
    text = F.when(F.col(body).startswith(bom), F.ltrim(F.col(body), F.lit(bom))).otherwise(F.col(body))
    text = text if when is None else F.when(when, text)
    # kept in a column, so that the body need not be carried beyond its parsing
    seal = F.col("_seal")
    # by default the reader refuses strings of 20 million characters and 1000 nested brackets
    sealed = F.from_json(F.concat(F.lit("["), text, F.lit(","), seal.cast("string"), F.lit("]")), "variant", JSON_LIMITS)
    checked = F.when(F.try_variant_get(F.col("_sealed"), "$[1]", "bigint") == seal, F.col("_sealed"))
    return df.withColumn("_seal", F.xxhash64(F.col(body))).withColumn("_sealed", sealed).withColumn(out, checked).drop("_seal", "_sealed")


def within(doc: Column, path: str = "", kind: str = "variant") -> Column:
    """Value at a dotted path of a parsed body; null if any step is missing."""
    return F.try_variant_get(doc, f"$[0].{path}" if path else "$[0]", kind)


def at(doc: Column, path: str) -> Column:
    """Value at a dotted path; null if any step is missing."""
    return F.try_variant_get(doc, f"$.{path}", "variant")


# Casts that say whether a value is an object, or how many keys it has, without copying what it holds.
_OBJECT = "struct<_: boolean>"
_KEYS = "map<string, struct<_: boolean>>"


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", _OBJECT).isNotNull()


def filled_object(value: Column) -> Column:
    """The value if it is an object with at least one key."""
    return F.when(F.size(F.try_variant_get(value, "$", _KEYS)) > 0, value)


def _tree(paths: Sequence[str]) -> dict:
    """Names of dotted paths as nested dictionaries, with None where a path ends."""
    tree: dict = {}
    for path in paths:
        *steps, last = path.split(".")
        node = tree
        for step in steps:
            node = node.setdefault(step, {})
        node[last] = None
    return tree


def _kind(tree: dict, leaves: Mapping[str, str], above: str = "") -> str:
    leaf = lambda path, sub: leaves.get(path, "variant") if sub is None else _kind(sub, leaves, f"{path}.")
    return "struct<" + ", ".join(f"`{name}`: {leaf(above + name, sub)}" for name, sub in tree.items()) + ">"


def _layers(paths: Sequence[str]) -> list[list[str]]:
    """The paths in groups in which none begins with another."""
    layers: list[list[str]] = []
    for path in dict.fromkeys(paths):
        clash = lambda other: f"{path}.".startswith(f"{other}.") or f"{other}.".startswith(f"{path}.")  # noqa: B023, E731
        layer = next((found for found in layers if not any(map(clash, found))), None)
        if layer is None:
            layers.append(layer := [])
        layer.append(path)
    return layers


def _read(doc: Column, layer: Sequence[str], root: str = "$", leaves: Mapping[str, str] = {}) -> Column:
    """Struct of the values at many paths below ``root``, in one pass over the object.

    ``leaves`` names the types of values that are not read as VARIANT, which
    would copy each with names of its own.
    """
    return F.try_variant_get(doc, root, _kind(_tree(layer), leaves))


def _value(read: Column, path: str) -> Column:
    for step in path.split("."):
        read = read.getField(step)
    return read


def _values(
    doc: Column, paths: Sequence[str], use: Callable[[list[Column]], Column], leaf: str = "variant"
) -> Column:
    """``use`` of the values at dotted paths; null where any step is missing."""
    found: dict[str, Column] = {}

    def through(layers: list[list[str]]) -> Column:
        if not layers:
            return use([found[p] for p in paths])

        def with_layer(read: Column) -> Column:
            found.update({p: _value(read, p) for p in layers[0]})
            return through(layers[1:])

        return let(_read(doc, layers[0], leaves=dict.fromkeys(layers[0], leaf)), with_layer)

    return through(_layers(paths))


def first_place(doc: Column, paths: Sequence[str]) -> Column:
    """Number of the first of the paths of a parsed body that holds a non-empty object."""
    place = F.lit(None).cast("int")
    for i, path in reversed(list(enumerate(paths))):
        # most have an id; only for others are the keys gathered
        filled = within(doc, f"{path}.id").isNotNull() | (F.size(within(doc, path, _KEYS)) > 0)
        place = F.when(filled, F.lit(i)).otherwise(place)
    return place


def at_place(place: Column, doc: Column, paths: Sequence[str]) -> Callable[[str], Column]:
    """How to read what stands at the path numbered ``place`` as a type, without copying it out of the body first."""

    def read(kind: str = "variant") -> Column:
        found = F.when(place == 0, within(doc, paths[0], kind))
        for i, path in enumerate(paths[1:], 1):
            found = found.when(place == i, within(doc, path, kind))
        return found

    return read


def with_first_object(df: DataFrame, doc: Column, paths: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: the first non-empty object among the paths of a parsed body."""
    placed = df.withColumn("_place", first_place(doc, paths))
    return placed.withColumn(out, at_place(F.col("_place"), doc, paths)()).drop("_place")


def as_list(value: Column) -> Column:
    """Array elements, or null if the value is not an array."""
    return F.try_variant_get(value, "$", "array<variant>")


def as_text(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def as_number(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return F.when(_is_number(kind), finite(F.try_variant_get(value, "$", "double"))).when(
        kind == "STRING", parse_number(F.try_variant_get(value, "$", "string"))
    )


def as_integer(value: Column) -> Column:
    """Number without its fraction, toward zero."""
    return as_number(value).try_cast("bigint")


def as_flag(value: Column) -> Column:
    """True or false where the value says so, else false."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(_is_number(kind), F.try_variant_get(value, "$", "double") == 1.0)
        .when(kind == "STRING", F.try_variant_get(value, "$", "string").isin("1", "true"))
        .otherwise(F.lit(False))
    )


def flag_or_missing(value: Column) -> Column:
    """Null only where the key is missing; JSON null is false."""
    return F.when(value.isNotNull(), as_flag(value))


def _number_text(value: Column) -> Column:
    number = F.try_variant_get(value, "$", "double")
    whole = (F.abs(number) < F.lit(9.2e18)) & (number == F.floor(number))
    return F.when(whole, number.try_cast("bigint").cast("string")).otherwise(number.cast("string"))


def as_id(value: Column) -> Column:
    """struct(value, is_num) of a finite number or a non-blank string."""
    pair = lambda v, n: F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(n).alias("is_num")))
    text, kind = F.try_variant_get(value, "$", "string"), F.schema_of_variant(value)
    finite_number = F.abs(F.try_variant_get(value, "$", "double")) < float("inf")
    return (
        F.when(kind == "BIGINT", pair(text, True))
        .when((kind == "STRING") & is_filled(text), pair(text, False))
        .when(_is_number(kind) & finite_number, pair(_number_text(value), True))
    )


def _first_usable(read: Callable[[Column], Column]) -> Callable[[Sequence[Column]], Column]:
    """First of several values that reads as wanted."""
    return lambda values: F.coalesce(*map(read, values))


def first_present(values: Sequence[Column]) -> Column:
    """First of several values that is there and not JSON null."""
    return F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in values])


# How the fields of an object are read, by kind of field: the type of each value, and the field from the values.
# Only a string is cast to binary, so what is not null there was one.  As text, a number reads as it did as a number,
# and no other value as one; what is null was missing or a JSON null.
READERS: dict[str, tuple[str, Callable[[Sequence[Column]], Column]]] = {
    "texts": ("binary", _first_usable(lambda v: non_blank(v.cast("string")))),
    "raw_texts": ("binary", _first_usable(lambda v: v.cast("string"))),
    "ids": ("variant", _first_usable(as_id)),
    "numbers": ("string", lambda values: parse_number(F.coalesce(*values))),
    "integers": ("string", lambda values: parse_number(F.coalesce(*values)).try_cast("bigint")),
    "flags": ("variant", lambda values: as_flag(values[0])),
    "maybe_flags": ("variant", lambda values: flag_or_missing(values[0])),
    "variants": ("variant", first_present),
    "filled": (_KEYS, lambda values: F.size(F.coalesce(*values)) > 0),
}


def places(doc: Column, paths: str) -> Column:
    """Array of the values at blank-separated paths; null for those without one."""
    return _values(doc, paths.split(), lambda values: F.array(*values))


def _leaves(kinds: Mapping[str, Mapping[str, str]]) -> dict[str, str]:
    """The type that each path of some kinds of fields is read as."""
    leaves: dict[str, str] = {}
    for kind, names in kinds.items():
        for path in (p for paths in names.values() for p in paths.split()):
            # a path of several types is read as VARIANT
            leaves[path] = READERS[kind][0] if leaves.get(path, READERS[kind][0]) == READERS[kind][0] else "variant"
    return leaves


def _fields(kinds: Mapping[str, Mapping[str, str]], leaves: Mapping[str, str], at_path: Mapping[str, Column]) -> dict[str, Column]:
    fields = {}
    for kind, names in kinds.items():
        leaf, read = READERS[kind]
        value = lambda p: at_path[p] if leaves[p] == leaf else F.try_variant_get(at_path[p], "$", leaf)  # noqa: B023, E731
        fields |= {name: read([value(p) for p in paths.split()]) for name, paths in names.items()}
    return fields


def with_fields(doc: Column, use: Callable[[dict[str, Column]], Column], **kinds: Mapping[str, str]) -> Column:
    """``use`` of many fields of an object, as :func:`read_fields` has them, inside an expression."""
    leaves = _leaves(kinds)
    (layer,) = _layers(list(leaves))
    return let(_read(doc, layer, leaves=leaves), lambda read: use(_fields(kinds, leaves, {p: _value(read, p) for p in layer})))


def read_fields(
    df: DataFrame, doc: Column | Callable[[str], Column], tag: str, **kinds: Mapping[str, str]
) -> tuple[DataFrame, dict[str, Column]]:
    """Read many fields of an object, each from the first usable path.

    Every kind maps names to blank-separated paths.  The object is gone through
    once for all of them.  A field is a column of its own, without functions
    over arrays, so that all of them are compiled.  ``doc`` is the object or
    reads it as a type.  Returns the frame with these columns (``tag`` starts
    their names) and the column of each field.
    """
    as_type = doc if callable(doc) else lambda kind: F.try_variant_get(doc, "$", kind)
    leaves = _leaves(kinds)
    reads, at_path = {}, {}
    for i, layer in enumerate(_layers(list(leaves))):
        reads[f"{tag}read{i}"] = as_type(_kind(_tree(layer), leaves))
        at_path.update({p: _value(F.col(f"{tag}read{i}"), p) for p in layer})
    wanted = {f"{tag}{name}": field for name, field in _fields(kinds, leaves, at_path).items()}
    fields = {name: F.col(f"{tag}{name}") for names in kinds.values() for name in names}
    return df.withColumns(reads).withColumns(wanted).drop(*reads), fields


def without_fields(df: DataFrame, tag: str) -> DataFrame:
    """The frame without the columns that :func:`read_fields` and steps after it named by ``tag``."""
    return df.drop(*[c for c in df.columns if c.startswith(tag)])


def _first_at(doc: Column, paths: str, kind: str) -> Column:
    leaf, read = READERS[kind]
    return _values(doc, paths.split(), read, leaf)


def first_text_at(doc: Column, paths: str) -> Column:
    return _first_at(doc, paths, "texts")


def first_id_at(doc: Column, paths: str) -> Column:
    return _first_at(doc, paths, "ids")


def present_at(doc: Column, paths: str) -> Column:
    return _first_at(doc, paths, "variants")
