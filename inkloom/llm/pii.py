"""Personal data replaced by surrogates, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from inkloom.llm.tables import written

_TITLES = {
    "m": "Mr|Mister|Herr|Monsieur|Señor|господин|г-н",
    "f": "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|госпожа|г-жа",
    "n": "Dr|Prof",
}
# A title is written as above, with a capital, or all in capitals.
TITLES = {
    gender: list(dict.fromkeys(form for t in titles.split("|") for form in (t, t[0].upper() + t[1:], t.upper())))
    for gender, titles in _TITLES.items()
}
_LOUD_NAME = r"\p{Lu}{2,}+(?:['’-]\p{Lu}++)*+(?!\p{Ll})"
_NAME = rf"(?:{_LOUD_NAME}|\p{{Lu}}[\p{{Ll}}'’-]*+(?:\p{{Lu}}[\p{{Ll}}'’-]*+)?)"
_HEX = "[0-9A-Fa-f]{1,4}"
# Cards of the common forms: 16 digits in fours (a group of three more may belong to it), 15 as 4-6-5.
_CARD = "(?<![\\w-])(?:{})(?![\\w-])".format(
    "|".join(
        rf"\d{{4}}{sign}\d{{4}}{sign}\d{{4}}{sign}\d{{4}}" + (rf"(?:{sign}\d{{3}}(?![\w-]|\.\d))?|3[47]\d\d{sign}\d{{6}}{sign}\d{{5}}" if sign else "")
        for sign in ("", " ", "-")
    )
)
# In the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}_.%+-])[\p{L}\p{N}_%+-]++(?:\.[\p{L}\p{N}_%+-]++)*+@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}+",
    "access_key": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsur]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{20,}+|AIza[A-Za-z0-9_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+)(?![A-Za-z0-9])",
    "secret": r"(?i:(?<![a-z0-9])(?:password|passwd|secret|token|api[_-]?key))\s?[=:]\s?[\"']?[A-Za-z0-9+/_-]{12,}+[\"']?",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})(?![\w]|\.\d)",
    "ip6": rf"(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[A-Fa-f:]*\d)(?=(?:{_HEX}::?){{2}})(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\w:]|\.\d)",
    "ssn": r"(?<![\w-])(?:\d{3}-\d{2}-\d{4}|(?!000|666|9)\d{3} \d{2} \d{4})(?![\w-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "card": _CARD,
    "phone": r"(?<![\w+(])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?![\w-])"
    r"|(?<![\w+(])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])|(?<![\w.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-])"
    r"|(?<![\w.-])[2-9]\d\d [2-9]\d\d \d{4}(?! ?\d|[\w-])|(?<=(?i:phone|call|mobile|tel|fax)[:.]? ?)[2-9]\d\d[2-9]\d{6}(?![\w-])",
    # after a title all in capitals so is the name
    "person": r"(?<![\p{L}\p{N}])(?:"
    + "|".join(
        rf"(?:{'|'.join(t for forms in TITLES.values() for t in forms if t.isupper() == loud)})\.?\s{name}(?:\s{name}){{0,2}}"
        for loud, name in ((False, _NAME), (True, _LOUD_NAME))
    )
    + r")(?!\p{L})",
}
# Other rows of 13 digits and more, up to where another pattern begins.
_DIGITS = r"\d++(?:-\d++)*+(?![\w-])"
_OTHERS = "|".join(f"(?:{PATTERNS[kind]})" for kind in ("email", "ip", "ssn", "card", "phone"))
_KEY_BEGINS = "AKIA ASIA gho_ ghp_ ghs_ ghu_ ghr_ xox AIza eyJ".split()
PATTERNS["row"] = rf"(?<![\w-])(?=\d(?:[ -]?\d){{12}}){_DIGITS}(?: (?!{_OTHERS}){_DIGITS})*+"
PII = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Names that surrogates are made of, by gender and script.
GIVEN = {
    "m_latin": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Noah Oscar Paul Robin Simon Thomas Victor",
    "f_latin": "Alice Bella Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Tessa Vera",
    "n_latin": "Alex Ariel Blake Casey Charlie Dana Eden Jamie Jordan Kim Logan Morgan Quinn Riley Robin Sam Sasha Taylor Terry Toni",
    "m_cyrillic": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Николай Олег Павел Роман Сергей Тимур",
    "f_cyrillic": "Анна Белла Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Тамара",
    "n_cyrillic": "Женя Саша Валя Слава Паша Шура Вася Никита",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe fo ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo",
    "cyrillic": "ба бе бо ва ве во га го да де до ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то",
}
WIDEN = 8  # attempts in the format of the original; later ones may be longer


def _may_hold(text: Column) -> Column:
    """Whether a text has what each match needs: a digit, a sign of an address or label, a key's beginning, or a title.

    Far cheaper than the patterns; plain substrings are looked for without a regular expression.
    """
    titles = [t for forms in TITLES.values() for t in forms]
    # what a title holds another one does too
    parts = [t for t in ("@", "=", ":", *_KEY_BEGINS, *titles) if not any(o != t and o in t for o in titles)]
    return reduce(lambda found, part: found | text.contains(part), parts, text.rlike("[0-9]"))


def _draw(key: str, n: Column | int, *seed: Column) -> Column:
    """A keyed number from 0 to n - 1."""
    digest = F.sha2(F.concat_ws("\u001f", lit(key), *[s.cast("string") for s in seed]), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), n if isinstance(n, Column) else lit(n))


def _pick(words: str, place: Column) -> Column:
    choices = words.split()
    return F.element_at(F.array(*map(lit, choices)), (place % len(choices) + 1).cast("int"))


def _any_of(choices: dict[str, str], kind: Column, place: Column) -> Column:
    return reduce(lambda rest, kv: F.when(kind == kv[0], _pick(kv[1], place)).otherwise(rest), choices.items(), lit(None))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, counted from its end."""
    places = F.sequence(lit(1), F.length(digits))
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(back, i, lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(places, lit(0), add)


def _letter(key: str, char: Column, letters: Column, *seed: Column) -> Column:
    """Another character of the same class and case, one of the first ``letters`` of the alphabet; signs stay."""
    number = _draw(key, letters, *seed)
    cyrillic = F.substr(lit("абвгдежзиклмнопрстуфхцчшщэюяйьыъ"), (number + 1).cast("int"), lit(1))
    latin = F.substr(lit("abcdefghijklmnopqrstuvwxyz"), (number + 1).cast("int"), lit(1))
    return (
        F.when(char.rlike(r"^\d$"), _draw(key, 10, *seed).cast("string"))
        .when(char.rlike(r"^[а-яё]$"), cyrillic)
        .when(char.rlike(r"^[А-ЯЁ]$"), F.upper(cyrillic))
        .when(char.rlike(r"^\p{Lu}$"), F.upper(latin))
        .when(char.rlike(r"^\p{L}$"), latin)
        .otherwise(char)
    )


def _surrogate(key: str) -> Column:
    """Candidate of columns ``kind``, ``norm``, ``gender`` and ``attempt``: keyed, in the format of the kind."""
    kind, attempt = col("kind"), col("attempt")
    seed = (kind, col("norm"), attempt)
    ending = F.when(kind == "email", F.regexp_extract("norm", r"(\.\p{L}+)$", 1)).otherwise("")  # stays
    norm = F.left("norm", F.length("norm") - F.length(ending))
    extra = F.greatest(attempt - (WIDEN - 1), lit(0))
    places = F.sequence(lit(1), F.length(norm))
    alphabet = F.when((kind == "secret") & norm.rlike("^[0-9a-f]+$") | (kind == "ip6"), 6).otherwise(26)  # hexadecimal stays so
    letters = F.array_join(F.transform(places, lambda i: _letter(key, F.substr(norm, i, lit(1)), alphabet, *seed, i)), "")
    tail = F.transform(F.sequence(lit(0), extra), lambda i: F.when(i > 0, _draw(key, 10, *seed, -i).cast("string")).otherwise(""))
    plain = F.concat(letters, F.array_join(tail, ""))
    # the first digit and the check digit stay right
    body = F.concat(F.left(norm, lit(1)), F.substr(letters, lit(2), F.length(norm) - 2))
    middle = F.concat(body, F.array_join(tail, ""))
    card = F.concat(middle, F.pmod(10 - _luhn(F.concat(middle, lit("0"))) % 10, lit(10)).cast("string"))

    def octet(i: Column) -> Column:
        width = F.when(attempt < WIDEN, F.length(F.get(F.split(norm, r"\."), i))).otherwise(lit(0))
        free = _draw(key, 256, *seed, i)
        return (
            F.when(width == 1, 1 + _draw(key, 9, *seed, i)).when(width == 2, 10 + _draw(key, 90, *seed, i))
            .when(width == 3, 100 + _draw(key, 156, *seed, i)).otherwise(free)
        ).cast("string")

    address = F.array_join(F.transform(F.array(*map(lit, range(4))), octet), ".")
    script = F.when(norm.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    syllable = lambda i: _any_of(SYLLABLES, script, _draw(key, 1 << 40, *seed, i))
    family = F.initcap(F.array_join(F.transform(F.sequence(lit(1), 3 + F.floor(attempt / 2).cast("int")), syllable), ""))
    longer = F.transform(F.sequence(lit(0), F.floor(attempt / 2).cast("int")), lambda i: F.when(i > 0, syllable(i)).otherwise(""))
    given = F.concat(_any_of(GIVEN, F.concat("gender", lit("_"), script), _draw(key, 1 << 40, *seed)), F.array_join(longer, ""))
    return (
        F.when(kind == "ip", address).when(kind == "card", card).when(kind == "family", F.lower(family))
        .when(kind == "given", F.lower(given)).otherwise(F.concat(plain, ending))
    )


def _parts(found: Column) -> Column:
    """What of a match is replaced: struct(kind, lead, body, tail, norm) for each part; lead and tail stay."""

    def part(kind: Column | str, lead: Column, body: Column, tail: Column, norm: Column) -> Column:
        named = kind if isinstance(kind, Column) else lit(kind)
        return F.struct(*[c.alias(n) for c, n in zip((named, lead, body, tail, norm), ("kind", "lead", "body", "tail", "norm"), strict=True)])

    none = lit("")
    digits = F.regexp_replace(found, r"\D", "")
    is_a = {kind: found.rlike(f"^(?:{pattern})$") for kind, pattern in PATTERNS.items()}
    ending = F.regexp_extract(found, r"(\.\p{L}+)$", 1)
    address = F.left(found, F.length(found) - F.length(ending))
    secret = F.regexp_extract(found, r"([A-Za-z0-9+/_-]{12,})[\"']?$", 1)
    secret_lead = F.regexp_extract(found, r"^(.*?[=:]\s?[\"']?)[A-Za-z0-9+/_-]{12,}[\"']?$", 1)
    secret_tail = F.regexp_extract(found, r"([\"']?)$", 1)
    country = F.regexp_extract(found, r"^(\+\d{1,3})(?=[ .(-])", 1)
    number = F.substr(found, F.length(country) + 1)
    title = F.regexp_extract(found, r"^(\S+\s)", 1)
    names = F.regexp_extract_all(F.substr(found, F.length(title) + 1), lit(r"\S+\s?"), 0)
    gender = reduce(lambda rest, kv: F.when(title.rlike(rf"^(?:{'|'.join(kv[1])})\.?\s"), kv[0]).otherwise(rest), TITLES.items(), lit("n"))

    def name_part(token: Column, i: Column) -> Column:
        word = F.regexp_replace(F.trim(token), "['’][sS]$", "")  # a possessive ending stays
        kind = F.when(i == F.size(names) - 1, "family").otherwise(F.concat(lit("given_"), gender))
        return part(kind, F.when(i == 0, title).otherwise(none), word, F.substr(token, F.length(word) + 1), F.lower(word))

    # a number of the common form is replaced without a right check digit too
    number_kind = lambda number: F.when(_luhn(number) % 10 == 0, "card").otherwise("account")
    sixteen = F.left(digits, lit(16))
    with_more = (F.length(digits) == 19) & ((_luhn(sixteen) % 10 == 0) | (_luhn(digits) % 10 != 0))
    front = F.left(found, lit(19))
    card = F.when(with_more, part(number_kind(sixteen), none, front, F.substr(found, lit(20)), sixteen)).otherwise(
        part(number_kind(digits), none, found, none, digits)
    )
    return (
        F.when(is_a["email"], F.array(part("email", none, address, ending, F.lower(found))))
        .when(is_a["access_key"], F.array(part("access_key", F.left(found, lit(4)), F.substr(found, lit(5)), none, F.substr(found, lit(5)))))
        .when(is_a["secret"], F.array(part("secret", secret_lead, secret, secret_tail, secret)))
        .when(is_a["ip"], F.array(part("ip", none, found, none, found)))
        .when(is_a["ip6"], F.array(part("ip6", none, found, none, F.lower(found))))
        .when(is_a["ssn"], F.array(part("ssn", none, found, none, digits)))
        .when(is_a["iban"], F.array(part("iban", F.left(found, lit(2)), F.substr(found, lit(3)), none, F.lower(F.replace(F.substr(found, lit(3)), lit(" "), none)))))
        .when(is_a["card"], F.array(card))
        .when(is_a["person"], F.transform(names, name_part))
        # the label before ten bare digits is not part of the match
        .when(is_a["phone"] | found.rlike(r"^\d{10}$"), F.array(part("phone", country, number, none, F.regexp_replace(number, r"\D", ""))))
        .otherwise(_cards_in_row(found, part))
    )


def _cards_in_row(found: Column, part: Callable[..., Column]) -> Column:
    """Parts of a row of digit groups: the cards in it, and what lies between them as it is.

    A card is a window of neighbouring groups of three digits and more with 13
    to 19 digits and a right check digit: from the left, one group rather than
    several, else the longest; or the row as a whole.
    """
    none, groups = lit(""), F.regexp_extract_all(found, lit(r"\d+[ -]?"), 0)
    text = lambda first, after: F.array_join(F.slice(groups, first + 1, after - first), "")
    bare = lambda window: F.regexp_replace(window, r"\D", "")
    right = lambda number: F.length(number).between(13, 19) & (_luhn(number) % 10 == 0)

    def is_card(first: Column, after: Column) -> Column:
        window = F.slice(groups, first + 1, after - first)
        return F.forall(window, lambda g: F.length(bare(g)) >= 3) & right(bare(F.array_join(window, "")))

    def card(first: Column | int, after: Column, begin: Column) -> Column:
        window = text(first, after)
        body = F.regexp_replace(window, r"[ -]$", "")
        return part("card", text(begin, first), body, F.substr(window, F.length(body) + 1), bare(window))

    def step(done: Column, first: Column) -> Column:
        # seven groups of three digits are more than 19 digits
        ends = F.sequence(first + 1, F.least(first + 6, F.size(groups)))
        after = F.when(is_card(first, first + 1), first + 1).otherwise(F.array_max(F.filter(ends, lambda e: is_card(first, e))))
        after = F.when(first >= done["next"], after)
        found_one = F.struct(after.alias("next"), F.concat(done["parts"], F.array(card(first, after, done["next"]))).alias("parts"))
        return F.when(after.isNotNull(), found_one).otherwise(done)

    empty = F.slice(F.array(part("card", none, none, none, none)), 1, 0)
    cards = F.aggregate(F.sequence(lit(0), F.size(groups) - 1), F.struct(lit(0).alias("next"), empty.alias("parts")), step)
    rest = lambda done: F.concat(done["parts"], F.array(part("", none, text(done["next"], F.size(groups)), none, none)))
    whole = F.array(part("card", none, found, none, bare(found)))
    return F.get(
        F.transform(F.array(cards), lambda done: F.when((F.size(done["parts"]) == 0) & right(bare(found)), whole).otherwise(rest(done))), lit(0)
    )


def _render(body: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the form of this occurrence: its signs and its case."""
    slots = F.regexp_replace(surrogate, r"[^\p{L}\p{N}]", "")
    places = F.sequence(lit(1), F.length(body))

    def put(done: Column, i: Column) -> Column:
        char = F.substr(body, i, lit(1))
        new = F.substr(slots, done["used"] + 1, lit(1))
        cased = F.when(char.rlike(r"^\p{Lu}$"), F.upper(new)).otherwise(new)
        taken = char.rlike(r"^[\p{L}\p{N}]$")
        return F.struct(
            F.concat(done["text"], F.when(taken, cased).otherwise(char)).alias("text"),
            (done["used"] + taken.cast("int")).alias("used"),
        )

    same = F.length(slots) == F.length(F.regexp_replace(body, r"[^\p{L}\p{N}]", ""))
    filled = F.aggregate(places, F.struct(lit("").alias("text"), lit(0).alias("used")), put)["text"]
    is_name = kind.isin("family", "given_m", "given_f", "given_n")
    named = F.when(body.rlike(r"^\P{Ll}{2,}$"), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return F.when(is_name, named).when(same & (kind != "ip"), filled).otherwise(surrogate)


def _identity(kind: Column) -> Column:
    """Kind by which surrogates are drawn: a given name is the same one after any title."""
    return F.when(kind.startswith("given"), "given").otherwise(kind)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) of distinct entities (kind, norm), where the kind of all given names is ``given``.

    No two that are written alike (names; card numbers; else of a kind) share a
    surrogate, as it is written in full, and none is another's original.
    Candidates are keyed hashes, so an entity has one surrogate wherever it
    occurs.  Those that meet another's, or an original, are drawn again until
    none is left; of several that meet, the least original keeps its candidate.
    A given name found with one gender keeps that; with both or none it gets a
    name of either.  Each round counts and joins narrow tables written to the
    shared folder.
    """
    is_for = lambda gender: F.bool_or(col("kind") == f"given_{gender}")
    gender = F.when(is_for("m") & ~is_for("f"), "m").when(is_for("f") & ~is_for("m"), "f").otherwise("n")
    entities = entities.groupBy(_identity(col("kind")).alias("identity"), "norm").agg(gender.alias("gender"))
    alike = F.when(col("kind").isin("family", "given"), "name").when(col("kind").isin("card", "account"), "number").otherwise(col("kind"))
    entities = entities.withColumnRenamed("identity", "kind").withColumn("alike", alike)
    state = written(entities.withColumn("attempt", lit(0)).withColumn("surrogate", _surrogate(key)), "surrogates")
    originals = state.select("alike", col("norm").alias("surrogate")).distinct().withColumn("original", lit(True))
    columns, own = ["alike", "kind", "norm", "gender", "attempt"], F.struct("norm", "kind")
    while True:
        firsts = state.groupBy("alike", "surrogate").agg(F.min(own).alias("first"), F.count(lit(1)).alias("n")).where("n > 1")
        checked = state.join(firsts, ["alike", "surrogate"], "left").join(originals, ["alike", "surrogate"], "left")
        clash = col("original").isNotNull() | F.coalesce(col("first") != own, lit(False))
        checked = written(checked.select(*columns, "surrogate", clash.alias("clash")), "checked")
        if checked.where("clash").isEmpty():
            return checked.select("kind", "norm", "surrogate")
        again = checked.withColumn("attempt", col("attempt") + col("clash").cast("int"))
        state = written(again.select(*columns, F.when(col("clash"), _surrogate(key)).otherwise(col("surrogate")).alias("surrogate")), "surrogates")


def replace_pii(docs: DataFrame, key: str, text_column: str = "text", kinds_column: str | None = None) -> DataFrame:
    """The documents with personal data in their texts replaced by surrogates.

    Found are e-mail and IP addresses, phone, card (16 digits or 15 as 4-6-5, or
    others with a right check digit, also within longer rows of digits) and social security numbers, access keys, secrets after a label, and names
    after a title.  A surrogate has the type, format, script, case and, for given
    names, the gender of what it replaces (see ``surrogates``); the same value gets the same one in
    all documents, written with the signs of each occurrence, and different
    values different ones (see ``surrogates``).  The name of a person is
    replaced word by word, so "Mr Smith" still is "Mr John Smith".

    Texts without a finding, null and empty ones are handed on as they are, and
    never shuffled.  Equal texts are scanned once.  Repeated rows stay.  All
    columns keep their names and order; ``kinds_column`` adds the kinds found,
    sorted, each as often as it occurs.
    """
    text = col(f"`{text_column}`")
    has = F.coalesce(_may_hold(text) & text.rlike(PII), lit(False))
    no_kinds = F.array().cast("array<string>")
    clean = docs.where(~has)
    touched = docs.where(has).withColumn("__pii_key", F.sha2(text, 256))
    texts = written(touched.groupBy("__pii_key").agg(F.first(text).alias("text")).withColumnRenamed("__pii_key", "key"), "pii-texts")
    found = texts.select("key", F.posexplode(F.regexp_extract_all("text", lit(PII), 0)).alias("place", "found"))
    parts = found.select("key", "place", F.posexplode(_parts(col("found"))).alias("number", "part"))
    parts = written(parts.select("key", "place", "number", "part.*"), "pii-parts")
    named = surrogates(parts.where("kind <> ''").select("kind", "norm").distinct(), key)
    named = named.withColumnRenamed("kind", "identity")
    joined = parts.withColumn("identity", _identity(col("kind"))).join(named, ["identity", "norm"], "left")
    new = F.when(col("kind") == "", col("body")).otherwise(
        F.concat("lead", _render(col("body"), col("kind"), F.when(col("kind") == "email", F.regexp_replace("surrogate", r"\.[^.]*$", "")).otherwise(col("surrogate"))), "tail")
    )
    rows = joined.select("key", "place", "number", new.alias("new"), F.when(col("kind") != "", col("kind")).alias("kind"))
    ordered = lambda *by: F.array_sort(F.collect_list(F.struct(*by, "new")))
    whole = rows.groupBy("key").agg(ordered("place", "number").alias("new"), F.array_sort(F.collect_list("kind")).alias("kinds"))
    # parts of one match follow one another; put the text between matches before the first of each
    between = F.split("text", PII, -1)
    pieces = F.transform("new", lambda p: F.concat(F.when(p["number"] == 0, F.get(col("between"), p["place"])).otherwise(""), p["new"]))
    masked = texts.join(whole, "key").withColumn("between", between)
    masked = masked.select(
        col("key").alias("__pii_key"),
        F.concat(F.array_join(pieces, ""), F.element_at("between", -1)).alias("__pii_text"),
        col("kinds").alias("__pii_kinds"),
    )
    changed = touched.join(masked, "__pii_key")
    keep = [F.col("__pii_text").alias(c) if c == text_column else col(f"`{c}`") for c in docs.columns]
    extra = [kinds_column] if kinds_column else []
    one = clean.select("*", *[no_kinds.alias(c) for c in extra])
    return one.unionByName(changed.select(*keep, *[col("__pii_kinds").alias(c) for c in extra]))
