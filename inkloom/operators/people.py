"""Contributors found inside a book or chapter object.

All people of one object sit in one captured body, so they are gathered and
made unique inside the row; only the finished rows leave it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkloom.functions.html import first_per_key
from inkloom.functions.payload import as_list, is_object, places, with_fields
from inkloom.functions.text import let

# Keys that may hold the people of a role, in order.
ROLE_KEYS = {
    "translator": ("translator", "translators", "translationTeam", "translationTeams"),
    "editor": ("editor", "editors", "redactor", "redactors"),
    "creator": ("creator", "creators", "authorUser"),
    "team": ("team", "teams", "translationGroup", "translationGroups"),
}
PERSON = "struct<role: string, id: string, id_is_num: boolean, name: string, username: string, url: string>"


def _person(raw: Column, role: str) -> Column:
    """A person's fields, read in one pass over the object."""

    def person(f: dict[str, Column]) -> Column:
        names = [f[n].alias(n) for n in ("name", "username", "url")]
        return let(f["id"], lambda id_: F.struct(F.lit(role).alias("role"), id_["value"].alias("id"), id_["is_num"].alias("id_is_num"), *names))

    texts = {"name": "displayName name title fullName", "username": "username login nickname slug", "url": "url profileUrl"}
    return with_fields(raw, person, ids={"id": "id userId teamId"}, texts=texts)


def people_of(doc: Column, role: str) -> Column:
    """People of a role in key order, nameless and id-less ones left out."""
    return people_among(places(doc, " ".join(ROLE_KEYS[role])), role)


def people_among(values: Column, role: str) -> Column:
    """People in an array of persons and lists of them, as :func:`people_of`."""
    values = F.filter(values, lambda v: v.isNotNull() & ~F.is_variant_null(v))
    listed = F.flatten(F.transform(values, lambda v: F.coalesce(as_list(v), F.array(v))))
    found = F.transform(F.filter(listed, is_object), lambda p: _person(p, role))
    return F.filter(found, lambda p: p["id"].isNotNull() | p["name"].isNotNull() | p["username"].isNotNull())


def with_id_only(people: Column, role: str, id_: Column) -> Column:
    """Add a person who is known by id alone, unless listed under that very id.

    The number 5 and the text '5' are different ids here.
    """
    none = F.lit(None).cast("string")

    def extended(i: Column) -> Column:
        known = F.exists(people, lambda p: (p["id"] == i["value"]) & (p["id_is_num"] == i["is_num"]))
        extra = F.struct(
            F.lit(role).alias("role"),
            i["value"].alias("id"),
            i["is_num"].alias("id_is_num"),
            none.alias("name"),
            none.alias("username"),
            none.alias("url"),
        )
        missing = i.isNotNull() & ~F.coalesce(known, F.lit(False))
        return F.when(missing, F.array(extra)).otherwise(F.array().cast(f"array<{PERSON}>"))

    return F.concat(people, let(id_, extended))


def unique_people(people: Column) -> Column:
    """First of each (role, id, username, name), whatever the kind of id."""
    text = lambda c: F.coalesce(c, F.lit(""))
    keyed = F.transform(
        people,
        lambda p, i: F.struct(
            i.alias("pos"),
            F.concat_ws(":", p["role"], text(p["id"]), text(p["username"]), text(p["name"])).alias("key"),
            p.alias("person"),
        ),
    )
    return F.transform(first_per_key(keyed, "key"), lambda x: x["person"])
