"""Columns from JSON payloads whose keys may hold an object, a list, a text or nothing. `v` is a VARIANT column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import timestamp

# fixed value: a postcode of the United Kingdom
POSTCODE = r"([Gg][Ii][Rr] 0[Aa]{2}|(?:[A-Za-z][0-9]{1,2}|[A-Za-z][A-Ha-hJ-Yj-y][0-9]{1,2}|[A-Za-z][0-9][A-Za-z]|[A-Za-z][A-Ha-hJ-Yj-y][0-9][A-Za-z]?)\s?[0-9][A-Za-z]{2})"


def variant(c: Column) -> Column:
    return F.try_parse_json(c)


def at(v: Column, path: str) -> Column:
    """The part at a path like $.a.b or $['@type']; null if absent."""
    return F.try_variant_get(v, path, "variant")


def form(v: Column) -> Column:
    """object, array, string, number, bool or null's name in upper case."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def scalar(v: Column, path: str = "$") -> Column:
    """The text of a scalar; null for an object or a list, and for JSON null."""
    text = F.try_variant_get(v, path, "string")
    return F.when(~text.rlike(r"^[\[{]"), text).when(text.isNotNull() & ~form(at(v, path)).isin("OBJECT", "ARRAY"), text)


def items(v: Column, path: str = "$") -> Column:
    """The elements of a list; null for anything else."""
    return F.try_variant_get(v, path, "array<variant>")


def listed(v: Column, path: str = "$") -> Column:
    """A list's elements, anything else as a list of one, nothing as an empty list."""
    part = at(v, path)
    return F.coalesce(items(v, path), F.when(~F.is_variant_null(part), F.array(part)), F.array().cast("array<variant>"))


def is_object(v: Column) -> Column:
    """Whether a value is an object; a cast tells it without a look at what it holds."""
    return F.try_variant_get(v, "$", "struct<_:int>").isNotNull()


def object_text(c: Column) -> Column:
    """Whether a JSON text is an object's."""
    return c.startswith("{")


def texts(c: Column) -> Column:
    """The elements of a JSON list as texts: objects and lists as JSON, others bare. One parse, in generated code."""
    return F.from_json(c, "array<string>")


def text_at(c: Column, path: str) -> Column:
    """The text of a scalar in a JSON text; null for an object or a list."""
    found = F.get_json_object(c, path)
    return F.when(~found.rlike(r"^[\[{]"), found)


def present(v: Column) -> Column:
    """Not absent, null, blank, [] or {}; 0 and false are values."""
    return ~F.coalesce(F.to_json(v), F.lit("null")).isin("null", '""', "[]", "{}")


def truthy(v: Column) -> Column:
    """What counts as given where alternatives are tried in turn: not 0 and not false either."""
    return ~F.coalesce(F.to_json(v), F.lit("null")).isin("null", '""', "[]", "{}", "0", "0.0", "false")


def empty_json(c: Column) -> Column:
    """A stored JSON text that holds nothing."""
    return c.isNull() | F.trim(c).isin("", "null", "{}", "[]", '""')


def keys(v: Column) -> Column:
    """The keys of an object, whatever their values."""
    return F.json_object_keys(F.to_json(v))


def labels(v: Column, path: str) -> Column:
    """prefLabel of objects and texts themselves, in order; what has neither is left out."""
    found = F.transform(listed(v, path), lambda x: F.when(is_object(x), scalar(x, "$.prefLabel")).when(form(x) == "STRING", scalar(x)))
    return F.filter(found, lambda x: x.isNotNull() & (x != ""))


def first_given(v: Column, *paths: str) -> Column:
    out = F.lit(None).cast("variant")
    for path in reversed(paths):
        out = F.when(truthy(at(v, path)), at(v, path)).otherwise(out)
    return out


def activities(v: Column) -> Column:
    return labels(first_given(v, "$.activity", "$.activities"), "$")


def facilities(v: Column) -> Column:
    return labels(first_given(v, "$.facilityType", "$.facilities", "$.category"), "$")


def accessibility(v: Column) -> Column:
    """Trimmed labels of objects; null if there are none."""
    part = at(v, "$.accessibilitySupport")
    found = F.transform(listed(part), lambda x: F.when(is_object(x), F.trim(scalar(x, "$.prefLabel"))).when(items(part).isNotNull() & (form(x) == "STRING"), F.trim(scalar(x))))
    found = F.filter(found, lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(found) > 0, found)


def organization(v: Column) -> Column:
    """The organizer, else the provider, as given."""
    own = lambda path: F.when(present(at(v, path)) & (F.coalesce(F.trim(scalar(v, path)), F.lit("x")) != ""), at(v, path))
    return F.coalesce(own("$.organizer"), own("$.provider"))


def organization_name(v: Column) -> Column:
    """A name in the organization; an address has none."""
    names = F.transform(listed(organization(v)), lambda x: F.when(is_object(x), F.nullif(F.trim(scalar(x, "$.name")), F.lit(""))))
    return F.get(F.filter(names, lambda x: x.isNotNull()), F.lit(0))


def strip_quotes(c: Column) -> Column:
    return F.btrim(c, F.lit('"'))


def data_id(v: Column) -> Column:
    return F.coalesce(scalar(v, "$['@id']"), scalar(v, "$.id"))


def kind(v: Column) -> Column:
    return F.coalesce(scalar(v, "$['@type']"), scalar(v, "$.type"))


def dates(v: Column) -> tuple[Column, Column]:
    """Start and end: of the schedules if they have any, else the payload's own."""

    def pick(key: str, reduce: object, *own: str) -> Column:
        scheduled = reduce(F.filter(F.transform(listed(v, "$.eventSchedule"), lambda x: timestamp(scalar(x, f"$.{key}"))), lambda x: x.isNotNull()))
        given = F.lit(None).cast("string")
        for name in reversed(own):
            text = F.nullif(scalar(v, f"$.{name}"), F.lit(""))
            given = F.coalesce(text, given)
        return F.coalesce(scheduled, timestamp(given))

    return pick("startDate", F.array_min, "startDate", "date_start"), pick("endDate", F.array_max, "endDate", "date_end")


def postcode(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, POSTCODE, 1), F.lit(""))


def location(v: Column, contains_place: bool = False) -> Column:
    """A struct of the first location: latitude, longitude (6 decimals, "0" is none), address, postal_code, place_name. With `contains_place`, the
    inner place's coordinates where the place has none."""
    first = F.get(listed(v, "$.location"), F.lit(0))
    place = F.when(is_object(first), first)

    def coordinate(path: str) -> Column:
        text = scalar(place, path)
        return F.when(text != "0", F.round(text.try_cast("double"), 6))

    lat, lng = coordinate("$.geo.latitude"), coordinate("$.geo.longitude")
    if contains_place:
        none = lat.isNull() & lng.isNull()
        lat, lng = (F.when(none, coordinate(f"$.containsPlace.geo.{k}")).otherwise(x) for k, x in (("latitude", lat), ("longitude", lng)))
    found = lat.isNotNull() | lng.isNotNull()
    address = F.trim(scalar(place, "$.address"))
    code = F.coalesce(F.trim(scalar(place, "$.address.postalCode")), postcode(address))
    name = F.nullif(F.trim(scalar(place, "$.name")), F.lit(""))
    return F.struct(
        lat.alias("latitude"), lng.alias("longitude"), F.when(~found, address).alias("address"), F.when(~found, code).alias("postal_code"), F.when(~found & code.isNull(), name).alias("place_name")
    )
