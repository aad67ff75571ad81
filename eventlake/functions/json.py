"""JSON column helpers built on from_json / VARIANT.

`object_entries(text)` is the one parsing primitive: it turns the text of a
JSON object into `array<struct<k, raw, v>>` in document order, duplicate keys
kept (the last one wins where a single value is taken).  `raw` is the value's
text (strings unquoted, nested objects as their own text in document order)
and `v` the typed VARIANT value.  Objects held in VARIANT come back key-sorted,
so order-sensitive walks use `raw`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTRY_TYPE = "array<struct<k:string,raw:string,v:variant>>"


def starts_with_char(text: Column, ch: str) -> Column:
    return F.startswith(F.ltrim(text), F.lit(ch))


def object_entries(text: Column) -> Column:
    """Entries of a JSON object in document order; NULL when `text` is no object."""
    as_text = F.from_json(text, "map<string,string>")
    as_variant = F.from_json(text, "map<string,variant>")
    entries = F.zip_with(
        F.map_entries(as_text), F.map_values(as_variant),
        lambda e, v: F.struct(e["key"].alias("k"), e["value"].alias("raw"), v.alias("v")),
    )
    return F.when(starts_with_char(text, "{"), entries)


def array_elements(text: Column) -> Column:
    """Texts of the elements of a JSON array (objects as text), NULL if no array."""
    return F.when(starts_with_char(text, "["), F.from_json(text, "array<string>"))


def entry_text(entry: Column) -> Column:
    """Text of one entry's value as a JSON node would give it: strings unquoted,
    numbers and booleans as written, containers as '', JSON null as NULL."""
    container = (starts_with_char(entry.raw, "{") | starts_with_char(entry.raw, "["))
    is_text = F.schema_of_variant(entry.v) == "STRING"
    return (
        F.when(entry.isNull() | F.is_variant_null(entry.v), F.lit(None).cast("string"))
        .when(container, F.when(is_text, entry.raw).otherwise(F.lit("")))
        .otherwise(entry.raw)
    )


def last_entry(entries: Column, name: str) -> Column:
    """Last entry whose key equals `name` exactly (duplicate keys: last wins)."""
    return F.try_element_at(F.filter(entries, lambda e: e.k == F.lit(name)), F.lit(-1))


def field_text(entries: Column, name: str | None) -> Column:
    if name is None:
        return F.lit(None).cast("string")
    return entry_text(last_entry(entries, name))


def to_node(entries: Column) -> Column:
    """A map as one JSON value: values of any type, a NULL value becomes JSON null; a NULL map stays NULL."""
    return F.when(entries.isNotNull(), F.try_parse_json(F.to_json(entries)))


def is_empty_value(v: Column) -> Column:
    """NULL, JSON null, empty string, empty array or empty object."""
    return v.isNull() | F.coalesce(
        F.is_variant_null(v)
        | (F.try_variant_get(v, "$", "string") == "")
        | (F.size(F.try_variant_get(v, "$", "array<variant>")) == 0)
        | (F.size(F.try_variant_get(v, "$", "map<string,variant>")) == 0),
        F.lit(False),
    )


def pointer_path(pointer: str, index_as_key: bool = False) -> str:
    """A JSON pointer (`/properties/name`, `~1` for a slash, `~0` for a tilde) as a VARIANT path;
    a number is an array index, or with `index_as_key` an object's key."""
    path = "$"
    for step in pointer.split("/")[1:]:
        key = step.replace("~1", "/").replace("~0", "~")
        path += f"[{key}]" if key.isdigit() and not index_as_key else f"['{key}']"
    return path


def at_pointer(value: Column, pointer: str, kind: str = "string") -> Column:
    """The value at a JSON pointer of a VARIANT, NULL where there is none or it is no `kind`."""
    found = F.try_variant_get(value, pointer_path(pointer), kind)
    if any(step.isdigit() for step in pointer.split("/")):
        return F.coalesce(found, F.try_variant_get(value, pointer_path(pointer, True), kind))
    return found
