"""Strict JSON over Spark's lenient parser, and questions about the kinds of values.

A text is strict JSON if it is one value with nothing after it. The parser accepts
trailing text, so the text is parsed inside a list (where trailing text breaks the list
or adds an element) and as a field (where a second element breaks the object).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), value being worked out once for a row, however often use names it; a Column that is named twice is worked out twice."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def is_json(text: Column) -> Column:
    """Whether text is exactly one JSON value; false for null."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"k":'), text, F.lit("}")))
    one = F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.coalesce(one & named.isNotNull(), F.lit(False))


def value(text: Column) -> Column:
    """The variant of a strict JSON text, else null."""
    return F.when(is_json(text), F.try_parse_json(text))


def get(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


#: How the schema of a variant begins, and what such a value is called; any other is a number.
KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "BIGINT": "integer", "VOID": "null"}


def kind(v: Column) -> Column:
    """object, array, string, boolean, integer, number or null; SQL null where there is no value."""
    names = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    known = F.try_element_at(names, F.substring_index(F.schema_of_variant(v), "<", 1))
    return F.coalesce(known, F.when(v.isNotNull(), "number"))


#: What counts as no text.
_BLANK = r"\A(?:null|false|0|0\.0|\[\]|\{\})\z"


def text_of(v: Column) -> Column:
    """A string value as it is, other values as JSON; null, false, 0 and empty ones as ''."""
    plain = F.when(kind(v) == "string", v.cast("string")).otherwise(F.to_json(v))
    return F.regexp_replace(F.coalesce(plain, F.lit("")), _BLANK, "")


def strings(v: Column) -> Column:
    """The elements of an array whose elements are all strings, else null."""
    items = v.try_cast("array<variant>")
    same = F.forall(items, lambda x: F.coalesce(kind(x) == "string", F.lit(False)))
    return F.when((kind(v) == "array") & same, F.transform(items, lambda x: x.cast("string")))


def keys(v: Column) -> Column:
    """The sorted keys of an object."""
    return F.array_sort(F.map_keys(v.try_cast("map<string,variant>")))


def parse_codes(text: Column) -> Column:
    """[] for a JSON object; ['invalid-json'] or ['root-not-object'] else."""
    return (
        F.when(~is_json(text), F.array(F.lit("invalid-json")))
        .when(kind(value(text)) != "object", F.array(F.lit("root-not-object")))
        .otherwise(F.array().cast("array<string>"))
    )


def codes_of(v: Column) -> Column:
    """``parse_codes`` of a text by its ``value``."""
    return (
        F.when(v.isNull(), F.array(F.lit("invalid-json")))
        .when(kind(v) != "object", F.array(F.lit("root-not-object")))
        .otherwise(F.array().cast("array<string>"))
    )


def extract_object(text: Column) -> Column:
    """The JSON object in a text: all of it, or else from the first { to the last }; null if neither is an object."""
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    found = F.when(is_json(text), text).when(is_json(inner), inner)
    return F.when(kind(value(found)) == "object", found)


def exact_keys(have: Column, want: list[str]) -> Column:
    """missing-key and extra-key codes, each kind sorted by key."""
    asked = F.array(*[F.lit(k) for k in sorted(want)])
    missing = F.transform(F.array_except(asked, have), lambda k: F.concat(F.lit("missing-key:"), k))
    extra = F.transform(F.array_sort(F.array_except(have, asked)), lambda k: F.concat(F.lit("extra-key:"), k))
    return F.concat(missing, extra)


def canonical(v: Column) -> Column:
    """A text that is the same for equal JSON values: numbers by value (1 and 1.0 are equal), keys sorted."""
    return F.when(kind(v).isin("integer", "number"), F.concat(F.lit("#"), v.try_cast("double").cast("string"))).otherwise(F.to_json(v))


def subset_of(v: Column, keys: Sequence[str]) -> Column:
    """Some fields of a JSON object as a JSON text with sorted keys; fields that are null or absent are left out, nulls within kept
    ones stay, and numbers are spelt by their value (1.0 as 1). Null for anything but an object."""
    kept = F.map_filter(v.try_cast("map<string,variant>"), lambda k, x: k.isin(*keys) & (kind(x) != "null"))
    entries = F.array_sort(F.map_entries(F.transform_values(kept, lambda _, x: F.to_json(x))))
    parts = F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def subset(text: Column, keys: Sequence[str]) -> Column:
    """``subset_of`` of a strict JSON text."""
    return subset_of(value(text), keys)
