"""Decoder schemas (JSON Schema) of answers, built from the same tables as their validators, and a compiler that checks by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions import json as J
from prefmill.operators.contracts import FIELDS, KERNELS

Schema = dict[str, object]
TEXT: Schema = {"type": "string"}
BOOL: Schema = {"type": "boolean"}
WHOLE: Schema = {"type": "integer"}


def text(least: int, most: int) -> Schema:
    return {"type": "string", "minLength": least, "maxLength": most}


def many(items: Schema, least: int | None = None, most: int | None = None, unique: bool = False) -> Schema:
    out: Schema = {"type": "array", "items": items}
    if least is not None:
        out["minItems"] = least
    if most is not None:
        out["maxItems"] = most
    if unique:
        out["uniqueItems"] = True
    return out


def closed(fields: dict[str, Schema], optional: tuple[str, ...] = ()) -> Schema:
    """An object with these fields and no others."""
    return {"type": "object", "properties": fields, "required": [f for f in fields if f not in optional], "additionalProperties": False}


def table(**limits: tuple[int, int]) -> dict[str, Schema]:
    return {name: text(*x) for name, x in limits.items()}


STRINGS = many(TEXT)
#: Length limits of every text, sizes of every list.
TERM = closed(table(tr=(2, 64), df=(20, 256), eg=(12, 192), mi=(12, 160), cx=(18, 192)))
ITEM = closed({
    **table(q=(12, 256)), "op": many(text(1, 160), 4, 4, True), "ai": {**WHOLE, "minimum": 0, "maximum": 3},
    **table(ex=(18, 400)), "fi": many({**WHOLE, "minimum": 0}, 1, 2),
})
LESSON = closed({
    **table(lessonId=(3, 64)), "facts": many(text(20, 192), 5, 5), "keyTerms": many(TERM, 3, 3), "scenario": closed(table(su=(35, 480), ma=(20, 224))),
    "discussionPrompt": closed({**table(pr=(20, 224), tn=(20, 224)), "po": many(text(1, 160), 3, 3)}),
    "assignmentCore": closed({**table(td=(45, 400)), "pa": many(text(1, 128), 4, 4)}),
    "workedExample": closed({**table(wp=(20, 256)), "ws": many(text(8, 128), 3, 3), **table(wr=(1, 128))}),
    "mc": many(ITEM, 4, 4), "studyGuide": closed(table(sm=(60, 480), rs=(30, 288))),
}, ("workedExample",))
KINDS: dict[str, Schema] = {
    "lesson": closed({"lessons": many(LESSON, 1, 1)}),
    "mc-item": ITEM,
    "key-term": TERM,
    "source-bundle": closed({"mcItems": many(ITEM, 1), "keyTerms": many(TERM, 1)}),
}
#: Fields that are not plain text.
TYPED: dict[str, Schema] = {
    **dict.fromkeys(("eligible", "feasible", "complete", "answerDeferred"), BOOL),
    **dict.fromkeys(("missingImmediate", "recommendedSequence", "sectionIds", "conflicts", "known", "needed", "canHelpWith", "citations"), STRINGS),
    "totalCredits": WHOLE,
    "remainingByGroup": {"type": "object", "additionalProperties": WHOLE},
    "eligibleOptions": {"type": "object", "additionalProperties": STRINGS},
    "arguments": closed({"courseCodes": STRINGS, "term": TEXT}),
}


def response_schema(kind: str) -> Schema:
    if kind not in KINDS:
        raise ValueError(f"unknown response kind: {kind}")
    return KINDS[kind]


def contract_schema(contract: str, kernels: tuple[str, ...] = KERNELS) -> Schema:
    if contract in kernels:
        return response_schema("lesson")
    if contract not in FIELDS:
        raise ValueError(f"unknown contract: {contract}")
    return closed({f: TYPED.get(f, TEXT) for f in FIELDS[contract]})


def response_format(kind: str, prefix: str = "pref") -> Schema:
    return {"type": "json_schema", "json_schema": {"name": f"{prefix}_{kind.replace('-', '_')}", "strict": True, "schema": response_schema(kind)}}


# -- schemas that check: a DDL type and a column of violations -------------------


def ddl(schema: Schema) -> str:
    """The Spark type of a closed schema's values, for typed reads."""
    kind = schema["type"]
    if kind == "array":
        return f"array<{ddl(schema['items'])}>"
    if kind == "object":
        more = schema.get("additionalProperties", True)
        if "properties" in schema:
            return "struct<" + ",".join(f"`{name}`:{ddl(s)}" for name, s in schema["properties"].items()) + ">"
        return f"map<string,{ddl(more)}>" if isinstance(more, dict) else "map<string,variant>"
    return {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}[kind]


def _told(path: Column, code: str, bad: Column) -> Column:
    """[path:code] where bad holds, else []."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.concat(path, F.lit(f":{code}")))).otherwise(none)


def _below(path: Column, name: Column) -> Column:
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))


def _typed(v: Column, kind: str) -> Column:
    k = J.kind(v)
    return k.isin("integer", "number") if kind == "number" else k == kind


def violations(schema: Schema, v: Column, path: Column | None = None) -> Column:
    """What keeps a variant from its schema: an array of path:code, [] if nothing does.

    Codes: missing, extra (keys); type; short, long (texts, in characters); few, many, repeated (lists); low, high
    (numbers). A value of the wrong type is told for that alone. Paths name keys and places, as in mc[0].op; a SQL null
    is a value of the wrong type.
    """
    path = F.lit("") if path is None else path
    kind = str(schema["type"])
    right = F.coalesce(_typed(v, kind), F.lit(False))
    found: list[Column] = []
    if kind == "string":
        size = F.length(v.try_cast("string"))
        found += [_told(path, "short", size < schema["minLength"])] if "minLength" in schema else []
        found += [_told(path, "long", size > schema["maxLength"])] if "maxLength" in schema else []
    elif kind in ("integer", "number"):
        number = v.try_cast("bigint" if kind == "integer" else "double")
        found += [_told(path, "low", number < schema["minimum"])] if "minimum" in schema else []
        found += [_told(path, "high", number > schema["maximum"])] if "maximum" in schema else []
    elif kind == "array":
        items = v.try_cast("array<variant>")
        found += [_told(path, "few", F.size(items) < schema["minItems"])] if "minItems" in schema else []
        found += [_told(path, "many", F.size(items) > schema["maxItems"])] if "maxItems" in schema else []
        if schema.get("uniqueItems"):
            texts = F.transform(items, J.canonical)
            found.append(_told(path, "repeated", F.size(F.array_distinct(texts)) < F.size(texts)))
        inner = schema["items"]
        at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        found.append(F.flatten(F.transform(items, lambda x, i: violations(inner, x, at(i)))))
    elif kind == "object":
        fields = v.try_cast("map<string,variant>")
        own = schema.get("properties", {})
        names = F.array(*[F.lit(n) for n in own]) if own else F.array().cast("array<string>")
        for name in schema.get("required", []):
            found.append(_told(_below(path, F.lit(name)), "missing", ~F.map_contains_key(fields, name)))
        rest = F.map_filter(fields, lambda k, _: ~F.array_contains(names, k)) if own else fields
        more = schema.get("additionalProperties", True)
        if more is False:
            found.append(F.transform(F.array_sort(F.map_keys(rest)), lambda k: F.concat(_below(path, k), F.lit(":extra"))))
        elif isinstance(more, dict):
            entries = F.array_sort(F.transform(F.map_entries(F.transform_values(rest, lambda k, x: violations(more, x, _below(path, k)))), lambda e: F.struct(e["key"], e["value"])))
            found.append(F.flatten(F.transform(entries, lambda e: e["value"])))
        for name, s in own.items():
            none = F.array().cast("array<string>")
            found.append(F.when(F.map_contains_key(fields, name), violations(s, F.element_at(fields, F.lit(name)), _below(path, F.lit(name)))).otherwise(none))
    bad = F.array(F.concat(path, F.lit(":type")))
    if not found:
        return F.when(right, F.array().cast("array<string>")).otherwise(bad)
    return F.when(right, F.concat(*found) if len(found) > 1 else found[0]).otherwise(bad)


def check(rows: DataFrame, schema: Schema, answer: str = "answer", out: str = "violations") -> DataFrame:
    """rows with what keeps each answer (JSON text) from the schema; text that is not one JSON value has ``:json``."""
    parsed = rows.withColumn("_schema_value", J.value(F.col(answer)))
    v = F.col("_schema_value")
    told = F.when(~J.is_json(F.col(answer)), F.array(F.lit(":json"))).otherwise(violations(schema, v))
    return parsed.withColumn(out, told).drop("_schema_value")


def typed(rows: DataFrame, schema: Schema, answer: str = "answer", out: str = "value") -> DataFrame:
    """rows with their answers as a Spark value of the schema's type; null where the answer breaks the schema."""
    checked = check(rows, schema, answer, "_schema_found")
    value = F.when(F.size("_schema_found") == 0, F.from_json(F.col(answer), ddl(schema)))
    return checked.withColumn(out, value).drop("_schema_found")
