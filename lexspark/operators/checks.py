"""Checks of JSON entries against a schema, compiled to Column expressions over variants: types, required fields, bounds, nested lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The schema of an entry.
_TEXT = {"type": "string"}
ENTRY_SCHEMA = {
    "type": "object",
    "required": ["lemma", "source", "translations"],
    "properties": {
        "lemma": _TEXT, "source": _TEXT, "pos": _TEXT,
        "morphology": {"type": "object", "properties": {"paradigm": _TEXT}},
        "translations": {
            "type": "array",
            "items": {
                "type": "object",
                "required": ["term", "lang", "confidence", "source"],
                "properties": {"term": _TEXT, "lang": _TEXT, "confidence": {"type": "number", "minimum": 0.0, "maximum": 1.0}, "source": _TEXT},
            },
        },
        "metadata": {"type": "object", "properties": {"source_page": _TEXT}},
    },
}

_KINDS = {"string": "^STRING$", "object": "^OBJECT<", "array": "^ARRAY<", "boolean": "^BOOLEAN$", "null": "^VOID$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$"}
_ERRORS = "array<struct<path: string, problem: string>>"


def _error(path: Column, problem: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(problem).alias("problem")))


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: F.concat(a, b), parts) if parts else F.array().cast(_ERRORS)


def schema_errors(value: Column, schema: dict, path: Column | None = None) -> Column:
    """array<struct<path, problem>> of a variant: what breaks the schema, outer values first; null (no value) breaks nothing.

    Known words: type, required, properties, items, minimum, maximum. Other fields are free. A value of a wrong type is
    not looked into; a JSON null is a value, of type null.
    """
    path = F.lit("") if path is None else path
    none = F.array().cast(_ERRORS)
    at = lambda name: F.when(path == "", F.lit(name)).otherwise(F.concat(path, F.lit(f".{name}")))
    field = lambda name: F.try_variant_get(value, f"$.{name}", "variant")
    checks = [F.when(field(name).isNull(), _error(at(name), "required")).otherwise(none) for name in schema.get("required", [])]
    for word, worse in (("minimum", lambda x, y: x < y), ("maximum", lambda x, y: x > y)):
        if word in schema:
            checks.append(F.when(worse(F.try_variant_get(value, "$", "double"), F.lit(float(schema[word]))), _error(path, word)).otherwise(none))
    checks += [schema_errors(field(name), inner, at(name)) for name, inner in schema.get("properties", {}).items()]
    if "items" in schema:
        items = F.try_variant_get(value, "$", "array<variant>")
        each = F.transform(items, lambda x, i: schema_errors(x, schema["items"], F.concat(path, F.lit("."), i.cast("string"))))
        checks.append(F.coalesce(F.flatten(each), none))
    inner = _all(checks)
    if "type" in schema:
        fits = F.schema_of_variant(value).rlike(_KINDS[schema["type"]])
        inner = F.when(fits, inner).otherwise(_error(path, f"not of type {schema['type']}"))
    return F.when(value.isNull(), none).otherwise(inner)


def entry_errors(entries: DataFrame, json: str = "value", schema: dict = ENTRY_SCHEMA) -> DataFrame:
    """``entries`` with ``errors``; text that is no JSON, null included, has the one problem that it can't be read."""
    return entries.withColumn("_v", F.try_parse_json(json)).withColumn("errors", F.when(F.col("_v").isNull(), _error(F.lit(""), "no JSON")).otherwise(schema_errors(F.col("_v"), schema))).drop("_v")
