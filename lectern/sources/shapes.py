"""Shapes of records: the rules of a schema file, compiled to Spark predicates over VARIANT values.

Rules are those of JSON Schema that bind a value's shape. Each becomes a predicate on one path; a record's faults are
told by the first path that breaks a rule. Nothing is parsed in Python, and a record needn't fit any one type.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules that are compiled, in the order in which they are told of one path, and words that bind nothing.
RULES = ("type", "const", "enum", "minLength", "maxLength", "pattern", "minimum", "maximum", "minItems", "maxItems", "uniqueItems", "required", "additionalProperties", "oneOf")
WORDS = ("$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "format", "contentEncoding")
FAULT = "struct<path:array<string>,place:int,rule:string>"


def kind_of(value: Column) -> Column:
    """null, boolean, number, string, array or object."""
    said = F.schema_of_variant(value)
    return (
        F.when(said == "VOID", "null").when(said == "BOOLEAN", "boolean").when(said == "STRING", "string")
        .when(said.startswith("ARRAY"), "array").when(said.startswith("OBJECT"), "object").otherwise("number")
    )


def _as(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _is(value: Column, kind: Column, wanted: str) -> Column:
    if wanted == "integer":  # 1.0 is one
        number = _as(value, "double")
        return (kind == "number") & (number == F.floor(number))
    return kind == wanted


def _equal(value: Column, kind: Column, wanted: object) -> Column:
    """Strings, numbers, booleans and null; true is not 1."""
    if wanted is None:
        return kind == "null"
    if isinstance(wanted, bool):
        return (kind == "boolean") & (_as(value, "boolean") == wanted)
    if isinstance(wanted, str):
        return (kind == "string") & (_as(value, "string") == wanted)
    if isinstance(wanted, (int, float)):
        return (kind == "number") & (_as(value, "double") == float(wanted))
    raise ValueError(f"only plain values can be told apart: {wanted!r}")


class Shape:
    """A compiled schema; ``fault`` of a VARIANT column is its first fault, or null."""

    def __init__(self, schema: dict | bool):
        self.schema = schema

    def fault(self, value: Column) -> Column:
        return self._first(self.schema, value, F.array().cast("array<string>"))

    def _resolved(self, schema: dict) -> dict:
        """What a reference inside the file names."""
        found = self.schema
        for step in schema["$ref"].removeprefix("#/").split("/"):
            found = found[step]
        return found

    def _first(self, schema: dict | bool, value: Column, path: Column) -> Column:
        faults = self._faults(schema, value, path)
        return F.array_min(F.array(*faults)) if faults else F.lit(None).cast(FAULT)

    def _faults(self, schema: dict | bool, value: Column, path: Column) -> list[Column]:
        if isinstance(schema, bool):
            return [] if schema else [self._told(F.lit(True), path, "type")]
        unknown = set(schema) - set(RULES) - set(WORDS) - {"$ref", "allOf", "properties", "items"}
        if unknown:
            raise ValueError(f"no such rule: {', '.join(sorted(unknown))}")
        kind = kind_of(value)
        found = self._faults(self._resolved(schema), value, path) if "$ref" in schema else []
        for part in schema.get("allOf", []):
            found += self._faults(part, value, path)
        found += [self._told(self._broken(rule, schema, value, kind), path, rule) for rule in RULES if rule in schema and not (rule == "additionalProperties" and schema[rule] is True) and not (rule == "uniqueItems" and not schema[rule])]
        for name, inner in schema.get("properties", {}).items():
            member = self._member(value, name)
            found.append(F.when((kind == "object") & member.isNotNull(), self._first(inner, member, F.concat(path, F.array(F.lit(name))))))
        if isinstance(rest := schema.get("additionalProperties"), dict):
            other = F.map_filter(_as(value, "map<string,variant>"), lambda k, _: ~k.isin(list(schema.get("properties", {}))))
            found.append(F.array_min(F.transform(F.map_entries(other), lambda x: self._first(rest, x["value"], F.concat(path, F.array(x["key"]))))))
        if "items" in schema:
            at = lambda i: F.concat(path, F.array(F.lpad(i.cast("string"), 10, "0")))  # noqa: E731  places sort as numbers
            found.append(F.array_min(F.transform(_as(value, "array<variant>"), lambda x, i: self._first(schema["items"], x, at(i)))))
        return found

    def _told(self, broken: Column, path: Column, rule: str) -> Column:
        return F.when(broken, F.struct(path.alias("path"), F.lit(RULES.index(rule)).alias("place"), F.lit(rule).alias("rule")))

    def _member(self, value: Column, name: str) -> Column:
        if "'" in name or "\\" in name:
            raise ValueError(f"a member's name can't be a path: {name!r}")
        return F.try_variant_get(value, f"$['{name}']", "variant")

    def _broken(self, rule: str, schema: dict, value: Column, kind: Column) -> Column:
        """Whether the value breaks one rule. Rules on lengths, bounds and members bind only values of their kind."""
        wanted, text, number = schema[rule], _as(value, "string"), _as(value, "double")
        items, members = _as(value, "array<variant>"), _as(value, "map<string,variant>")
        if rule == "type":
            return ~any_of(_is(value, kind, x) for x in ([wanted] if isinstance(wanted, str) else wanted))
        if rule in ("const", "enum"):
            return ~any_of(_equal(value, kind, x) for x in ([wanted] if rule == "const" else wanted))
        if rule == "oneOf":
            return sum((self._first(x, value, F.array().cast("array<string>")).isNull().cast("int") for x in wanted), F.lit(0)) != 1
        if rule == "required":
            return (kind == "object") & any_of(self._member(value, x).isNull() for x in wanted)
        if rule == "additionalProperties":
            return F.lit(False) if isinstance(wanted, dict) else F.coalesce(F.exists(F.map_keys(members), lambda k: ~k.isin(list(schema.get("properties", {})))), F.lit(False))
        checks = {
            "minLength": (kind == "string") & (F.length(text) < wanted), "maxLength": (kind == "string") & (F.length(text) > wanted), "pattern": (kind == "string") & ~text.rlike(str(wanted)),
            "minimum": (kind == "number") & (number < wanted), "maximum": (kind == "number") & (number > wanted), "minItems": (kind == "array") & (F.size(items) < wanted), "maxItems": (kind == "array") & (F.size(items) > wanted),
            "uniqueItems": (kind == "array") & (F.size(F.array_distinct(F.transform(items, lambda x: F.to_json(x)))) < F.size(items)),
        }
        return checks[rule]


def any_of(conditions) -> Column:
    found = F.lit(False)
    for x in conditions:
        found = found | F.coalesce(x, F.lit(False))
    return found


def read_schema(spark: SparkSession, path: str) -> dict:
    """A schema file, by whatever store Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def shape_faults(records: DataFrame, schemas: dict[str, dict], record: str = "record", kind: str = "type") -> DataFrame:
    """``records`` plus path and rule, null where a record has the shape of its kind.

    ``record`` is a column of JSON text, ``kind`` the column that names one of ``schemas``; a kind without one breaks rule
    ``type`` at the root, and so does text that is no JSON. The path is the first, in the order of its steps, that breaks a rule,
    dots between the steps (``record`` for the root); of the rules of one path the first in RULES is told. Null records
    are no JSON. Extra columns stay; those named path or rule are replaced.
    """
    value = F.try_parse_json(F.col(record))
    root = F.struct(F.array().cast("array<string>").alias("path"), F.lit(0).alias("place"), F.lit("type").alias("rule"))
    fault = F.when(F.col("_value").isNull() | ~F.coalesce(F.col(kind).isin(list(schemas)), F.lit(False)), root)
    for name, schema in schemas.items():
        fault = fault.when(F.col(kind) == name, Shape(schema).fault(F.col("_value")))
    steps = F.transform("_fault.path", lambda x: F.when(x.rlike("^[0-9]{10}$"), F.regexp_replace(x, "^0{1,9}", "")).otherwise(x))
    found = records.withColumn("_value", value).withColumn("_fault", fault)
    path = F.when(F.col("_fault").isNotNull(), F.when(F.size("_fault.path") == 0, "record").otherwise(F.array_join(steps, ".")))
    return found.withColumn("path", path).withColumn("rule", F.col("_fault.rule")).drop("_value", "_fault")
