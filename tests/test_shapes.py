"""Compiled shapes against a plain checker of the same rules, over random records."""

import json
import random
import re

import pytest

from lectern.sources import shapes

SCHEMA = {
    "$defs": {"value": {"type": "object", "required": ["size", "data"], "properties": {"size": {"type": "integer", "minimum": 0}, "data": {"type": "string", "pattern": "^[a-z]*$"}}, "additionalProperties": False}},
    "allOf": [{"type": "object", "required": ["sequence"], "properties": {"sequence": {"type": "integer", "minimum": 0, "maximum": 9}}}],
    "required": ["kind"],
    "properties": {
        "kind": {"enum": ["a", "b", 1, None]}, "key": {"$ref": "#/$defs/value"}, "list": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"oneOf": [{"type": "string", "minLength": 2}, {"$ref": "#/$defs/value"}]}},
        "flag": {"const": True}, "other": {"type": ["string", "null"], "maxLength": 3}, "more": {"type": "object", "additionalProperties": {"type": "number"}},
    },
}


def kinds(x):
    if x is None:
        return {"null"}
    if isinstance(x, bool):
        return {"boolean"}
    if isinstance(x, (int, float)):
        return {"number", "integer"} if float(x).is_integer() else {"number"}
    return {"string"} if isinstance(x, str) else {"array"} if isinstance(x, list) else {"object"}


def same(a, b):
    return kinds(a) & kinds(b) and a == b


def faults(schema, x, path=()):
    """(path, place of the rule) of every fault, by the rules' own words."""
    if "$ref" in schema:
        yield from faults(SCHEMA["$defs"][schema["$ref"].rsplit("/", 1)[1]], x, path)
    for part in schema.get("allOf", []):
        yield from faults(part, x, path)
    is_string, is_number, is_list, is_object = isinstance(x, str), "number" in kinds(x), isinstance(x, list), isinstance(x, dict)
    wanted = schema.get("type", [])
    broken = {
        "type": wanted and not kinds(x) & set([wanted] if isinstance(wanted, str) else wanted), "const": "const" in schema and not same(x, schema["const"]), "enum": "enum" in schema and not any(same(x, y) for y in schema["enum"]),
        "minLength": is_string and len(x) < schema.get("minLength", 0), "maxLength": is_string and len(x) > schema.get("maxLength", 99), "pattern": is_string and not re.search(schema.get("pattern", ""), x),
        "minimum": is_number and x < schema.get("minimum", x), "maximum": is_number and x > schema.get("maximum", x), "minItems": is_list and len(x) < schema.get("minItems", 0),
        "uniqueItems": is_list and schema.get("uniqueItems") and len({json.dumps(y, sort_keys=True) for y in x}) < len(x), "required": is_object and set(schema.get("required", [])) - set(x),
        "additionalProperties": is_object and schema.get("additionalProperties") is False and set(x) - set(schema["properties"]),
        "oneOf": "oneOf" in schema and sum(not list(faults(y, x)) for y in schema["oneOf"]) != 1,
    }
    yield from ((path, shapes.RULES.index(rule)) for rule, bad in broken.items() if bad)
    if is_object:
        for name, value in x.items():
            if name in schema.get("properties", {}):
                yield from faults(schema["properties"][name], value, (*path, name))
            elif isinstance(schema.get("additionalProperties"), dict):
                yield from faults(schema["additionalProperties"], value, (*path, name))
    if is_list and "items" in schema:
        for k, value in enumerate(x):
            yield from faults(schema["items"], value, (*path, f"{k:010d}"))


def test_random_records(spark):
    rng = random.Random(11)
    plain = [None, True, False, 0, 1, 1.0, -1, 2.5, 12, "", "a", "ab", "abcd", "A"]
    value = lambda: rng.choice([*plain, {"size": rng.choice(plain), "data": rng.choice(plain)}, {"size": 1, "data": "x"}, {"size": 1, "data": "x", "z": 0}, {"size": 2}, [], ["ab"], ["ab", "ab"]])
    rows = []
    for _ in range(1500):
        good = {"sequence": 3, "kind": "a", "key": {"size": 0, "data": "q"}, "list": ["ab", {"size": 1, "data": ""}], "flag": True, "other": None, "more": {"x": 1, "y": 2.5}}
        for name in rng.sample(sorted(good), rng.randint(0, 2)):
            good[name] = rng.choice([value, lambda: [value() for _ in range(rng.randint(0, 12))], lambda: {rng.choice("xyz"): value()}])()
        for name in rng.sample(sorted(good), rng.choice([0, 0, 1, 2])):
            del good[name]
        rows.append(good)
    rows += [None, [], "x", 3]
    wanted = {}
    for k, x in enumerate(rows):
        first = min(faults(SCHEMA, x), default=None)
        wanted[k] = first and (".".join(str(int(p)) if len(p) == 10 else p for p in first[0]) or "record", shapes.RULES[first[1]])
    df = spark.createDataFrame([(k, "r", json.dumps(x), "extra") for k, x in enumerate(rows)], "k long, type string, record string, path string")
    found = shapes.shape_faults(df, {"r": SCHEMA})
    assert found.columns == ["k", "type", "record", "path", "rule"]
    got = {x.k: x.path and (x.path, x.rule) for x in found.collect()}
    assert got == wanted
    assert len({x[1] for x in got.values() if x}) >= 10 and sum(x is None for x in got.values()) > 100


def test_odd_records_and_rules(spark, tmp_path):
    rows = [("{", "r"), (None, "r"), ("{}", "unknown"), ("{}", None), ("{}", "r")]
    found = shapes.shape_faults(spark.createDataFrame(rows, "record string, type string"), {"r": {"type": "object"}})
    assert [(x.path, x.rule) for x in found.collect()] == [("record", "type")] * 4 + [(None, None)]
    with pytest.raises(ValueError, match="no such rule: dependentRequired"):
        shapes.Shape({"dependentRequired": {}}).fault(found["record"])
    (tmp_path / "s.json").write_text(json.dumps(SCHEMA))
    assert shapes.read_schema(spark, str(tmp_path / "s.json")) == SCHEMA
