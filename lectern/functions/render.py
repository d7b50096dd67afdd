"""Documents as published: stable JSON, two spaces deep, members in their order, absent ones left out."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

#: Members that are published as null rather than left out.
KEPT_NULLS = ("strong_prefix",)


def bare(value: object) -> object:
    """Without null members, but for KEPT_NULLS."""
    if isinstance(value, dict):
        return {k: bare(v) for k, v in value.items() if v is not None or k in KEPT_NULLS}
    if isinstance(value, (list, tuple)):
        return [bare(x) for x in value]
    return value


def stable_json(value: object) -> str:
    return json.dumps(bare(value), ensure_ascii=False, indent=2) + "\n"


def member_lines(document: str) -> str:
    """A document as a member of an array in another: indented four more."""
    return "\n".join("    " + line if line else line for line in document.rstrip("\n").split("\n"))


def _members(value: Column, kind: StructType, one: Callable[[Column, StructField], Column]) -> Column:
    """The sum of ``one`` over the members that are shown."""
    shown = [F.lit(True) if f.name in KEPT_NULLS else value[f.name].isNotNull() for f in kind.fields]
    return sum((F.when(here, one(value[f.name], f)).otherwise(0) for here, f in zip(shown, kind.fields, strict=True)), F.lit(0).cast("long"))


def _elements(value: Column, one: Callable[[Column], Column]) -> Column:
    return F.aggregate(value, F.lit(0).cast("long"), lambda a, x: a + one(x))


def pretty_bytes(value: Column, kind: DataType, depth: int = 0) -> Column:
    """Bytes of a value as ``stable_json`` shows it ``depth`` levels deep, without the last line's end: sizes are known from columns, before
    anything is rendered. Kinds: structs, arrays, strings, whole numbers and booleans; a null one is ``null``.
    """
    indent = 2 * (depth + 1)
    framed = lambda parts, count: F.when(count == 0, 2).otherwise(2 + parts + 2 * (count - 1) + 1 + 2 * depth + 1)  # noqa: E731  brackets on lines of their own, a comma and an end of line between two
    if isinstance(kind, StructType):
        member = lambda x, f: pretty_bytes(x, f.dataType, depth + 1) + indent + len(f.name.encode()) + 4  # noqa: E731  quotes, colon and blank
        size = framed(_members(value, kind, member), _members(value, kind, lambda *_: F.lit(1)))
    elif isinstance(kind, ArrayType):
        size = framed(_elements(value, lambda x: pretty_bytes(x, kind.elementType, depth + 1) + indent), F.size(value))
    elif isinstance(kind, StringType):
        size = F.octet_length(F.to_json(F.struct(value.alias("x")))) - 6
    else:
        size = F.octet_length(value.cast("string"))
    return F.when(value.isNull(), 4).otherwise(size).cast("long")


def pretty_lines(value: Column, kind: DataType) -> Column:
    """Lines of the same."""
    if isinstance(kind, StructType):
        inside = _members(value, kind, lambda x, f: pretty_lines(x, f.dataType))
    elif isinstance(kind, ArrayType):
        inside = _elements(value, lambda x: pretty_lines(x, kind.elementType))
    else:
        return F.lit(1).cast("long")
    return F.when(value.isNull() | (inside == 0), 1).otherwise(inside + 2).cast("long")


def megabytes(size: int) -> str:
    return f"{size / (1 << 20):.2f} MB"
