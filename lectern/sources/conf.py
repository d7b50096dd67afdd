"""Module descriptors: configuration text parsed into a multimap, read from an archive or a folder of files."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import fold_col
from lectern.operators.policy import last_value, module_kind

#: Bytes of one configuration and of all of an archive, and members of an archive, at most.
ONE, ALL, MEMBERS = 4 << 20, 64 << 20, 100_000
MODULE = "name string, fields map<string,array<string>>, conf_path string"


def safe_path(path: str) -> str:
    """A relative path with forward slashes; absolute, empty and upward ones are errors."""
    clean = path.replace("\\", "/")
    parts = [x for x in clean.split("/") if x not in ("", ".")]
    if clean.startswith("/") or not parts or ".." in parts or (len(parts[0]) == 2 and parts[0][1] == ":"):
        raise ValueError(f"unsafe path in archive: {path!r}")
    return "/".join(parts)


def parse_conf(text: str, path: str = "") -> tuple[str, dict[str, list[str]]]:
    """The section's name (the last one's, if there are several) and the values of each folded key, in order.

    Blank lines and comments are skipped anywhere. An indented line is no field. A value that ends in a backslash
    goes on in the next line, joined by a space.
    """
    name, fields, open_key = "", {}, ""
    for line in text.removeprefix("﻿").splitlines():
        body = line.strip()
        if not body or body[0] in "#;":
            continue
        if open_key:
            more = body.endswith("\\")
            fields[open_key][-1] = (fields[open_key][-1] + " " + body.rstrip("\\").strip()).strip()
            open_key = open_key if more else ""
        elif body[0] == "[" and body[-1] == "]":
            name = body[1:-1].strip()
        elif "=" in body and not line[0].isspace():
            key, value = (x.strip() for x in body.split("=", 1))
            key, more = key.casefold(), value.endswith("\\")
            fields.setdefault(key, []).append(value.rstrip("\\").strip())
            open_key = key if more else ""
    if not name:
        raise ValueError(f"no section in {path or 'configuration'}")
    return name, fields


def conf_members(data: bytes) -> Iterator[tuple[str, str]]:
    """(path, text) of the regular .conf files of a gzip tar; the limits hold before anything is given out."""
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:gz") as archive:
        total = 0
        for count, member in enumerate(archive):
            path = safe_path(member.name)
            if count >= MEMBERS:
                raise ValueError(f"over {MEMBERS} members in archive")
            if not member.isfile() or not path.lower().endswith(".conf"):
                continue
            total += member.size
            if member.size > ONE or total > ALL:
                raise ValueError(f"{path} exceeds the size limits")
            yield path, archive.extractfile(member).read().decode("utf-8", "replace")


def _modules(found: Iterator[tuple[str, str]]) -> pd.DataFrame:
    rows = [(*parse_conf(text, path), path) for path, text in found]
    return pd.DataFrame(rows, columns=["name", "fields", "conf_path"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """name, fields and conf_path of each module in the gzip tars at ``path``; an archive is bounded, and a task's."""

    def untar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                yield _modules(conf_members(data))

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(untar, MODULE)


def read_confs(spark: SparkSession, path: str) -> DataFrame:
    """The same of a folder of .conf files."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _modules(zip(batch["path"], (x.decode("utf-8", "replace") for x in batch["content"]), strict=True))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][oO][nN][fF]").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(parse, MODULE)


def described(modules: DataFrame) -> DataFrame:
    """Adds the columns that the policy and the publisher use: description (else the name), language (else und), and so on."""
    get = lambda name, default="": last_value(F.col("fields"), name, default)
    rows = modules.withColumns({
        "description": F.coalesce(F.nullif(get("description"), F.lit("")), F.col("name")), "language": F.lower(F.coalesce(F.nullif(get("lang"), F.lit("")), F.lit("und"))),
        "driver": get("moddrv"), "category": get("category"), "license": get("distributionlicense"), "version": get("version"),
    })
    kind = module_kind(F.col("driver"), F.col("category"), get("modtype"))
    return rows.withColumn("kind", kind).withColumn("license_key", fold_col(F.trim(F.regexp_replace("license", r"(?U)\s+", " "))))
