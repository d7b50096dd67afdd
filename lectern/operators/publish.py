"""Sinks: documents as exactly named files, staged by tasks and promoted at the end, with a manifest of their digests."""

from __future__ import annotations

import hashlib
import os
import posixpath
import re
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.render import member_lines, stable_json

#: Bytes of a document at most (0: any), and above which it is worth a word.
CEILING, WARNING = 95 << 20, 50 << 20


def render(rows: DataFrame, path: Column, document: Column, ceiling: int = CEILING) -> DataFrame:
    """(path, json, size): a document a row, as stable JSON. One over the ceiling is an error that names its path."""
    fields = rows.select(path.alias("path"), F.to_json(document, {"ignoreNullFields": "false"}).alias("compact"))

    def pretty(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for batch in batches:
            texts = [stable_json(json.loads(x)) for x in batch["compact"]]
            sizes = [len(x.encode()) for x in texts]
            for name, size in zip(batch["path"], sizes, strict=True):
                if ceiling and size > ceiling:
                    raise ValueError(f"{name} has {size} bytes, over the ceiling of {ceiling}")
            yield pd.DataFrame({"path": batch["path"], "json": texts, "size": sizes})

    return fields.mapInPandas(pretty, "path string, json string, size long")


def oversized(documents: DataFrame, limit: int = WARNING) -> DataFrame:
    return documents.where(F.col("size") > limit).select("path", "size")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), os.path.abspath(uri))


def stage(documents: DataFrame, folder: str) -> DataFrame:
    """Writes each (path, json) below a staging folder next to ``folder`` and returns the manifest (path, sha256, size).

    A task writes a file under another name and moves it into place, so one that is run again only writes the same
    bytes again. Nothing is visible in ``folder`` before ``promote``.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(folder)
        for batch in batches:
            digests = []
            for path, text in zip(batch["path"], batch["json"], strict=True):
                data, target = text.encode(), posixpath.join(base, path)
                store.create_dir(posixpath.dirname(target), recursive=True)
                part = f"{target}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(data)
                store.move(part, target)
                digests.append((path, hashlib.sha256(data).hexdigest(), len(data)))
            yield pd.DataFrame(digests, columns=["path", "sha256", "size"])

    return documents.select("path", "json").mapInPandas(write, "path string, sha256 string, size long")


def promote(staged: str, live: str) -> None:
    """Swaps a staged local tree in: the live one steps aside, and comes back if the swap fails."""
    for path in (staged, live):
        if os.path.islink(path) or not re.fullmatch(r"[A-Za-z0-9._-]+", os.path.basename(path.rstrip("/"))):
            raise ValueError(f"{path} is a link or has no plain name")
    old = f"{live}.previous"
    if os.path.isdir(old):
        shutil.rmtree(old)
    if os.path.isdir(live):
        os.rename(live, old)
    try:
        os.rename(staged, live)
    except OSError:
        if os.path.isdir(old):
            os.rename(old, live)
        raise
    shutil.rmtree(old, ignore_errors=True)


def reset_folder(path: str, boundary: str) -> None:
    """An empty folder strictly below the boundary; never through a link."""
    real, edge = os.path.realpath(path), os.path.realpath(boundary)
    if os.path.islink(path) or os.path.commonpath([real, edge]) != edge or real == edge:
        raise ValueError(f"{path} isn't strictly below {boundary}")
    shutil.rmtree(real, ignore_errors=True)
    os.makedirs(real)


def tree_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of every .json below a folder, read by Spark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(folder)
    base = _store(folder)[1].rstrip("/") + "/"
    return files.select(F.substring_index("path", base, -1).alias("path"), F.sha2("content", 256).alias("sha256"))


def manifest_order() -> Column:
    """Paths compare part by part: a folder's files come before a file of its name with an ending."""
    return F.split("path", "/")


def write_composed(folder: str, path: str, header: dict, member: str, sources: list[str]) -> int:
    """A document whose array ``member`` holds the documents at ``sources``, copied line by line; returns its size.

    Only one member is in memory at a time, so a whole module needs no more room than its largest document.
    """
    store, base = _store(folder)
    target = posixpath.join(base, path)
    part, mark, size = f"{target}.{uuid.uuid4().hex}.part", uuid.uuid4().hex, 0

    def text() -> Iterator[str]:
        """The document as it is with one member in the array, or none; then each source in that member's place."""
        before, *after = stable_json({**header, member: [mark] if sources else []}).split(f'"{mark}"')
        yield before
        for k, source in enumerate(sources):
            with store.open_input_stream(posixpath.join(base, source)) as one:
                lines = member_lines(one.read().decode()).lstrip(" ")
            yield f",\n    {lines}" if k else lines
        yield from after

    with store.open_output_stream(part) as out:
        for data in map(str.encode, text()):
            out.write(data)
            size += len(data)
    store.move(part, target)
    return size
