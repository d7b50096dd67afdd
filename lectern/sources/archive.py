"""Packages and extractor processes as sources: zip members with limits, and the checked output of a command a row."""

from __future__ import annotations

import io
import json
import stat
import subprocess
import tempfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from lectern.sources.conf import MEMBERS, safe_path
from lectern.sources.ndjson import LINE, ROW, Stream

#: Bytes that a package may declare for all of its members.
DECLARED = 4 << 30


def zip_members(data: bytes) -> Iterator[tuple[str, bytes]]:
    """(path, content) of a package's files. All members are checked before the first is given out: safe paths, no
    links, a bounded number and declared size."""
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        members = package.infolist()
        if len(members) > MEMBERS or sum(x.file_size for x in members) > DECLARED:
            raise ValueError("package exceeds the limits")
        for member in members:
            safe_path(member.filename)
            if stat.S_ISLNK(member.external_attr >> 16):
                raise ValueError(f"link in package: {member.filename}")
        for member in members:
            if not member.is_dir():
                yield safe_path(member.filename), package.read(member)


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """package, path and content of the files in the zip packages at ``path``."""

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for package, data in zip(batch["path"], batch["content"], strict=True):
                for name, content in zip_members(data):
                    yield pd.DataFrame({"package": [package], "path": [name], "content": [content]})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInPandas(unzip, "package string, path string, content binary")


def changed_packages(packages: DataFrame, stamps: DataFrame) -> DataFrame:
    """Packages (name, stamp) whose stamp isn't the one that was seen last: the only ones to read again."""
    return packages.join(stamps, ["name", "stamp"], "left_anti")


def run_extractors(commands: DataFrame) -> DataFrame:
    """``commands``: name and argv (an array). The records that each command prints, checked as a stream line by line; a
    broken stream kills the command, and a command that fails or a stream without an end fails the task with its errors.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, argv in zip(batch["name"], batch["argv"], strict=True):
                with tempfile.TemporaryFile() as errors, subprocess.Popen(list(argv), stdout=subprocess.PIPE, stderr=errors) as process:
                    stream, rows = Stream(), []
                    try:
                        while line := process.stdout.readline(LINE + 1):
                            record = stream.take(line)
                            rows.append((name, record["sequence"], record["type"], json.dumps(record, ensure_ascii=False)))
                            if len(rows) == 1000:
                                yield pd.DataFrame(rows, columns=["file", "sequence", "type", "record"])
                                rows = []
                    except ValueError:
                        process.kill()
                        raise
                    if process.wait():
                        errors.seek(0)
                        raise RuntimeError(f"{name}: command ended with {process.returncode}: {errors.read(2000).decode('utf-8', 'replace')}")
                    stream.close()
                    yield pd.DataFrame(rows, columns=["file", "sequence", "type", "record"])

    return commands.select("name", "argv").mapInPandas(run, ROW)
