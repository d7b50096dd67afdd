"""A store of documents as a Spark data source: exactly named files, written by tasks and made visible by the driver's commit.

``df.write.format("documents").mode("append").save(folder)`` takes path and json, and perhaps piece: then rows of one path that follow
each other are its pieces, and a document may be larger than any memory. Each task attempt writes below a hidden folder of
its own and sends that folder's name; the commit notes the folders of the attempts that count and moves their files into place,
each replacing what had its name in one step. Attempts that were killed or lost are never noted, so their files are never seen; an
aborted job leaves nothing. ``spark.read.format("documents").load(folder)`` gives the visible documents as path and json.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from lectern.sources.conf import safe_path

SCHEMA = "path string, json string"
#: Where jobs keep what isn't visible yet, and bytes of files that a task reads, about.
HIDDEN, READ = ".staging-", 32 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is a local one."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:/") else (fs.LocalFileSystem(), os.path.abspath(uri))


def visible(store: fs.FileSystem, base: str, suffix: str = ".json") -> list[fs.FileInfo]:
    """The documents below a folder, by path; what hidden folders hold is none."""
    found = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    inside = lambda x: posixpath.relpath(x.path, base)
    return sorted((x for x in found if x.type == fs.FileType.File and x.path.endswith(suffix) and not any(p.startswith(".") for p in inside(x).split("/"))), key=lambda x: x.path)


@dataclass
class Staged(WriterCommitMessage):
    """What a task attempt has written: its folder, how many documents and bytes."""

    folder: str
    documents: int
    size: int


class DocumentsWriter(DataSourceWriter):
    def __init__(self, folder: str, ceiling: int, columns: list[str], suffix: str = ".json"):
        if not {"path", "json"} <= set(columns):
            raise ValueError("documents have the columns path and json")
        self.folder, self.ceiling, self.suffix, self.job = folder, ceiling, suffix, HIDDEN + uuid.uuid4().hex
        self.at = columns.index("path"), columns.index("json"), columns.index("piece") if "piece" in columns else None

    def write(self, rows: Iterator[Row]) -> Staged:
        store, base = opened(self.folder)
        task = TaskContext.get()
        attempt = f"{task.partitionId()}-{task.taskAttemptId()}" if task else uuid.uuid4().hex
        here, seen, total = posixpath.join(base, self.job, attempt), set(), 0
        for path, parts in self._documents(rows):
            if not path.endswith(self.suffix) or any(x.startswith(".") for x in path.split("/")) or path in seen:
                raise ValueError(f"{path} is written twice, hidden, or no {self.suffix}")
            target, size = posixpath.join(here, path), 0
            store.create_dir(posixpath.dirname(target), recursive=True)
            with store.open_output_stream(target) as out:
                for data in parts:
                    size += len(data)
                    if self.ceiling and size > self.ceiling:
                        raise ValueError(f"{path} has {size} bytes or more, over the ceiling of {self.ceiling}")
                    out.write(data)
            seen.add(path)
            total += size
        return Staged(attempt, len(seen), total)

    def _documents(self, rows: Iterator[Row]) -> Iterator[tuple[str, Iterator[bytes]]]:
        """Each path with its pieces, which must rise; without the column piece, a row is a document."""
        path, text, piece = self.at
        if piece is None:
            yield from ((safe_path(row[path]), iter([row[text].encode()])) for row in rows)
            return
        for name, parts in groupby(rows, lambda row: row[path]):

            def rising(parts=parts, name=name):
                last = None
                for row in parts:
                    if last is not None and row[piece] <= last:
                        raise ValueError(f"pieces of {name} are out of order")
                    last = row[piece]
                    yield row[text].encode()

            yield safe_path(name), rising()

    def commit(self, messages: list[Staged | None]) -> None:
        """The note is the point of no return: a commit that is cut short after it is finished by ``recover``."""
        store, base = opened(self.folder)
        attempts = [x.folder for x in messages if x is not None and x.documents]
        top = posixpath.join(base, self.job)
        if attempts:
            paths = [posixpath.relpath(x.path, posixpath.join(top, a)) for a in attempts for x in visible(store, posixpath.join(top, a), "")]
            if len(set(paths)) < len(paths):
                store.delete_dir(top)
                raise ValueError("two tasks wrote one path")
            with store.open_output_stream(posixpath.join(top, "commit.part")) as out:
                out.write(json.dumps(attempts).encode())
            store.move(posixpath.join(top, "commit.part"), posixpath.join(top, "commit"))
            promoted(store, base, self.job)
        elif store.get_file_info(top).type != fs.FileType.NotFound:
            store.delete_dir(top)

    def abort(self, messages: list[Staged | None]) -> None:
        store, base = opened(self.folder)
        if store.get_file_info(posixpath.join(base, self.job)).type != fs.FileType.NotFound:
            store.delete_dir(posixpath.join(base, self.job))


def promoted(store: fs.FileSystem, base: str, job: str) -> None:
    """Moves what a job's note names into place, some files at once, then drops the job's folder. Doing so again is harmless."""
    top = posixpath.join(base, job)
    with store.open_input_stream(posixpath.join(top, "commit")) as note:
        attempts = json.loads(note.read())

    def move(source: str, target: str) -> None:
        store.create_dir(posixpath.dirname(target), recursive=True)
        store.move(source, target)

    with ThreadPoolExecutor(16) as pool:
        for attempt in attempts:
            here = posixpath.join(top, attempt)
            list(pool.map(lambda x, here=here: move(x.path, posixpath.join(base, posixpath.relpath(x.path, here))), visible(store, here, "")))
    store.delete_dir(top)


def recover(folder: str) -> None:
    """Finishes commits that were cut short, and drops the folders of jobs that never came to one. For when no job is writing."""
    store, base = opened(folder)
    for x in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        if x.type == fs.FileType.Directory and x.base_name.startswith(HIDDEN):
            if store.get_file_info(posixpath.join(x.path, "commit")).type == fs.FileType.File:
                promoted(store, base, x.base_name)
            else:
                store.delete_dir(x.path)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class DocumentsReader(DataSourceReader):
    def __init__(self, folder: str, suffix: str = ".json"):
        self.folder, self.suffix = folder, suffix

    def partitions(self) -> list[Files]:
        """Files by path, some READ bytes together."""
        store, base = opened(self.folder)
        parts, held = [[]], 0
        for x in visible(store, base, self.suffix):
            if parts[-1] and held + x.size > READ:
                parts, held = [*parts, []], 0
            parts[-1].append(posixpath.relpath(x.path, base))
            held += x.size
        return [Files(x) for x in parts]

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        store, base = opened(self.folder)
        for path in partition.paths:
            with store.open_input_stream(posixpath.join(base, path)) as one:
                yield path, one.read().decode()


class Documents(DataSource):
    """Options: path, the folder; ceiling, bytes of a document at most (0: any); suffix, what names of documents end with."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DocumentsReader:
        return DocumentsReader(self.options["path"], self.options.get("suffix", ".json"))

    def writer(self, schema: StructType, overwrite: bool) -> DocumentsWriter:
        if overwrite:
            raise ValueError("documents are replaced one by one: use mode append")
        return DocumentsWriter(self.options["path"], int(self.options.get("ceiling", 0)), schema.names, self.options.get("suffix", ".json"))


def write_documents(documents: DataFrame, folder: str, ceiling: int = 0, suffix: str = ".json") -> None:
    """Publishes (path, json) or (path, piece, json), all or none; each replaces the document of its name."""
    if "piece" in documents.columns:
        documents = documents.repartition("path").sortWithinPartitions("path", "piece")
    documents.sparkSession.dataSource.register(Documents)
    documents.write.format("documents").option("ceiling", ceiling).option("suffix", suffix).mode("append").save(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """path and json of the visible documents."""
    spark.dataSource.register(Documents)
    return spark.read.format("documents").load(folder)
