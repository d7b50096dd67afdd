"""WARC archives with an index written first: sorted byte ranges are read back in few, coalesced requests."""

from __future__ import annotations

import gzip
import hashlib
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import read, scratch, small_batches, written

#: Payloads of fewer bytes are never revisits.
LEAST = 100
#: Ranges that lie no further apart are read at once, and at most so many bytes at once.
GAP, AT_ONCE = 64 << 10, 8 << 20
#: Tasks that read records, at most.
TASKS = 1 << 16
INDEX = "page_id long, url string, file string, offset long, length long, digest string, record_type string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_id(page: int | None, digest: str) -> str:
    """The same for the same page and payload, so that a revisit can name the record that it refers to."""
    return f"<{(uuid.uuid4() if page is None else uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest}')).urn}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, revisit: bool) -> bytes:
    """One record, uncompressed. A revisit holds the size and digest of the payload that it refers to, not the payload."""
    clean = "".join(x for x in url or "" if x not in "\r\n")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}", f"X-Page: {'' if page is None else page}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers, digest)}", f"X-Refers-To-Page: {refers}"]
    body = b"" if revisit else payload
    head += ["Content-Type: application/octet-stream", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one compressed record, its payload included; a response's size and digest are checked."""
    whole = gzip.decompress(raw)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    named = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[: int(named["Content-Length"])]
    revisit = named["WARC-Type"] == "revisit"
    digest = named["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (hashlib.sha256(body).hexdigest() != digest or len(body) != int(named["X-Payload-Length"])):
        raise ValueError(f"payload of page {named['X-Page']} doesn't match its digest")
    page, refers = named["X-Page"], named.get("X-Refers-To-Page")
    return {
        "page_id": int(page) if page else None, "url": named["WARC-Target-URI"], "payload_bytes": int(named["X-Payload-Length"]), "payload_digest": digest,
        "record_type": named["WARC-Type"], "refers_to": int(refers) if refers else None, "payload": None if revisit else body,
    }


def with_first(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, digest and first_page: the smallest page_id among equal payloads of ``least`` bytes or
    more, null where a payload is shorter or has no equal. Only digests and ids are grouped, never payloads; the join
    on a digest that many pages share is one that Spark can split."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= least)
    firsts = written(long.groupBy("digest").agg(F.min("page_id").alias("first_page"), F.count("*").alias("n")).where("n > 1").select("digest", "first_page"), "firsts")
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", "first_page")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record a page into ``folder`` and returns the index: a row a record with its file, offset, length,
    url and digest.

    ``folder`` is a URI that pyarrow can open on every executor (file, hdfs, s3, gs). A record is a gzip member of
    its own, so that any byte range of the index is readable by itself. A task writes a file of its own name; the
    index, written as Parquet, names only files of tasks that ended, so a task that is run again leaves no trace in it.
    """
    rows = with_first(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                index: dict[str, list] = {x: [] for x in ("page_id", "url", "file", "offset", "length", "digest", "record_type")}
                for page, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    revisit = first is not None and page != first
                    raw = gzip.compress(record(page, url, payload, digest, first, revisit), 1, mtime=0)
                    out = out or fs.open_output_stream(posixpath.join(base, name), compression=None)
                    out.write(raw)
                    row = (page, url, name, at, len(raw), digest, "revisit" if revisit else "response")
                    for values, value in zip(index.values(), row, strict=True):
                        values.append(value)
                    at += len(raw)
                if index["file"]:
                    types = {"page_id": pa.int64(), "offset": pa.int64(), "length": pa.int64()}
                    yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.string())) for k, v in index.items()], list(index))
        finally:
            if out:
                out.close()

    small_batches(pages.sparkSession, 500)
    return written(rows.mapInArrow(write, INDEX), "index")


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Coalesces sorted (file, offset, length) into reads: file, start, end and the ranges inside."""
    held: list[tuple[int, int]] = []
    file, start, end = "", 0, 0
    for name, at, size in rows:
        if held and (name != file or at - end > GAP or max(end, at + size) - start > AT_ONCE):
            yield file, start, end, held
            held = []
        if not held:
            file, start, end = name, at, at
        held.append((at, size))
        end = max(end, at + size)
    if held:
        yield file, start, end, held


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the index's rows (all, or those that the caller selected), each read by its byte range.

    Rows are dealt by file and sorted by offset, so neighbours share a read. Payload is null for revisits, and for
    all where ``payloads`` is false; sizes and digests are those of the full payload either way.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        opened: tuple[str, pa.NativeFile] | None = None
        for batch in batches:
            wanted = list(zip(*(batch.column(x).to_pylist() for x in ("file", "offset", "length")), strict=True))
            for name, start, end, inside in ranges(wanted):
                if opened is None or opened[0] != name:
                    if opened:
                        opened[1].close()
                    opened = (name, fs.open_input_file(posixpath.join(base, name)))
                raw = opened[1].read_at(end - start, start)
                found = [parse(raw[at - start : at - start + size]) for at, size in inside]
                if not payloads:
                    for x in found:
                        x["payload"] = None
                yield pa.RecordBatch.from_pylist(found, schema)
        if opened:
            opened[1].close()

    long, text = pa.int64(), pa.string()
    schema = pa.schema([("page_id", long), ("url", text), ("payload_bytes", long), ("payload_digest", text), ("record_type", text), ("refers_to", long), ("payload", pa.binary())])
    slices = F.floor(F.col("offset") / AT_ONCE)  # a file's far parts may go to other tasks
    # A row of the index is small whatever it stands for, so the number of tasks comes from the bytes to be read.
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = min(1 + int(total) // AT_ONCE, TASKS)
    spread = index.select("file", "offset", "length").repartition(tasks, F.col("file"), slices).sortWithinPartitions("file", "offset")
    return spread.mapInArrow(load, RECORD)


def archive_pages(pages: DataFrame, folder: str | None = None, payloads: bool = False) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as WARC records and reads them back: a row a page with page_id, url,
    payload_bytes, payload_digest, record_type, refers_to and payload.

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of at least 100 bytes, those with
    the smallest page_id are responses (several where rows repeat it) and the others revisit it; a null page_id is
    never the smallest, and where all are null each is a response. Line breaks in a url are left out; a null url reads
    back empty. Extra columns are ignored; an empty table gives an empty result.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder, payloads)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_pages(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH rows AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), sized AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM rows
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_page FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_page IS NOT NULL AND page_id IS DISTINCT FROM first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_page IS NOT NULL AND page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM firsts
"""
