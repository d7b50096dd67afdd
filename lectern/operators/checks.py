"""Checks on records as tables: ordinals, byte values, counts against a footer, artifacts, manifests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordinal_gaps(rows: DataFrame, scope: list[str], ordinal: str, first: int = 0) -> DataFrame:
    """(scope, rows, gaps): scopes whose ordinals aren't first, first + 1, ... each once. One aggregate, no sort:
    n distinct whole numbers from ``first`` to first + n - 1 leave no gap."""
    n, at = F.count("*"), F.col(ordinal)
    seen = rows.groupBy(*scope).agg(n.alias("rows"), F.count_distinct(at).alias("distinct"), F.min(at).alias("low"), F.max(at).alias("high"))
    broken = (F.col("distinct") != F.col("rows")) | (F.col("low") != first) | (F.col("high") != first + F.col("rows") - 1)
    return seen.withColumn("broken", F.coalesce(broken, F.lit(True)))


def byte_value_fault(value: Column) -> Column:
    """The first rule that a byte value (base64, encoding, sha256, size, utf8) breaks, or null where it holds."""
    raw = F.try_to_binary(value["base64"], F.lit("base64"))
    text = F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
    return (
        F.when(value["base64"].isNull() | value["sha256"].isNull() | value["size"].isNull(), "member missing")
        .when(F.coalesce(value["encoding"] != "base64", F.lit(True)), "encoding").when(raw.isNull(), "base64")
        .when(F.octet_length(raw) != value["size"], "size").when(F.sha2(raw, 256) != F.lower(value["sha256"]), "sha256")
        .when(value["utf8"].isNotNull() & ~F.coalesce(text == value["utf8"], F.lit(False)), "utf8")
    )


def count_mismatches(rows: DataFrame, kind: str, footer: DataFrame) -> DataFrame:
    """Kinds whose count differs from the footer's (kind, expected); either may lack a kind."""
    seen = rows.groupBy(F.col(kind).alias("kind")).agg(F.count("*").alias("seen"))
    both = seen.join(footer, "kind", "full_outer").select("kind", F.coalesce("seen", F.lit(0)).alias("seen"), F.coalesce("expected", F.lit(0)).alias("expected"))
    return both.where("seen <> expected")


def digests(chunks: DataFrame) -> DataFrame:
    """(artifact_id, made): the SHA-256 of each artifact's chunks in the order of their index; a null one adds nothing.

    Spark sorts the chunks within partitions by artifact and index, to disk where need be; a task goes through them a batch at a
    time and carries the digest from one to the next, so an artifact may be larger than a worker's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, made = None, None
        for batch in batches:
            for artifact, data in zip(batch.column("artifact_id").to_pylist(), batch.column("data"), strict=True):
                if made is None or artifact != now:
                    if made is not None:
                        done.append((now, made.hexdigest()))
                    now, made = artifact, hashlib.sha256()
                if data.is_valid:
                    made.update(data.as_buffer())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], batch.schema.field("artifact_id").type), pa.array([x for _, x in done])], ["artifact_id", "made"])
                done = []
            kind = batch.schema.field("artifact_id").type
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([made.hexdigest()])], ["artifact_id", "made"])

    dealt = chunks.select("artifact_id", "index", "data").repartition("artifact_id").sortWithinPartitions("artifact_id", "index")
    return dealt.mapInArrow(run, f"artifact_id {chunks.schema['artifact_id'].dataType.simpleString()}, made string")


def artifact_faults(begins: DataFrame, chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """(artifact_id, fault): artifacts that are not whole. begins: artifact_id, file_type, size_expected; chunks:
    artifact_id, index, data; ends: artifact_id, size, sha256. Chunks of many artifacts may be mixed.

    Chunks are counted and measured by an aggregate; only digests need an artifact's bytes in order (``digests``).
    """
    sums = ordinal_gaps(chunks, ["artifact_id"], "index").join(chunks.groupBy("artifact_id").agg(F.sum(F.octet_length("data")).cast("long").alias("bytes")), "artifact_id")
    made = digests(chunks)
    joined = begins.join(ends, "artifact_id", "full_outer").join(sums, "artifact_id", "full_outer").join(made, "artifact_id", "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    fault = (
        F.when(F.col("file_type").isNull(), "not begun").when(F.col("sha256").isNull(), "not ended")
        .when((F.col("file_type") != "regular") & F.col("bytes").isNotNull(), "chunk of no regular file")
        .when(F.coalesce("broken", F.lit(False)), "chunk order")
        .when((F.col("file_type") == "regular") & (F.coalesce("bytes", F.lit(0)) != F.col("size")), "size")
        .when((F.col("file_type") == "regular") & (F.col("size_expected") != F.col("size")), "size expected")
        .when((F.col("file_type") == "regular") & (F.coalesce("made", empty) != F.lower("sha256")), "sha256")
    )
    return joined.select("artifact_id", fault.alias("fault")).where("fault is not null")


def manifest_faults(manifest: DataFrame, tree: DataFrame) -> DataFrame:
    """(path, fault): listed but missing, differing, or there but not listed. Both: path, sha256."""
    left, right = manifest.select("path", F.col("sha256").alias("listed")), tree.select("path", F.col("sha256").alias("found"))
    fault = F.when(F.col("found").isNull(), "missing").when(F.col("listed").isNull(), "extra").when(F.col("listed") != F.col("found"), "mismatch")
    return left.join(right, "path", "full_outer").select("path", fault.alias("fault")).where("fault is not null")
