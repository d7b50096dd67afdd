"""Sharding by an external shuffle in two passes: scatter by a seeded hash, then Fisher-Yates within each bucket."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, LongType, NumericType, StructField, StructType, TimestampType

from lectern.llm.common import bytes_of, map_arrow, read, scratch, small_batches, written

SHARDS = 8
#: Bytes of records that a bucket holds, about; one task shuffles a bucket in memory.
BUCKET = 32 << 20
#: Buckets at least, so that small inputs also spread over tasks.
LEAST = 96


def scatter(rows: DataFrame, buckets: int, seed: int) -> DataFrame:
    """Pass one: a uniform bucket for each row. The row's place takes part, so rows that repeat scatter as well."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "file_no", "row_no"), F.lit(buckets)).cast("int"))


def shuffled(rows: DataFrame, seed: int = 42, bucket_bytes: int = BUCKET) -> DataFrame:
    """``rows`` (any columns, with file_no, row_no and size) plus position: a uniform random order from 0, gapless.

    Buckets are dealt by a seeded hash; each is put in order of its rows' places and then shuffled by Fisher-Yates with a seed
    of its own, so the order doesn't depend on which task ran when. A bucket's first position is the count of the
    buckets before it.
    """
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first().bytes
    dealt = scatter(rows, max(LEAST, -(-int(total) // bucket_bytes)), seed)
    counts = dealt.groupBy("bucket").agg(F.count("*").alias("n"))
    # A row a bucket, some bytes for each 32 MB of records; Spark broadcasts it only below its own threshold.
    starts = counts.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("start"))

    def shuffle(key: tuple, records: pa.Table) -> pa.Table:
        records = records.take(pa.array(np.lexsort([records[x].to_numpy() for x in ("file_no", "row_no")])))
        place = np.random.default_rng([seed, key[0].as_py()]).permutation(len(records))  # numpy's Fisher-Yates
        return records.append_column("place", pa.array(place, pa.int64()))

    dealt = dealt.join(starts, "bucket")  # before records move, so that they move once
    placed = dealt.groupBy("bucket").applyInArrow(shuffle, StructType([*dealt.schema.fields, StructField("place", LongType())]))
    return placed.withColumn("position", F.col("start") + F.col("place")).drop("bucket", "start", "place")


def cut(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """shard and slot from the positions of ``n`` rows: consecutive runs whose lengths differ by one at most."""
    small, more = divmod(n, shards)  # the first ``more`` shards hold small + 1 rows
    edge, at = more * (small + 1), F.col("position")
    early = at < edge
    shard = F.when(early, F.floor(at / (small + 1))).otherwise(more + F.floor((at - edge) / max(small, 1)))
    slot = F.when(early, at % (small + 1)).otherwise((at - edge) % max(small, 1))
    return rows.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = 42, steady: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0) for each row of the shards that this writes below the
    shared folder and reads back; counts of shards differ by one at most.

    size: UTF-8 bytes of the text (null: none) plus 1; text_crc32: unsigned, of an empty text where it is null.
    Rows that repeat, or share an id or a text, each have their own slot, and so do rows with a null doc_id.
    Extra columns move with their rows; an empty table gives an empty result.
    """
    path = scratch(docs.sparkSession, "shards")
    write_shards(docs, path, shards, seed, steady)

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or b"" for x in bytes_of(batch, "text")]
        columns = [batch.column("doc_id"), pa.array([len(x) + 1 for x in texts], pa.int64()), pa.array(list(map(zlib.crc32, texts)), pa.int64()), batch.column("shard"), batch.column("slot")]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "text_crc32", "shard", "slot"])

    fields = [f for f in docs.schema.fields if f.name not in ("shard", "slot")]
    found = docs.sparkSession.read.schema(StructType([*fields, StructField("slot", LongType()), StructField("shard", IntegerType())])).parquet(path)
    found = found.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "shard", "slot")
    return map_arrow(found, digest, "doc_id long, size long, text_crc32 long, shard int, slot long")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 42, steady: bool = False, bucket_bytes: int = BUCKET) -> None:
    """Writes whole rows, with their slot, as Parquet below ``path``/shard=N; a bucket is a task's memory. Whoever shuffles
    a bucket writes it: rows of a file are in slot order. Columns named shard or slot are replaced.

    A row's place must be the same each time that rows are read, whatever tasks read them. ``steady``: ``docs`` is a reading of Parquet
    files and no more, so the file and the row's number in it are its place; other rows are numbered and written first.
    """
    fields = [f for f in docs.schema.fields if f.name not in ("shard", "slot")]
    plain = (BooleanType, DateType, NumericType, TimestampType)
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in fields if not isinstance(f.dataType, plain)]
    size = sum(wide, F.lit(8 * len(fields) + 1)).cast("long")  # of the whole record: a bucket must fit a task's memory
    place = [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")] if steady else [F.lit(0).cast("long"), F.monotonically_increasing_id()]
    rows = docs.select(F.struct(*[F.col(f"`{f.name}`") for f in fields]).alias("record"), *[x.alias(name) for x, name in zip(place, ("file_no", "row_no"), strict=True)], size.alias("size"))
    if not steady:
        rows = written(rows, "numbered")
    small_batches(docs.sparkSession)
    placed = cut(shuffled(rows, seed, bucket_bytes), rows.count(), shards)
    placed.select("record.*", "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_rows(read(spark, sf_dir, "documents"), steady=True)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
