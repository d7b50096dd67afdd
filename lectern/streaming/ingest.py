"""Incremental ingest: entry files that arrive in a folder go through the same rows as a batch, each file once, and a passage
keeps what it has covered as state, so that a chapter may arrive in any number of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.commentary import commentary_entries, commentary_rows

ENTRY = "module string, ordinal long, key string, raw string, html string, plain string, verse struct<osis:string,testament:int,book:int,chapter:int,verse:int>"


def entry_stream(spark: SparkSession, folder: str, files_a_batch: int = 64) -> DataFrame:
    """Entries of the JSON files in a folder as they arrive; the schema is declared, never inferred."""
    return spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", files_a_batch).json(folder)


def collapse_into(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Collapses the whole stream: an aggregation whose state has a row a passage (module, book, chapter and text). Each batch writes
    the passages that it has changed, as they now are, to a Parquet folder of its own number; a batch that is run again replaces
    what it wrote. ``collapsed`` reads what holds now."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    changed = commentary_entries(commentary_rows(stream))
    return changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collapsed(spark: SparkSession, table: str) -> DataFrame:
    """The entries that ``collapse_into`` has written: of each passage the row of the latest batch."""
    rows = spark.read.option("basePath", table).parquet(f"{table}/batch=*")
    keys = ["module", "book", "chapter", "text"]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*[x for x in rows.columns if x not in keys]), "batch").alias("row"))
    return latest.select(*keys, "row.*").drop("batch").select(*[x for x in rows.columns if x != "batch"])
