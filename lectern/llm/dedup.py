"""Exact dedup with a split for heavy hitters: Misra-Gries finds frequent digests, whose winners are broadcast; the rest shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import read, written

#: Counters of a summary. A digest that more than 1 in COUNTERS + 1 rows have is found for certain, and no more than COUNTERS can be so frequent.
COUNTERS = 1024


def merged(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """One Misra-Gries summary of several: counts of equal keys are added; where over ``most`` keys are left, the largest
    count beyond the first ``most`` is taken off all, and those that have nothing left go."""
    names, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(names), np.int64)
    np.add.at(sums, at, counts)
    if len(names) > most:
        sums -= np.partition(sums, len(sums) - most - 1)[len(sums) - most - 1]
        names, sums = names[sums > 0], sums[sums > 0]
    return names, sums


def summaries(keys: DataFrame, most: int = COUNTERS) -> DataFrame:
    """(key, low): the Misra-Gries summary of each task's rows, at most ``most`` rows a task. ``keys``: one column, a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            new = batch.column(0).to_numpy()
            names, sums = merged(np.concatenate([names, new]), np.concatenate([sums, np.ones(len(new), np.int64)]), most)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums)], ["key", "low"])

    return keys.mapInArrow(run, "key long, low long")


def frequent(marked: DataFrame, most: int = COUNTERS) -> DataFrame:
    """(digest, group_size, last): digests that more than one row and more than 1 in ``most`` + 1 rows have, how many have
    them, and the last of those by doc_id and place. At most ``most`` rows, whatever the input.

    Summaries of tasks are added up, and the ``most`` largest sums are candidates: all frequent digests are among them, since
    the sum of a digest falls short of its count by at most 1 in ``most`` + 1 rows. Candidates are by 64 bits of the digest; they
    are then verified: counted exactly by the whole digest, in one more pass that a broadcast filter keeps to their rows.
    """
    sums = summaries(marked.select(F.col("key")), most).groupBy("key").agg(F.sum("low").alias("low"))
    likely = written(sums.orderBy(F.desc("low"), "key").limit(most).select("key"), "likely")
    counted = marked.join(F.broadcast(likely), "key").groupBy("digest").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "place")).alias("last"))
    rows = marked.count()
    return written(counted.where((F.col("group_size") > 1) & (F.col("group_size") * (most + 1) > rows)), "frequent")


def exact_dedup(docs: DataFrame, columns: list[str] | None = None, normalised: Callable[[Column], Column] = lambda x: x, most: int = COUNTERS) -> DataFrame:
    """Every row of ``docs`` plus keep_id, group_size, kept and text_sha256: of rows whose texts are equal after
    ``normalised`` (by default, unchanged), the one with the largest doc_id stays.

    Needs doc_id and text; ``columns`` are those to carry (by default all), and any of the names of the added ones are replaced.
    A null text counts as empty. Of rows that share the largest doc_id one stays, the last in the input; a null doc_id comes
    before all others, and keep_id is null only where a group has no other. So each group keeps exactly one row. Texts
    of any length count by their SHA-256. An empty table gives an empty result.

    Rows get their digest and a place once and are written, so a lost executor changes neither. Winners of frequent
    digests, at most ``most``, are broadcast: their rows never move. All others, of which none has more than 1 in ``most`` + 1 of the
    rows, are grouped by an ordinary shuffle.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    names = [x for x in (docs.columns if columns is None else columns) if x not in added]
    text = F.coalesce(normalised(F.col("text").cast("string")), F.lit(""))
    record = F.struct(*[F.col(f"`{x}`") for x in names]) if names else F.lit(None)
    digest = F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))
    marked = docs.select(F.col("doc_id"), digest.alias("digest"), F.monotonically_increasing_id().alias("place"), record.alias("record"))
    key = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    marked = written(marked.withColumn("key", key), "digests")
    heavy = frequent(marked.select("doc_id", "digest", "place", "key"), most)
    here = marked.join(F.broadcast(heavy), "digest")
    rest = marked.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "place")).alias("last"))
    both = here.unionByName(rest.join(groups, "digest"))
    return both.select(
        *([F.col("record.*")] if names else []), F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("place") == F.col("last.place")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with their own columns."""
    own = [f"`{x}`" for x in docs.columns if x not in ("keep_id", "group_size", "kept", "text_sha256")]
    return exact_dedup(docs).where("kept").select(*own)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"), ["doc_id"])


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
