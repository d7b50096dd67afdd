"""Numbers of rows within groups where one group may hold any share of the rows: no group has to meet in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lectern.sources.shared import written


def row_numbers(rows: DataFrame, keys: list[str], order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Adds ``name``: 1, 2 and so on in each group of ``keys``, by ``order``, as ``row_number`` over a window gives.

    Rows are dealt to ``parts`` ranges of keys and order (by default as many as shuffles have), so a hot group fills several parts. A task
    numbers its sorted rows a batch at a time and carries the count on. A group goes on from one part to the next only where a part
    begins, so what is added to its numbers is known from a row a part: its first group, and its last with its number. Only those rows meet on
    the driver. Ties in ``order`` are numbered in some order; null keys are a group. The rows are written below the shared folder.
    """
    number = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.withColumn("_a", F.xxhash64(*keys)).withColumn("_b", F.xxhash64(F.lit(1), *[x for k in keys for x in (F.col(k).isNull(), F.col(k))]))
    dealt = marked.repartitionByRange(number, *keys, *order).withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*keys, *order)
    schema = StructType([*dealt.schema.fields, StructField("_place", LongType()), StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, place = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a, b = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("_a", "_b"))
            starts = np.flatnonzero(np.append(last != (a[0], b[0]), (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            turn = np.arange(1, n + 1)
            before = np.append(-count, starts)[np.searchsorted(starts, np.arange(n), side="right")]  # where each row's group began
            turn -= before
            last, count = (a[-1], b[-1]), int(turn[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(place, place + n)), pa.array(turn)], [*batch.schema.names, "_place", name])
            place += n

    found = written(dealt.mapInArrow(run, schema), "numbers")
    edges = found.groupBy("_part").agg(F.min_by(F.struct("_a", "_b"), "_place").alias("first"), F.max_by(F.struct("_a", "_b", name), "_place").alias("last"))
    added, now = [], (None, 0)  # the group that the part before ended with, and its number there
    for x in edges.orderBy("_part").collect():  # a row a part
        more = now[1] if now[0] == (x.first._a, x.first._b) else 0
        if more:
            added.append((x._part, x.first._a, x.first._b, more))
        group = (x.last._a, x.last._b)
        now = (group, x.last[2] + (more if group == (x.first._a, x.first._b) else 0))
    if added:
        offsets = F.broadcast(rows.sparkSession.createDataFrame(added, "_part int, _a long, _b long, _more long"))  # as many rows as there are parts, at most
        found = found.join(offsets, ["_part", "_a", "_b"], "left").withColumn(name, F.col(name) + F.coalesce("_more", F.lit(0)))
    return found.select(*rows.columns, name)
