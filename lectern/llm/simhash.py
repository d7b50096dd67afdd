"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import bytes_of, map_arrow, read, unite, written
from lectern.llm.components import connected_components

BITS = 64
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def majority(hashes: np.ndarray) -> int:
    """The bits that are 1 in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; 0 where there is no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    return majority(np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=False)], np.uint64))


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(x, width) for x in bytes_of(batch, "text")], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), one, "doc_id long, fp long")


def quarters(x: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit parts."""
    return np.bitwise_count(x.view("<u2").reshape(len(x), 4)).astype(np.int8)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int, tile: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of left and right (None: left against itself, i < j) that differ in at most ``radius`` bits.

    Both sides are sorted by the population counts of their 16-bit parts and cut into tiles. The counts of two
    words differ by no more than their bits do, so a pair of tiles whose count ranges lie further apart than
    the radius is skipped; the rest are compared exactly.
    """
    other = left if right is None else right
    sides = []
    for x in (left, other):
        q = quarters(x)
        order = np.lexsort(q.T[::-1])
        cut = np.arange(0, len(x), tile)
        q = q[order]
        sides.append((x[order], order, cut, np.minimum.reduceat(q, cut) if len(x) else q, np.maximum.reduceat(q, cut) if len(x) else q))
    (a, a_at, a_cut, a_low, a_high), (b, b_at, b_cut, b_low, b_high) = sides
    widths = np.diff(np.append(b_cut, len(b)))
    for k, at in enumerate(a_cut):
        gap = np.maximum(0, np.maximum(a_low[k] - b_high, b_low - a_high[k])).sum(axis=1)
        near = gap <= radius
        if right is None:
            near[:k] = False
        rows = np.flatnonzero(np.repeat(near, widths))
        mine = a[at : at + tile]
        for s in range(0, len(rows), 1 << 14):
            some = rows[s : s + (1 << 14)]
            i, j = np.nonzero(np.bitwise_count(mine[:, None] ^ b[some][None, :]) <= radius)
            if len(i):
                i, j = i + at, some[j]
                if right is None:
                    i, j = i[i < j], j[i < j]
                yield a_at[i], b_at[j]


def _cell_forest(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        side = pdf["side"].to_numpy()
        at_l, at_r = np.flatnonzero(side != 1), np.flatnonzero(side == 1)
        alone = bool((side == 2).any())
        parent = np.arange(len(fps))
        for i, j in tile_links(fps[at_l], None if alone else fps[at_r], radius):
            parent = unite(parent, at_l[i], (at_l if alone else at_r)[j])
        linked = np.flatnonzero(parent != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[linked].view(np.int64), "b": fps[parent[linked]].view(np.int64)})

    return run


def links(fps: DataFrame, radius: int = 4, most: int = 1 << 18) -> DataFrame:
    """(a, b): a spanning forest of the links between distinct fingerprints that differ in 1 to ``radius`` bits.

    Fingerprints are dealt into chunks by population count, several to a count; chunks whose counts differ
    by more than the radius never meet. Each pair of chunks that may hold a link is a cell, and a task compares
    a cell's tiles exactly. A cell sends on at most one edge a fingerprint (its local forest), never all pairs.
    ``most`` bounds a chunk's rows and so a task's memory. Rows that repeat a fingerprint, and an empty table, give no link of their own.
    """
    bits = F.bit_count("fp").cast("int")
    hashed = fps.select("fp", bits.alias("p"))
    total = F.sum("n").over(Window.partitionBy())  # the window is over at most 65 rows
    classes = (
        hashed.groupBy("p").agg(F.count("*").alias("n")).select("p", "n", total.alias("all"))
        .withColumn("k", F.ceil(F.col("n") / F.greatest(F.lit(1), F.least(F.lit(most), F.ceil(F.col("all") / 32)))).cast("int"))
    )
    classes = written(classes.select("p", "k"), "classes")
    chunks = classes.select("p", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("c"))
    one = chunks.select(F.col("p").alias("p1"), F.col("c").alias("c1"), F.explode(F.sequence(F.col("p"), F.col("p") + radius)).alias("p2"))
    cells = one.join(chunks.select(F.col("p").alias("p2"), F.col("c").alias("c2")), "p2").where("p1 < p2 or c1 <= c2")
    cells = cells.withColumn("cell", F.xxhash64("p1", "c1", "p2", "c2"))
    same = (F.col("p1") == F.col("p2")) & (F.col("c1") == F.col("c2"))
    side = lambda p, c, s: F.struct(F.col(p).alias("p"), F.col(c).alias("c"), s.cast("int").alias("side"))
    seats = cells.select("cell", F.explode(F.when(same, F.array(side("p1", "c1", F.lit(2)))).otherwise(F.array(side("p1", "c1", F.lit(0)), side("p2", "c2", F.lit(1))))).alias("s")).select("cell", "s.*")
    # One row a chunk: its list of seats. Spark broadcasts it only below its own size threshold.
    seats = written(seats.groupBy("p", "c").agg(F.collect_list(F.struct("cell", "side")).alias("seats")), "seats")
    placed = (
        hashed.join(classes, "p").withColumn("c", F.pmod(F.xxhash64(F.lit(7), "fp"), F.col("k")).cast("int"))
        .join(seats, ["p", "c"]).select("fp", F.explode("seats").alias("s")).select("fp", "s.cell", "s.side")
    )
    return placed.groupBy("cell").applyInPandas(_cell_forest(radius), "a long, b long")


def simhash_components(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """One row a document: doc_id, fp and component_id, the smallest doc_id that links reach.

    Links join fingerprints at most ``radius`` bits apart, equal ones included. Null, empty and wordless texts
    have fingerprint 0 and link like any other. Rows with one doc_id stay apart as rows and share what their
    fingerprints share; a null doc_id is kept and is never the smallest (null only where nothing else is
    reachable). Extra columns are ignored; an empty table gives an empty result.
    """
    prints = written(fingerprints(docs, width), "fingerprints")
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
    label = written(connected_components(links(first.select("fp"), radius)).select(F.col("node").alias("fp"), "component"), "labels")
    least = written(label.join(first, "fp").groupBy("component").agg(F.min("first").alias("least")), "least")  # Spark can split a join of tables
    linked = label.join(least, "component").select("fp", "least")
    final = written(first.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "final")
    return prints.join(final, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, radius: int = 4) -> DataFrame:
    """The documents of which the component keeps one: that with the smallest doc_id. All columns stay.

    Rows that share the kept doc_id all stay; rows with a null doc_id stay only where their component has no other.
    """
    keep = simhash_components(docs, radius).where("doc_id <=> component_id").select("doc_id").distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["doc_id"]), "left_semi")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
