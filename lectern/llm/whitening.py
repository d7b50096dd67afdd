"""Whitening of embeddings: an exact scatter matrix from popcounts of bit planes, centred as integers before its eigenvectors."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import read, written

#: Rows whose bit planes are packed at once, and lengths of vectors that a table may hold.
PACKED, LENGTHS = 1 << 14, 64


def whole_numbers(vectors: DataFrame, scale: int = 1024, offset: int = 100_000, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(id, x, dims): x = floor(scale * component) + offset, of vectors without a null or non-finite component. A number
    beyond 64 bits is an error."""
    fits = lambda v: F.when(F.abs(v) < float(1 << 62), F.floor(v) + F.lit(offset).cast("long")).otherwise(F.raise_error(F.lit("a component is too large for 64 bits")).cast("long"))
    good = vectors.select(F.col(id_col).alias("id"), F.col(col).alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    return good.select("id", F.transform("v", lambda v: fits(v.cast("double") * scale)).alias("x"), F.size("v").alias("dims"))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length among the batch's vectors, the places of its rows and a matrix of them."""
    column, dims = batch.column(batch.schema.get_field_index("x")), batch.column(batch.schema.get_field_index("dims")).to_numpy()
    flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def planes(y: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative numbers: for each column and bit, the rows' bits packed into 64-bit words. Shape (columns, bits, words)."""
    rows, dims = y.shape
    bits = int(y.max(initial=0)).bit_length()
    packed = np.zeros((dims, bits, -(-rows // 64) * 8), np.uint8)
    for b in range(bits):
        one = np.packbits(((y >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        packed[:, b, : one.shape[1]] = one
    return packed.view(np.uint64)


def cross_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns, and of the products of each two, of unsigned numbers, as Python's whole numbers and so exact.

    The product of two columns is the sum, over each two of their bits, of 2 to the places of the bits times the
    rows that have both: an AND of two planes and a population count.
    """
    packed = planes(y)
    dims, bits, words = packed.shape
    weights = np.array([1 << b for b in range(bits)], object)
    alone = np.bitwise_count(packed).sum(axis=2, dtype=np.int64).astype(object)
    products = np.zeros((dims, dims), object)
    flat = packed.reshape(dims * bits, words)
    for i in range(dims):
        for b in range(bits):
            both = np.bitwise_count(packed[i, b] & flat[i * bits :]).sum(axis=1, dtype=np.int64).reshape(dims - i, bits)
            products[i, i:] += (both.astype(object) @ weights) << b if 2 * bits + 14 > 62 else ((both @ weights.astype(np.int64)) << b).astype(object)
    return alone @ weights if bits else np.zeros(dims, object), products


class Moments:
    """Exact sums of vectors of one length and of the products of their components (the upper half)."""

    def __init__(self, dims: int):
        self.n, self.sums, self.products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)

    def add(self, x: np.ndarray) -> None:
        """Each batch is shifted by its own least values, so that few bits are left, and shifted back in whole numbers."""
        low = x.min(axis=0)
        sums, products = cross_products((x - low).astype(np.uint64))
        rows, low = len(x), low.astype(object)
        self.n += rows
        self.sums += sums + rows * low
        self.products += products + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)


SUMS = "dims int, i int, j int, total decimal(38,0)"


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's moments by length: (dims, i, j, total) with i <= j, sums of components at i = -1, numbers of rows at i = j = -1."""
    found: dict[int, Moments] = {}
    for batch in batches:
        for _, x in matrices(batch):
            moments = found.setdefault(x.shape[1], Moments(x.shape[1]))
            for k in range(0, len(x), PACKED):
                moments.add(x[k : k + PACKED])
    for dims, m in found.items():
        i, j = np.triu_indices(dims)
        totals = [m.n, *m.sums, *m.products[i, j]]
        first, second = np.concatenate([[-1] * (dims + 1), i]), np.concatenate([[-1], np.arange(dims), j])
        yield pa.RecordBatch.from_arrays([pa.array([dims] * len(totals), pa.int32()), pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array([Decimal(int(t)) for t in totals], pa.decimal128(38, 0))], ["dims", "i", "j", "total"])


class Model(NamedTuple):
    """What whitens vectors of one length: rows and sums of the fit list, eigenvectors as columns, their roots, and their shares of the trace."""

    n: int
    sums: list[int]
    directions: np.ndarray
    roots: np.ndarray
    explained: np.ndarray


def solved(n: int, sums: list[int], products: list[list[int]], components: int) -> Model:
    """n * products - sums sums' is the covariance times n squared, in whole numbers; only then do its entries become
    doubles. Eigenvalues that are zero to double precision have no component."""
    dims = len(sums)
    centred = np.array([[float(n * products[i][j] - sums[i] * sums[j]) for j in range(dims)] for i in range(dims)]).reshape(dims, dims) / float(n * n)
    values, vectors = np.linalg.eigh(centred) if dims else (np.empty(0), np.empty((0, 0)))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    good = values > dims * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    return Model(n, sums, vectors[:, good], np.sqrt(values[good]), values[good] / np.trace(centred) if good.any() else values[good])


def fitted(rows: DataFrame, components: int) -> dict[int, Model]:
    """A model for each length. The driver gets sums only: as many as a length has pairs of components, however many rows."""
    totals = rows.select("x", "dims").mapInArrow(partial_sums, SUMS).groupBy("dims", "i", "j").agg(F.sum("total").alias("total"), F.count("*").alias("parts"))
    totals = written(totals, "moments")
    lengths = [x.dims for x in totals.select("dims").distinct().limit(LENGTHS + 1).collect()]
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    models = {}
    for dims in lengths:
        pdf = totals.where(F.col("dims") == dims).toPandas()
        if pdf["total"].isna().any():
            raise ValueError("a sum of products is beyond 38 digits")
        by = {(i, j): int(t) for i, j, t in zip(pdf["i"], pdf["j"], pdf["total"], strict=True)}
        products = [[by[min(i, j), max(i, j)] for j in range(dims)] for i in range(dims)]
        models[dims] = solved(by[-1, -1], [by[-1, j] for j in range(dims)], products, components)
    return models


def projected(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """(id, n, deviation, whitened, explained): deviation is the exact sum of (n * x - sums)**2; whitened and explained have an entry for each component."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in matrices(batch):
                model = shared.value[x.shape[1]]
                far = max((abs(model.n * int(v) - s) for side in (x.min(axis=0), x.max(axis=0)) for v, s in zip(side, model.sums, strict=True)), default=0)
                small = far * far * max(1, len(model.sums)) < 1 << 63
                centred = x.astype(np.int64 if small else object) * model.n - np.array(model.sums, np.int64 if small else object)
                deviations = (centred * centred).sum(axis=1) if len(model.sums) else np.zeros(len(x), np.int64)
                white = centred.astype(float) @ model.directions / (model.n * model.roots)
                k = white.shape[1]
                lists = lambda values: pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k, pa.int32()), pa.array(values.ravel()))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("id")).take(pa.array(at)), pa.array(np.full(len(at), model.n)), pa.array([Decimal(int(v)) for v in deviations], pa.decimal128(38, 0)), lists(white), lists(np.tile(model.explained, len(at)))],
                    ["id", "n", "deviation", "whitened", "explained"],
                )

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>")


def identity_error(white: DataFrame, components: int) -> float | None:
    """The largest absolute entry of the covariance of ``whitened``, over all rows, minus the identity; null where there is no entry."""
    w = [F.try_element_at("whitened", F.lit(k + 1)) for k in range(components)]
    sums = [F.sum(x) for x in w]
    products = {(i, j): F.sum(w[i] * w[j]) for i in range(components) for j in range(i, components)}
    worst = None
    for found in white.groupBy(F.size("whitened").alias("k"), "n").agg(F.count("*"), *sums, *products.values()).collect():  # a row a length
        k, n = found[0], found[2]
        mean = [None if s is None else s / n for s in found[3 : 3 + components]]
        for (i, j), s in zip(products, found[3 + components :], strict=True):
            if j < k:
                worst = max(worst or 0.0, abs(s / n - mean[i] * mean[j] - (i == j)))
    return worst


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) for each vector without a null or non-finite component.

    Components become whole numbers x = floor(scale * c) + offset. The fit list is all vectors that stay; n is their number, V the
    covariance of x over it (divisor n). ``whitened`` holds (x - mean) projected on each of the first ``components`` unit eigenvectors of
    V, by falling eigenvalue, over the root of the eigenvalue; ``explained`` each eigenvalue's share of the trace;
    ``deviation`` the exact sum of squares of n * x - sums; identity_error is measured on the whitened rows themselves.

    Rows that repeat count as often as they occur, and a null id is kept. Components whose eigenvalue is zero to double
    precision (constant vectors, fewer rows than dimensions) are left out, so ``whitened`` may be shorter or empty. Vectors of
    different lengths (LENGTHS at most, more is an error) are fit lists of their own. Extra columns are ignored; an
    empty table gives an empty result.

    One pass makes exact sums of products in each task, a row a pair of dimensions; only their totals reach the driver. The
    model, components x dimensions doubles a length, is broadcast.
    """
    rows = written(whole_numbers(vectors, scale, offset, id_col, col), "numbers")
    white = written(projected(rows, fitted(rows, components)), "whitened")
    return white.withColumn("identity_error", F.lit(identity_error(white, components)).cast("double"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(read(spark, sf_dir, "embeddings"))
    each = found.select("id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", F.col("deviation").cast("long").alias("deviation"), "c.whitened", "c.explained", "identity_error")
