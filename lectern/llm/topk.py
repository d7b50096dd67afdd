"""Exact top-k search: bounds from segment means and deviations, coarse to fine, then exact scores of survivors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import read, written

#: Rows of a chunk of candidates, of a block of queries, and of the sample that gives each query a first floor.
CHUNK, BLOCK, SAMPLE = 4096, 1024, 4096
#: Queries compared with a chunk at once.
STEP = 64


def levels(dims: int) -> list[int]:
    """Segments at each resolution: 1, 4, 16 and so on below half of the components, then a half and three quarters of
    them. Where no few directions hold most of a vector, only the last two tell vectors apart."""
    coarse = [4**k for k in range(16) if 2 * 4**k < dims]
    return [*coarse, *sorted({max(1, dims // 2), max(1, 3 * dims // 4)} - set(coarse))]


def segments(x: np.ndarray, parts: int) -> np.ndarray:
    """Means times root length, then deviations times root length, of ``parts`` segments: the inner product of two
    vectors is at most that of these, since in a segment <x, y> = n mean mean + <x - mean, y - mean>, and the
    latter is at most the product of the deviations' norms. So |x|^2 + |y|^2 - 2 of it bounds the distance from below.
    """
    means, spreads = [], []
    for part in np.array_split(x, min(parts, x.shape[1]), axis=1):
        mean = part.mean(axis=1)
        means.append(mean * np.sqrt(part.shape[1]))
        if part.shape[1] > 1:  # one component deviates from nothing
            spreads.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.column_stack(means + spreads)


class Chunk:
    """Candidates of one length, with their segments at every resolution."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.whole = ids, x, x.astype(np.int64)
        self.parts = levels(x.shape[1])
        self.coarse = [segments(x, p) for p in self.parts]
        self.reach = float(np.sqrt((x**2).sum(axis=1).max(initial=0)))

    def best(self, q_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: its index, and the ids and scores of its k best rows (a row with its own id excepted), as far
        as they reach the query's floor. Scores are sums of whole numbers, so exact."""
        asked = [segments(q, p) for p in self.parts]
        for at in range(0, len(q), STEP):
            upper = asked[0][at : at + STEP] @ self.coarse[0].T
            for r in range(len(upper)):
                i = at + r
                left = self.survivors(upper[r], [x[i] for x in asked], q[i], floors[i], q_ids[i], k)
                score = self.whole[left] @ q[i].astype(np.int64)
                order = np.lexsort((self.ids[left], -score))[:k]
                yield i, self.ids[left][order], score[order]

    def survivors(self, bound: np.ndarray, asked: list[np.ndarray], q: np.ndarray, floor: float, own: int, k: int) -> np.ndarray:
        """Rows whose bounds reach the floor at every resolution, coarse to fine. The floor is raised to the k-th best score
        of the rows with the highest coarse bounds."""
        slack = 1e-9 * (1 + self.reach * float(np.sqrt(q @ q)))
        other = self.ids != own
        probe = np.argpartition(-bound, min(4 * k, len(bound)) - 1)[: 4 * k]
        probe = probe[other[probe]]
        if len(probe) >= k:
            floor = max(floor, np.partition(self.x[probe] @ q, len(probe) - k)[len(probe) - k])
        left = np.flatnonzero((bound >= floor - slack) & other)
        for mine, theirs in zip(self.coarse[1:], asked[1:], strict=True):
            if len(left) > 4 * k:
                left = left[mine[left] @ theirs >= floor - slack]
        return left


def meeting(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """(qno, query_id, vec_id, score) of a chunk of candidates (id, v, dims) and a block of queries (qno, id, v, dims, floor)."""
    out: list[tuple] = []
    for dims, asked in right.groupby("dims"):
        given = left[left["dims"] == dims]
        if len(given):
            chunk = Chunk(given["id"].to_numpy(), np.stack(given["v"].to_list()))
            q_ids, numbers = asked["id"].to_numpy(), asked["qno"].to_numpy()
            for i, ids, score in chunk.best(q_ids, np.stack(asked["v"].to_list()), asked["floor"].to_numpy(), k):
                out.extend((numbers[i], q_ids[i], a, b) for a, b in zip(ids.tolist(), score.tolist(), strict=True))
    return pd.DataFrame(out, columns=["qno", "query_id", "vec_id", "score"], dtype="int64")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its ``k`` highest integer inner products, ties to smaller ids.

    Components become floor(scale * x). Vectors that are null, empty, or hold a null or non-finite component, rows with a
    null id, and vectors so long that a score may not fit 64 bits (a component over 2**31 / root of the length) take no
    part. A row is no candidate of a query with its own id; rows that repeat an id each are candidates of others; a query
    row that repeats in id and vector is answered once, and rows that share an id only are queries of their own. Vectors of
    another length than a query's aren't its candidates. Extra columns are ignored; an empty table gives an empty result.

    A first pass compares all queries with a sample of some SAMPLE candidates, whose k-th best score is a query's floor from
    then on. Candidates are dealt into chunks and queries into blocks of bounded size; a task meets one of each, so no side
    is broadcast or gathered, and each pair of a chunk and a block sends on ``k`` rows a query at most.
    """
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(col).alias("x"))
        .where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
        .where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
        .select("id", "asks", F.transform("x", lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("v"), F.size("x").alias("dims"))
        .where(~F.exists("v", lambda v: F.abs(v) > float(1 << 31) / F.sqrt("dims")))
    )
    rows = written(rows, "vectors")
    sizes = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)).alias("q")).first()
    chunks, blocks = max(12, -(-sizes.n // CHUNK)), max(1, -(-sizes.q // BLOCK))
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), "id"), F.lit(n)).cast("int")
    asked = rows.where("asks").dropDuplicates(["id", "v"]).select("id", "v", "dims", F.monotonically_increasing_id().alias("qno"), F.lit(float("-inf")).alias("floor"))
    asked = written(asked.withColumn("block", deal(blocks, 2)), "queries")
    sample = rows.where(F.pmod(F.xxhash64(F.lit(3), "id", "v"), F.lit(max(1, sizes.n))) < SAMPLE).select("id", "v", "dims", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    kind = "qno long, query_id long, vec_id long, score long"
    meet = lambda left, right: meeting(left, right, k)
    first = sample.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(meet, kind)
    floors = written(first.groupBy("qno").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).otherwise(float("-inf")).alias("floor")), "floors")
    queries = asked.drop("floor").join(floors, "qno", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    queries = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    candidates = rows.select("id", "v", "dims", deal(chunks, 1).alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    # The work of a cell is in its rows' pairs, not in their bytes, so the number of partitions is given, not left to sizes.
    tasks = min(chunks * blocks, 1 << 14)
    left, right = (t.repartition(tasks, "chunk", "block") for t in (candidates, queries))
    found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInPandas(meet, kind)
    order = Window.partitionBy("qno").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH rows AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT id, unnest(v) AS x, unnest(range(len(v))) AS at FROM rows
), scores AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.at = c.at AND q.id <> c.id WHERE q.id % 50 = 0 GROUP BY 1, 2
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
