"""Best-fit packing by a grouping genetic algorithm on islands, with migration of the best."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm.bytelevel import spelled
from lectern.llm.common import map_arrow, read, written

ROOM, END = 4096, 1
#: Pieces of a cell, about; a cell's islands pack the same pieces from different seeds.
CELL, ISLANDS = 768, 4
#: Rounds between which the best of each island moves on; packings of an island and generations of a round.
ROUNDS, POPULATION, GENERATIONS = 2, 20, 20
#: Cells or islands that a task is dealt, about, and tasks at most.
DEALT, TASKS = 16, 1 << 16
#: Chunks of text whose ids a worker keeps before it starts anew.
CACHED = 1 << 20

_ids: dict[str, Ids] = {}


class Ids(dict):
    """Ids of a chunk of text between blanks, as little-endian unsigned 32-bit bytes; missing ones are encoded once."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, chunk: str) -> bytes:
        # A run of letters and one mark after it are pre-tokens of their own, and letters are encoded in lower case
        # (beyond Latin, lower case may depend on what is around a letter, so only Latin ones are lowered here).
        if chunk[-1:] in (",", ".") and chunk[:-1].isalpha():
            ids = self[chunk[:-1]] + self[chunk[-1]]
        elif chunk.isalpha() and max(chunk) < "\u0250":
            low = chunk.lower()
            ids = self[low] if low != chunk else self.modelled(chunk)
        else:
            ids = self.encoded(chunk)
        if len(self) > CACHED:
            self.clear()
        if len(chunk) < 200:
            self[chunk] = ids
        return ids

    def encoded(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def modelled(self, word: str) -> bytes:
        """One pre-token straight from the model, which is what the tokenizer does with it after cutting the text."""
        return np.array([x.id for x in self.model.tokenize(spelled(word))], "<u4").tobytes()

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _tokens(path: str) -> Ids:
    """This worker's ids; they outlive a task."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


def pieces(docs: DataFrame, path: str, room: int = ROOM, end: int = END, with_ids: bool = False) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids_crc32 (and ids). A document is its text's ids, then ``end``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table, tail = _tokens(path), np.array([end], "<u4").tobytes()
        found: dict[str, list] = {x: [] for x in ("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids)}
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = table.of(text or "") + tail
            for k, at in enumerate(range(0, len(ids), 4 * room)):
                part = ids[at : at + 4 * room]
                row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part)
                for name, value in zip(found, row, strict=False):
                    found[name].append(value)
        types = {"doc_id": pa.int64(), "piece": pa.int32(), "ids": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(v, types.get(n, pa.int64())) for n, v in found.items()], list(found))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


class Bins:
    """A packing under way: bins as lists of pieces, the free room of each, and the open ones ordered by it."""

    def __init__(self, sizes: list[int], room: int):
        self.sizes, self.room = sizes, room
        self.bins: list[list[int]] = []
        self.free: list[int] = []
        self.open: list[tuple[int, int]] = []

    def keep(self, members: list[int], used: int) -> None:
        left = self.room - used
        self.bins.append(list(members))
        self.free.append(left)
        if left:
            insort(self.open, (left, len(self.bins) - 1))

    def place(self, item: int) -> None:
        """Best fit: the bin with the least room that still takes the piece, or a new one."""
        size = self.sizes[item]
        at = bisect_left(self.open, (size, -1))
        if at == len(self.open):
            self.keep([item], size)
            return
        left, k = self.open.pop(at)
        self.bins[k].append(item)
        self.free[k] = left - size
        if left > size:
            insort(self.open, (left - size, k))


class Packing(NamedTuple):
    """Bins, and what each of them holds."""

    bins: list[list[int]]
    used: np.ndarray

    @staticmethod
    def of(bins: list[list[int]], sizes: list[int]) -> Packing:
        return Packing(bins, np.array([sum(sizes[x] for x in one) for one in bins], np.int64))

    def cost(self, room: int) -> tuple[int, float]:
        """Fewer bins first, then uneven ones: fuller bins leave more room in the last."""
        return len(self.bins), -float(((self.used / room) ** 2).sum())


def packed_in(sizes: list[int], order: list[int], room: int, under_way: Bins | None = None) -> Packing:
    """Best fit of the pieces in this order, into the bins that there are."""
    packing = under_way or Bins(sizes, room)
    for item in order:
        packing.place(item)
    return Packing(packing.bins, room - np.array(packing.free, np.int64))


def best_fit(sizes: list[int], order: list[int], room: int) -> list[list[int]]:
    return packed_in(sizes, order, room).bins


def cross(a: Packing, b: Packing, sizes: list[int], down: list[int], room: int, rng: np.random.Generator) -> Packing:
    """Puts well-filled bins of ``b`` whole into ``a``, drops the bins of ``a`` that share a piece with them, and
    best-fits the displaced pieces, the largest first (``down``). A few of the emptiest bins are broken up as well."""
    full = np.flatnonzero(b.used >= np.quantile(b.used, 0.5))
    given = rng.choice(full, max(1, len(full) // 3), replace=False).tolist()
    inside = {x for k in given for x in b.bins[k]}
    child = Bins(sizes, room)
    for k in given:
        child.keep(list(b.bins[k]), int(b.used[k]))
    left = sorted((k for k, one in enumerate(a.bins) if inside.isdisjoint(one)), key=(-a.used).__getitem__)
    spare = max(1, len(left) // 20)
    for k in left[:-spare]:
        child.keep(list(a.bins[k]), int(a.used[k]))
        inside.update(a.bins[k])
    return packed_in(sizes, [x for x in down if x not in inside], room, child)


def least_bins(sizes: list[int], room: int) -> int:
    """A number of bins that no packing falls below: by room, and by pieces of over half of it, of which no two share a
    bin, with what smaller pieces need beyond the room that those leave (for every size that sets the smallest apart)."""
    best = -(-sum(sizes) // room)
    ordered = np.sort(np.array(sizes, np.int64))
    big = ordered[2 * ordered > room]
    for small in np.unique(ordered[2 * ordered <= room]):
        huge = big[big > room - small]
        mid = big[big <= room - small]
        rest = ordered[(ordered >= small) & (2 * ordered <= room)].sum() - (room * len(mid) - mid.sum())
        best = max(best, len(huge) + len(mid) + max(0, -(-int(rest) // room)))
    return max(best, len(big))


def evolve(sizes: list[int], start: list[list[list[int]]], room: int, rng: np.random.Generator) -> list[list[int]]:
    """The best packing that a population reaches in a round; it stops at the least number of bins that there can be."""
    least = least_bins(sizes, room)
    down = sorted(range(len(sizes)), key=lambda x: (-sizes[x], x))
    people = [*(Packing.of(x, sizes) for x in start), packed_in(sizes, down, room)]
    while len(people) < POPULATION and min(len(x.bins) for x in people) > least:
        noise = np.argsort(-np.array(sizes) * rng.uniform(0.8, 1.0, len(sizes)), kind="stable")
        people.append(packed_in(sizes, noise.tolist(), room))
    people = sorted((x.cost(room), k, x) for k, x in enumerate(people))
    for turn in range(GENERATIONS):
        if people[0][0][0] <= least:
            break
        i, j = rng.choice(len(people), 2, replace=False) if len(people) > 1 else (0, 0)
        born = (cross(people[k][2], people[j][2], sizes, down, room, rng) for k in (i, 0))
        people = sorted([*people, *((x.cost(room), POPULATION + 2 * turn + k, x) for k, x in enumerate(born))])[:POPULATION]
    return people[0][2].bins


def _packings(pdf: pd.DataFrame, names: list[str]) -> list[list[list[int]]]:
    """The packings that the columns ``names`` hold, a bin's number a piece; -1 where there is none yet."""
    out = []
    for name in names:
        if len(pdf) and pdf[name].iat[0] >= 0:
            groups: dict[int, list[int]] = {}
            for item, k in enumerate(pdf[name].tolist()):
                groups.setdefault(k, []).append(item)
            out.append(list(groups.values()))
    return out


def _round(seed: int, turn: int, room: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """A round of one island: the best packing that it reaches from its own and its guest."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        rng = np.random.default_rng([seed, turn, int(key[0]), int(key[1])])
        best = evolve(pdf["length"].tolist(), _packings(pdf, ["own", "guest"]), room, rng)
        number = np.empty(len(pdf), np.int32)
        for k, members in enumerate(best):
            number[members] = k
        return pdf.assign(own=number)

    return run


def _first(room: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """Best fit, the largest first, and whether it takes the least number of bins that there can be."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        sizes = pdf["length"].tolist()
        bins = best_fit(sizes, sorted(range(len(sizes)), key=lambda x: (-sizes[x], x)), room)
        number = np.empty(len(pdf), np.int32)
        for k, members in enumerate(bins):
            number[members] = k
        return pdf.assign(own=number, least=len(bins) <= least_bins(sizes, room))

    return run


def islands(items: DataFrame, seed: int, room: int = ROOM) -> DataFrame:
    """(uid, cell, length, bin): each cell's best packing. ``items``: uid, cell, length.

    A cell that best fit packs in the least number of bins is done. Every other one lives on ISLANDS islands. A round
    evolves each island by itself; then its best packing stays there and goes on to the next island as well, and the next
    round starts from both. Lengths are 1 to ``room``; uids are distinct; an empty table gives an empty result.
    """
    # A cell's work is in its pieces, not in their few bytes, so the number of tasks is given, not left to sizes.
    tasks = lambda cells, each: max(1, min(-(-cells * each // DEALT), TASKS))
    cells = int(items.agg(F.coalesce(F.max("cell"), F.lit(0))).first()[0]) + 1
    start = written(items.repartition(tasks(cells, 1), "cell").groupBy("cell").applyInPandas(_first(room), "uid long, cell long, length long, own int, least boolean"), "first")
    every = F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island")
    live = start.where("not least").select("uid", "cell", "length", every, "own", F.lit(-1).alias("guest"))
    hard = start.where("not least").select("cell").distinct().count()
    for turn in range(ROUNDS):
        live = live.repartition(tasks(hard, ISLANDS), "cell", "island").groupBy("cell", "island").applyInPandas(_round(seed, turn, room), live.schema)
        if turn < ROUNDS - 1:
            live = written(live, "islands")
            # Migration: a row of each piece goes to its island and one to the next; there they meet as own and guest.
            moved = live.select("uid", "cell", "length", F.explode(F.array(F.struct(F.col("island").alias("at"), F.lit(True).alias("home")), F.struct(((F.col("island") + 1) % ISLANDS).alias("at"), F.lit(False).alias("home")))).alias("go"), "own")
            live = moved.groupBy("uid", "cell", "length", F.col("go.at").alias("island")).agg(F.max(F.when(F.col("go.home"), F.col("own"))).alias("own"), F.max(F.when(~F.col("go.home"), F.col("own"))).alias("guest"))
    live = written(live.select("uid", "cell", "length", "island", "own"), "islands")
    rank = live.groupBy("cell", "island").agg(F.max("own").alias("bins")).groupBy("cell").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    evolved = live.join(rank, ["cell", "island"]).select("uid", "cell", "length", F.col("own").alias("bin"))
    return start.where("least").select("uid", "cell", "length", F.col("own").alias("bin")).union(evolved)


def pack(found: DataFrame, seed: int = 42, room: int = ROOM) -> DataFrame:
    """``found`` (pieces, any columns, with length <= room) plus sequence_id and offset.

    Full pieces are sequences of their own. The rest is dealt into cells at random, and each cell is packed on its
    islands. What the emptiest sequences of all cells hold is dealt anew and packed once more, so that cells
    share their remainders. A cell has a bounded number of pieces, whatever the input. Rows that repeat are pieces each; columns
    named uid, sequence_id or offset are replaced, and one named number is not allowed; an empty table gives an empty result.
    """
    rows = written(found.withColumn("uid", F.monotonically_increasing_id()), "pieces")  # ids are fixed by being written
    small = rows.where(F.col("length") < room).select("uid", "length")

    def deal(items: DataFrame, again: int) -> DataFrame:
        cells = max(1, -(-items.count() // CELL))
        return items.withColumn("cell", F.pmod(F.xxhash64(F.lit(seed + again), "uid"), F.lit(cells)))

    first = written(islands(deal(small, 0), seed, room), "packed")
    used = first.groupBy("cell", "bin").agg(F.sum("length").alias("used"))
    loose = used.where(F.col("used") < room * 0.97).select("cell", "bin")
    rest = written(first.join(loose, ["cell", "bin"], "left_semi").select("uid", "length"), "rest")
    second = islands(deal(rest, 1), seed + 1, room).select("uid", F.lit(1).alias("level"), "cell", "bin")
    done = first.join(loose, ["cell", "bin"], "left_anti").select("uid", F.lit(0).alias("level"), "cell", "bin").union(second)
    # Levels, cells and bins number the sequences: a bin's number is below 2**20 as a cell's pieces are few.
    number = F.shiftleft(F.col("cell"), 22) + F.shiftleft(F.col("level").cast("long"), 20) + F.col("bin")
    placed = rows.join(done.select("uid", number.alias("number")), "uid", "left")
    alone = F.shiftleft(F.col("uid"), 1) + 1
    placed = placed.withColumn("sequence_id", F.when(F.col("number").isNull(), alone).otherwise(F.shiftleft(F.col("number"), 1)))
    return offsets(placed.drop("number"))


def offsets(placed: DataFrame) -> DataFrame:
    """Places follow uid within a sequence, which holds ``room`` pieces at most."""
    run = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(run), F.lit(0))).drop("uid")


def pack_documents(docs: DataFrame, path: str | None = None, seed: int = 42, with_ids: bool = False) -> DataFrame:
    """A row a piece of a document: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id and offset.

    A null text is empty: its document is the end id alone. Rows that repeat are packed each; rows with a null
    doc_id are packed like others. Only documents longer than a sequence are cut. Extra columns are ignored; an
    empty table gives an empty result.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return pack(pieces(docs, path, with_ids=with_ids), seed)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
