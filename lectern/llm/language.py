"""Language identification by n-gram filters whose every slot holds a bit for each language."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import bytes_of, map_arrow, read, small_batches

#: Bytes of an n-gram; n-grams run over lower-cased text whose runs of other characters than letters are one space.
GRAM = 5
#: Documents of a language that its filter learns from, and n-grams that it holds, at most.
FITTED, HELD = 4_000, 20_000
#: Least share of a language's documents that hold an n-gram, of its highest share in any language.
OWN = 0.3
#: Slots and hash functions of the filter.
SLOTS, HASHES = 1 << 20, 3
#: Languages that one word of bits holds.
WORD = 64
#: ASCII other than letters becomes a space; all else stands, capitals in lower case.
FOLD = bytes(x if x >= 128 or chr(x).islower() else x + 32 if chr(x).isupper() else 32 for x in range(256))
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def grams(text: bytes) -> np.ndarray:
    """The n-grams of a text, each packed in a number; repeats included."""
    words = text.translate(FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.array([int.from_bytes(raw.astype(np.uint8).tobytes(), "little")], np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out |= raw[k : k + n] << np.uint64(8 * k)
    return out


def places(found: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (found ^ (found >> np.uint64(23))) * MULTIPLIERS[k]
    return (mixed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


class Filters(NamedTuple):
    """A bit-sliced Bloom filter: slots[w, place] has a bit for each of 64 languages; false_rate is each language's."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    def hits(self, found: np.ndarray) -> np.ndarray:
        """For each language, how many of the n-grams its filter says it holds."""
        at = [places(found, k) for k in range(HASHES)]
        counts = np.zeros(len(self.languages), np.float64)
        for w, slots in enumerate(self.slots):
            mask = slots[at[0]]
            for other in at[1:]:
                mask = mask & slots[other]
            many = min(WORD, len(self.languages) - w * WORD)
            if many <= 8:
                table = np.bincount(mask.astype(np.uint8), minlength=256)
                for b in range(many):
                    counts[w * WORD + b] = table.reshape(-1, 2, 1 << b)[:, 1].sum()
            else:
                for b in range(many):
                    counts[w * WORD + b] = np.count_nonzero((mask >> np.uint64(b)) & np.uint64(1))
        return counts

    def decide(self, text: bytes | None) -> tuple[str, float]:
        """The language whose filter holds most of the text's n-grams, less the hits that chance explains, and its
        share of them; ``und`` where the text has no letter (or nothing was learned)."""
        if not text or not self.languages or not has_letter(text):
            return "und", 0.0
        net, _ = self.net(text)
        best = int(net.argmax())
        return self.languages[best], float(net[best] / net.sum()) if net.sum() > 0 else 0.0

    def net(self, text: bytes) -> tuple[np.ndarray, int]:
        """Each language's hits less those that chance explains, and how many n-grams the text has."""
        found = grams(text)
        n = len(found)
        return np.maximum(0.0, (self.hits(found) - n * self.false_rate) / (1 - self.false_rate)) if n else np.zeros(len(self.languages)), n

    def tells(self, text: bytes | None, share: float, lead: float) -> bool:
        """Whether the best language holds ``share`` of the text's n-grams at least, and ``lead`` of them more than the
        second; neither depends on how many languages are learned."""
        if not text or not self.languages or not has_letter(text):
            return False
        net, n = self.net(text)
        top = np.sort(np.append(net, 0.0))
        return n > 0 and bool(top[-1] >= share * n and top[-1] - top[-2] >= lead * n)


def has_letter(text: bytes) -> bool:
    return len(text.translate(None, LETTERS)) < len(text) or not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace")))


LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def build(languages: list[str], held: dict[str, np.ndarray]) -> Filters:
    slots = np.zeros((max(1, -(-len(languages) // WORD)), SLOTS), np.uint64)
    rates = []
    for k, name in enumerate(languages):
        row, bit = slots[k // WORD], np.uint64(1 << (k % WORD))
        for i in range(HASHES):
            at = places(held[name], i)
            row[at] |= bit
        rates.append((np.count_nonzero(row & bit) / SLOTS) ** HASHES)
    return Filters(languages, slots if len(languages) > 8 else slots.astype(np.uint8), np.array(rates))


def learn(docs: DataFrame, most: int = FITTED, held: int = HELD) -> Filters:
    """Filters learned from rows with a doc_id, a text and a lang: all of a language that has ``most`` rows or fewer, else about
    ``most``, those whose seeded hash of doc_id falls below that share. Rows that share a doc_id are taken together or not at all,
    and count each. A language holds the ``held`` n-grams found in most of its rows, twice at least, of those that it has a fair share
    of (OWN); of n-grams found as often, those of smaller numbers. Rows with a null take no part; empty texts have no n-gram; a
    language of which nothing is held never wins; learning from an empty table gives filters of no language. Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string")).where("lang is not null and text is not null and doc_id is not null")
    order = F.struct(F.xxhash64(F.lit(29), "doc_id").alias("h"), "doc_id")
    # The smallest hashes of each language: partial aggregates find them, no task sees a whole language.
    counts = {x.lang: x.n for x in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()}
    span = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, most / n)))]) if counts else None
    if span is None:
        return build([], {})
    unit = F.shiftrightunsigned(order["h"], 11).cast("double") / float(1 << 53)
    chosen = rows.where(unit < span[F.col("lang")])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), bytes_of(batch, "text"), strict=True):
                by.setdefault(lang, []).append(np.unique(grams(text)))
            for lang, found in by.items():
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    small_batches(docs.sparkSession)
    seen = chosen.mapInArrow(spread, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    # A gram is a language's own if its share of documents there is near its highest anywhere: quotes in other
    # languages' documents don't count.
    share = F.col("n") / F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, float(min(most, n)))])[F.col("lang")]
    seen = seen.withColumn("share", share).withColumn("highest", F.max("share").over(Window.partitionBy("gram"))).where(F.col("share") >= OWN * F.col("highest"))
    top = seen.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= held)
    table = top.groupBy("lang").agg(F.sort_array(F.collect_list("gram")).alias("grams")).collect()  # ``held`` numbers a language
    found = {x.lang: np.array(x.grams, np.int64).view(np.uint64) for x in table}
    names = sorted(counts)
    return build(names, {k: found.get(k, np.zeros(0, np.uint64)) for k in names})


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """The columns of ``docs`` with lang_pred and score (0 to 1); only text decides.

    A null text, or one without a letter, is ``und`` with score 0; ties go to the language first by code point.
    Rows that repeat give a row each; columns named lang_pred or score are replaced; an empty table gives an
    empty result, and so does learning from one (every document is ``und``).
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rest = docs.drop("lang_pred", "score")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        found = [known.decide(x) for x in bytes_of(batch, "text")]
        names = [*batch.schema.names, "lang_pred", "score"]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return map_arrow(rest, run, f"{schema}, lang_pred string, score double")


def told(docs: DataFrame, filters: Filters, share: float, lead: float) -> DataFrame:
    """The rows of ``docs`` whose language can be told (``Filters.tells``); that of a null, empty or letterless text cannot. Rows that
    repeat stay or go alike; columns of any name stay as they are; an empty table gives an empty result, and so do filters of no language."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        return batch.filter(pa.array([known.tells(x, share, lead) for x in bytes_of(batch, "text")], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def held_out() -> F.Column:
    """Documents that filters are never learned from: crc32 of doc_id's digits is 2 modulo 4. A null doc_id isn't one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    filters = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), filters).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
