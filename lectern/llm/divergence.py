"""How far the sources of a language diverge in what they say: a cube of group blocks, group blocks and term blocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import bytes_of, read, small_batches, written

#: Documents of a language that a term must be in, what is added to each count, the unit of a probability, and terms listed a group.
LEAST, ADDED, UNIT, TOP = 30, 5, 1_000_000_000, 50
#: Blocks into which a language's groups are dealt, as long as a block stays within GROUPS, and terms of a term block, about.
BLOCKS, GROUPS, TERMS = 4, 128, 4096
#: Entries that a task counts before it passes them on.
HELD = 1 << 19
#: ASCII that is no letter becomes a blank, A to Z lower case; other bytes stay.
_FOLDED = bytes((x + 32 if 65 <= x <= 90 else x) if x >= 128 or chr(x).isalpha() else 32 for x in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): partial counts of each group's terms; a null term says that there is a group.

    Each task adds up before it sends, and never holds more than HELD entries and a batch. Null lang, source and text are ''.
    """
    kind = "lang string, source string, term binary, count long, docs long"

    def sent(found: dict[tuple, tuple[Counter, Counter]]) -> pa.RecordBatch:
        groups = np.repeat(np.arange(len(found)), [len(times) + 1 for times, _ in found.values()])
        name = lambda k: pa.array([x[k] for x in found], pa.binary()).cast(pa.string()).take(pa.array(groups))
        terms, counts, docs = [], [], []
        for times, seen in found.values():  # a null term in front says that there is a group
            terms += [None, *times]
            counts += [0, *times.values()]
            docs += [0, *map(seen.__getitem__, times)]
        return pa.RecordBatch.from_arrays([name(0), name(1), pa.array(terms, pa.binary()), pa.array(counts, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "count", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(bytes_of(batch, "lang"), bytes_of(batch, "source"), bytes_of(batch, "text"), strict=True):
                times, seen = found.setdefault((lang, source), (Counter(), Counter()))
                words = text.translate(_FOLDED).split()
                before = len(times)
                times.update(words)
                seen.update(set(words))
                held += len(times) - before
                if held > HELD:
                    yield sent(found)
                    found, held = {}, 0
        if found:
            yield sent(found)

    small_batches(docs.sparkSession)
    plain = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x)
    return docs.select(plain("lang"), plain("source"), plain("text")).mapInArrow(run, kind)


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + ADDED) / (total + ADDED * terms)), in whole numbers of any size."""
    wide = lambda x: x.cast("decimal(38,0)")
    over, under = F.lit(UNIT).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(ADDED)), total.cast("decimal(20,0)") + F.lit(ADDED) * terms.cast("decimal(18,0)")
    return F.call_function("div", wide(over), wide(under)) + 1


def tables(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(terms, groups, counts), all written. terms: lang, term, term_id, q, the language's probability of a kept term;
    groups: lang, source, gid, v (kept terms), p0 (the probability of a term that the group lacks); counts: gid, term_id, lang, source, term, q and p of the kept
    terms that a group has."""
    raw = written(term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "counts")
    terms = raw.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count")).where(F.col("docs") >= least)
    terms = written(terms.select("lang", F.col("term").cast("string").alias("term"), "count", F.monotonically_increasing_id().alias("term_id")), "terms")
    sizes = written(terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("count").alias("n")), "sizes")  # a row a language
    terms = terms.join(sizes, "lang").select("lang", "term", "term_id", probability(F.col("count"), F.col("n"), F.col("v")).alias("q"))
    terms = written(terms, "probabilities")
    kept = raw.where("term is not null").withColumn("term", F.col("term").cast("string")).join(terms, ["lang", "term"])
    kept = written(kept.select("lang", "source", "term", "term_id", "count", "q"), "kept")
    groups = raw.where("term is null").select("lang", "source").join(kept.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left").join(sizes.select("lang", "v"), "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.monotonically_increasing_id().alias("gid"))
    groups = written(groups, "groups")
    p0 = F.when(F.col("v") > 0, probability(F.lit(0), F.col("n"), F.greatest(F.col("v"), F.lit(1))))
    groups = groups.withColumn("p0", p0)
    counts = kept.join(groups.drop("p0"), ["lang", "source"]).select("gid", "term_id", "lang", "source", "term", "q", probability(F.col("count"), F.col("n"), F.col("v")).alias("p"))
    return terms, written(groups, "groups"), written(counts, "present")


def cell(pdf: pd.DataFrame) -> pd.DataFrame:
    """(g, h, part), g < h: sums of |p - q| over the terms of one block, for groups of the cell's two group blocks.

    ``pdf``: side (0, 1, or 2 where both blocks are one), gid, term_id and p; rows without a term_id give each group's
    probability of what it lacks, and in ``terms`` how many kept terms the block has. Each block becomes a dense
    matrix of groups x terms that any of them has; all other terms of the block differ by what is lacked alone.
    """
    heads, rows = pdf[pdf["term_id"].isna()], pdf[pdf["term_id"].notna()]
    terms, at = np.unique(rows["term_id"].to_numpy(np.int64), return_inverse=True)
    absent = int(heads["terms"].iat[0]) - len(terms)

    def dense(side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mine = heads[heads["side"] == side].sort_values("gid")
        gids, lacked = mine["gid"].to_numpy(np.int64), mine["p"].to_numpy(np.int64)
        matrix = np.repeat(lacked[:, None], len(terms), axis=1)
        here = (rows["side"] == side).to_numpy()
        matrix[np.searchsorted(gids, rows["gid"].to_numpy(np.int64)[here]), at[here]] = rows["p"].to_numpy(np.int64)[here]
        return gids, lacked, matrix

    one = bool((heads["side"] == 2).any())
    left, right = (dense(2),) * 2 if one else (dense(0), dense(1))
    out = []
    for g, lacked, p in zip(*left, strict=True):
        sums = np.abs(right[2] - p).sum(axis=1) + absent * np.abs(right[1] - lacked)
        keep = right[0] > g if one else np.ones(len(sums), bool)
        out.append(pd.DataFrame({"g": g, "h": right[0][keep], "part": sums[keep]}))
    return pd.concat(out) if out else pd.DataFrame({"g": [], "h": [], "part": []}, dtype="int64")


def divergences(groups: DataFrame, terms: DataFrame, counts: DataFrame, block: int | None = None, term_block: int = TERMS) -> DataFrame:
    """(g, h, value): for each two groups of a language, in both orders, the sum of |p - q| over its kept terms.

    The cube: groups of a language are dealt into blocks (BLOCKS of them, more where a block would exceed GROUPS), its terms
    into blocks of some TERMS. A slice, the rows of one group block and one term block, goes to each cell that its group block
    shares with another (or itself). A task makes one cell's partial sums in memory that GROUPS x TERMS bounds; the sums of a
    pair meet along the term axis, and Spark adds them up before and after the shuffle.
    """
    per = groups.groupBy("lang").agg(F.count("*").alias("n"), F.max("v").alias("v"))
    wide = F.lit(block) if block else F.least(F.lit(GROUPS), F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCKS)))
    per = per.where("v > 0 and n > 1").select("lang", F.ceil(F.col("n") / wide).cast("int").alias("blocks"), F.ceil(F.col("v") / term_block).cast("int").alias("layers"), wide.alias("wide"))
    per = written(per, "cube")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("gid")) - 1  # of a language's groups, not of its rows
    dealt = groups.join(per, "lang").withColumn("b", F.floor(place / F.col("wide")).cast("int"))
    dealt = written(dealt.select("lang", "gid", "p0", "b", "blocks", "layers"), "dealt")
    layer = F.pmod(F.xxhash64(F.lit(11), "term_id"), F.col("layers")).cast("int")
    full = terms.join(per.select("lang", "layers"), "lang").groupBy("lang", layer.alias("layer")).agg(F.count("*").alias("terms"))
    heads = dealt.join(full, "lang").select("lang", "gid", "b", "blocks", "layer", F.lit(None).cast("long").alias("term_id"), F.col("p0").alias("p"), "terms")
    rows = counts.select("gid", "term_id", "p").join(dealt.drop("p0"), "gid").select("lang", "gid", "b", "blocks", layer.alias("layer"), "term_id", "p", F.lit(None).cast("long").alias("terms"))
    seat = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("b")).alias("one"), F.greatest(x, F.col("b")).alias("two"), F.when(x == F.col("b"), 2).when(x < F.col("b"), 1).otherwise(0).alias("side")))
    placed = heads.unionByName(rows).withColumn("seat", F.explode(seat)).select("lang", "layer", "seat.one", "seat.two", "seat.side", "gid", "term_id", "p", "terms")
    parts = placed.groupBy("lang", "layer", "one", "two").applyInPandas(cell, "g long, h long, part long")
    sums = written(parts.groupBy("g", "h").agg(F.sum("part").alias("value")), "divergences")
    return sums.unionByName(sums.select(F.col("h").alias("g"), F.col("g").alias("h"), "value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, block: int | None = None, term_block: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each group of documents, a lang and source, diverges.

    Part ``pair``: an item is each other source of the lang, value the sum over all kept terms of |p - q| (0 where
    there is none). Part ``term``: an item is each kept term that the group has more of than its lang, p > q, value p - q, the
    ``top`` highest. Ranks go by falling value, then the item's UTF-8. Terms are runs of ASCII letters and all characters
    beyond ASCII, A to Z lower-cased; a lang keeps those in ``least`` of its documents (rows that repeat count each time).
    p = 1 + floor(10**9 * (count + 5) / (N + 5 V)), in whole numbers. Null lang, source and text are ''; a group without a kept term has
    the probabilities of one that lacks them all; a lang with one source has no pairs; other columns are ignored; an empty table gives
    an empty result.

    Documents are counted in their tasks, so texts never move. A hot group's counts move as one row a term and task.
    """
    terms, groups, counts = tables(docs, least)
    names = groups.select("gid", "lang", "source")
    other = names.select(F.col("gid").alias("h"), F.col("lang"), F.col("source").alias("item"))
    pairs = names.withColumnRenamed("gid", "g").join(other, "lang").where("g <> h").join(divergences(groups, terms, counts, block, term_block), ["g", "h"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    above = counts.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    return pairs.withColumn("rank", rank).unionByName(above.withColumn("rank", rank).where(F.col("rank") <= top))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), groups AS (SELECT DISTINCT lang, source FROM docs),
words AS (SELECT doc_id, lang, source, unnest(terms) AS term FROM docs),
vocabulary AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
lang_sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM vocabulary GROUP BY lang),
langs AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (x.n + 5) // (s.n + 5 * v)::HUGEINT AS q FROM vocabulary x JOIN lang_sizes s USING (lang)),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN vocabulary USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
dense AS (
  SELECT g.lang, g.source, x.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(s.n, 0) + 5 * l.v)::HUGEINT AS p
  FROM groups g JOIN vocabulary x USING (lang) JOIN lang_sizes l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = x.term
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM dense JOIN langs USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
