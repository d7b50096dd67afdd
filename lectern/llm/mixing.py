"""Mixing sources to target weights: Efraimidis-Spirakis keys, prefix sums to word budgets, whole epochs first."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import BLANKS, bytes_of, map_arrow, read, written

#: Weights of the sources by code point, repeating; share of all words that the mix takes; most of a source, in its sizes.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Documents in a bucket of keys, about, and buckets that are summed up together first.
BUCKET, SPAN = 512, 1024
#: ASCII that is no letter.
PLAIN = bytes(x for x in range(128) if not chr(x).isalpha())


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` plus mix_size (its text's words) and mix_quality: 1 to 4, rising with the share of letters in words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, quality = [], []
        for text in bytes_of(batch, "text"):
            words = (text or b"").split()
            sizes.append(len(words))
            tight = len(text.translate(None, BLANKS)) if words else 0
            quality.append(1.0 + 3.0 * len(text.translate(None, PLAIN)) / tight if words else 1.0)
        names = [*batch.schema.names, "mix_size", "mix_quality"]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(quality, pa.float64())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, run, f"{schema}, mix_size long, mix_quality double")


def source_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("mix_source")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Per source its size, its target and how often all of it is taken (epochs). ``sizes``: a row a source.

    Shares go by weight; a source stops at ``most`` times its size, and its excess goes to the others by weight.
    In order of cap over weight the capped sources come first, so running sums find the level in one pass.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("mix_source") == "", "mix_source")) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    by = Window.orderBy(F.col("cap") / F.col("weight"), "mix_source")
    everything = Window.partitionBy()
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    given = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = given / F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("level", level)
        .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
        .withColumn("level", F.max(F.when(~F.col("capped"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("level") * F.col("weight")))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        .select("mix_source", "n", "source_size", "target", "epochs", "budget")
    )


def keyed(rows: DataFrame, seed: int) -> DataFrame:
    """Adds the Efraimidis-Spirakis key: exponential, its rate the document's quality; the smallest keys are taken.

    The uniform number behind it comes from an MD5 digest, so that other engines can make the same one.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("mix_mark")))
    unit = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return rows.withColumn("mix_key", -F.log(unit) / F.col("mix_quality"))


def bucket() -> Column:
    """Equal keys share a bucket and buckets follow the keys; a bucket holds some BUCKET documents of a source."""
    many = F.ceil(F.col("n") / F.lit(BUCKET))
    return F.least(many - 1, F.floor((1 - F.exp(-F.col("mix_key"))) * many)).cast("long")


def first_beyond(sums: DataFrame, part: str) -> DataFrame:
    """For each source the part in which its running sum of words reaches the budget, and the words before that part.
    ``sums``: mix_source, the part, words, start (what comes before all of these) and budget; few rows a source."""
    running = F.col("start") + F.sum("words").over(Window.partitionBy("mix_source").orderBy(part))
    reached = sums.withColumn("end", running).where((F.col("budget") > 0) & (F.col("end") >= F.col("budget")))
    edge = F.min_by(F.struct(F.col(part).alias("edge"), (F.col("end") - F.col("words")).alias("start")), part)
    return reached.groupBy("mix_source").agg(edge.alias("edge")).select("mix_source", "edge.*")


def plan(rows: DataFrame, seed: int, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """A row a source: its target, epochs, and where its fractional epoch ends: the edge bucket, the last key taken in it,
    and the share of the rows with that key (rows that repeat have one) that the budget still holds.

    Words are summed up for spans of buckets, then for the buckets of one span a source, then for the keys of one bucket.
    """
    sources = written(targets(rows.groupBy("mix_source").agg(F.count("*").alias("n"), F.sum("mix_size").alias("source_size")), weights, share, most), "sources")
    dealt = keyed(rows, seed).join(sources, "mix_source").withColumn("bucket", bucket())
    filled = written(dealt.groupBy("mix_source", "bucket").agg(F.sum("mix_size").alias("words"), F.first("budget").alias("budget")), "buckets")
    filled = filled.withColumn("span", F.floor(F.col("bucket") / SPAN))
    spans = filled.groupBy("mix_source", "span").agg(F.sum("words").alias("words"), F.first("budget").alias("budget"))
    spans = written(first_beyond(spans.withColumn("start", F.lit(0)), "span").withColumnRenamed("edge", "span"), "spans")
    edges = written(first_beyond(filled.join(spans, ["mix_source", "span"]), "bucket"), "edges")
    keys = dealt.join(edges.withColumnRenamed("edge", "bucket"), ["mix_source", "bucket"])
    keys = keys.groupBy("mix_source", "bucket", "start", "budget", "mix_key").agg(F.sum("mix_size").alias("words"), F.count("*").alias("many"))
    before = F.col("start") + F.sum("words").over(Window.partitionBy("mix_source", "bucket").orderBy("mix_key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    # Of rows with one key, as many as bring the sum of words nearest to the budget.
    room = F.col("budget") - F.col("before")
    held = F.when(F.col("words") == 0, F.when(room >= 0, 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.floor(room * F.col("many") / F.col("words") + 0.5), F.col("many"))) / F.col("many"))
    ends = keys.withColumn("before", before).withColumn("held", held).where("held > 0").groupBy("mix_source").agg(F.max(F.struct("mix_key", "held")).alias("last"))
    ends = ends.select("mix_source", F.col("last.mix_key").alias("last_key"), F.col("last.held").alias("held"))
    return written(sources.join(edges.select("mix_source", "edge"), "mix_source", "left").join(ends, "mix_source", "left"), "plan")


def mix(docs: DataFrame, seed: int = 42, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs`` plus mix_size, mix_source_size, mix_target and mix_repeats, how often the mix takes the document.

    Needs doc_id, text and source. Sizes are words; sources (null is one, the last) weigh 5, 2, 1, repeating, by code
    point. A source is taken whole as often as its target holds it; what is left goes to documents in the order of
    their exponential keys, as far as the prefix sum of words comes nearest to the budget. Keys come from a seed,
    doc_id and text, so reruns agree. Rows equal in both share a key; where the budget ends among them, that share of
    them is taken which it still holds, chosen by their places in the input. A null text has size 0; documents of a
    source without words aren't taken. All other columns stay as they are, whatever their names; columns named like the
    four added ones are replaced. An empty table gives an empty result.

    Keys fall in buckets of some hundred documents; only sums of buckets and the keys of one bucket a source are
    ordered, so no task sees a whole source. The plan has one row a source.
    """
    added = ("mix_size", "mix_source_size", "mix_target", "mix_repeats")
    record = F.struct(*[F.col(f"`{x}`") for x in docs.columns if x not in added]).alias("record")
    mark = F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mix_mark")
    rows = measured(docs.select(record, "doc_id", F.col("text").cast("string").alias("text"), source_key(), mark, F.monotonically_increasing_id().alias("place"))).drop("text")
    narrow = written(rows.select("doc_id", "mix_mark", "mix_size", "mix_quality", "mix_source"), "sizes")
    made = plan(narrow, seed, weights, share, most)
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "place"), 11).cast("double") / F.lit(float(1 << 53))
    last = (F.col("mix_key") < F.col("last_key")) | ((F.col("mix_key") == F.col("last_key")) & (unit < F.col("held")))
    takes = (F.col("bucket") < F.col("edge")) | ((F.col("bucket") == F.col("edge")) & last)
    found = keyed(rows, seed).join(made, "mix_source").withColumn("bucket", bucket())
    repeats = F.col("epochs") + F.coalesce(takes, F.lit(False)).cast("long")
    return found.select("record.*", "mix_size", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), repeats.alias("mix_repeats"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_repeats")).alias("taken"))


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS source FROM documents
), sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS size, md5(text) AS mark,
    octet_length(encode(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))) AS tight, octet_length(encode(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g'))) AS letters
  FROM texts
), sources AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, CAST([5, 2, 1][(row_number() OVER (ORDER BY source = '', source) - 1) % 3 + 1] AS DOUBLE) AS weight FROM sizes GROUP BY source
), levels AS (
  SELECT *, 2 * source_size AS cap,
    (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY 2 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), targets AS (
  SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap ELSE weight * max(CASE WHEN cap > level * weight THEN level END) OVER () END AS target FROM levels
), plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets
), keyed AS (
  SELECT doc_id, size, plans.*, target - epochs * source_size AS budget,
    -ln((CAST(CAST('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR) || '|' || mark), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
      / CASE WHEN size > 0 THEN 1 + 3.0::DOUBLE * letters / tight ELSE 1 END AS key
  FROM sizes JOIN plans USING (source)
), reached AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reach FROM keyed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (epochs + CASE WHEN budget > 0 AND reach - size / 2 <= budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM reached
"""
