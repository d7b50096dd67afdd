"""Invariants of published tables, checked on every row; each returns its violations, so an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def repeated_texts(entries: DataFrame, scope: list[str], text: str = "text") -> DataFrame:
    """Texts that a scope holds more than once: a collapse leaves none."""
    return entries.groupBy(*scope, text).agg(F.count("*").alias("times")).where("times > 1")


def false_anchors(entries: DataFrame, position: str = "verse") -> DataFrame:
    """Entries whose position isn't the lowest of those that they cover, or whose list has fewer than two."""
    some = F.col("positions").isNotNull()
    return entries.where(some & ((F.array_min("positions") != F.col(position)) | (F.size("positions") < 2) | (F.array_sort(F.array_distinct("positions")) != F.col("positions"))))


def unsorted_terms(index: DataFrame) -> DataFrame:
    """Index records whose term sorts before the one above it. Ranks leave no gap, so each record meets the one before by a join on
    its rank, which spreads a module over all tasks; records without one above, but for the first, are told as well."""
    before = index.select("module", (F.col("rank") + 1).alias("rank"), F.col("search").alias("above"))
    return index.join(before, ["module", "rank"], "left").where((F.col("above") > F.col("search")) | (F.col("above").isNull() & (F.col("rank") > 1))).select("module", "rank", "search")


def one_way_links(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """Links that only one direction lists. Both: module, id, ids."""
    out = forward.select("module", F.col("id").alias("src"), F.explode("ids").alias("dst"))
    back = backward.select("module", F.explode("ids").alias("src"), F.col("id").alias("dst"))
    return out.exceptAll(back).union(back.exceptAll(out))


def composition_faults(parts: DataFrame, whole: DataFrame, scope: list[str]) -> DataFrame:
    """Scopes whose composed entries differ from those of their parts, by count or digest. Both: scope, entry (a string)."""
    mark = lambda df, name: df.groupBy(*scope).agg(F.count("*").alias(f"{name}_n"), F.sum(F.xxhash64("entry").cast("decimal(38,0)")).alias(f"{name}_mark"))
    both = mark(parts, "part").join(mark(whole, "whole"), scope, "full_outer")
    return both.where(~(F.col("part_n").eqNullSafe(F.col("whole_n")) & F.col("part_mark").eqNullSafe(F.col("whole_mark"))))


def markup_members(kind: DataType, path: str = "") -> list[str]:
    """Paths of members, at any depth, that no published document may have."""
    if isinstance(kind, ArrayType):
        return markup_members(kind.elementType, path)
    if not isinstance(kind, StructType):
        return []
    found = []
    for f in kind.fields:
        here = f"{path}.{f.name}" if path else f.name
        found += ([here] if f.name.lower() == "html" else []) + markup_members(f.dataType, here)
    return found


#: Problems told of a rule, at most.
TOLD = 20


def write_checked(rows: DataFrame, rules: dict[str, Column], path: str, label: str = "path") -> DataFrame:
    """Writes ``rows`` to ``path`` as Parquet and returns a row a rule: rule, rows, broken, and problems, the first TOLD labels.

    A rule is a condition that a row must meet; null breaks it. Rules are counted while the rows are written, as metrics that Spark observes, so
    nothing is read or evaluated twice. What is written has a column ``broken``, the names of the rules that a row breaks, nothing
    for most rows. Only where a count isn't 0 are problems looked up, in that column alone, with TOLD rows a rule and task kept.
    Labels sort as strings; a null one comes first. An empty table has 0 rows and no problem.
    """
    broken = F.filter(F.array(*[F.when(~F.coalesce(kept, F.lit(False)), F.lit(name)) for name, kept in rules.items()]), lambda x: x.isNotNull())
    seen = Observation()
    counts = [F.count_if(F.array_contains("broken", name)).alias(f"rule{k}") for k, name in enumerate(rules)]
    rows.withColumn("broken", F.when(F.size(broken) > 0, broken)).observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    found, spark = seen.get, rows.sparkSession
    schema = "rule string, rows long, broken long, problems array<string>"
    told: dict[str, list[str]] = {}
    if any(found[f"rule{k}"] for k in range(len(rules))):
        each = spark.read.parquet(path).where("broken is not null").select(F.col(label).cast("string").alias("label"), F.explode("broken").alias("rule"))
        first = each.withColumn("n", F.row_number().over(Window.partitionBy("rule").orderBy("label"))).where(F.col("n") <= TOLD)
        told = {x.rule: x.labels for x in first.groupBy("rule").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "label"))), lambda x: x["label"]).alias("labels")).collect()}
    return spark.createDataFrame([(name, found["rows"], found[f"rule{k}"], told.get(name, [])) for k, name in enumerate(rules)], schema)


def linked_count(entries: DataFrame, forward: DataFrame) -> DataFrame:
    """(module, entries, linked): entries of each module, and those that link to another. ``forward``: module, id, ids."""
    links = forward.where(F.size("ids") > 0).select("module", "id", F.lit(True).alias("links")).distinct()
    return entries.select("module", "id").join(links, ["module", "id"], "left").groupBy("module").agg(F.count("*").alias("entries"), F.count("links").alias("linked"))


def claimed_names(documents: DataFrame, reserved: tuple[str, ...] = ("metadata.json", "books.json", "index.json")) -> DataFrame:
    """Paths of documents that stand where a module keeps one of its own: ``documents`` are those of entries, chapters and books."""
    return documents.where(F.element_at(F.split("path", "/"), -1).isin(*reserved)).select("path")
