"""Dictionaries: identifiers and occurrences, the alias index, the graph of links, and the search index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.ids import aliases, canonical_number, clean_target, encoded_id, hashed_id, link_candidates
from lectern.functions.text import fold_col, public_text_col, search_fold_col, strip_col
from lectern.operators.numbering import row_numbers
from lectern.sources.shared import scratch, written


def base_ids(entries: DataFrame, prefix: str | None = None) -> DataFrame:
    """Adds canonical and base: the canonical number where the key is one, else the encoded key."""
    canonical = canonical_number(F.col("key"), F.col(prefix) if prefix else None)
    return entries.withColumn("canonical", canonical).withColumn("base", F.coalesce("canonical", encoded_id(F.col("key"))))


#: What a numbered id ends with.
NUMBER = "--[0-9]+$"


def publishable(entries: DataFrame) -> DataFrame:
    """Entries with a key and a text, before they get ids, so that no other claims an id, alias or link: key is stripped, and
    text is the public one. ``entries``: key, plain and html; a null key is none."""
    rows = entries.withColumn("key", strip_col("key")).withColumn("text", public_text_col("plain", "html"))
    return rows.where("key <> '' and text <> ''")


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds name, the id without a number, occurrence and claim, the folded id. ``rows``: diverted says who is named by its hash."""
    name, folded = F.when(F.col("diverted"), F.col("hash")), F.when(F.col("diverted"), F.col("hash")).otherwise(F.col("folded"))
    rows = rows.withColumn("name", F.coalesce(name, "base")).withColumn("mark", folded)
    rows = row_numbers(rows, ["module", "mark"], ["ordinal"], "occurrence")
    number = F.when(F.col("occurrence") > 1, F.concat(F.lit("--"), F.col("occurrence"))).otherwise("")
    return rows.withColumn("claim", F.concat("mark", number)).withColumn("id", F.concat("name", number)).drop("mark", "name")


def _claimed(rows: DataFrame) -> DataFrame:
    """Adds next: whether, as ids are now, another key has claimed a row's folded base before it. Bases without a number are settled."""
    owners = written(_numbered(rows).groupBy("module", F.col("claim").alias("folded")).agg(F.min(F.struct("ordinal", "key")).alias("owner")), "owners")
    taken = (F.col("owner.ordinal") < F.col("ordinal")) & (F.col("owner.key") != F.col("key"))
    next_ = F.when(F.col("folded").rlike(NUMBER), F.coalesce(taken, F.lit(False))).otherwise(F.col("diverted"))
    return rows.join(owners, ["module", "folded"], "left").withColumn("next", next_).drop("owner")


def _settled(rows: DataFrame) -> DataFrame:
    """(module, ordinal, settled): who is named by its hash, of rows whose bases look like numbered ids.

    Whether a base is taken depends on earlier rows only, so passes over all rows at once agree with the rule that goes from row to
    row as soon as one changes nothing: the first pass is right about first rows, each further one about those that depend on
    them. Rows whose base has no number are settled before; only families (bases without their numbers) that hold such a
    base, and keys whose hash may be numbered so, take part. Two rows that end with one id are an error.
    """
    odd = rows.where(F.col("folded").rlike(NUMBER))
    family = lambda x: F.regexp_replace(x, "(--[0-9]+)+$", "")
    families = odd.select("module", family(F.col("folded")).alias("family")).distinct()
    either = rows.withColumn("family", F.explode(F.array_distinct(F.array(family(F.col("folded")), F.col("hash"))))).join(families, ["module", "family"], "left_semi")
    now = written(either.drop("family").dropDuplicates(["module", "ordinal"]), "claims")
    while True:
        now = written(_claimed(now), "claims")
        if now.where("next <> diverted").isEmpty():
            break
        now = now.withColumn("diverted", F.col("next")).drop("next")
    twice = _numbered(now).groupBy("module", "id").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice:
        raise ValueError(f"two entries of module {twice.module} would both be {twice.id}")
    return now.where(F.col("folded").rlike(NUMBER)).select("module", "ordinal", F.col("diverted").alias("settled"))


def assign_ids(entries: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Adds id and occurrence. ``entries``: module, ordinal (unique in its module), key, base, perhaps canonical; further
    columns are joined to the ids afterwards, from ``entries`` again.

    The first key to claim a folded base keeps it; another key with that base is named by its hash. Later entries
    of the same name are numbered by their order, and the number is part of the id from the second on, claimed like any
    other. One aggregate and one numbering do this, neither of which gathers a base's entries in one task; bases that look like
    numbered ids are settled by passes of the same (``_settled``).
    What ids need is written once and so are the ids: ``entries`` is read once for them.
    """
    slim = entries.select(*[x for x in entries.columns if x in ("module", "ordinal", "key", "base", "canonical")])
    rows = slim.withColumn("folded", fold_col("base", ascii_only=ascii_only)).withColumn("hash", hashed_id(F.col("key")))
    rows = written(rows, "keys")
    owners = written(rows.groupBy("module", "folded").agg(F.min_by("key", "ordinal").alias("owner")), "owners")  # so that Spark can split the join
    rows = rows.join(owners, ["module", "folded"]).withColumn("diverted", F.col("owner") != F.col("key")).drop("owner")
    if not rows.where(F.col("folded").rlike(NUMBER)).isEmpty():
        settled = F.coalesce("settled", "diverted")
        rows = rows.join(_settled(rows), ["module", "ordinal"], "left").withColumn("diverted", settled).drop("settled")
    found = written(_numbered(rows).select(*slim.columns, "id", "occurrence"), "ids")
    if slim.columns == entries.columns:
        return found
    return entries.join(found.select("module", "ordinal", "id", "occurrence"), ["module", "ordinal"]).select(*entries.columns, "id", "occurrence")


def searchable(named: DataFrame) -> DataFrame:
    """Adds aliases and search, the key as it is searched for."""
    return named.withColumn("aliases", aliases(F.col("key"), F.col("canonical"))).withColumn("search", search_fold_col("key"))


def alias_index(named: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(module, alias, target): the first entry to bear an alias, by order, then key, further aliases, search form."""
    ranked = F.concat(F.array("key"), F.array_remove("aliases", F.col("key")), F.array("search"))
    rows = named.select("module", "ordinal", "id", F.posexplode(ranked).alias("rank", "alias"))
    rows = rows.withColumn("alias", fold_col("alias", ascii_only=ascii_only)).where("alias <> ''")
    return rows.groupBy("module", "alias").agg(F.min_by("id", F.struct("ordinal", "rank")).alias("target"))


def link_edges(named: DataFrame, candidates: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(module, src, dst), distinct, without loops. ``candidates``: module, id, target (raw). A target is looked up
    folded, and as a search form where that finds nothing."""
    index = written(alias_index(named, ascii_only), "aliases")
    wanted = candidates.withColumn("target", clean_target(F.col("target"))).where("target is not null").distinct()
    wanted = wanted.withColumn("direct", fold_col("target", ascii_only=ascii_only)).withColumn("loose", fold_col(search_fold_col("target"), ascii_only=ascii_only))
    first = index.select("module", F.col("alias").alias("direct"), F.col("target").alias("dst1"))
    second = index.select("module", F.col("alias").alias("loose"), F.col("target").alias("dst2"))
    found = wanted.join(first, ["module", "direct"], "left").join(second, ["module", "loose"], "left")
    edges = found.select("module", F.col("id").alias("src"), F.coalesce("dst1", "dst2").alias("dst"))
    return edges.where("dst is not null and src <> dst").distinct()


def candidates_of(entries: DataFrame, *texts: str, ids: DataFrame | None = None) -> DataFrame:
    """(module, id, target). ``entries`` has the texts; where ``ids`` (module, ordinal, id) is given, only the targets found
    in them are joined to it, not the texts."""
    target = F.explode(link_candidates(*map(F.col, texts))).alias("target")
    if ids is None:
        return entries.select("module", "id", target)
    return entries.select("module", "ordinal", target).join(ids.select("module", "ordinal", "id"), ["module", "ordinal"]).select("module", "id", "target")


def neighbours(edges: DataFrame, forward: bool = True) -> DataFrame:
    """(module, id, ids): each entry's targets, or where not ``forward`` its sources, by id."""
    me, other = ("src", "dst") if forward else ("dst", "src")
    return edges.groupBy("module", F.col(me).alias("id")).agg(F.array_sort(F.collect_set(other)).alias("ids"))


ORDER = ("module", "search", "folded", "occurrence", "ordinal")
ROWS = "module string, id string, key string, search string, aliases array<string>, occurrence long, ordinal long, folded string, place long, part int"
PARTS = "module string, part int, n long, low string, high string, start long"


def write_index(named: DataFrame, path: str, parts: int | None = None, ascii_only: bool = False) -> None:
    """Writes the slim records of an index below ``path``, in order of search form, folded key, occurrence and ordinal.

    Records are dealt by ranges of their whole order, so one hot beginning, or one hot term, spreads over as many parts as it
    fills; each part is a folder, sorted, and a record knows its place in it. The table of parts (a row a part and module) has
    its least and greatest search form and the number of the module's records before it: ranks are their sums, and no window
    ever sees a module.
    """
    spark = named.sparkSession
    slim = named.select("module", "id", "key", "search", "aliases", "occurrence", F.col("ordinal").cast("long").alias("ordinal"), fold_col("key", ascii_only=ascii_only).alias("folded"))
    dealt = slim.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *ORDER)
    placed = dealt.withColumn("part", F.spark_partition_id()).sortWithinPartitions("part", *ORDER)
    placed.withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).write.partitionBy("part").parquet(f"{path}/rows")
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows")
    each = rows.groupBy("module", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"), F.min("search").alias("low"), F.max("search").alias("high"))
    before = F.sum("n").over(Window.partitionBy("module").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    each.withColumn("start", F.coalesce(before, F.lit(0)) - F.col("first")).drop("first").coalesce(1).write.parquet(f"{path}/parts")


def read_index(spark: SparkSession, path: str, prefix: str | None = None, term: str | None = None) -> DataFrame:
    """module, rank (from 1 in each module), id, key, search, and aliases and occurrence where they say something new.

    With a ``prefix`` or a whole ``term``, only those records; the table of parts says which folders can hold them, and no
    other is read. Parquet skips what else it can by the bounds of its row groups.
    """
    rows, parts = spark.read.schema(ROWS).parquet(f"{path}/rows"), spark.read.schema(PARTS).parquet(f"{path}/parts")
    if term is not None:
        rows, parts = rows.where(F.col("search") == term), parts.where((F.col("low") <= term) & (F.col("high") >= term))
    if prefix:
        rows, parts = rows.where(F.col("search").startswith(prefix)), parts.where((F.substring("low", 1, len(prefix)) <= prefix) & (F.col("high") >= prefix))
    if prefix or term is not None:
        held = [x.part for x in parts.select("part").distinct().collect()]  # as many numbers as there are parts, at most
        rows = rows.where(F.col("part").isin(held)) if held else rows.limit(0)
    rank = (F.col("start") + F.col("place") + 1).cast("long").alias("rank")
    slim = F.when(F.col("aliases") != F.array("key"), F.col("aliases"))
    found = rows.join(parts.select("module", "part", "start"), ["module", "part"])
    return found.select("module", rank, "id", "key", "search", slim.alias("aliases"), F.when(F.col("occurrence") > 1, F.col("occurrence")).alias("occurrence"))


def search_index(named: DataFrame, ascii_only: bool = False) -> DataFrame:
    """The index of ``named``, written below the shared folder and read from there."""
    path = scratch(named.sparkSession, "index")
    write_index(named, path, ascii_only=ascii_only)
    return read_index(named.sparkSession, path)


def unique_keys(named: DataFrame, ascii_only: bool = False) -> DataFrame:
    return named.groupBy("module").agg(F.count_distinct(fold_col("key", ascii_only=ascii_only)).alias("unique_keys"))


def with_prefix(index: DataFrame, prefix: str) -> DataFrame:
    return index.where(F.col("search").startswith(prefix))
