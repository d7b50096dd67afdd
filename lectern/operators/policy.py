"""Which modules may be published: their kind, the licence policy, and guards on their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import fold_col, license_text

# Drivers of either kind, and names that no module may take.
COMMENTARY_DRIVERS = ("rawcom", "rawcom4", "zcom", "zcom4", "rawfiles")
DICTIONARY_DRIVERS = ("rawld", "rawld4", "zld", "rawfiles")
RESERVED = ("build", "commentaries", "dictionaries", "hashes", "schema")


def last_value(fields: Column, name: str, default: str = "") -> Column:
    """A field's last value, stripped."""
    return F.coalesce(F.trim(F.try_element_at(F.try_element_at(fields, F.lit(name)), F.lit(-1))), F.lit(default))


def module_kind(driver: Column, category: Column, module_type: Column) -> Column:
    """commentaries, dictionaries or null. Plain files need a hint in the category or type; commentaries come first."""
    driver, said = F.lower(driver), F.lower(F.concat_ws(" ", category, module_type))
    hinted = driver != "rawfiles"
    return (
        F.when(driver.isin(*COMMENTARY_DRIVERS) & (hinted | said.contains("comment")), "commentaries")
        .when(driver.isin(*DICTIONARY_DRIVERS) & (hinted | said.contains("diction") | said.contains("lexicon")), "dictionaries")
    )


def decide(modules: DataFrame, denied: DataFrame, approved: DataFrame, licenses: DataFrame, name: str = "name", license: str = "license_key") -> DataFrame:
    """Adds allowed and reason. A denial beats an approval, an approval beats the licence, and what nothing allows is out.

    ``denied`` and ``approved``: name, why; ``licenses``: license. All three are short lists that people keep. Names are
    compared folded on both sides; of several entries for one name, the greatest reason is told. A module without a licence
    has none that could be approved.
    """
    listed = lambda df, mark: df.groupBy(fold_col("name").alias(mark)).agg(F.max(F.coalesce("why", F.lit(""))).alias(f"{mark}_why"))
    fine = licenses.select(F.col("license").alias("_fine")).where("_fine <> ''").distinct()
    named = modules.withColumn("_name", fold_col(F.col(name)))
    joined = named.join(listed(denied, "_no"), F.col("_name") == F.col("_no"), "left").join(listed(approved, "_yes"), F.col("_name") == F.col("_yes"), "left")
    joined = joined.join(fine, F.col(license) == F.col("_fine"), "left").drop("_name")
    allowed = F.col("_no").isNull() & (F.col("_yes").isNotNull() | F.col("_fine").isNotNull())
    reason = (
        F.when(F.col("_no").isNotNull(), F.concat(F.lit("denied: "), "_no_why")).when(F.col("_yes").isNotNull(), F.concat(F.lit("approved: "), "_yes_why"))
        .when(F.col("_fine").isNotNull(), F.concat(F.lit("licence: "), F.col(license))).otherwise(F.lit("licence not approved"))
    )
    return joined.withColumn("allowed", allowed).withColumn("reason", reason).drop("_no", "_no_why", "_yes", "_yes_why", "_fine")


def select_modules(modules: DataFrame, resource: str = "all", requested: list[str] | None = None) -> DataFrame:
    """Modules of a kind that were asked for by name (in any case); names that nothing bears are an error that lists them."""
    kept = modules.where("kind is not null" if resource == "all" else F.col("kind") == resource)
    if not requested:
        return kept
    names = sorted({x.casefold() for x in requested})
    spark = modules.sparkSession
    missing = [x.name for x in missing_names(spark.createDataFrame([(x,) for x in names], "name string"), kept.select(fold_col("name").alias("name"))).orderBy("name").collect()]
    if missing:
        raise ValueError("no such module: " + ", ".join(missing))
    return kept.where(fold_col("name").isin(names))


def missing_names(requested: DataFrame, found: DataFrame) -> DataFrame:
    return requested.join(found, "name", "left_anti").distinct()


def slug_collisions(modules: DataFrame) -> DataFrame:
    """(kind, slug, names): path names that two different modules of a kind would share."""
    same = modules.groupBy("kind", "slug").agg(F.count_distinct("name").alias("names"))
    return same.where("names > 1")


def reserved_names(modules: DataFrame) -> DataFrame:
    return modules.where(F.col("slug").isin(*RESERVED))


def catalog_rollup(modules: DataFrame) -> DataFrame:
    """A row a kind: how many modules, and their ids in order."""
    return modules.groupBy("kind").agg(F.count("*").alias("module_count"), F.array_sort(F.collect_list("slug")).alias("ids"))


def load_policy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(denied, approved, licenses) for ``decide``, from a JSON file that lists licences and names modules with reasons.
    Licences are compared squeezed and folded."""
    kept = "approved_license_values array<string>, approved_modules map<string,string>, denied_modules map<string,string>"
    policy = spark.read.schema(kept).json(path, multiLine=True)
    names = lambda column: policy.select(F.explode(column).alias("name", "why"))
    values = policy.select(F.explode("approved_license_values").alias("license"))
    return names("denied_modules"), names("approved_modules"), values.select(license_text("license").alias("license"))


def misclassified(modules: DataFrame, streams: DataFrame) -> DataFrame:
    """Modules whose stream says another classification than their kind. ``streams``: name, classification."""
    expected = F.when(F.col("kind") == "commentaries", "commentary").when(F.col("kind") == "dictionaries", "dictionary")
    return modules.join(streams, "name").where(~expected.eqNullSafe(F.col("classification"))).select("name", "kind", "classification")
