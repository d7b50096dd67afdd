"""References to passages: tokens in text, their resolution against the dimension of books, coordinates of entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import fold, fold_col

# The books by number, each with its name and its abbreviations.
BOOKS = (
    (1, "Genesis", ("Gen",)), (2, "Exodus", ("Exod",)), (3, "Leviticus", ("Lev",)), (4, "Numbers", ("Num",)), (5, "Deuteronomy", ("Deut",)),
    (6, "Joshua", ("Josh",)), (7, "Judges", ("Judg",)), (8, "Ruth", ("Ruth",)), (9, "I Samuel", ("1Sam",)), (10, "II Samuel", ("2Sam",)),
    (11, "I Kings", ("1Kgs",)), (12, "II Kings", ("2Kgs",)), (13, "I Chronicles", ("1Chr",)), (14, "II Chronicles", ("2Chr",)), (15, "Ezra", ("Ezra",)),
    (16, "Nehemiah", ("Neh",)), (17, "Esther", ("Esth",)), (18, "Job", ("Job",)), (19, "Psalms", ("Ps",)), (20, "Proverbs", ("Prov",)),
    (21, "Ecclesiastes", ("Eccl",)), (22, "Song of Solomon", ("Song",)), (23, "Isaiah", ("Isa",)), (24, "Jeremiah", ("Jer",)), (25, "Lamentations", ("Lam",)),
    (26, "Ezekiel", ("Ezek",)), (27, "Daniel", ("Dan",)), (28, "Hosea", ("Hos",)), (29, "Joel", ("Joel",)), (30, "Amos", ("Amos",)),
    (31, "Obadiah", ("Obad",)), (32, "Jonah", ("Jonah",)), (33, "Micah", ("Mic",)), (34, "Nahum", ("Nah",)), (35, "Habakkuk", ("Hab",)),
    (36, "Zephaniah", ("Zeph",)), (37, "Haggai", ("Hag",)), (38, "Zechariah", ("Zech",)), (39, "Malachi", ("Mal",)), (40, "Matthew", ("Matt",)),
    (41, "Mark", ("Mark",)), (42, "Luke", ("Luke",)), (43, "John", ("John",)), (44, "Acts", ("Acts",)), (45, "Romans", ("Rom",)),
    (46, "I Corinthians", ("1Cor",)), (47, "II Corinthians", ("2Cor",)), (48, "Galatians", ("Gal",)), (49, "Ephesians", ("Eph",)), (50, "Philippians", ("Phil",)),
    (51, "Colossians", ("Col",)), (52, "I Thessalonians", ("1Thess",)), (53, "II Thessalonians", ("2Thess",)), (54, "I Timothy", ("1Tim",)), (55, "II Timothy", ("2Tim",)),
    (56, "Titus", ("Titus",)), (57, "Philemon", ("Phlm",)), (58, "Hebrews", ("Heb",)), (59, "James", ("Jas",)), (60, "I Peter", ("1Pet",)),
    (61, "II Peter", ("2Pet",)), (62, "I John", ("1John",)), (63, "II John", ("2John",)), (64, "III John", ("3John",)), (65, "Jude", ("Jude",)),
    (66, "Revelation of John", ("Rev",)), (67, "I Esdras", ("1Esd",)), (68, "II Esdras", ("2Esd",)), (69, "Tobit", ("Tob",)), (70, "Judith", ("Jdt",)),
    (71, "Additions to Esther", ("AddEsth", "EsthGr")), (72, "Additional Psalm", ("Ps151",)), (73, "Wisdom", ("Wis",)), (74, "Sirach", ("Sir",)),
    (75, "Baruch", ("Bar", "EpJer")), (76, "Prayer of Azariah", ("PrAzar",)), (77, "Susanna", ("Sus",)), (78, "Bel and the Dragon", ("Bel",)),
    (79, "Prayer of Manasses", ("PrMan",)), (80, "I Maccabees", ("1Macc",)), (81, "II Maccabees", ("2Macc",)), (82, "III Maccabees", ("3Macc",)), (83, "IV Maccabees", ("4Macc",)),
)

# Fixed value: the format of a reference.
#: Book, chapter and perhaps verse, joined by dots. Digits may be any script's, letters are ASCII.
TOKEN = r"[1-4]?[A-Za-z][A-Za-z0-9]+\.\p{Nd}+(?:\.\p{Nd}+)?"
REFERENCE = "struct<osis:string,book:int,chapter:int,verse:int>"
REFERENCES = f"array<{REFERENCE}>"


def books(spark: SparkSession) -> DataFrame:
    """The dimension: alias (folded), book and name; one row an alias, under a hundred in all."""
    return spark.createDataFrame([(fold(alias), number, name) for number, name, aliases in BOOKS for alias in aliases], "alias string, book int, name string")


def book_map() -> Column:
    """Folded alias to number, as a literal: a lookup without a join."""
    return F.create_map(*[F.lit(x) for number, _, aliases in BOOKS for alias in aliases for x in (fold(alias), number)])


def reference_tokens(*texts: Column | str) -> Column:
    """Distinct tokens in all the texts, by code point. Tokens inside link addresses are found as in any text."""
    found = [F.coalesce(F.regexp_extract_all(F.col(x) if isinstance(x, str) else x, F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>")) for x in texts]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))


def resolve_tokens(tokens: Column, aliases: Column | None = None) -> Column:
    """References of those tokens whose book is known, in the tokens' order. Aliases here are ASCII, so lower() folds them."""
    aliases = book_map() if aliases is None else aliases

    def one(token: Column) -> Column:
        part = F.split(token, r"\.")
        number = lambda k: F.try_element_at(part, F.lit(k)).try_cast("int")
        return F.struct(token.alias("osis"), F.try_element_at(aliases, F.lower(part[0])).alias("book"), number(2).alias("chapter"), number(3).alias("verse"))

    return F.filter(F.transform(tokens, one), lambda x: x["book"].isNotNull() & x["chapter"].isNotNull())


def coordinates(verse: Column) -> Column:
    """The book's number of an entry: by its reference's abbreviation, else by its place in its testament, else null."""
    named = F.try_element_at(book_map(), F.lower(F.split(F.coalesce(verse["osis"], F.lit("")), r"\.")[0]))
    at, half = verse["book"], verse["testament"]
    return F.coalesce(named, F.when((half == 1) & at.between(1, 39), at).when((half == 2) & at.between(1, 27), at + 39))


def resolve_by_join(tokens: DataFrame, dimension: DataFrame, token: str = "token") -> DataFrame:
    """The same as a join, for a dimension that is a table: token, book, chapter, verse; unknown books go."""
    part = F.split(F.col(token), r"\.")
    keyed = tokens.withColumn("alias", fold_col(part[0], ascii_only=True)).withColumn("chapter", F.try_element_at(part, F.lit(2)).try_cast("int")).withColumn("verse", F.try_element_at(part, F.lit(3)).try_cast("int"))
    return keyed.where("chapter is not null").join(dimension, "alias")
