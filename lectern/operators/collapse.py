"""Repeated passages collapsed into one record with the positions it covers, and the roll-ups above it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lectern.functions.render import pretty_bytes, pretty_lines


def collapse(rows: DataFrame, scope: list[str], position: str = "verse", text: str = "text", order: str = "ordinal", anchor: str | None = None, refs: str | None = None) -> DataFrame:
    """One row for each (scope, text): covered positions, the lowest of them, the anchor's label and the references' union.

    The anchor is the row of the lowest position, the earliest by ``order`` on ties; only its label counts, and an
    empty one is null. ``positions`` is null where there is only one. Nothing crosses a scope. Long texts group by
    themselves: Spark aggregates partially before the one shuffle.
    """
    where = F.col(position)
    made = [F.min(where).alias(position), F.array_sort(F.collect_set(where)).alias("covered"), F.count("*").alias("copies")]
    if anchor:
        made.append(F.min_by(F.nullif(F.col(anchor), F.lit("")), F.struct(where, F.col(order))).alias(anchor))
    if refs:
        union = F.array_distinct(F.flatten(F.collect_list(F.coalesce(F.col(refs), F.array().cast(rows.schema[refs].dataType)))))
        made.append(F.array_sort(union, _by_reference).alias(refs))
    found = rows.groupBy(*scope, text).agg(*made)
    return found.withColumn("positions", F.when(F.size("covered") > 1, F.col("covered")))


def _by_reference(a: Column, b: Column) -> Column:
    key = lambda x: F.struct(x["osis"], x["book"], x["chapter"], F.coalesce(x["verse"], F.lit(0)))
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


def chapters(collapsed: DataFrame, scope: list[str], position: str = "verse", text: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """A row a scope: its entries by (position, text) and how many there are. A chapter's entries are bounded by its positions."""
    entry = F.struct(position, text, *[x for x in ("positions", *extra)])
    return collapsed.groupBy(*scope).agg(F.array_sort(F.collect_list(entry)).alias("entries"), F.count("*").alias("entry_count"))


def book_index(chapter_rows: DataFrame, book: list[str], chapter: str = "chapter") -> DataFrame:
    """A row a book: its chapters in order, the sum of their entries, and whether it has an introduction (chapter 0)."""
    return chapter_rows.groupBy(*book).agg(
        F.array_sort(F.collect_set(chapter)).alias("chapters"), F.sum("entry_count").alias("entry_count"), F.max((F.col(chapter) == 0).cast("int")).cast("boolean").alias("has_introduction"),
    )


def coordinates(rows: DataFrame, scope: list[str]) -> DataFrame:
    return rows.select(*scope).distinct()


def utf8_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.encode(F.col(text), "UTF-8")), F.lit(0)).cast("long")


def storage(collapsed: DataFrame, text: str = "text") -> DataFrame:
    """One row: entries and bytes before and after the collapse, from the collapsed rows alone, as a row's ``copies`` says how
    many it stands for. The rounded ratio is made by ``ratio`` on the driver."""
    size = utf8_bytes(text)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return collapsed.agg(total(F.col("copies")).alias("source_entries"), total(F.col("copies") * size).alias("source_bytes"), F.count("*").alias("published_entries"), total(size).alias("published_bytes"))


def storage_levels(entries: DataFrame, modules: DataFrame, books: DataFrame, text: str = "text") -> DataFrame:
    """module, book, chapter, parts, entries, bytes, source_entries, source_bytes, text_bytes: what each chapter, book (chapter null)
    and module (book null too) is published with; parts counts the chapters of a book and the books of a module.

    ``entries``: collapsed, with module, book, chapter, copies, the text and ``entry``, the struct that a chapter shows, absent members null;
    ``modules``: module, id, language, description; ``books``: book, name. Sizes are those of the composed documents, to
    the byte, from the columns alone: a chapter in its book and again in its module is the same lines, four spaces deeper
    each time. One pass sums entries into chapters; one GROUPING SETS over the chapters gives all levels.
    """
    kind, size = entries.schema["entry"].dataType, utf8_bytes(text)
    entry = F.col("entry")
    sized = entries.select("module", "book", "chapter", "copies", size.alias("text_bytes"), pretty_bytes(entry, kind, 2).alias("e"), pretty_lines(entry, kind).alias("l"))
    sized = sized.groupBy("module", "book", "chapter").agg(F.count("*").alias("n"), F.sum("e").alias("e"), F.sum("l").alias("l"), F.sum("copies").alias("source_entries"), F.sum(F.col("copies") * F.col("text_bytes")).alias("source_bytes"), F.sum("text_bytes").alias("text_bytes"))
    rows = sized.join(modules, "module").join(books, "book")

    def frame(kind: str, name: str, *members: Column) -> Column:
        """Bytes and lines of a document beside the members of its one array: it is shown with one of no bytes."""
        document = F.struct(F.lit(kind).alias("schema"), F.col("id").alias("commentary"), F.col("language"), *members, F.array(F.lit("")).alias(name))
        shown = rows.select(document.alias("d")).schema["d"].dataType
        return F.struct((pretty_bytes(document, shown) + 1 - 6).alias("bytes"), (pretty_lines(document, shown) - 1).alias("lines"))

    book = [F.col("book"), F.col("name")]
    joined = lambda sizes, parts: sizes + 2 * (parts - 1)  # noqa: E731  a comma and an end of line between two
    rows = rows.withColumns({"c": frame("commentary-chapter-v1", "entries", *book, F.col("chapter")), "b": frame("commentary-book-v1", "chapters", *book), "m": frame("commentary-v1", "books", F.col("description").alias("name"))})
    chapters = rows.withColumn("size", F.col("c.bytes") + joined(F.col("e") + 4 * F.col("n"), F.col("n"))).withColumn("lines", F.col("c.lines") + F.col("l")).withColumn("b", F.struct("book", "b.bytes", "b.lines"))
    total = lambda x: F.sum(x).cast("long").alias(x)
    sums = [total(x) for x in ("n", "size", "lines", "source_entries", "source_bytes", "text_bytes")]
    sets = chapters.groupingSets([["module", "book", "chapter"], ["module", "book"], ["module"]], "module", "book", "chapter").agg(
        F.grouping_id().alias("level"), F.count("*").alias("count"), *sums, F.first("m.bytes").alias("frame"), F.collect_set("b").alias("around"),
    )  # fmt: skip  around: a struct a book, of which there are under a hundred
    size, lines, count, many = F.col("size"), F.col("lines"), F.col("count"), F.size("around")
    frames = lambda deep: F.aggregate("around", F.lit(0).cast("long"), lambda a, x: a + x["bytes"] + deep * x["lines"])
    as_book = frames(0) + joined(size + 4 * lines - count, count)
    inside = size + 8 * lines - count + 2 * (count - many)  # all chapters, twice as deep, with the commas of their books
    as_module = F.col("frame") + joined(frames(4) + inside - many, many)
    found = F.when(F.col("level") == 0, size).when(F.col("level") == 1, as_book).otherwise(as_module).cast("long")
    parts = F.when(F.col("level") == 0, 0).when(F.col("level") == 1, count).otherwise(many).cast("long")
    return sets.select("module", "book", "chapter", parts.alias("parts"), F.col("n").alias("entries"), found.alias("bytes"), "source_entries", "source_bytes", "text_bytes")


def storage_blocks(entries: DataFrame, modules: DataFrame, books: DataFrame, text: str = "text") -> DataFrame:
    """A row a module: source_entry_count, source_text_bytes, text_bytes, repetition_ratio, the bytes of its chapters, books and
    whole, and published_bytes, all of them. The ratio has three places, half-even on the binary value, as ``ratio`` has."""
    whole, is_book = F.col("book").isNull(), F.col("book").isNotNull() & F.col("chapter").isNull()
    at = lambda when, name="bytes": F.coalesce(F.sum(F.when(when, F.col(name))), F.lit(0)).cast("long")
    blocks = storage_levels(entries, modules, books, text).groupBy("module").agg(
        at(whole, "source_entries").alias("source_entry_count"), at(whole, "source_bytes").alias("source_text_bytes"), at(whole, "text_bytes").alias("text_bytes"),
        at(F.col("chapter").isNotNull()).alias("chapter_bytes"), at(is_book).alias("book_bytes"), at(whole).alias("commentary_bytes"), F.sum("bytes").cast("long").alias("published_bytes"),
    )
    names = ["source_entry_count", "source_text_bytes", "text_bytes", "repetition_ratio", "chapter_bytes", "book_bytes", "commentary_bytes", "published_bytes"]
    return blocks.withColumn("repetition_ratio", ratio_column("source_text_bytes", "text_bytes")).select("module", *names)


@F.pandas_udf(DoubleType())
def ratio_column(source_bytes: pd.Series, published_bytes: pd.Series) -> pd.Series:
    """``ratio`` of each row; there is one a module."""
    return pd.Series([ratio(int(a), int(b)) for a, b in zip(source_bytes, published_bytes, strict=True)], dtype=float)


def ratio(source_bytes: int, published_bytes: int) -> float:
    """Half-even on the binary value, which neither of Spark's rounding functions is."""
    return round(source_bytes / published_bytes, 3) if published_bytes else 1.0


def covering(collapsed: DataFrame, wanted: Column | int, position: str = "verse") -> DataFrame:
    """The records that cover a position."""
    at = F.lit(wanted) if isinstance(wanted, int) else wanted
    return collapsed.where(F.array_contains(F.coalesce(F.col("positions"), F.array(F.col(position))), at))


def coverage(collapsed: DataFrame, position: str = "verse") -> DataFrame:
    """A row a covered position, for lookups of many positions by an equi-join."""
    return collapsed.withColumn("at", F.explode(F.coalesce(F.col("positions"), F.array(F.col(position)))))
