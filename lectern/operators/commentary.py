"""Entries of a commentary as published rows: coordinates resolved, text cleaned, references found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.refs import coordinates, reference_tokens, resolve_tokens
from lectern.functions.text import public_text_col
from lectern.operators.collapse import collapse


def commentary_rows(entries: DataFrame) -> DataFrame:
    """``entries``: module, ordinal, key, raw, html, plain, verse (a struct). Rows without a known book, with a negative
    chapter or verse, or without text go. Chapter 0 introduces a book and verse 0 a chapter."""
    where = F.col("verse")
    rows = entries.select(
        "module", "ordinal", coordinates(where).alias("book"), F.coalesce(where["chapter"], F.lit(0)).alias("chapter"), F.coalesce(where["verse"], F.lit(0)).alias("at"),
        F.nullif(where["osis"], F.lit("")).alias("osis"), public_text_col("plain", "html").alias("text"), resolve_tokens(reference_tokens("raw", "html")).alias("references"),
    )
    return rows.withColumnRenamed("at", "verse").where("book is not null and chapter >= 0 and verse >= 0 and text <> ''")


def commentary_entries(rows: DataFrame) -> DataFrame:
    """Collapsed entries of each chapter."""
    return collapse(rows, ["module", "book", "chapter"], anchor="osis", refs="references")
