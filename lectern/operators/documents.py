"""Documents of a module as (path, document) tables: chapters, books and their index; entries and their index.

Members follow the published order; absent ones are null here and left out when rendered. Documents that hold
others are written in pieces: a dictionary and its index as rows of pieces (``pieces``), a commentary and its books as tables of
source paths, at most as many as a book has chapters or a module books, which ``compose`` copies member by member.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lectern.functions.refs import BOOKS, reference_tokens, resolve_tokens
from lectern.functions.render import member_lines, stable_json
from lectern.operators.policy import last_value
from lectern.operators.publish import render, write_composed


def book_name(number: Column) -> Column:
    return F.create_map(*[F.lit(x) for n, name, _ in BOOKS for x in (n, name)])[number]


def named(kind: str, *members: Column) -> Column:
    return F.struct(F.lit(kind).alias("schema"), *members)


def shown_entry() -> Column:
    """A collapsed entry as its chapter shows it."""
    return F.struct("book", "chapter", "verse", F.col("positions").alias("verses"), "osis", "text", F.when(F.size("references") > 0, F.col("references")).alias("references"))


def chapter_documents(entries: DataFrame, modules: DataFrame) -> DataFrame:
    """(module, book, chapter, path, document, entry_count). ``entries``: collapsed; ``modules``: module, id, language, description."""
    one = F.struct("verse", shown_entry().alias("e"))
    order = F.array_sort(F.collect_list(F.struct("verse", "text", one.alias("one"))))
    rows = entries.groupBy("module", "book", "chapter").agg(F.transform(order, lambda x: x["one"]["e"]).alias("entries"), F.count("*").alias("entry_count")).join(modules, "module")
    document = named("commentary-chapter-v1", F.col("id").alias("commentary"), F.col("language"), F.col("book"), book_name(F.col("book")).alias("name"), F.col("chapter"), F.col("entries"))
    return rows.select("module", "book", "chapter", F.concat_ws("/", "id", "book", F.concat("chapter", F.lit(".json"))).alias("path"), document.alias("document"), "entry_count")


def books_documents(chapters: DataFrame, modules: DataFrame) -> DataFrame:
    """(path, document): each module's index of books, with their chapters and counts."""
    per = chapters.groupBy("module", "book").agg(F.array_sort(F.collect_set("chapter")).alias("chapters"), F.sum("entry_count").alias("entry_count"))
    one = F.struct("book", book_name(F.col("book")).alias("name"), "chapters", "entry_count")
    rows = per.groupBy("module").agg(F.array_sort(F.collect_list(one)).alias("books")).join(modules, "module")
    document = named(
        "commentary-books-v1", F.col("id").alias("commentary"), F.col("language"), F.col("description").alias("name"), F.lit("{book}.json").alias("book_url_template"),
        F.lit("{book}/{chapter}.json").alias("chapter_url_template"), F.size("books").alias("book_count"), F.col("books"),
    )
    return rows.select(F.concat_ws("/", "id", F.lit("books.json")).alias("path"), document.alias("document"))


def composed_books(chapters: DataFrame, modules: DataFrame) -> DataFrame:
    """(path, header, member, sources): a book of its chapters' files."""
    per = chapters.groupBy("module", "book").agg(F.transform(F.array_sort(F.collect_list(F.struct("chapter", "path"))), lambda x: x["path"]).alias("sources")).join(modules, "module")
    header = named("commentary-book-v1", F.col("id").alias("commentary"), F.col("language"), F.col("book"), book_name(F.col("book")).alias("name"))
    return per.select(F.concat_ws("/", "id", F.concat("book", F.lit(".json"))).alias("path"), F.to_json(header).alias("header"), F.lit("chapters").alias("member"), "sources")


def composed_commentaries(chapters: DataFrame, modules: DataFrame) -> DataFrame:
    """(path, header, member, sources): a module of its books' files."""
    books = chapters.select("module", "book").distinct().join(modules, "module")
    per = books.groupBy("module", "id", "language", "description").agg(F.array_sort(F.collect_list("book")).alias("books"))
    header = named("commentary-v1", F.col("id").alias("commentary"), F.col("language"), F.col("description").alias("name"))
    sources = F.transform("books", lambda x: F.concat(F.col("id"), F.lit("/"), x.cast("string"), F.lit(".json")))
    return per.select(F.concat("id", F.lit(".json")).alias("path"), F.to_json(header).alias("header"), F.lit("books").alias("member"), sources.alias("sources"))


def entry_documents(entries: DataFrame, forward: DataFrame, backward: DataFrame, modules: DataFrame) -> DataFrame:
    """(module, entry, path, document): a dictionary's entries with links both ways. ``entries``: publishable, named and
    searchable, with raw, html and text; ``forward``, ``backward``: module, id, ids."""
    keys = entries.select("module", F.col("id").alias("other"), F.col("key").alias("other_key"))

    def linked(links: DataFrame, name: str) -> DataFrame:
        each = links.select("module", "id", F.explode("ids").alias("other")).join(keys, ["module", "other"])
        return each.groupBy("module", "id").agg(F.array_sort(F.collect_list(F.struct(F.col("other").alias("id"), F.col("other_key").alias("key")))).alias(name))

    rows = entries.withColumn("refs", resolve_tokens(reference_tokens("raw", "html")))
    rows = rows.join(linked(forward, "see_also"), ["module", "id"], "left").join(linked(backward, "backlinks"), ["module", "id"], "left")
    rows = rows.join(modules.select("module", F.col("id").alias("dictionary"), "language"), "module")
    document = named(
        "dictionary-entry-v1", F.col("dictionary"), F.col("language"), F.col("id"), F.col("key"), F.col("occurrence"), F.col("aliases"), F.col("text"), F.col("see_also"), F.col("backlinks"),
        F.when(F.size("refs") > 0, F.col("refs")).alias("references"),
    )
    return rows.select("module", F.col("id").alias("entry"), F.concat_ws("/", "dictionary", F.concat("id", F.lit(".json"))).alias("path"), document.alias("document"))


def pieces(frames: DataFrame, members: DataFrame) -> DataFrame:
    """(path, piece, json): documents in pieces, a row each, for ``store.write_documents`` to join: no row, task or driver holds a document.

    ``frames``: path, header (a struct) and member, the name of the array that ends the document; ``members``: path, rank (from 1, gapless in
    each path) and document (a struct, or a string that is rendered already). The first piece is what comes before the array's
    members, the last one what comes after; each member is a piece, indented, with a comma before it but for the first.
    """
    last = (1 << 62) + 1
    shown = frames.select("path", F.to_json("header", {"ignoreNullFields": "false"}).alias("header"), "member")
    filled = members.groupBy("path").agg(F.count("*").alias("n"))
    whole = isinstance(members.schema["document"].dataType, StringType)
    texts = members.select("path", "rank", "document" if whole else F.to_json("document", {"ignoreNullFields": "false"}).alias("document"))

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            mark, rows = uuid.uuid4().hex, []
            for path, header, member, n in zip(batch["path"], batch["header"], batch["member"], batch["n"], strict=True):
                before, *after = stable_json({**json.loads(header), member: [mark] if n else []}).split(f'    "{mark}"')
                rows += [(path, 0, before), (path, last, "".join(after))]
            yield pd.DataFrame(rows, columns=["path", "piece", "json"])

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [member_lines(x if whole else stable_json(json.loads(x))) for x in batch["document"]]
            yield pd.DataFrame({"path": batch["path"], "piece": batch["rank"], "json": [x if k == 1 else f",\n{x}" for k, x in zip(batch["rank"], text, strict=True)]})

    kind = "path string, piece long, json string"
    framed = shown.join(filled, "path", "left").na.fill(0, ["n"]).mapInPandas(around, kind)
    return framed.union(texts.mapInPandas(inside, kind))


def composed_dictionaries(documents: DataFrame, index: DataFrame, modules: DataFrame) -> DataFrame:
    """(path, piece, json): each dictionary of its entries' documents, in index order. ``documents``: module, entry, document."""
    path = F.concat("id", F.lit(".json")).alias("path")
    header = named("dictionary-v1", F.col("id").alias("dictionary"), F.col("language"), F.col("description").alias("name"))
    members = documents.select("module", "entry", "document").join(index.select("module", F.col("id").alias("entry"), "rank"), ["module", "entry"]).join(modules, "module")
    held = documents.select("module").distinct().join(modules, "module")
    return pieces(held.select(path, header.alias("header"), F.lit("entries").alias("member")), members.select(path, "rank", "document"))


def compose(composed: DataFrame, folder: str) -> DataFrame:
    """Writes composed documents, a task one after another, and returns (path, size)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [write_composed(folder, x.path, json.loads(x.header), x.member, list(x.sources)) for x in batch.itertuples()]
            yield pd.DataFrame({"path": batch["path"], "size": sizes})

    return composed.repartition("path").mapInPandas(write, "path string, size long")


def rendered(documents: DataFrame) -> DataFrame:
    return render(documents, F.col("path"), F.col("document"))


# Where the documents of a resource are, as its metadata and its catalog say.
METADATA_URLS = {
    "commentary": {"books_url": "books.json", "book_url_template": "{book}.json", "chapter_url_template": "{book}/{chapter}.json"},
    "dictionary": {"index_url": "index.json", "entry_url_template": "{entry}.json"},
}
CATALOG_URLS = {
    "commentaries": {
        "metadata_url_template": "{commentary}/metadata.json", "books_url_template": "{commentary}/books.json", "commentary_url_template": "{commentary}.json",
        "book_url_template": "{commentary}/{book}.json", "chapter_url_template": "{commentary}/{book}/{chapter}.json",
    },
    "dictionaries": {"metadata_url_template": "{dictionary}/metadata.json", "index_url_template": "{dictionary}/index.json", "dictionary_url_template": "{dictionary}.json", "entry_url_template": "{dictionary}/{entry}.json"},
}


def quoted(text: Column) -> Column:
    """Percent-encoded, all but letters, digits and ``_.-~``."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def metadata_documents(modules: DataFrame, counts: DataFrame, kind: str, source: str = "", source_url: str = "", note: str = "") -> DataFrame:
    """(path, document): what each module is and how much of it was published. ``modules``: as described, with module, id and
    fields, its configuration; ``counts``: module and the columns to show, in order; ``source``, ``source_url`` (to which the module's quoted
    name is added) and ``note`` say where modules come from and what was done to them."""
    get = lambda name, default="": last_value(F.col("fields"), name, default)
    shown = [F.col(x) for x in counts.columns if x != "module"]
    contact = F.struct(get("copyrightcontactname").alias("name"), get("copyrightcontactemail").alias("email"), get("copyrightcontactaddress").alias("address"))
    document = named(
        f"{kind}-metadata-v1", F.col("id"), F.col("module"), F.col("description").alias("name"), F.col("language"), F.col("version"), F.col("license"), F.col("driver"),
        get("sourcetype").alias("source_type"), *([get("versification", "KJV").alias("versification")] if kind == "commentary" else []), *shown,
        *[F.lit(url).alias(name) for name, url in METADATA_URLS[kind].items()], F.lit(source).alias("source"), F.concat(F.lit(source_url), quoted(F.col("module"))).alias("source_module_url"),
        get("textsource").alias("text_source"), get("copyright").alias("copyright"), get("copyrightholder").alias("copyright_holder"), contact.alias("copyright_contact"),
        get("distributionnotes").alias("distribution_notes"), get("about").alias("about"), F.lit(note).alias("conversion_note"),
    )
    return modules.join(counts, "module").select(F.concat_ws("/", "id", F.lit("metadata.json")).alias("path"), document.alias("document"))


def stamp(at: Column | None = None) -> Column:
    """A time, by default now, in UTC to the second."""
    return F.date_format(F.to_utc_timestamp(at if at is not None else F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def build_stamp(records: DataFrame, kind: str, version: str, at: Column | None = None) -> DataFrame:
    """(path, document): when a resource was built, by what, and how many modules it has."""
    document = F.struct(F.lit(version).alias("builder_version"), F.lit(1).alias("api_version"), F.lit(kind).alias("resource"), F.first("at").alias("generated_at"), F.count("id").alias("module_count"))
    return records.withColumn("at", stamp(at)).agg(document.alias("document")).select(F.lit("build.json").alias("path"), "document")


def catalog(records: DataFrame, kind: str, base_url: str = "", at: Column | None = None) -> DataFrame:
    """(path, piece, json): the catalog of a resource, its modules by id, a record a piece. ``records``: id and whatever a record
    shows, a row a module; an empty table gives a catalog of none."""
    path = F.lit(f"{kind}.json").alias("path")
    shown = F.struct("id", *[F.col(x) for x in records.columns if x != "id"]).alias("document")
    placed = records.select(path, F.row_number().over(Window.orderBy("id")).cast("long").alias("rank"), shown)  # a row a module
    header = named(
        f"{kind}-catalog-v1", F.lit(1).alias("version"), stamp(at).alias("generated_at"), F.lit(base_url).alias("base_url"),
        *[F.lit(url).alias(name) for name, url in CATALOG_URLS[kind].items()], F.col("module_count"),
    )
    frame = records.agg(F.count("*").alias("module_count")).select(path, header.alias("header"), F.lit(kind).alias("member"))
    return pieces(frame, placed)


def index_documents(index: DataFrame, counts: DataFrame, modules: DataFrame) -> DataFrame:
    """(path, piece, json): each dictionary's search index, a record a piece, in index order. ``counts``: module, unique_keys."""
    path = F.concat_ws("/", "id", F.lit("index.json")).alias("path")
    per = index.groupBy("module").agg(F.count("*").alias("n")).join(counts, "module").join(modules, "module")
    header = named(
        "dictionary-index-v1", F.col("id").alias("dictionary"), F.col("language"), F.col("description").alias("name"), F.lit("{entry}.json").alias("entry_url_template"),
        F.col("n").alias("entry_count"), F.col("unique_keys").alias("unique_key_count"),
    )
    record = F.struct("id", "key", "search", "aliases", "occurrence").alias("document")
    records = index.select("module", "rank", record).join(modules.select("module", "id"), "module")
    return pieces(per.select(path, header.alias("header"), F.lit("entries").alias("member")), records.select(path, "rank", "document"))
