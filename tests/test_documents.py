"""Modules published end to end: rows, documents, files, manifest, and the invariants of what was published."""

import json
import urllib.parse

import pytest
from pyspark.sql import functions as F

from lectern.functions import refs
from lectern.functions.render import stable_json
from lectern.operators import checks, collapse, commentary, documents, lexicon, publish, validate
from lectern.sources import store

ENTRY = "module string, ordinal long, key string, raw string, html string, plain string, verse struct<osis:string,testament:int,book:int,chapter:int,verse:int>"
MODULES = "module string, id string, language string, description string"


def load(folder, path):
    return json.loads((folder / path).read_text())


def test_commentary(spark, tmp_path):
    rows = [
        ("Com", 0, "", "", "", "same", ("John.1.1", 2, 4, 1, 1)), ("Com", 1, "", "see Gen.1.1", "", "same", ("John.1.2", 2, 4, 1, 2)), ("Com", 2, "", "", "<p>intro</p>", "", ("", 2, 4, 0, 0)),
        ("Com", 3, "", "", "", "other", ("Gen.2.10", 1, 1, 2, 10)), ("Com", 4, "", "", "", "again", ("Gen.2.9", 1, 1, 2, 9)), ("Com", 5, "", "", "", "ten", ("Gen.10.1", 1, 1, 10, 1)),
    ]
    modules = spark.createDataFrame([("Com", "com", "en", "A commentary")], MODULES)
    entries = commentary.commentary_entries(commentary.commentary_rows(spark.createDataFrame(rows, ENTRY)))
    chapters = documents.chapter_documents(entries, modules).cache()
    every = documents.rendered(chapters.select("path", "document")).union(documents.rendered(documents.books_documents(chapters, modules)))
    manifest = publish.stage(every, str(tmp_path / "v1")).cache()
    assert manifest.count() == 5
    assert documents.compose(documents.composed_books(chapters, modules), str(tmp_path / "v1")).count() == 2
    assert documents.compose(documents.composed_commentaries(chapters, modules), str(tmp_path / "v1")).count() == 1
    john = load(tmp_path / "v1", "com/43/1.json")
    assert list(john) == ["schema", "commentary", "language", "book", "name", "chapter", "entries"] and john["name"] == "John"
    assert john["entries"] == [{"book": 43, "chapter": 1, "verse": 1, "verses": [1, 2], "osis": "John.1.1", "text": "same", "references": [{"osis": "Gen.1.1", "book": 1, "chapter": 1, "verse": 1}]}]
    assert [x["verse"] for x in load(tmp_path / "v1", "com/1/2.json")["entries"]] == [9, 10]
    assert [x["chapter"] for x in load(tmp_path / "v1", "com/1.json")["chapters"]] == [2, 10]
    assert load(tmp_path / "v1", "com/43.json")["chapters"] == [load(tmp_path / "v1", "com/43/0.json"), john]
    assert load(tmp_path / "v1", "com.json")["books"] == [load(tmp_path / "v1", "com/1.json"), load(tmp_path / "v1", "com/43.json")]
    index = load(tmp_path / "v1", "com/books.json")
    assert index["book_count"] == 2 and index["books"][0] == {"book": 1, "name": "Genesis", "chapters": [2, 10], "entry_count": 3}
    size = lambda path: (tmp_path / "v1" / path).stat().st_size
    dimension = refs.books(spark).select("book", "name").distinct()
    levels = {(x.book, x.chapter): (x.parts, x.entries, x.bytes) for x in collapse.storage_levels(entries.withColumn("entry", documents.shown_entry()), modules, dimension).collect()}
    assert levels == {
        (43, 1): (0, 1, size("com/43/1.json")), (43, 0): (0, 1, size("com/43/0.json")), (1, 2): (0, 2, size("com/1/2.json")), (1, 10): (0, 1, size("com/1/10.json")),
        (43, None): (2, 2, size("com/43.json")), (1, None): (2, 3, size("com/1.json")), (None, None): (2, 5, size("com.json")),
    }
    block = collapse.storage_blocks(entries.withColumn("entry", documents.shown_entry()), modules, dimension).first().asDict()
    chapter_bytes, book_bytes = sum(levels[x][2] for x in levels if x[1] is not None), levels[43, None][2] + levels[1, None][2]
    assert list(block)[1:4] == ["source_entry_count", "source_text_bytes", "text_bytes"] and block == {
        "module": "Com", "source_entry_count": 6, "source_text_bytes": 26, "text_bytes": 22, "repetition_ratio": round(26 / 22, 3), "chapter_bytes": chapter_bytes, "book_bytes": book_bytes,
        "commentary_bytes": size("com.json"), "published_bytes": chapter_bytes + book_bytes + size("com.json"),
    }
    assert validate.repeated_texts(entries, ["module", "book", "chapter"]).count() == 0 and validate.false_anchors(entries).count() == 0
    found = {x.path: x.fault for x in checks.manifest_faults(manifest, publish.tree_manifest(spark, str(tmp_path / "v1"))).collect()}
    assert found == {"com.json": "extra", "com/1.json": "extra", "com/43.json": "extra"}


def test_dictionary(spark, tmp_path):
    rows = [("Dic", 0, "Zeta", '<a href="Alpha">x</a> John.3.16', "", "z", "G"), ("Dic", 1, "Alpha", "", "<b>a</b>", "", "G"), ("Dic", 2, "03056", "", "", "n", "G"), ("Dic", 3, "Empty", "", "", " ", "G")]
    modules = spark.createDataFrame([("Dic", "dic", "el", "A dictionary")], MODULES)
    entries = spark.createDataFrame(rows, "module string, ordinal long, key string, raw string, html string, plain string, prefix string")
    entries = lexicon.publishable(entries)
    named = lexicon.searchable(lexicon.assign_ids(lexicon.base_ids(entries, "prefix"))).cache()
    edges = lexicon.link_edges(named, lexicon.candidates_of(named, "raw", "html"))
    ahead, back = lexicon.neighbours(edges), lexicon.neighbours(edges, forward=False)
    index = lexicon.search_index(named)
    made = documents.entry_documents(named, ahead, back, modules)
    store.write_documents(documents.rendered(made.select("path", "document")).select("path", "json"), str(tmp_path))
    store.write_documents(documents.index_documents(index, lexicon.unique_keys(named), modules), str(tmp_path))
    store.write_documents(documents.composed_dictionaries(made, index, modules), str(tmp_path))
    for path in ("dic.json", "dic/index.json"):
        assert (tmp_path / path).read_text() == stable_json(load(tmp_path, path))
    zeta, alpha = load(tmp_path, "dic/k-Zeta.json"), load(tmp_path, "dic/k-Alpha.json")
    assert zeta["see_also"] == [{"id": "k-Alpha", "key": "Alpha"}] and alpha["backlinks"] == [{"id": "k-Zeta", "key": "Zeta"}]
    assert zeta["references"] == [{"osis": "John.3.16", "book": 43, "chapter": 3, "verse": 16}] and "see_also" not in alpha and alpha["text"] == "a"
    shown = load(tmp_path, "dic/index.json")
    assert [x["key"] for x in shown["entries"]] == ["03056", "Alpha", "Zeta"] and shown["unique_key_count"] == 3
    assert shown["entries"][0] == {"id": "G3056", "key": "03056", "search": "03056", "aliases": ["03056", "G3056"]} and "aliases" not in shown["entries"][1]
    assert load(tmp_path, "dic.json")["entries"] == [load(tmp_path, f"dic/{x}.json") for x in ("G3056", "k-Alpha", "k-Zeta")]
    records = spark.createDataFrame([("dic", "A dictionary", None)], "id string, name string, strong_prefix string")
    at = F.lit("2026-01-02 03:04:05").cast("timestamp")
    store.write_documents(documents.catalog(records, "dictionaries", "https://example.org/v1/", at), str(tmp_path))
    assert list(load(tmp_path, "dictionaries.json").items()) == [
        ("schema", "dictionaries-catalog-v1"), ("version", 1), ("generated_at", "2026-01-02T03:04:05Z"), ("base_url", "https://example.org/v1/"), ("metadata_url_template", "{dictionary}/metadata.json"),
        ("index_url_template", "{dictionary}/index.json"), ("dictionary_url_template", "{dictionary}.json"), ("entry_url_template", "{dictionary}/{entry}.json"), ("module_count", 1),
        ("dictionaries", [{"id": "dic", "name": "A dictionary", "strong_prefix": None}]),
    ]
    store.write_documents(documents.catalog(records.limit(0), "commentaries", at=at), str(tmp_path))
    assert load(tmp_path, "commentaries.json")["commentaries"] == []
    assert made.where(F.col("entry") == "k-Empty").count() == 0


def test_metadata(spark):
    fields = {"about": ["old", "new"], "versification": ["KJVA"]}
    modules = spark.createDataFrame([("Com", "com", "en", "A", "1", "PD", "zCom", fields)], MODULES + ", version string, license string, driver string, fields map<string,array<string>>")
    counts = spark.createDataFrame([("Com", 2, 5)], "module string, book_count int, entry_count long")
    found = documents.rendered(documents.metadata_documents(modules, counts, "commentary")).first()
    shown = json.loads(found.json)
    assert found.path == "com/metadata.json" and (shown["book_count"], shown["entry_count"], shown["about"], shown["versification"], shown["copyright_contact"]["email"]) == (2, 5, "new", "KJVA", "")
    full = "schema id module name language version license driver source_type versification book_count entry_count books_url book_url_template chapter_url_template source source_module_url text_source copyright copyright_holder copyright_contact distribution_notes about conversion_note"
    assert list(shown) == full.split() and list(shown["copyright_contact"]) == ["name", "email", "address"]
    names = spark.createDataFrame([("a b/ü~*_.-(",)], "module string")
    assert names.select(documents.quoted(F.col("module")).alias("q")).first().q == urllib.parse.quote("a b/ü~*_.-(", safe="")
    counts = spark.createDataFrame([("Com", 7, 6, None, 99)], "module string, entry_count long, unique_key_count long, strong_prefix string, bytes long")
    shown = json.loads(documents.rendered(documents.metadata_documents(modules, counts, "dictionary", "Src", "https://example.org/?m=", "Converted.")).first().json)
    full = "schema id module name language version license driver source_type entry_count unique_key_count strong_prefix bytes index_url entry_url_template source source_module_url text_source copyright copyright_holder copyright_contact distribution_notes about conversion_note"
    assert list(shown) == full.split() and (shown["source"], shown["source_module_url"], shown["conversion_note"], shown["strong_prefix"]) == ("Src", "https://example.org/?m=Com", "Converted.", None)
    stamp = json.loads(documents.rendered(documents.build_stamp(modules, "commentaries", "1.0", F.lit("2026-01-02 03:04:05").cast("timestamp"))).first().json)
    assert stamp["generated_at"] == "2026-01-02T03:04:05Z" and stamp["module_count"] == 1


def test_pieces_of_a_large_and_an_empty_document(spark, tmp_path):
    """Documents are the same whether or not they were ever one string; one has no member."""
    frames = spark.createDataFrame([("a.json", 5000), ("b/none.json", 0), ("c.json", 1)], "path string, n long").withColumn("header", F.struct(F.col("n"), F.lit(None).cast("string").alias("gone"))).withColumn("member", F.lit("list"))
    members = spark.range(1, 5001).select(F.lit("a.json").alias("path"), F.col("id").alias("rank"), F.struct(F.concat(F.lit("é"), "id").alias("t")).alias("document")).union(spark.sql("select 'c.json' as path, 1L as rank, struct('x' as t) as document"))
    store.write_documents(documents.pieces(frames, members), str(tmp_path))
    for path, rows in (("a.json", [{"t": f"é{k}"} for k in range(1, 5001)]), ("b/none.json", []), ("c.json", [{"t": "x"}])):
        assert (tmp_path / path).read_text() == stable_json({"n": len(rows), "list": rows})
    bad = spark.createDataFrame([("a.json", 1, "x"), ("a.json", 1, "y")], "path string, piece long, json string")
    with pytest.raises(Exception, match="out of order"):
        store.write_documents(bad, str(tmp_path / "bad"))
    assert not [x for x in (tmp_path / "bad").rglob("*") if x.is_file()]


def test_markup_members(spark):
    kind = spark.sql("select struct(1 as a, array(struct('x' as HTML, 2 as b)) as list, struct('y' as html) as s) as d").schema["d"].dataType
    assert validate.markup_members(kind) == ["list.HTML", "s.html"]
    rows = spark.createDataFrame([("m/index.json",), ("m/1.json",), ("index.json/k",)], "path string")
    assert [x.path for x in validate.claimed_names(rows).collect()] == ["m/index.json"]


def test_rules_are_counted_while_rows_are_written(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 4).select(F.format_string("p%04d", "id").alias("path"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("x"))
    rules = {"known": F.col("x").isNotNull(), "small": F.col("x") < 990, "any": F.lit(True)}
    report = {x.rule: x for x in validate.write_checked(rows, rules, str(tmp_path / "t")).collect()}
    assert {k: (x.rows, x.broken) for k, x in report.items()} == {"known": (1000, 100), "small": (1000, 109), "any": (1000, 0)}
    assert report["known"].problems == [f"p{k:04d}" for k in range(0, 200, 10)] and report["any"].problems == [] and len(report["small"].problems) == 20
    assert spark.read.parquet(str(tmp_path / "t")).where("broken is null").count() == 891
    empty = validate.write_checked(rows.limit(0), rules, str(tmp_path / "e")).collect()
    assert [(x.rows, x.broken, x.problems) for x in empty] == [(0, 0, [])] * 3
