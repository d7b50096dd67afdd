import os

import pytest
from pyspark.sql import functions as F

from lectern.operators import checks, collapse, commentary, lexicon, policy, publish, validate

ENTRY = "module string, ordinal long, key string, raw string, html string, plain string, verse struct<osis:string,testament:int,book:int,chapter:int,verse:int>"


def entry(ordinal, verse, plain="text", raw="", html="", chapter=1, osis=None, book=4, testament=2):
    return ("c", ordinal, "k", raw, html, plain, (osis, testament, book, chapter, verse))


def published(spark, rows):
    return commentary.commentary_entries(commentary.commentary_rows(spark.createDataFrame(rows, ENTRY)))


def test_commentary_row(spark):
    found = published(spark, [entry(0, 1, raw="see Gen.1.2", osis="John.1.1")]).first()
    assert (found.book, found.chapter, found.verse, found.osis, found.positions) == (43, 1, 1, "John.1.1", None)
    assert [tuple(x) for x in found.references] == [("Gen.1.2", 1, 1, 2)]


def test_range_collapse(spark):
    found = published(spark, [entry(k, k + 1) for k in range(8)]).collect()
    assert len(found) == 1 and found[0].positions == list(range(1, 9)) and found[0].verse == 1


def test_collapse_stays_in_chapter_and_unites_references(spark):
    rows = [entry(0, 1, raw="Gen.1.1"), entry(1, 2, raw="Gen.1 Gen.1.1"), entry(2, 1, chapter=2)]
    found = {x.chapter: x for x in published(spark, rows).collect()}
    assert sorted(found) == [1, 2]
    assert [x.osis for x in found[1].references] == ["Gen.1", "Gen.1.1"]


def test_anchor_is_lowest_then_earliest(spark):
    rows = [entry(5, 1, osis="John.1.1"), entry(3, 1, osis="John.1.1!a"), entry(1, 2, osis="John.1.2")]
    assert published(spark, rows).first().osis == "John.1.1!a"
    assert published(spark, [entry(0, 1), entry(1, 2, osis="John.1.2")]).first().osis is None


def test_dropped_rows(spark):
    rows = [entry(0, 1, book=99), entry(1, -1), entry(2, 1, plain=" "), entry(3, 0, chapter=0, plain="intro")]
    found = published(spark, rows).collect()
    assert [(x.chapter, x.verse, x.text) for x in found] == [(0, 0, "intro")]


def test_rollups(spark):
    found = published(spark, [entry(0, 1), entry(1, 2, plain="b"), entry(2, 0, chapter=0, plain="i")])
    chapters = collapse.chapters(found, ["module", "book", "chapter"])
    assert {x.chapter: [e.text for e in x.entries] for x in chapters.collect()} == {0: ["i"], 1: ["text", "b"]}
    index = collapse.book_index(chapters, ["module", "book"]).first()
    assert (index.chapters, index.entry_count, index.has_introduction) == ([0, 1], 3, True)
    assert [x.text for x in collapse.covering(found, 2).collect()] == ["b"]
    assert collapse.ratio(2001, 1000) == 2.001 and collapse.ratio(1, 16) == 0.062 and collapse.ratio(0, 0) == 1.0


def dictionary(spark, keys):
    rows = spark.createDataFrame([("d", k, x, "G") for k, x in enumerate(keys)], "module string, ordinal long, key string, prefix string")
    return lexicon.assign_ids(lexicon.base_ids(rows, "prefix"))


def ids_of(spark, *keys):
    return [x.id for x in dictionary(spark, keys).orderBy("ordinal").collect()]


def test_ids(spark):
    assert ids_of(spark, "03056", "03056") == ["G3056", "G3056--2"]
    found = ids_of(spark, "3056", "03056")
    assert found[0] == "G3056" and found[1].startswith("h-")
    found = ids_of(spark, "Aaron", "AARON", "Aaron")
    assert found[0] == "k-Aaron" and found[1].startswith("h-") and found[2] == "k-Aaron--2"


def test_numbered_keys(spark):
    found = ids_of(spark, "X", "X", "X--2")
    assert found[:2] == ["k-X", "k-X--2"] and found[2].startswith("h-")
    with pytest.raises(Exception, match="would both be"):
        ids_of(spark, "X--2", "X", "X")


def test_links_both_ways(spark):
    named = lexicon.searchable(dictionary(spark, ["Zeta", "Alpha", "Beth-el, the", "03056"]))
    raw = [("d", "k-Zeta", "ALPHA"), ("d", "k-Zeta", "beth-el the"), ("d", "k-Zeta", "zeta"), ("d", "k-Alpha", "g3056"), ("d", "k-Alpha", "nothing"), ("d", "k-Alpha", "John.1.1")]
    edges = lexicon.link_edges(named, spark.createDataFrame(raw, "module string, id string, target string"))
    beth = next(x.id for x in named.collect() if x.key.startswith("Beth"))
    assert {(x.src, x.dst) for x in edges.collect()} == {("k-Zeta", "k-Alpha"), ("k-Zeta", beth), ("k-Alpha", "G3056")}
    ahead, back = lexicon.neighbours(edges), lexicon.neighbours(edges, forward=False)
    assert {x.id: x.ids for x in back.collect()} == {"k-Alpha": ["k-Zeta"], beth: ["k-Zeta"], "G3056": ["k-Alpha"]}
    assert validate.one_way_links(ahead, back).count() == 0
    index = lexicon.search_index(named)
    assert [x.key for x in index.orderBy("rank").collect()] == ["03056", "Alpha", "Beth-el, the", "Zeta"]
    assert {x.key: x.aliases for x in index.collect()}["03056"] == ["03056", "G3056"]
    assert validate.unsorted_terms(index).count() == 0
    assert [x.key for x in lexicon.with_prefix(index, "al").collect()] == ["Alpha"]


def test_kinds(spark):
    rows = spark.createDataFrame([("RawFiles", "", ""), ("zCom", "", ""), ("RawFiles", "Lexicons", ""), ("rawld", "", ""), ("rawtext", "comment", ""), ("RawFiles", "", "Commentary")], "d string, c string, t string")
    assert [x.k for x in rows.select(policy.module_kind(F.col("d"), F.col("c"), F.col("t")).alias("k")).collect()] == [None, "commentaries", "dictionaries", "dictionaries", None, "commentaries"]


def test_policy(spark):
    modules = spark.createDataFrame([("a", "pd"), ("b", "pd"), ("c", "no"), ("d", "no")], "name string, license_key string")
    lists = lambda *x: spark.createDataFrame(list(x), "name string, why string")
    found = policy.decide(modules, lists(("b", "x")), lists(("b", "y"), ("c", "z")), spark.createDataFrame([("pd",)], "license string"))
    assert {x.name: (x.allowed, x.reason) for x in found.collect()} == {"a": (True, "licence: pd"), "b": (False, "denied: x"), "c": (True, "approved: z"), "d": (False, "licence not approved")}


def test_policy_file(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"approved_license_values": ["Public  Domain"], "approved_modules": {}, "denied_modules": {"b": "x"}}')
    denied, approved, licenses = policy.load_policy(spark, str(tmp_path / "p.json"))
    modules = spark.createDataFrame([("a", "public domain"), ("b", "public domain")], "name string, license_key string")
    assert {x.name: x.allowed for x in policy.decide(modules, denied, approved, licenses).collect()} == {"a": True, "b": False}
    kinds = spark.createDataFrame([("a", "commentaries"), ("b", "dictionaries")], "name string, kind string")
    said = spark.createDataFrame([("a", "commentary"), ("b", "commentary")], "name string, classification string")
    assert [x.name for x in policy.misclassified(kinds, said).collect()] == ["b"]


def test_selection(spark):
    modules = spark.createDataFrame([("A", "commentaries"), ("B", "dictionaries"), ("C", None)], "name string, kind string")
    assert [x.name for x in policy.select_modules(modules, requested=["b"]).collect()] == ["B"]
    assert policy.select_modules(modules, "commentaries").count() == 1
    with pytest.raises(ValueError, match="no such module: c, x"):
        policy.select_modules(modules, requested=["x", "C"])


def test_artifacts(spark):
    import hashlib

    begins = spark.createDataFrame([(0, "regular", 2), (1, "regular", 2), (2, "directory", None)], "artifact_id long, file_type string, size_expected long")
    chunks = spark.createDataFrame([(0, 1, b"b"), (0, 0, b"a"), (1, 0, b"a"), (1, 2, b"b")], "artifact_id long, index long, data binary")
    sha = hashlib.sha256(b"ab").hexdigest()
    ends = spark.createDataFrame([(0, 2, sha), (1, 2, sha), (2, 0, "")], "artifact_id long, size long, sha256 string")
    assert [tuple(x) for x in checks.artifact_faults(begins, chunks, ends).collect()] == [(1, "chunk order")]


def test_publish(spark, tmp_path):
    rows = spark.createDataFrame([("m/1.json", 1, None), ("m/2.json", 2, "é")], "path string, n long, t string")
    documents = publish.render(rows, F.col("path"), F.struct("n", "t"))
    staged, live = str(tmp_path / "tree.next"), str(tmp_path / "tree")
    manifest = publish.stage(documents, staged).cache()
    manifest.count()
    assert (tmp_path / "tree.next/m/1.json").read_text() == '{\n  "n": 1\n}\n'
    publish.write_composed(staged, "m.json", {"name": "m"}, "entries", ["m/1.json", "m/2.json"])
    import json

    assert json.loads((tmp_path / "tree.next/m.json").read_text()) == {"name": "m", "entries": [{"n": 1}, {"n": 2, "t": "é"}]}
    os.remove(tmp_path / "tree.next/m.json")
    assert checks.manifest_faults(manifest, publish.tree_manifest(spark, staged)).count() == 0
    os.makedirs(live)
    publish.promote(staged, live)
    assert os.path.exists(f"{live}/m/2.json") and not os.path.exists(staged)
    with pytest.raises(Exception, match="over the ceiling"):
        publish.render(rows, F.col("path"), F.struct("n", "t"), ceiling=5).collect()
    with pytest.raises(ValueError):
        publish.reset_folder(str(tmp_path), str(tmp_path))
    order = spark.createDataFrame([("clarke.json",), ("clarke/1.json",)], "path string").orderBy(publish.manifest_order()).collect()
    assert [x.path for x in order] == ["clarke/1.json", "clarke.json"]


def one_by_one(entries):
    """The rule in the order of entries: {ordinal: (id, occurrence)}; None where two entries would end with one id."""
    import hashlib

    owner, times, found = {}, {}, {}
    for ordinal, key, base in entries:
        name = base if owner.setdefault(base.casefold(), key) == key else "h-" + hashlib.sha256(key.encode()).hexdigest()
        owner.setdefault(name.casefold(), key)
        n = times[name.casefold()] = times.get(name.casefold(), 0) + 1
        if n > 1:
            name = f"{name}--{n}"
            owner.setdefault(name.casefold(), key)
        found[ordinal] = (name, n)
    return found if len({x for x, _ in found.values()}) == len(found) else None


def test_ids_of_random_sequences(spark):
    """Passes over all rows give what the rule gives row by row, on 10,000 modules whose keys look like numbered ids."""
    import random

    rng = random.Random(7)
    pool = ["a", "A", "a--2", "A--2", "a--3", "a--2--2", "A--2--3", "a--2--2--2", "b", "B", "b--2", "a--x"]
    rows, wanted = [], {}
    while len(wanted) < 10_000:
        keys = rng.choices(pool, k=rng.randint(2, 9))
        entries = [(3 * k + 1, x, "k-" + x) for k, x in enumerate(keys)]
        if (ids := one_by_one(entries)) is not None:
            module = f"m{len(wanted)}"
            wanted[module] = ids
            rows += [(module, *x, "html") for x in entries]
    found = lexicon.assign_ids(spark.createDataFrame(rows, "module string, ordinal long, key string, base string, html string"))
    assert found.columns == ["module", "ordinal", "key", "base", "html", "id", "occurrence"]
    got = {}
    for x in found.collect():
        got.setdefault(x.module, {})[x.ordinal] = (x.id, x.occurrence)
    assert got == wanted


def test_a_key_with_several_bases(spark):
    """A hash may name entries of two families, and be numbered across them."""
    import hashlib

    hashed = "h-" + hashlib.sha256(b"q").hexdigest()
    keys = [("p", "k-1"), ("q", "k-1"), ("p", "k-2"), ("q", "k-2"), ("r", f"{hashed}--2"), ("s", "k-3--2"), ("q", f"{hashed}--3")]
    rows = [("m", k, *x) for k, x in enumerate(keys)]
    found = lexicon.assign_ids(spark.createDataFrame(rows, "module string, ordinal long, key string, base string"))
    assert {x.ordinal: (x.id, x.occurrence) for x in found.collect()} == one_by_one([x[1:] for x in rows])


def test_unpublishable_entries_own_nothing(spark):
    """A blank entry that comes first neither claims an id or alias nor is linked to; keys lose white space of any kind."""
    rows = [(0, "Alpha", "", " "), (1, "ALPHA", "", "x"), (2, " Alpha\u00a0", "<b>y</b>", ""), (3, " ", "", "z"), (4, None, "", "z"), (5, "Beta", '<a href="Alpha">', "b")]
    entries = spark.createDataFrame([("d", *x) for x in rows], "module string, ordinal long, key string, html string, plain string")
    kept = lexicon.publishable(entries)
    named = lexicon.searchable(lexicon.assign_ids(lexicon.base_ids(kept)))
    assert {x.ordinal: (x.id[:7], x.text) for x in named.collect()} == {1: ("k-ALPHA", "x"), 2: ("h-" + named.where("ordinal = 2").first().id[2:7], "y"), 5: ("k-Beta", "b")}
    edges = lexicon.link_edges(named, lexicon.candidates_of(kept, "html", ids=named))
    assert [(x.src, x.dst) for x in edges.collect()] == [("k-Beta", "k-ALPHA")]


def test_index_in_parts(spark, tmp_path):
    """A third of all records bear one term: ranks are those of the whole order, and a lookup reads the parts that can hold it."""
    rows = [("m" if k % 5 else "n", k, "hot" if k % 3 == 0 else f"t{k % 97:02d}") for k in range(3000)]
    named = lexicon.searchable(lexicon.assign_ids(lexicon.base_ids(spark.createDataFrame(rows, "module string, ordinal long, key string"))))
    lexicon.write_index(named, str(tmp_path), parts=16)
    index = lexicon.read_index(spark, str(tmp_path))
    got = {(x.module, x.rank): (x.search, x.occurrence or 1) for x in index.collect()}
    keys = {m: sorted((x.search, x.occurrence) for x in named.where(F.col("module") == m).collect()) for m in "mn"}
    assert got == {(m, r): x for m in "mn" for r, x in enumerate(keys[m], 1)}
    sizes = [x["count"] for x in spark.read.parquet(f"{tmp_path}/rows").groupBy("part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2.5 * 3000 / 16
    assert validate.unsorted_terms(index).count() == 0

    assert [x.search for x in lexicon.read_index(spark, str(tmp_path), prefix="t0").select("search").distinct().orderBy("search").collect()] == [f"t0{k}" for k in range(10)]
    assert {(x.module, x.rank) for x in lexicon.read_index(spark, str(tmp_path), term="hot").collect()} == {k for k, v in got.items() if v[0] == "hot"}
    wanted = lexicon.read_index(spark, str(tmp_path), term="t07").collect()
    bounds = {x.part: (x.low, x.high) for x in spark.read.parquet(f"{tmp_path}/parts").where("module = 'm'").collect()}
    spoiled = [path for part, (low, high) in bounds.items() if not low <= "t07" <= high for path in (tmp_path / f"rows/part={part}").glob("*")]
    assert len(spoiled) >= 12
    for path in spoiled:
        path.write_bytes(b"no table")
    assert wanted and lexicon.read_index(spark, str(tmp_path), term="t07").where("module = 'm'").collect() == [x for x in wanted if x.module == "m"]
    assert lexicon.read_index(spark, str(tmp_path), term="none").count() == 0 and lexicon.read_index(spark, str(tmp_path), prefix="zz").count() == 0


def test_policy_folds_names(spark):
    modules = spark.createDataFrame([("clarke", "pd"), ("Straße", "pd"), ("None", ""), ("Gill", "no")], "name string, license_key string")
    lists = lambda *x: spark.createDataFrame(list(x), "name string, why string")
    found = policy.decide(modules, lists(("Clarke", "x"), ("CLARKE", "w"), ("STRASSE", None)), lists(("GILL", "z")), spark.createDataFrame([("pd",), ("",)], "license string"))
    assert {x.name: (x.allowed, x.reason) for x in found.collect()} == {"clarke": (False, "denied: x"), "Straße": (False, "denied: "), "None": (False, "licence not approved"), "Gill": (True, "approved: z")}
    kinds = spark.createDataFrame([("Straße", "commentaries")], "name string, kind string")
    assert policy.select_modules(kinds, requested=["strasse"]).count() == 1


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_row_numbers_of_a_hot_group(spark, parts):
    """A group of half of all rows fills several parts; numbers are those of a window, over batches of any size."""
    from pyspark.sql import Window

    from lectern.operators.numbering import row_numbers

    rows = spark.range(0, 4000, 1, 7).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 11 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), (F.col("id") * 7919 % 4001).alias("o"), F.lit(1).alias("_x"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = row_numbers(rows, ["k"], ["o"], "n", parts)
        wanted = rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o")))
        assert found.columns == wanted.columns and sorted(map(repr, found.collect())) == sorted(repr(x) for x in wanted.withColumn("n", F.col("n").cast("long")).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert row_numbers(rows.limit(0), ["k"], ["o"], "n", parts).count() == 0


def test_unsorted_terms(spark):
    rows = [("m", 1, "a"), ("m", 2, "c"), ("m", 3, "b"), ("m", 4, "b"), ("n", 1, "z"), ("n", 3, "zz")]
    found = validate.unsorted_terms(spark.createDataFrame(rows, "module string, rank long, search string"))
    assert sorted(map(tuple, found.collect())) == [("m", 3, "b"), ("n", 3, "zz")]
