import re
import unicodedata
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lectern.functions import ids, refs, text
from lectern.functions.render import megabytes, member_lines, pretty_bytes, pretty_lines, stable_json


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first().x


def plain_search_fold(key):
    """By Python's own patterns."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", key) if not unicodedata.combining(c)).casefold()
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s-]", " ", bare)).strip() or key.casefold()


def test_search_fold_over_all_code_points():
    for k in (*range(0xD800), *range(0xE000, 0x110000)):
        key = f"a{chr(k)}b"
        assert text.search_fold(key) == plain_search_fold(key), hex(k)


class Shown(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts = []

    def handle_data(self, data):
        self.parts.append(data)


@pytest.mark.parametrize("markup", ["a<!-- b <i>c</i>", "a<!-- b", "a<!--", "a<!-->b<i>c</i>", "a<!-- x -- >b", "a<!-- <!-- x --> b", "a<!-- x <i>y<!-- z --> w"])
def test_open_comments_as_the_standard_parser(markup):
    parser = Shown()
    parser.feed(markup)
    parser.close()
    assert text.strip_markup(markup) == "".join(parser.parts)


def test_markup():
    assert text.strip_markup("<p>a<script>no</script>b</p>c&amp;d<br/>e<!-- x -->") == "\nab\nc&d\ne"
    assert text.strip_markup("<style>x<b>y</b></style>z") == "z"
    assert text.strip_markup("<title>t</title>") == "t"
    assert text.strip_markup('a<a href="x>y">b</a> 1 < 2 <script/>c<!doctype html><?pi?>') == "ab 1 < 2 c"
    assert text.strip_markup("a<script>b</p>") == "a" and text.strip_markup("a<!-- b <p>") == "a<!-- b <p>"
    assert text.strip_markup("x</ y>z<BR>&#65;</SCRIPT>") == "xz\nA"


@pytest.mark.parametrize(("given", "wanted"), [(" a \u00a0", "a"), ("a \x0bb\u2028c ", "a\nb\nc"), ("x\0y", "xy"), ("&eacute; ", "é"), ("", "")])
def test_clean(given, wanted):
    assert text.clean_text(given) == wanted


def test_public_text(spark):
    assert text.public_text("plain &lt;", "<p>no</p>") == "plain <"
    assert text.public_text(" ", "<p>yes &amp;lt;</p>") == "yes &lt;"
    assert text.public_text(None, None) == ""
    assert one(spark, text.public_text_col("p", "h"), p=None, h="<p>x</p>") == "x"


def test_folds(spark):
    assert text.fold("Straße ΣΑΣ") == "strasse σασ"
    assert text.search_fold("KADESH") == "kadesh"
    assert text.search_fold("ἀγάπη") == "αγαπη"
    assert text.search_fold("Beth-el, the") == "beth-el the"
    assert text.search_fold("!?") == "!?"
    assert text.search_fold("हिन्दी") == "ह नद" and text.search_fold("ไทย ที่") == "ไทย ท" and text.search_fold("שָׁלוֹם") == "שלום" and text.search_fold("a\u034fb\u20dd") == "a b"
    assert text.percent_decode("100%+%41") == "100%+A"
    assert text.slug("  A b/C. ") == "a-b-c"
    with pytest.raises(ValueError):
        text.slug("!!")
    assert one(spark, text.fold_col("a"), a="Straße") == "strasse"
    assert one(spark, text.fold_col("a"), a=None) is None
    assert one(spark, text.license_text("a"), a=" Public \t Domain\u00a0") == "public domain"


def test_references(spark):
    found = one(spark, refs.reference_tokens("a", "b"), a="see John.3.16 and Gen.1 xGen.1.1", b='<a href="sword://KJV/John.3.16">')
    assert found == ["Gen.1", "John.3.16", "xGen.1.1"]
    resolved = one(spark, refs.resolve_tokens(refs.reference_tokens("a")), a="John.3.16 gen.2 xGen.1.1 3John.1")
    assert [tuple(x) for x in resolved] == [("3John.1", 64, 1, None), ("John.3.16", 43, 3, 16), ("gen.2", 1, 2, None)]
    assert refs.books(spark).count() == 85


def test_coordinates(spark):
    rows = spark.createDataFrame([(("John.1.1", 0, 0),), (("", 1, 39),), (("", 2, 27),), (("", 2, 28),), ((None, 2, 1),)], "v struct<osis:string,testament:int,book:int>")
    assert [x.b for x in rows.select(refs.coordinates(F.col("v")).alias("b")).collect()] == [43, 39, 66, None, 40]


@pytest.mark.parametrize(("key", "prefix", "wanted"), [("3056", "G", "G3056"), ("00430", "H", "H0430"), ("H07225", None, "H07225"), ("00011", "G", "G11"), ("agape", "G", None), ("strong:g5!x", None, "G5"), ("H5", None, "H05"), ("000", "G", "G0"), ("5", None, None)])
def test_numbers(spark, key, prefix, wanted):
    assert one(spark, ids.canonical_number(F.col("k"), F.col("p")), k=key, p=prefix) == wanted


def test_encoded_ids(spark):
    assert one(spark, ids.encoded_id(F.col("k")), k="Aaron") == "k-Aaron"
    found = one(spark, ids.encoded_id(F.col("k")), k="ἀγάπη / ?" * 3)
    assert found.startswith("k-") and "/" not in found and "\n" not in found and "=" not in found
    assert one(spark, ids.encoded_id(F.col("k")), k="é" * 80).startswith("h-")


def test_prefix(spark):
    assert one(spark, ids.number_prefix(F.col("a")), a="StrongsGreek lexicon") == "G"
    assert one(spark, ids.number_prefix(F.col("a")), a="HebrewDef") == "H"
    assert one(spark, ids.number_prefix(F.col("a")), a="Greek words") is None


def test_links(spark):
    def targets(raw):
        rows = spark.createDataFrame([(raw,)], "a string").select(F.explode(ids.link_candidates(F.col("a"))).alias("t"))
        return sorted(x.t for x in rows.select(ids.clean_target(F.col("t")).alias("t")).where("t is not null").collect())

    assert targets('sword://Dict/word%20a <ref target="John.3.16"> <a href="bible:John.1.1#">') == ["word a"]
    assert targets("see GREEK for 03056, See hebrew for 430") == ["G3056", "H0430"]
    assert targets('<a class="x" href="x/y#z#">') == ["y#z"]
    assert targets("sword://100%") == ["100%"]


def test_shapes_are_those_of_rendered_values(spark):
    """Bytes and lines from columns, for nested structs and arrays with absent members, odd characters and empty lists."""
    kind = "a long, t string, strong_prefix string, n array<long>, s struct<x:int,y:array<struct<t:string,b:boolean>>>, e array<string>"
    rows = [
        (1, 'é"\\\n\t\x01/\x7f\u2028 漢', None, [1, -22, None], (None, [("q", True), (None, None)]), []), (None, None, "G", [], (5, []), None), (10**12, "", "H", None, None, [None, "a"]), (0, "x", None, [7], (None, None), ["", "b"]),
    ]
    df = spark.createDataFrame(rows, kind)
    value = F.struct(*df.columns)
    data_type = df.select(value.alias("v")).schema["v"].dataType
    for depth in (0, 2):
        for x in df.select(value.alias("v"), pretty_bytes(value, data_type, depth).alias("b"), pretty_lines(value, data_type).alias("l")).collect():
            shown = stable_json(x.v.asDict(recursive=True)).rstrip("\n").replace("\n", "\n" + "  " * depth)
            assert (x.b, x.l) == (len(shown.encode()), shown.count("\n") + 1)


def test_rendering():
    assert stable_json({"b": "é", "a": None, "strong_prefix": None, "c": [{"d": None, "e": 1}]}) == '{\n  "b": "é",\n  "strong_prefix": null,\n  "c": [\n    {\n      "e": 1\n    }\n  ]\n}\n'
    assert member_lines("{\n  1\n}\n") == "    {\n      1\n    }"
    assert megabytes(1 << 20) == "1.00 MB"
