"""Exact dedup, whitening and the divergence audit: plain versions of each, hot groups, and awkward rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_corpus import ROWS, SCHEMA

from lectern.llm import dedup, divergence, queries, whitening


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_exact_dedup"])
def test_equals_sql(spark, tables, duck, name):
    expected = duck.execute(queries.ORACLE_SQL[name])
    columns = [x[0] for x in expected.description]
    found = queries.QUERIES[name](spark, tables)
    assert sorted(found.columns) == sorted(columns)
    rows = found.select(*columns).collect()
    assert rows and Counter(map(tuple, rows)) == Counter(expected.fetchall())


# exact dedup


def plain_groups(rows):
    """(doc_id, keep_id, size, sha256) of each row."""
    by = defaultdict(list)
    for doc_id, text in rows:
        by[text or ""].append(doc_id)
    last = {t: max((x for x in ids if x is not None), default=None) for t, ids in by.items()}
    return Counter((d, last[t or ""], len(by[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)


@pytest.mark.parametrize("most", [1, 2, 1024])
def test_dedup_odd_rows(spark, odd, none, most):
    rows = dedup.exact_dedup(odd, most=most).collect()
    assert Counter((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in rows) == plain_groups([x[:2] for x in ROWS])
    kept = Counter(x.text_sha256 for x in rows if x.kept)
    assert set(kept.values()) == {1} and set(kept) == {x.text_sha256 for x in rows}
    assert all(x.doc_id == x.keep_id for x in rows if x.kept)
    assert dedup.exact_dedup(none).count() == 0 and dedup.exact_dedup(none).columns == [*none.columns, "keep_id", "group_size", "kept", "text_sha256"]


def test_deduplicated_keeps_columns_of_any_name(spark, odd):
    clash = odd.withColumn("keep_id", F.lit("x")).withColumn("digest", F.lit("y")).withColumn("place", F.lit(1)).withColumn("record", F.lit(2)).withColumn("a.b", F.lit(3))
    left = dedup.deduplicated(clash)
    assert left.columns == [x for x in clash.columns if x != "keep_id"]
    rows = left.collect()
    assert Counter(x.text or "" for x in rows) == Counter({x[1] or "": 1 for x in ROWS})
    assert {(x.digest, x.place, x.record, x["a.b"]) for x in rows} == {("y", 1, 2, 3)}


def test_a_hot_group_never_shuffles(spark):
    """A third of all rows are one text, a tenth another; both are found frequent, and only the others are grouped by a shuffle."""
    docs = spark.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 4))).alias("text"))
    found = dedup.exact_dedup(docs, most=16)
    assert Counter((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in found.collect()) == plain_groups([tuple(x) for x in docs.collect()])
    marked = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.col("doc_id").alias("place"))
    heavy = dedup.frequent(marked.withColumn("key", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")), 16)
    assert {x.group_size for x in heavy.collect()} == {1000, docs.where("text = 'warm'").count()}


def test_summaries_hold_every_frequent_key():
    rng = np.random.default_rng(5)
    for k in (1, 3, 10):
        rows = np.concatenate([rng.integers(0, 50, 400), rng.integers(100, 104, 600)])
        rng.shuffle(rows)
        names, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for part in np.array_split(rows, 13):
            names, sums = dedup.merged(np.concatenate([names, part]), np.concatenate([sums, np.ones(len(part), np.int64)]), k)
        true = Counter(rows.tolist())
        assert len(names) <= k
        assert {x for x, n in true.items() if n * (k + 1) > len(rows)} <= set(names.tolist())
        assert all(true[x] - len(rows) / (k + 1) <= n <= true[x] for x, n in zip(names.tolist(), sums.tolist(), strict=True))


def test_dedup_by_another_form(spark):
    docs = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    found = dedup.exact_dedup(docs, normalised=lambda x: F.lower(F.regexp_replace(x, " +", " ")))
    assert {x.doc_id: x.keep_id for x in found.collect()} == {1: 2, 2: 2, 3: 3}


# whitening


@pytest.mark.parametrize(("rows", "dims", "top"), [(1, 1, 1), (65, 3, 1), (200, 5, 1 << 11), (130, 4, 1 << 40), (70, 2, (1 << 62) + 5), (10, 3, 0)])
def test_cross_products_are_exact(rows, dims, top):
    y = np.random.default_rng(rows).integers(0, top + 1, (rows, dims), dtype=np.uint64)
    sums, products = whitening.cross_products(y)
    plain = y.astype(object)
    assert sums.tolist() == plain.sum(axis=0).tolist()
    assert np.triu(products.astype(object)).tolist() == np.triu(plain.T @ plain).tolist()


def whitened_plainly(vectors, k):
    """n, exact deviations, and per component the eigenvalue's share and the projections, from whole numbers."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    off = [[n * r[d] - sums[d] for d in range(dims)] for r in x]
    cov = np.array([[sum(r[i] * r[j] for r in off) for j in range(dims)] for i in range(dims)], float) / n**3
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:k]
    return n, [sum(v * v for v in r) for r in off], values[order] / np.trace(cov), (np.array(off, float) / n) @ vectors[:, order] / np.sqrt(values[order])


def test_whitening_equals_the_plain_rule(spark, tables):
    vectors = {x.vec_id: x.embedding for x in spark.read.parquet(f"{tables}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    n, deviation, share, white = whitened_plainly([vectors[i] for i in ids], 8)
    found = queries.QUERIES["op11_embedding_whitening"](spark, tables).collect()
    assert len(found) == 8 * n
    at = {v: k for k, v in enumerate(ids)}
    signs = {c: np.sign(next(x.whitened for x in found if x.vec_id == ids[0] and x.component == c) * white[0, c - 1]) for c in range(1, 9)}
    for x in found:
        k = at[x.vec_id]
        assert (x.n, x.deviation) == (n, deviation[k])
        assert x.whitened == pytest.approx(signs[x.component] * white[k, x.component - 1], abs=1e-7)
        assert x.explained == pytest.approx(share[x.component - 1], rel=1e-9)
    assert len({x.identity_error for x in found}) == 1 and found[0].identity_error < 1e-9


def test_whitening_odd_rows(spark):
    kind = "vec_id long, embedding array<float>, id string, whitened int"
    nan, inf = float("nan"), float("inf")
    good = [[0.5, -0.25, 0.1], [0.1, 0.7, 0.1], [-0.3, 0.2, 0.1], [0.5, -0.25, 0.1], [1.5, 0.0, 0.1]]
    rows = [(k, v, "x", 1) for k, v in enumerate(good)] + [(None, good[0], "x", 1), (9, None, "x", 1), (10, [1.0, None, 2.0], "x", 1), (11, [nan, 0.0, 0.0], "x", 1), (12, [0.0, inf, 0.0], "x", 1), (13, [], "x", 1), (14, [0.3], "x", 1)]
    found = {x.id: x for x in whitening.whiten(spark.createDataFrame(rows, kind)).collect()}
    n, deviation, share, white = whitened_plainly([*good, good[0]], 2)
    assert set(found) == {*range(5), None, 13, 14}
    for k in range(5):
        assert (found[k].n, found[k].deviation) == (n, deviation[k])
        assert np.abs(found[k].whitened) == pytest.approx(np.abs(white[k]), abs=1e-8) and found[k].explained == pytest.approx(share, rel=1e-9)
    assert found[None].whitened == found[0].whitened and found[13].whitened == [] and found[14].whitened == [] and (found[14].n, found[14].deviation) == (1, 0)
    assert found[0].identity_error < 1e-9
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    with pytest.raises(Exception, match="too large for 64 bits"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], "x", 1)], kind)).collect()


def test_whitening_of_large_numbers_is_exact(spark):
    values = [[1e9, -3e9], [2.5e9, 4e9], [-1e9, 1e3], [7e9, 5e9]]
    found = {x.vec_id: x for x in whitening.whiten(spark.createDataFrame([(k, v) for k, v in enumerate(values)], "vec_id long, embedding array<double>").withColumnRenamed("vec_id", "k"), id_col="k").withColumnRenamed("id", "vec_id").collect()}
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in values]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert [found[k].deviation for k in range(4)] == [sum((4 * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]


# divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audited(rows, least):
    """The audit by its definition, over (lang, source, text)."""
    groups, seen, counts = set(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        key = (lang or "", source or "")
        groups.add(key)
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        counts[key].update(terms)
        seen[key[0]].update(set(terms))
    out = []
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def p(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, each = p(whole), {s: p(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(each[s][t] - each[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(each[s][t] - q[t], t) for t in kept if counts[lang, s][t] and each[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                order = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(order, 1) if part == "pair" or k <= 50]
    return Counter(out)


def audited_by_spark(df, **more):
    return Counter((x.lang, x.source, x.part, x.item, x.value, x.rank) for x in divergence.audit(df, **more).collect())


def test_audit_odd_rows(spark, odd, none):
    assert audited_by_spark(odd, least=1) == audited([(x[2], x[3], x[1]) for x in ROWS], 1)
    assert audited_by_spark(odd, least=99) == audited([(x[2], x[3], x[1]) for x in ROWS], 99)
    assert divergence.audit(none).count() == 0


@pytest.mark.parametrize(("block", "term_block"), [(1, 3), (2, 7), (3, 1000), (None, 16)])
def test_cells_of_any_size_give_the_same_sums(spark, monkeypatch, block, term_block):
    monkeypatch.setattr(divergence, "HELD", 20)
    rng = np.random.default_rng(3)
    words = [f"w{'abcdefghij'[k % 10] * (k // 10 + 1)}" for k in range(60)] + ["É", "é", "漢", "Ab"]
    rows = [("xy"[k % 3 == 0], f"s{rng.integers(0, 7)}", " ".join(rng.choice(words, rng.integers(0, 30)))) for k in range(150)] + [("z", "only", "wa wa"), ("z", None, None), (None, "s", "wa")]
    df = spark.createDataFrame([(k, *r, "clash") for k, r in enumerate(rows)], "doc_id long, lang string, source string, text string, term string")
    assert audited_by_spark(df, least=4, block=block, term_block=term_block) == audited(rows, 4)


def test_probabilities_of_large_counts_are_exact(spark):
    row = spark.range(1).select(divergence.probability(F.lit(10**15 + 1), F.lit(3 * 10**15), F.lit(10**6)).alias("p")).first()
    assert row.p == 1 + 10**9 * (10**15 + 6) // (3 * 10**15 + 5 * 10**6)
