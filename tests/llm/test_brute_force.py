"""Language ID against plain sets of n-grams, and quality verdicts against trees walked node by node."""

import os
from collections import Counter, defaultdict

import numpy as np
import pytest

from lectern.llm import language, quality


def plain_grams(text):
    """All n-grams of a text as byte strings, by the rule's words."""
    letters = bytes(x if x >= 128 or 97 <= x <= 122 else x + 32 if 65 <= x <= 90 else 32 for x in range(256))
    words = text.encode().translate(letters).split()
    if not words:
        return []
    raw = b" " + b" ".join(words) + b" "
    return [raw[k : k + language.GRAM] for k in range(max(1, len(raw) - language.GRAM + 1))]


def test_language_equals_sets_of_grams(spark, tables):
    """Filters differ from exact sets by false hits only, which are corrected for: predictions and shares agree."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = docs.withColumn("out", language.held_out()).collect()
    fitted = defaultdict(list)
    for x in rows:
        if not x.out and x.text is not None and x.lang is not None:
            fitted[x.lang].append(set(plain_grams(x.text)))
    assert max(map(len, fitted.values())) <= language.FITTED  # so that all of them are learned from
    seen = {lang: Counter(g for s in found for g in s) for lang, found in fitted.items()}
    share = {lang: {g: n / len(fitted[lang]) for g, n in c.items() if n > 1} for lang, c in seen.items()}
    highest = Counter()
    for c in share.values():
        for g, v in c.items():
            highest[g] = max(highest[g], v)
    held = {}
    for lang, c in share.items():
        own = [g for g, v in c.items() if v >= language.OWN * highest[g]]
        own.sort(key=lambda g, lang=lang: (-seen[lang][g], int.from_bytes(g, "little")))
        held[lang] = set(own[: language.HELD])
    wanted = {}
    for x in rows:
        hits = {lang: sum(g in held[lang] for g in plain_grams(x.text or "")) for lang in sorted(held)}
        best = max(sorted(hits), key=hits.get)
        lettered = any(map(str.isalpha, x.text or ""))
        wanted[x.doc_id] = (best, hits[best] / sum(hits.values()) if sum(hits.values()) else 0.0) if lettered else ("und", 0.0)
    found = {x.doc_id: (x.lang_pred, x.score) for x in language.op8(spark, tables).collect()}
    assert found.keys() == wanted.keys()
    clear = [k for k, (_, s) in wanted.items() if s == 0 or s > 0.3]
    assert len(clear) > 0.95 * len(rows) and np.mean([found[k][0] == wanted[k][0] for k in clear]) >= 0.99
    assert np.mean([abs(found[k][1] - wanted[k][1]) for k in clear]) < 0.02


def walked(forest, x):
    """Log-odds of one row, a node at a time."""
    total = forest.start
    for top in forest.tops.tolist():
        node = top
        while forest.feature[node] >= 0:
            node = int(forest.left[node]) + int(x[forest.feature[node]] > forest.threshold[node])
        total += forest.value[node]
    return total


def test_verdicts_equal_walked_trees(spark, tables):
    docs, labels = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    forest = quality.fit_forest(docs, labels)
    assert len(forest.tops) and (forest.feature >= 0).any()
    texts = {x.doc_id: (x.text or "").encode() for x in docs.collect()}
    for x in quality.quality_rules(docs, forest).collect():
        score = walked(forest, quality.features(quality.statistics([texts[x.doc_id]]))[0])
        failed = x.n_words < 20 or 100 * x.n_repeat_words > 30 * x.n_words
        assert x.score == pytest.approx(score, abs=1e-9) and x.base_failed == failed
        assert x.kept == (not failed and x.score >= forest.cut)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/labels.parquet"), reason="the larger tables are not here")
def test_quality_of_held_out_labels(spark):
    """Fitted on every other labelled document, the forest tells the quality of the rest."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    forest = quality.fit_forest(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.quality_rules(docs, forest).join(labels.where("doc_id % 2 = 1"), "doc_id").select("score", "kept", "base_failed", "quality").collect()
    good, bad = [x.score for x in rows if x.quality == 1], [x.score for x in rows if x.quality == 0]
    assert len(good) > 20 and len(bad) > 20
    ranks = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert ranks > 0.8
    assert np.mean([x.kept for x in rows if x.quality == 1 and not x.base_failed]) > 0.9
