"""Quality rules: document statistics, base rules, and boosted trees scored from flat numpy node arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import BLANKS, bytes_of, map_arrow, read

WINDOW = 8
#: Words whose windows are compared at once; a longer text is compared alone.
AT_ONCE = 1 << 20
#: Labelled documents that the trees are fitted on, at most.
FITTED = 20_000

SYMBOLS = b"#*$%&|<>"
LETTERS = bytes(x for x in range(256) if x >= 128 or chr(x).isalpha())
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
ENDS = b".!?"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_letters", "n_capitals", "n_digits", "n_ends", "n_lines", "n_distinct")
#: What the trees see, and whether the score may only rise (1) or only fall (-1) with it.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "letter_share": 1,
    "capital_share": -1, "digit_share": 0, "end_share": 0, "words_a_line": 0, "distinct_share": 0,
}


def repeated(hashes: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """For each document, the words that lie in windows found twice or more in it. hashes, owner: a row a word."""
    out = np.zeros(docs, np.int64)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return out
    mixed = hashes.view(np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        window = (owner[:n].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(WINDOW):
            window = (window ^ (window >> np.uint64(29))) * odd + mixed[k : k + n]
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])  # windows across two documents are none
    order = inside[np.argsort(window[inside], kind="stable")]
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return np.bincount(owner[covered], minlength=docs).astype(np.int64)


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """A row a text, with the columns of BASE and EXTRA."""
    out = np.zeros((len(texts), len(BASE) + len(EXTRA)), np.int64)
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = 0

    def settle() -> None:
        nonlocal size
        if held:
            first = owners[0][0]
            owner = np.concatenate(owners)
            found = repeated(np.concatenate(held), owner - first, int(owner[-1] - first) + 1)
            out[first : first + len(found), 4] = found
        held.clear()
        owners.clear()
        size = 0

    for k, raw in enumerate(texts):
        if not raw:
            continue
        words = raw.split()
        if not words:
            continue
        lines = [x for x in raw.split(b"\n") if x.strip(BLANKS)]
        tight = raw.translate(None, BLANKS)
        count = lambda chars: len(tight) - len(tight.translate(None, chars))  # noqa: B023, E731
        points = len(tight) if tight.isascii() else len(tight.decode("utf-8", "replace"))
        out[k] = (
            len(words), points, count(SYMBOLS), len(lines) - len(set(lines)), 0,
            count(LETTERS), count(CAPITALS), count(DIGITS), count(ENDS), len(lines), len(set(words)),
        )
        if len(words) > WINDOW:
            held.append(np.fromiter(map(hash, words), np.int64, len(words)))
            owners.append(np.full(len(words), k))
            size += len(words)
            if size >= AT_ONCE:
                settle()
    settle()
    return out


def features(stats: np.ndarray) -> np.ndarray:
    words, chars, symbols, dups, repeats, letters, capitals, digits, ends, lines, distinct = stats.T.astype(np.float64)
    n, c, m = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.column_stack([np.log1p(words), chars / n, symbols / c, dups / m, repeats / n, letters / c, capitals / c, digits / c, ends / n, words / m, distinct / n])


class Forest(NamedTuple):
    """Boosted trees in flat arrays: a node's feature (-1: leaf), threshold, children (right is left + 1) and value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    tops: np.ndarray
    start: float
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good quality; all rows go down a level of a tree at a time."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for top in self.tops:
            node = np.full(len(x), top)
            while True:
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.value[node]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 32, rate: float = 0.2, ridge: float = 2.0, keep: float = 0.995) -> Forest:
    """Logistic boosting on histograms. A split against a feature's direction is refused, and its children's values
    stay on their sides of the split's middle, so the score is monotone in every constrained feature.

    ``keep``: the share of good documents whose scores reach the forest's cut.
    """
    signs = np.array(list(FEATURES.values()))
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])] if len(x) else []
    binned = np.column_stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)]) if len(x) else x
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(len(x), start)
    nodes: list[list[float]] = []  # feature, threshold, left, value
    tops: list[int] = []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return min(max(-g / (h + ridge), low), high)

    def split(node: int, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, low: float, high: float, level: int) -> None:
        g, h = grad[rows].sum(), hess[rows].sum()
        nodes[node][3] = rate * leaf(g, h, low, high)
        best = (1e-6, -1, 0, 0.0, 0.0)
        for k, e in enumerate(edges if level else []):
            if not len(e):
                continue
            b = binned[rows, k]
            gl = np.cumsum(np.bincount(b, grad[rows], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, hess[rows], len(e) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
            vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-(g - gl) / (h - hl + ridge), low, high)
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(nl < 5) | (len(rows) - nl < 5) | (signs[k] * (vr - vl) < 0)] = -1
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], k, at, vl[at], vr[at])
        _, k, at, vl, vr = best
        if k < 0:
            score[rows] += nodes[node][3]
            return
        left, middle = len(nodes), (vl + vr) / 2
        nodes[node][:3] = [k, edges[k][at], left]
        nodes.extend([[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]])
        goes = binned[rows, k] <= at
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(signs[k])]
        split(left, rows[goes], grad, hess, *bounds[0], level - 1)
        split(left + 1, rows[~goes], grad, hess, *bounds[1], level - 1)

    if 0 < y.sum() < len(y):
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            tops.append(len(nodes))
            nodes.append([-1, 0.0, 0, 0.0])
            split(tops[-1], np.arange(len(x)), p - y, p * (1 - p), -np.inf, np.inf, depth)
    table = np.array(nodes or [[-1, 0.0, 0, 0.0]])
    cut = float(np.quantile(score[y == 1], 1 - keep)) - 1e-9 if y.sum() else -np.inf
    return Forest(table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3], np.array(tops, np.int64), start, min(cut, 0.0))


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id with the counts of BASE and EXTRA as longs; a null text counts as one without words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = statistics(bytes_of(batch, "text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in stats.T)], ["doc_id", *BASE, *EXTRA])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, " + ", ".join(f"{x} long" for x in (*BASE, *EXTRA)))


def fit_forest(docs: DataFrame, labels: DataFrame, most: int = FITTED) -> Forest:
    """Trees fitted on at most ``most`` labelled documents, those whose seeded hashes of doc_id are smallest.

    Of several labels for one doc_id the highest counts; a null doc_id or label is none. A doc_id that several rows of ``docs`` have is
    fitted with each of them, so only there are rows more than ``most``; one that none has is left out. A null text has no words. Where all
    labels agree, or there are none, the forest has no tree and one score for all. Extra columns are ignored.
    """
    asked = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    chosen = asked.orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")  # ``most`` rows at most

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = statistics(bytes_of(batch, "text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), *(pa.array(x) for x in stats.T)], ["doc_id", "quality", *BASE, *EXTRA])

    found = map_arrow(rows.withColumn("quality", F.col("quality").cast("int")), run, "doc_id long, quality int, " + ", ".join(f"{x} long" for x in (*BASE, *EXTRA))).toPandas()
    found = found.sort_values(list(found.columns), kind="stable")
    return fit(features(found[[*BASE, *EXTRA]].to_numpy(np.int64)), (found["quality"].to_numpy() > 0).astype(float))


def quality_rules(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row a document: doc_id, the base counts, base_failed, score (log-odds of good quality) and kept.

    base_failed: fewer than 20 words, or over 30 % of the words in repeated windows. kept: not base_failed, and
    the score reaches the forest's cut. A null, empty or blank text has no words and fails. Rows that repeat
    give a row each; extra columns are ignored; an empty table gives an empty result.
    """
    names = (*BASE, *EXTRA)
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = statistics(bytes_of(batch, "text"))
        trees = shared.value
        score = trees.score(features(stats))
        failed = (stats[:, 0] < 20) | (100 * stats[:, 4] > 30 * stats[:, 0])
        columns = {"doc_id": batch.column("doc_id")} | dict(zip(names, map(pa.array, stats.T), strict=True))
        columns = {k: v for k, v in columns.items() if k not in EXTRA}
        columns |= {"base_failed": pa.array(failed), "kept": pa.array(~failed & (score >= trees.cut)), "score": pa.array(score)}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, " + ", ".join(f"{x} long" for x in BASE) + ", base_failed boolean, kept boolean, score double"
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules(docs, fit_forest(docs, read(spark, sf_dir, "labels")))
