"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text is turned into a row of statistics inside the tasks. The trees
are fitted on a bounded sample of labelled rows, flattened into arrays of split
features and thresholds, and all rows of a batch walk down a tree together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from reviewlens.llm.common import text_or_empty

SAMPLE_ROWS = 20_000  # labelled rows to learn from, at most about
TREES = 120
DEPTH = 4
BINS = 64
RATE = 0.1
SHRINK = 1.0  # L2 weight on the leaves
MIN_LEAF = 20.0  # rows on each side of a split, at least
THRESHOLD = 0.7

FEATURES = [
    "log_chars", "log_words", "log_lines", "word_length", "longest_word", "distinct_words", "distinct_lines",
    "top_word", "repeated_triples", "line_words", "byte_entropy", "capitals", "digits", "blanks", "non_ascii",
    "stops", "commas", "exclamations", "symbols", "pipes", "brackets", "quotes", "other_marks", "short_words",
    "ended_lines", "capital_words",
]
_MARKS = {
    "stops": b".", "commas": b",;:", "exclamations": b"!?", "symbols": b"#*$%&", "pipes": b"|",
    "brackets": b"<>()[]{}", "quotes": b"\"'", "other_marks": b"-_/\\=+@^~`",
}


def _masks() -> np.ndarray:
    of_byte = np.zeros((5 + len(_MARKS), 256))
    of_byte[0, 65:91] = of_byte[1, 48:58] = of_byte[2, [9, 10, 11, 12, 13, 32]] = of_byte[3, 128:] = 1
    of_byte[4, 97:123] = 1
    for i, marks in enumerate(_MARKS.values()):
        of_byte[5 + i, list(marks)] = 1
    return of_byte.T


_OF_BYTE = _masks()


def statistics(text: str) -> list[float]:
    """The ``FEATURES`` of one whole text; an empty one has zeros."""
    words = text.split()
    if not words:
        return [float(np.log1p(len(text)))] + [0.0] * (len(FEATURES) - 1)
    n = len(words)
    data = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts / len(data)
    present = shares[counts > 0]
    capitals, digits, blanks, non_ascii, _, *marks = (shares @ _OF_BYTE).tolist()
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    lengths = [len(w) for w in words]
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [
        float(np.log1p(len(text))), float(np.log1p(n)), float(np.log1p(len(lines))),
        sum(lengths) / n, float(max(lengths)), len(set(words)) / n, len(set(lines)) / len(lines),
        Counter(words).most_common(1)[0][1] / n, 1 - triples / max(1, n - 2), n / len(lines),
        float(-(present * np.log2(present)).sum()), capitals, digits, blanks, non_ascii, *marks,
        sum(k <= 2 for k in lengths) / n, sum(line.rstrip()[-1] in ".!?" for line in lines) / len(lines),
        sum(map(str.isupper, words)) / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in arrays: node i has the children 2i+1 and 2i+2."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        raw, every = np.full(len(rows), self.start), np.arange(len(rows))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(rows), np.int64)
            while len(at) and at[0] < inner:  # all rows are on the same level
                at = 2 * at + 1 + (rows[every, feature[at]] > threshold[at])
            raw += value[at - inner]
        return 1.0 / (1.0 + np.exp(-raw))


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE
) -> Forest:
    """Boosted trees for the log loss. Splits are searched on histograms of the
    gradients over quantile bins, level by level; a node without a useful split
    sends all its rows to the left."""
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not len(y) or y.min() == y.max():
        trees = 0
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    if not trees:
        return Forest(start, feature, threshold, value)
    edges = [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)])
    raw = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, curvature = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for f, column in enumerate(binned):
                cell = node * bins + column
                g, h, n = (
                    np.bincount(cell, w, width * bins).reshape(width, bins).cumsum(axis=1)
                    for w in (gradient, curvature, None)
                )
                all_g, all_h, all_n = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = (
                    g**2 / (h + SHRINK) + (all_g - g) ** 2 / (all_h - h + SHRINK) - all_g**2 / (all_h + SHRINK)
                )
                gain[(n < MIN_LEAF) | (all_n - n < MIN_LEAF)] = -np.inf
                gain[:, len(edges[f]):] = -np.inf
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                for k in np.flatnonzero(top > best):
                    best[k] = top[k]
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][cut[k]]
            own = first + node
            node = 2 * node + (x[np.arange(len(y)), feature[t, own]] > threshold[t, own])
        g, h = np.bincount(node, gradient, leaves), np.bincount(node, curvature, leaves)
        value[t] = -rate * g / (h + SHRINK)
        raw += value[t][node]
    return Forest(start, feature, threshold, value)


@F.pandas_udf(ArrayType(DoubleType()))
def _statistics(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([statistics(t) for t in texts])


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, labels) of about ``sample_rows`` labelled documents, picked
    by a hash of the id: the only rows that come to the driver. A document
    labelled several times takes the majority, ties go to 0."""
    one_each = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) > 0.5).cast("int").alias("_y"))
    )
    total = one_each.count()
    spread = F.pmod(F.xxhash64(F.lit("quality"), "_id"), F.lit(1 << 30))
    bound = int(min(1.0, sample_rows / max(1, total)) * (1 << 30))
    sample = one_each.filter(spread < bound).limit(2 * sample_rows)
    rows = (
        docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
        .join(F.broadcast(sample), "_id")  # bounded by the line above
        .limit(4 * sample_rows).select("_id", "_y", _statistics("_text").alias("_x")).collect()
    )
    rows.sort(key=lambda r: (r["_id"], r["_x"]))
    x = np.array([r["_x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return x, np.array([r["_y"] for r in rows], float)


def score_documents(docs: DataFrame, forest: Forest, text: Column, score_col: str = "score") -> DataFrame:
    """Add the probability of label 1."""
    model = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))
            yield pd.Series(model.value.score(rows))

    return docs.withColumn(score_col, scored(text_or_empty(text)))


def classify_quality(
    docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, score and predicted for every document.

    Labels are learnt only from rows of ``labels`` where ``training`` (over the
    id column) holds; only the text enters a score. Null and empty texts are
    scored by their zero statistics, repeated rows one by one. Without usable
    labels, or with labels of one kind, every score is the prior (0.5 without
    any). Other columns are not looked at; an empty table gives an empty result.
    """
    x, y = training_rows(docs, labels.filter(training), id_col, text_col, label_col, sample_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    scored = score_documents(texts, fit_forest(x, y), F.col("_text")).drop("_text")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
