"""Text vectors from word co-occurrence, without a vocabulary.

Words are hashed to a fixed number of buckets. Pairs of words at most ``WINDOW``
places apart are counted per pair of buckets, and weighted by how much more often
they meet than chance has it (positive pointwise mutual information). A randomised
range finder with power iterations takes the leading eigenvectors of this
symmetric matrix: a round multiplies the stored matrix, dealt out by rows, with a
block of ``buckets x size`` numbers. Only such blocks, whose size the parameters
fix (about 19 MB), pass through the driver. A text's vector is the mean of its
words' vectors.

Rows of the matrix are added up in the order of their columns, so the vectors do
not depend on how the texts were partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import usable_text
from reviewlens.session import store

BUCKETS = 1 << 15
SIZE = 64
SPARE = 8       # further columns of the range finder
ROUNDS = 4
WINDOW = 4
SEED = 42
WORDS_AT_ONCE = 1 << 19  # whose pairs a task lists
PAIRS_AT_ONCE = 1 << 22  # different pairs that a task holds, about


def bucket_list(text: Column, buckets: int) -> Column:
    """The buckets of the words of a text, in order."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\W+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def _held(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of pairs in order, each once, with the sum of their counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _count_pairs(window: int):
    """(pair, n): how often two buckets meet, the smaller in the upper half of
    ``pair``. What a task has counted is sent on whenever it holds many pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made() -> pa.RecordBatch:
            return pa.record_batch([pa.array(x) for x in held.pop()], ["pair", "n"])

        for batch in batches:
            lists = batch.column("h")
            words = lists.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            for start in range(0, len(words), WORDS_AT_ONCE):
                found = []
                for d in range(1, window + 1):
                    x, y = words[start:start + WORDS_AT_ONCE], words[start + d:start + WORDS_AT_ONCE + d]
                    x = x[:len(y)]
                    same = row[start:start + len(y)] == row[start + d:start + d + len(y)]
                    found.append((np.minimum(x, y) << 32 | np.maximum(x, y))[same])
                pairs, counts = np.unique(np.concatenate(found), return_counts=True)
                if len(pairs):
                    held = [_held([*held, (pairs, counts)])]
                    if len(held[0][0]) > PAIRS_AT_ONCE:
                        yield made()
        if held:
            yield made()

    return run


def pair_counts(listed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(a, b, n), stored: how often two buckets meet, both ways round; all pairs of
    one row a lie in one task, in the order of b."""
    parts = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = listed.select("h").mapInArrow(_count_pairs(window), "pair long, n long")
    # every task sends a pair few times, so it is not counted again before it moves
    counted = store(met.repartition(parts, "pair").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    one_way = counted.select(
        F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("b"), "n"
    )
    both = one_way.withColumn("n", F.when(F.col("a") == F.col("b"), 2 * F.col("n")).otherwise(F.col("n"))).unionByName(
        one_way.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    )
    return store(both.repartition(parts, "a").sortWithinPartitions("a", "b"), "matrix")


def _times(pairs: DataFrame, totals: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The weighted matrix times a block of columns."""
    sent = pairs.sparkSession.sparkContext.broadcast((totals, totals.sum(), block))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, whole, block = sent.value
        held = None

        def made(part: pd.DataFrame) -> pd.DataFrame:
            a, b, n = (part[c].to_numpy() for c in ("a", "b", "n"))
            weight = np.maximum(np.log(n * whole / (totals[a] * totals[b])), 0.0)
            first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            out = np.empty((len(first), block.shape[1]))
            for i, (start, stop) in enumerate(zip(first, [*first[1:], len(a)], strict=True)):
                out[i] = weight[start:stop] @ block[b[start:stop]]
            return pd.DataFrame({"a": a[first], "v": out.tolist()})

        for batch in batches:  # the last row of a batch may go on in the next
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = batch["a"].to_numpy() == batch["a"].iloc[-1] if len(batch) else np.zeros(0, bool)
            if len(batch) and not last.all():
                yield made(batch[~last])
            held = batch[last] if len(batch) else None
        if held is not None and len(held):
            yield made(held)

    out = np.zeros_like(block)
    found = pairs.mapInPandas(rows, "a int, v array<double>").toArrow()  # at most one row per bucket, from all tasks at once
    if found.num_rows:
        out[found["a"].to_numpy()] = found["v"].combine_chunks().flatten().to_numpy().reshape(-1, block.shape[1])
    return out


def bucket_vectors(
    listed: DataFrame, buckets: int = BUCKETS, size: int = SIZE, rounds: int = ROUNDS, seed: int = SEED
) -> np.ndarray:
    """buckets x size: eigenvectors times the root of their eigenvalues."""
    pairs = pair_counts(listed)
    totals = np.zeros(buckets)
    for row in pairs.groupBy("a").agg(F.sum("n").alias("n")).collect():  # one per bucket
        totals[row["a"]] = row["n"]
    block = np.random.default_rng(seed).normal(size=(buckets, size + SPARE))
    for _ in range(rounds):
        block, _ = np.linalg.qr(_times(pairs, totals, block))
    small = block.T @ _times(pairs, totals, block)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-np.abs(values), kind="stable")[:size]
    return block @ vectors[:, best] * np.sqrt(np.abs(values[best]))


def text_vectors(
    texts: DataFrame, keep: list[str], text: str = "text", buckets: int = BUCKETS, size: int = SIZE, seed: int = SEED
) -> DataFrame:
    """``keep`` and ``embedding``, the mean vector of the words of every usable text;
    null for the others, which are not learnt from either."""
    usable = F.coalesce(usable_text(F.col(text)), F.lit(False))
    learnt = texts.filter(usable).select(bucket_list(F.col(text), buckets).alias("h"))
    table = texts.sparkSession.sparkContext.broadcast(bucket_vectors(learnt, buckets, size, seed=seed))

    @F.pandas_udf("array<float>")
    def mean(lists: pd.Series) -> pd.Series:
        return pd.Series([
            None if h is None else (table.value[h].mean(axis=0) if len(h) else np.zeros(size)).astype(np.float32) for h in lists
        ])

    return texts.select(*keep, mean(F.when(usable, bucket_list(F.col(text), buckets))).alias("embedding"))
