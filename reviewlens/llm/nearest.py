"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample: every node splits at the median of a
random projection. Every vector is sent to its leaf in every tree. A query walks
all trees through one priority queue, opening the node it lies deepest in first,
until it has seen its budget of leaves; the vectors of these leaves are then
ranked by their exact inner products.

Largest inner products become nearest directions by one more coordinate, which
lifts every vector to the same length; queries have 0 there. The budget is
measured: on the sample, against brute force, it is the smallest that reaches
the wanted recall. Few vectors are searched in full.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import store

SAMPLE_ROWS = 20_000  # vectors the trees are fitted on, at most about
TREES = 8
LEAF_ROWS = 48  # sampled vectors in a leaf, about
TARGET_RECALL = 0.96
CALIBRATION_QUERIES = 200
FULL_SEARCH_ROWS = 2_000  # up to so many vectors every leaf is opened
BLOCK_ROWS = 32_768  # vectors that meet a block of queries at once
BLOCK_QUERIES = 2_048
SEED = 11


@dataclass(frozen=True)
class Forest:
    """Complete trees: node i of a tree has the children 2i+1 and 2i+2."""

    directions: np.ndarray  # tree, node, coordinate
    thresholds: np.ndarray  # tree, node
    radius: float  # all vectors are lifted to this length

    @property
    def leaves(self) -> int:
        return self.thresholds.shape[1] + 1

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.radius**2 - (vectors**2).sum(axis=1), 0.0)
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        lifted, inner = self.lift(vectors), self.thresholds.shape[1]
        out = np.empty((len(vectors), len(self.thresholds)), np.int64)
        for tree, (directions, thresholds) in enumerate(zip(self.directions, self.thresholds, strict=True)):
            at = np.zeros(len(vectors), np.int64)
            while len(at) and at[0] < inner:
                side = (lifted * directions[at]).sum(axis=1) > thresholds[at]
                at = 2 * at + 1 + side
            out[:, tree] = at - inner
        return out

    def margins(self, queries: np.ndarray) -> np.ndarray:
        """query, tree, node: signed distance to the split, positive on the right."""
        lifted = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        return np.einsum("qd,tnd->qtn", lifted, self.directions, optimize=True) - self.thresholds

    def open_leaves(self, margins: np.ndarray, budget: int) -> list[tuple[int, int]]:
        """(tree, leaf) of one query in the order of the shared priority queue."""
        inner, found = self.thresholds.shape[1], []
        queue = [(-np.inf, tree, 0) for tree in range(len(self.thresholds))]
        while queue and len(found) < budget:
            depth, tree, node = heapq.heappop(queue)
            if node >= inner:
                found.append((tree, node - inner))
                continue
            margin = margins[tree, node]
            heapq.heappush(queue, (max(depth, margin), tree, 2 * node + 1))
            heapq.heappush(queue, (max(depth, -margin), tree, 2 * node + 2))
        return found


def fit_forest(
    sample: np.ndarray, radius: float, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = SEED
) -> Forest:
    """Split every node at the median of its sampled vectors along a random direction."""
    rng = np.random.default_rng(seed)
    depth = max(0, int(np.ceil(np.log2(max(1, len(sample)) / leaf_rows))))
    inner = 2**depth - 1
    directions = rng.normal(size=(trees, inner, sample.shape[1] + 1))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    forest = Forest(directions, np.zeros((trees, inner)), radius)
    lifted = forest.lift(sample)
    for tree in range(trees):
        at = np.zeros(len(sample), np.int64)
        for level in range(depth):
            projected = (lifted * directions[tree, at]).sum(axis=1)
            order = np.lexsort((projected, at))
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                low, high = np.searchsorted(at[order], [node, node + 1])
                if high > low:
                    forest.thresholds[tree, node] = np.median(projected[order[low:high]])
            at = 2 * at + 1 + (projected > forest.thresholds[tree, at])
    return forest


def leaf_budget(
    forest: Forest, sample: np.ndarray, k: int, recall: float = TARGET_RECALL,
    queries: int = CALIBRATION_QUERIES, seed: int = SEED,
) -> float:
    """Share of all leaves to open so that brute force over the sample agrees
    with the wanted recall."""
    total = forest.leaves * len(forest.thresholds)
    rng = np.random.default_rng(seed + 1)
    asked = rng.permutation(len(sample))[:queries]
    placed, needed = forest.place(sample), []
    margins = forest.margins(sample[asked])
    for own, query in enumerate(asked):
        near = sample @ sample[query]
        near[query] = -np.inf
        best = np.argsort(-near)[:min(k, len(sample) - 1)]
        rank = np.empty((len(forest.thresholds), forest.leaves), np.int64)
        for place, (tree, leaf) in enumerate(forest.open_leaves(margins[own], total)):
            rank[tree, leaf] = place + 1
        needed.append(rank[np.arange(len(forest.thresholds)), placed[best]].min(axis=1))
    return float(np.quantile(np.concatenate(needed), recall) / total) if needed else 1.0


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector of the rows that take part: an id, the most frequent
    number of components (of equally frequent ones the smallest), all of them
    finite, not all zero."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    whole = rows.filter(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    sizes = whole.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    first = sizes.first()
    return whole.filter(F.size("vector") == (first["d"] if first else 0))


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _dealt(forest: Forest, counts: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
    """(group of every leaf, shards of every group): neighbouring leaves are put
    together up to ``BLOCK_ROWS`` vectors, larger leaves are cut into shards."""
    group = np.zeros((len(forest.thresholds), forest.leaves), np.int64)
    shards: list[int] = []
    for tree in range(len(forest.thresholds)):
        filled = BLOCK_ROWS + 1
        for leaf in range(forest.leaves):
            rows = counts.get((tree, leaf), 0)
            if filled + rows > BLOCK_ROWS:
                shards.append(1)
                filled = 0
            filled += rows
            shards[-1] = max(shards[-1], -(-rows // BLOCK_ROWS))
            group[tree, leaf] = len(shards) - 1
    return group, np.array(shards)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, trees: int = TREES, recall: float = TARGET_RECALL,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest vectors
    found for every query, nearest first, ties to the smaller vec_id.

    ``queries`` has the same two columns. Rows that take no part (see
    :func:`usable_vectors`) are neither asked nor found. A query does not find
    its own id. Of equal vectors only the k + 1 smallest ids are indexed: no
    others can be among the k nearest. An id that occurs with several vectors
    counts by its largest product. With fewer than ``k`` others all are
    returned. Other columns are not looked at; empty tables give an empty result.
    """
    usable = usable_vectors(vectors, id_col, vector_col)
    among_equals = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    index = store(
        usable.distinct().withColumn("_n", among_equals).filter(F.col("_n") <= k + 1).drop("_n"), "vectors"
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows, longest, width = index.agg(F.count("*"), F.max(squares), F.max(F.size("vector"))).first()
    spark = vectors.sparkSession
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    spread = F.pmod(F.xxhash64(F.lit("forest"), "vec_id"), F.lit(1 << 30))
    bound = int(min(1.0, sample_rows / rows) * (1 << 30))
    sampled = index.filter(spread < bound).orderBy("vec_id").limit(2 * sample_rows).collect()
    sample = np.array([r["vector"] for r in sampled], float).reshape(len(sampled), width)
    forest = fit_forest(sample, float(np.sqrt(longest)), trees)
    total = forest.leaves * trees
    share = 1.0 if rows <= FULL_SEARCH_ROWS else leaf_budget(forest, sample, k, recall)
    budget = max(1, int(np.ceil(share * total)))
    sent = spark.sparkContext.broadcast(forest)  # bounded by the sample

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                leaves = sent.value.place(_stack(batch["vector"]))
                for tree in range(leaves.shape[1]):
                    yield batch.assign(tree=tree, leaf=leaves[:, tree])

    kind = index.schema["vector"].dataType.simpleString()
    placed = store(index.mapInPandas(place, f"vec_id long, vector {kind}, tree int, leaf int"), "leaves")
    counts = {(r["tree"], r["leaf"]): r["count"] for r in placed.groupBy("tree", "leaf").count().collect()}
    group, shards = _dealt(forest, counts)
    dealt = spark.sparkContext.broadcast((group, shards))  # no more entries than leaves

    asked = usable_vectors(queries, id_col, vector_col).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    n_asked = asked.count()
    blocks = max(1, -(-n_asked // BLOCK_QUERIES))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, (groups, cut) = sent.value, dealt.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                out = []
                margins = own.margins(_stack(part["vector"]))
                for query, vector, margin in zip(part["query_id"], part["vector"], margins, strict=True):
                    by_group: dict[int, list[int]] = {}
                    for tree, leaf in own.open_leaves(margin, budget):
                        by_group.setdefault(int(groups[tree, leaf]), []).append(leaf)
                    for g, leaves in by_group.items():
                        out += [(query, vector, g, shard, leaves) for shard in range(cut[g])]
                yield pd.DataFrame(out, columns=["query_id", "vector", "group", "shard", "leaves"])

    visits = asked.mapInPandas(
        visit, f"query_id long, vector {kind}, group int, shard int, leaves array<int>"
    ).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups, cut = dealt.value
        for batch in batches:
            g = groups[batch["tree"], batch["leaf"]]
            yield batch.assign(group=g, shard=batch["vec_id"].to_numpy() % cut[g])[
                ["vec_id", "vector", "leaf", "group", "shard"]
            ]

    blocked = placed.mapInPandas(
        assign, f"vec_id long, vector {kind}, leaf int, group int, shard int"
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def rank(asking: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(known):
            return pd.DataFrame({"query_id": [], "near": []})
        base, ids, leaf = _stack(known["vector"]), known["vec_id"].to_numpy(), known["leaf"].to_numpy()
        found = []
        for query, vector, leaves in zip(asking["query_id"], asking["vector"], asking["leaves"], strict=True):
            q = np.asarray(vector, np.float64)
            seen = np.flatnonzero(np.isin(leaf, leaves) & (ids != query))
            near = base[seen] @ q
            if len(near) > k:  # with all ties of the last place
                least = np.partition(near, len(near) - k)[len(near) - k]
                seen = seen[near >= least - 1e-9 * (1.0 + abs(least))]
            score = (base[seen] * q).sum(axis=1)
            best = np.lexsort((ids[seen], -score))[:k]
            found.append((query, list(zip(ids[seen][best].tolist(), score[best].tolist(), strict=True))))
        return pd.DataFrame(found, columns=["query_id", "near"])

    key = ["group", "shard", "block"]
    pairs = visits.groupBy(*key).cogroup(blocked.groupBy(*key)).applyInPandas(
        rank, "query_id long, near array<struct<vec_id:long,score:double>>"
    ).select("query_id", F.inline("near"))
    once = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
