"""Vector code compression: product codes learnt over a trie of distinct parts.

Components become integers and a vector is cut into equal parts. Equal parts are
counted once, with a weight. The distinct parts of a position, in lexicographic
order, are the leaves of a trie whose levels are the dimensions of a part. A
depth-first walk carries the distances to all entries of the codebook, added up
over the dimensions so far; every node adds one dimension for all parts below
it, so parts that begin alike share that work. A leaf takes the nearest entry
and adds its weight times its components to that entry's sums.

Sorted parts are dealt by ranges and written once, so a task walks one stretch
of the trie, and every round reads the table without a shuffle. A round sends
back at most parts x entries sums, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import store

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LEAVES_AT_ONCE = 8_192  # a subtree of no more leaves is walked level by level in numpy
LARGEST = 1 << 27  # integers of a larger magnitude could overflow the sums


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) for lexicographically
    sorted distinct rows; ties go to the lower index.

    The stack holds subtrees: their first and last leaf, the depth of their node
    and the distances carried so far. A large subtree is split at its next
    dimension; a small one is finished level by level, one row per node.
    """
    n, dims = parts.shape
    best, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    stack = [(0, n, 0, np.zeros(len(entries), np.int64))] if n else []
    while stack:
        start, stop, depth, carried = stack.pop()
        if stop - start > LEAVES_AT_ONCE and depth < dims:
            column = parts[start:stop, depth]
            cuts = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1])
            added = carried + (column[cuts, None] - entries[None, :, depth]) ** 2
            ends = np.append(cuts[1:], stop - start)
            stack.extend(
                (start + int(cuts[i]), start + int(ends[i]), depth + 1, added[i]) for i in range(len(cuts) - 1, -1, -1)
            )
            continue
        block, node, distances = parts[start:stop], np.zeros(stop - start, np.int64), carried[None, :]
        fresh = np.zeros(stop - start, bool)  # where a node of this level begins
        fresh[0] = True
        for d in range(depth, dims):
            fresh[1:] |= block[1:, d] != block[:-1, d]
            first = np.flatnonzero(fresh)
            distances = distances[node[first]] + (block[first, d, None] - entries[None, :, d]) ** 2
            node = np.cumsum(fresh) - 1
        best[start:stop] = distances.argmin(axis=1)[node]
        error[start:stop] = distances.min(axis=1)[node]
    return best, error


def sorted_distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, the place of every row in them)."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64)
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    fresh = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], place


def part_bounds(dimension: int, parts: int) -> list[int]:
    """Where the parts begin and end; all equal if the dimension allows it."""
    return [i * dimension // parts for i in range(parts + 1)]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """vec_id, label and ``v``, the vector in integers, of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    kept = vectors.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    return kept.select(
        F.col(id_col).alias("vec_id"), label.alias("label"),
        F.transform(v, lambda x: F.floor(x * SCALE).cast("long")).alias("v"),
    )


def _in_range(rows: np.ndarray) -> np.ndarray:
    if len(rows) and np.abs(rows).max() > LARGEST:
        raise OverflowError(f"components beyond {LARGEST // SCALE} in magnitude overflow 64-bit sums")
    return rows


def distinct_parts(whole: DataFrame, bounds: list[int]) -> DataFrame:
    """(position, part, weight), distinct, in order within ranges; stored."""
    cut = F.array(*[
        F.struct(F.lit(i).alias("position"), F.slice("v", a + 1, b - a).alias("part"))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
    ])
    counted = whole.select(F.explode(cut).alias("p")).groupBy("p.position", "p.part").agg(F.count(F.lit(1)).alias("weight"))
    return store(
        counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "parts"
    )


def first_codebooks(whole: DataFrame, bounds: list[int], entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids."""
    rows = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    data = _in_range(np.array([r["v"] for r in rows], np.int64))
    return [data[:, a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def improved(parts: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """One round: assign every distinct part, move every entry that got some to
    the componentwise floor of their mean; the others stay."""
    books = parts.sparkSession.sparkContext.broadcast(codebooks)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for position, rows in batch.groupby("position", sort=False):
                data = _in_range(np.concatenate(rows["part"].tolist()).reshape(len(rows), -1))
                weight = rows["weight"].to_numpy(np.int64)
                best, _ = nearest_entries(data, books.value[position])
                for entry in np.unique(best).tolist():
                    mine = best == entry
                    total = np.append(weight[mine] @ data[mine], weight[mine].sum())
                    sums[position, entry] = sums.get((position, entry), 0) + total
        keys = list(sums)
        yield pd.DataFrame({
            "position": [k[0] for k in keys], "entry": [k[1] for k in keys], "sums": [sums[k].tolist() for k in keys],
        })

    partial = parts.mapInPandas(walk, "position int, entry int, sums array<long>")
    total = partial.select("position", "entry", F.posexplode("sums").alias("at", "x")).groupBy("position", "entry", "at")
    moved = [book.copy() for book in codebooks]
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in total.agg(F.sum("x").alias("x")).collect():  # at most parts x entries x dimensions rows
        found.setdefault((r["position"], r["entry"]), {})[r["at"]] = r["x"]
    for (position, entry), row in found.items():
        width = codebooks[position].shape[1]
        moved[position][entry] = [row[d] // row[width] for d in range(width)]
    return moved


def encoded(whole: DataFrame, codebooks: list[np.ndarray], bounds: list[int]) -> DataFrame:
    """vec_id, label, ``codes`` (one entry per part) and ``error`` of every vector."""
    books = whole.sparkSession.sparkContext.broadcast(codebooks)

    @F.pandas_udf("codes array<int>, error long")
    def encode(vectors: pd.Series) -> pd.DataFrame:
        data = _in_range(np.concatenate(vectors.tolist()).reshape(len(vectors), -1))
        codes, error = np.empty((len(data), len(books.value)), np.int64), np.zeros(len(data), np.int64)
        for position, book in enumerate(books.value):
            parts, place = sorted_distinct(data[:, bounds[position]:bounds[position + 1]])
            best, distance = nearest_entries(parts, book)
            codes[:, position], error = best[place], error + distance[place]
        return pd.DataFrame({"codes": codes.tolist(), "error": error})

    made = whole.select("vec_id", "label", encode("v").alias("e"))
    return made.select("vec_id", "label", "e.codes", "e.error")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, codes, error of every vector, stored; the codebooks).

    Vectors that are null, empty or hold null, NaN or infinite components take no
    part. The smallest id of the others sets the dimension; a vector of another
    dimension takes no part either. If the dimension is no multiple of ``parts``
    the parts differ by one. Equal ids start the codebook in the order of their
    vectors, null ids come last; repeated rows count as often as they occur. With
    fewer vectors than entries the codebooks have that many entries. Null labels
    are one label. Other columns are not looked at; an empty table gives an empty
    one and empty codebooks. Components are limited to 2^15 in magnitude, so that
    no sum overflows; beyond, the query fails.
    """
    whole = whole_vectors(vectors, id_col, vector_col, label_col)
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("d")).first()
    dimension = first["d"] if first else parts
    bounds = part_bounds(dimension, parts)
    whole = whole.filter(F.size("v") == dimension)
    codebooks = first_codebooks(whole, bounds, entries) if first else [np.empty((0, 1), np.int64)] * parts
    if first:
        table = distinct_parts(whole, bounds)
        for _ in range(rounds):
            codebooks = improved(table, codebooks)
    return store(encoded(whole, codebooks, bounds), "codes"), codebooks


def decode(codes: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """Add ``vector``: the entries that the codes stand for, in the scale of the input."""
    books = codes.sparkSession.sparkContext.broadcast(codebooks)

    @F.pandas_udf("array<double>")
    def entries_of(rows: pd.Series) -> pd.Series:
        data = np.array(rows.tolist(), np.int64).reshape(len(rows), -1)
        parts = [book[data[:, i]] for i, book in enumerate(books.value)]
        return pd.Series((np.concatenate(parts, axis=1) / SCALE).tolist() if len(data) else [])

    return codes.withColumn("vector", entries_of("codes"))


def label_errors(codes: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors added up over the rows of equal label.

    Errors are added up per label first, so the join has one row per label on
    its small side; a hot label is left to Spark's adaptive skew join.
    """
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    """sha256 of all components by part, entry and position, in decimal, comma-joined."""
    spelled = ",".join(str(x) for book in codebooks for row in book.tolist() for x in row)
    return hashlib.sha256(spelled.encode()).hexdigest()
