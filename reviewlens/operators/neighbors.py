"""Exact neighbour search by blocks of nearby points.

Points are ordered along a curve through their principal axes and cut into blocks
of a fixed number of points, so no block can become hot. Boxes are taken along
the principal axes too: the rotation keeps distances, and correlated features
give thin boxes that way. Sixteen neighbouring blocks share a parent
box, sixteen parents a grandparent, and so on. Block pairs that may hold
neighbours are found by walking down both box trees and dropping pairs that are
too far apart. Each surviving pair meets in a task that holds two blocks of
bounded size and emits results per point, never per pair of points.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import small_batches, store

BLOCK_POINTS = 256
FAN_BITS = 4          # 16 children per box
CURVE_BITS = 60       # splits that make up a point's place on the curve
AXIS_BITS = 7         # splits of one axis at most
REACH_GROUPS = 2      # query points of a block: those that look near, those that look far
NEAR_SHARE = 7 / 8
PARTNERS_PER_TASK = 64
MAX_STREAMS = 64      # streams of one block, so what they report per point stays bounded
WIDE_ROWS = 128       # rows per Arrow batch when a row carries a block
SLACK = 1e-9
ESTIMATE_MARGIN = 1e-12  # bounds the rounding of |a|^2 + |b|^2 - 2ab


@dataclass
class Blocks:
    """Blocks of points and their number. Columns of ``rows``: block, pid, x
    (coordinates, point after point), w, is_query, is_base, lo, hi."""

    rows: DataFrame
    count: int
    axes: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.axes)

    @property
    def levels(self) -> int:
        depth, n = 0, self.count * REACH_GROUPS
        while n > 1:
            depth, n = depth + 1, -(-n // (1 << FAN_BITS))
        return depth


def collapse(points: DataFrame, key: str, features: list[str], flags: list[str] = ()) -> DataFrame:
    """Identical points become one with a weight; ``pid`` is the smallest key."""
    return points.groupBy(*features, *flags).agg(
        F.min(key).alias("pid"), F.count(F.lit(1)).alias("w")
    )


def _principal_axes(points: DataFrame, features: list[str]) -> np.ndarray:
    """Orthonormal principal axes as columns; plain axes where there are none."""
    dims = len(features)
    vectors = VectorAssembler(inputCols=features, outputCol="_v").transform(points).select("_v")
    if len(vectors.take(2)) < 2:
        return np.eye(dims)
    axes = PCA(k=dims, inputCol="_v", outputCol="_y").fit(vectors).pc.toArray()
    orthonormal = np.allclose(axes.T @ axes, np.eye(dims), atol=1e-9)
    return axes if orthonormal else np.eye(dims)


def _rotated(features: list[str], axes: np.ndarray) -> Column:
    @F.pandas_udf("array<double>")
    def rotate(x: pd.Series) -> pd.Series:
        return pd.Series(list(np.vstack(x.to_numpy()) @ axes)) if len(x) else x

    return rotate(F.array(*features))


def _curve_position(rotated: DataFrame, dims: int) -> Column:
    """Place on the curve: the widest remaining extent is halved at each split.

    Halves are quantiles, so dense regions get fine cells.
    """
    parts = 1 << AXIS_BITS
    fractions = [i / parts for i in range(1, parts)]
    cuts = rotated.agg(*[
        F.percentile_approx(F.col("_y")[i], fractions, 1000).alias(f"c{i}") for i in range(dims)
    ]).first()
    edges = [np.array(cuts[f"c{i}"] or [0.0] * (parts - 1)) for i in range(dims)]
    extent = [e[-1] - e[0] for e in edges]
    splits, used = [], [0] * dims
    for _ in range(min(CURVE_BITS, dims * AXIS_BITS)):
        axis = max((i for i in range(dims) if used[i] < AXIS_BITS), key=lambda i: extent[i])
        splits.append((axis, AXIS_BITS - 1 - used[axis]))
        used[axis] += 1
        extent[axis] /= 2.0

    @F.pandas_udf("long")
    def place(y: pd.Series) -> pd.Series:
        at = np.vstack(y.to_numpy()) if len(y) else np.zeros((0, dims))
        rank = [np.searchsorted(edges[i], at[:, i], side="left") for i in range(dims)]
        key = np.zeros(len(at), np.int64)
        for axis, bit in splits:
            key = (key << 1) | ((rank[axis] >> bit) & 1)
        return pd.Series(key)

    return place(F.col("_y"))


def _cut_blocks(
    features: list[str], axes: np.ndarray
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def emit(part: int, seq: int, rows: pd.DataFrame) -> pd.DataFrame:
        x = rows[features].to_numpy(dtype=np.float64)
        box = x @ axes
        return pd.DataFrame({
            "part": [part], "seq": [seq],
            "pid": [rows["pid"].to_numpy(np.int64)], "x": [x.ravel()],
            "w": [rows["w"].to_numpy(np.int64)],
            "is_query": [rows["is_query"].to_numpy(np.int32)],
            "is_base": [rows["is_base"].to_numpy(np.int32)],
            "lo": [box.min(axis=0)], "hi": [box.max(axis=0)],
        })

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            full = len(held) // BLOCK_POINTS * BLOCK_POINTS
            for start in range(0, full, BLOCK_POINTS):
                yield emit(part, seq, held.iloc[start:start + BLOCK_POINTS])
                seq += 1
            held = held.iloc[full:].reset_index(drop=True)
        if held is not None and len(held):
            yield emit(part, seq, held)

    return cut


def pack(points: DataFrame, features: list[str]) -> Blocks:
    """Cut points (pid, w, features and optionally is_query / is_base) into blocks."""
    for flag in ("is_query", "is_base"):
        if flag not in points.columns:
            points = points.withColumn(flag, F.lit(1))
    axes = _principal_axes(points, features)
    rotated = points.withColumn("_y", _rotated(features, axes))
    placed = (
        rotated.withColumn("_z", _curve_position(rotated, len(features)))
        .select("pid", "w", "is_query", "is_base", *features, "_z")
        .repartitionByRange("_z", "pid").sortWithinPartitions("_z", "pid").drop("_z")
    )
    schema = ("part int, seq int, pid array<bigint>, x array<double>, w array<bigint>, "
              "is_query array<int>, is_base array<int>, lo array<double>, hi array<double>")
    cut = store(placed.mapInPandas(_cut_blocks(features, axes), schema), "blocks")
    # number the blocks along the curve; ``starts`` has one row per partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    rows = cut.join(F.broadcast(starts), "part").withColumn(
        "block", (F.col("start") + F.col("seq")).cast("long")
    ).drop("part", "seq", "start")
    return Blocks(rows, cut.count(), axes)


def _gap2(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Squared distance between two boxes."""
    def minus(x: str, y: str) -> Column:
        return F.zip_with(x, y, lambda p, q: p - q)

    apart = F.zip_with(
        minus(a[0], b[1]), minus(b[0], a[1]), lambda p, q: F.greatest(p, q, F.lit(0.0))
    )
    return F.aggregate(apart, F.lit(0.0), lambda total, gap: total + gap * gap)


def _tree(leaves: DataFrame, key: str, lo: str, hi: str, levels: int, dims: int,
          extra: dict[str, Callable[[str], Column]]) -> list[DataFrame]:
    """Box tables from the leaves up; ``extra`` says how other columns roll up."""
    tables = [leaves]
    for _ in range(levels):
        below = tables[-1].withColumn(key, F.shiftright(key, FAN_BITS))
        tables.append(below.groupBy(key).agg(
            F.array(*[F.min(F.col(lo)[i]) for i in range(dims)]).alias(lo),
            F.array(*[F.max(F.col(hi)[i]) for i in range(dims)]).alias(hi),
            *[rule(name).alias(name) for name, rule in extra.items()],
        ))
    return tables


def _far2(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Squared distance of the points of two boxes that lie farthest apart."""
    def span(x: str, y: str) -> Column:
        return F.zip_with(x, y, lambda p, q: F.abs(p - q))

    widest = F.zip_with(span(a[1], b[0]), span(b[1], a[0]), lambda p, q: F.greatest(p, q))
    return F.aggregate(widest, F.lit(0.0), lambda total, gap: total + gap * gap)


def nearest_pairs(queries: DataFrame, bases: DataFrame, blocks: Blocks, name: str, rows: int) -> DataFrame:
    """Block pairs (a, b, gap2) that can hold the nearest ``rows`` base rows of a
    point of block a, walking down both box trees.

    ``queries``: a, alo, ahi, radius (may be infinite). ``bases``: b, blo, bhi and
    n, the base rows in the box. On every level the nearest box that holds enough
    rows bounds the search of all points of box a by the farthest they can lie
    apart, so points without a radius of their own, far from every base point,
    still meet only the boxes on their side.
    """
    above = _tree(queries, "a", "alo", "ahi", blocks.levels, blocks.dims, {"radius": F.max})
    below = _tree(bases, "b", "blo", "bhi", blocks.levels, blocks.dims, {"n": F.sum})
    pairs = None
    for level in range(blocks.levels, -1, -1):
        a, b = above[level], below[level]
        if pairs is None:  # both trees end in one root box
            met = a.withColumn("_root", F.lit(1)).join(b.withColumn("_root", F.lit(1)), "_root").withColumn(
                "limit", F.lit(math.inf)
            )
        else:
            met = (
                pairs.select(F.col("a").alias("_pa"), F.col("b").alias("_pb"), "limit")
                .join(a.withColumn("_pa", F.shiftright("a", FAN_BITS)), "_pa")
                .join(b.withColumn("_pb", F.shiftright("b", FAN_BITS)), "_pb")
            )
        own = F.least("limit", F.col("radius") * F.col("radius"))
        met = store(met.select(
            "a", "b", own.alias("limit"), _gap2(("alo", "ahi"), ("blo", "bhi")).alias("gap2"),
            F.when(F.col("n") >= rows, _far2(("alo", "ahi"), ("blo", "bhi"))).alias("far2"),
        ), name)
        bounds = met.groupBy("a").agg(F.min("far2").alias("bound"))
        limit = F.least("limit", F.coalesce("bound", F.lit(math.inf)))
        pairs = met.join(bounds, "a").withColumn("limit", limit).filter(
            F.col("gap2") <= F.col("limit") * (1 + SLACK) + SLACK
        ).select("a", "b", "gap2", "limit")
    return store(pairs.drop("limit"), name)


def near_pairs(
    queries: DataFrame, bases: DataFrame, blocks: Blocks, name: str,
    keep: Column | None = None,
    extra_a: dict[str, Callable[[str], Column]] | None = None,
    extra_b: dict[str, Callable[[str], Column]] | None = None,
) -> DataFrame:
    """Block pairs (a, b, gap2) whose boxes come within the radius of block a.

    ``queries``: a, alo, ahi, radius (+ extras). ``bases``: b, blo, bhi (+ extras).
    ``keep`` may drop more pairs by the extra columns; it is applied at every level.
    """
    rules = {"radius": F.max, **(extra_a or {})}
    above = _tree(queries, "a", "alo", "ahi", blocks.levels, blocks.dims, rules)
    below = _tree(bases, "b", "blo", "bhi", blocks.levels, blocks.dims, extra_b or {})
    limit = F.col("radius") * F.col("radius")
    wanted = F.col("gap2") <= limit * (1 + SLACK) + SLACK
    if keep is not None:
        wanted = wanted & keep
    pairs = None
    for level in range(blocks.levels, -1, -1):
        a, b = above[level], below[level]
        if pairs is None:  # both trees end in one root box
            met = a.withColumn("_root", F.lit(1)).join(b.withColumn("_root", F.lit(1)), "_root")
        else:
            met = (
                pairs.select(F.col("a").alias("_pa"), F.col("b").alias("_pb"))
                .join(a.withColumn("_pa", F.shiftright("a", FAN_BITS)), "_pa")
                .join(b.withColumn("_pb", F.shiftright("b", FAN_BITS)), "_pb")
            )
        gap2 = _gap2(("alo", "ahi"), ("blo", "bhi"))
        pairs = met.withColumn("gap2", gap2).filter(wanted).select("a", "b", "gap2")
    return store(pairs, name)


def meet(
    pairs: DataFrame, queries: DataFrame, bases: DataFrame,
    run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, name: str,
) -> DataFrame:
    """Run ``run`` over streams of blocks: a query block, then its partners by distance.

    ``queries`` has (a, item), ``bases`` has (b, item) with the same struct type.
    A block with very many partners is dealt to several streams.
    """
    partners = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    streams = F.least(F.lit(MAX_STREAMS), F.ceil(F.col("n") / PARTNERS_PER_TASK)).cast("int")
    partners = partners.select("a", streams.alias("streams"))
    heads = (
        partners.select("a", F.explode(F.sequence(F.lit(0), F.col("streams") - 1)).alias("stream"))
        .join(queries, "a")
        .select("a", "stream", F.lit(-1.0).alias("gap2"), F.lit(-1).cast("long").alias("b"), "item")
    )
    bodies = (
        pairs.join(partners, "a")
        .withColumn("stream", F.pmod(F.hash("b"), F.col("streams")))
        .join(bases, "b")
        .select("a", "stream", "gap2", "b", "item")
    )
    streamed = (
        heads.unionByName(bodies).repartition("a", "stream")
        .sortWithinPartitions("a", "stream", "gap2", "b").select("a", "gap2", "b", "item.*")
    )
    with small_batches(pairs.sparkSession, WIDE_ROWS):
        return store(streamed.mapInPandas(run, schema), name)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two blocks by plain differences, without cancellation."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        step = a[:, i, None] - b[None, :, i]
        out += step * step
    return out


def _points(row, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pid = np.asarray(row.pid, dtype=np.int64)
    return pid, np.asarray(row.x, dtype=np.float64).reshape(-1, dims), np.asarray(row.w, np.int64)


class _Nearest:
    """The k nearest base points of each point in one query block."""

    def __init__(self, pid: np.ndarray, x: np.ndarray, k: int, include_self: bool):
        self.pid, self.x, self.k, self.include_self = pid, x, k, include_self
        self.d2 = np.full((len(pid), k), np.inf)
        self.ids = np.full((len(pid), k), -1, np.int64)
        self.w = np.zeros((len(pid), k), np.int64)

    def reach2(self) -> np.ndarray:
        """Squared distance within which k base rows are known, per point."""
        enough = np.cumsum(self.w, axis=1) >= self.k
        first = enough.argmax(axis=1)
        found = self.d2[np.arange(len(self.pid)), first]
        return np.where(enough.any(axis=1), found, np.inf)

    def offer(self, pid: np.ndarray, x: np.ndarray, w: np.ndarray) -> None:
        """Take in base points. A fast estimate with a safe margin finds the few
        candidates; only their exact distances are compared."""
        norm_a, norm_b = (self.x ** 2).sum(axis=1), (x ** 2).sum(axis=1)
        estimate = norm_a[:, None] + norm_b[None, :] - 2.0 * (self.x @ x.T)
        margin = ESTIMATE_MARGIN * (1.0 + norm_a.max() + norm_b.max())
        limit = self.d2[:, -1] * (1 + SLACK) + margin
        i, j = np.nonzero(estimate <= limit[:, None])
        weight = w[j]
        if not self.include_self:
            weight = np.where(self.pid[i] == pid[j], weight - 1, weight)
            i, j, weight = i[weight > 0], j[weight > 0], weight[weight > 0]
        if not len(i):
            return
        exact = ((self.x[i] - x[j]) ** 2).sum(axis=1)
        rows, counts = np.unique(i, return_counts=True)
        width = int(counts.max())
        at = np.searchsorted(rows, i)
        column = np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)
        d2 = np.full((len(rows), width), np.inf)
        ids = np.full((len(rows), width), -1, np.int64)
        more = np.zeros((len(rows), width), np.int64)
        d2[at, column], ids[at, column], more[at, column] = exact, pid[j], weight
        d2 = np.concatenate([self.d2[rows], d2], axis=1)
        ids = np.concatenate([self.ids[rows], ids], axis=1)
        more = np.concatenate([self.w[rows], more], axis=1)
        order = np.lexsort((ids, d2), axis=1)[:, :self.k]
        self.d2[rows] = np.take_along_axis(d2, order, axis=1)
        self.ids[rows] = np.take_along_axis(ids, order, axis=1)
        self.w[rows] = np.take_along_axis(more, order, axis=1)

    def frame(self) -> pd.DataFrame:
        found = np.isfinite(self.d2)
        return pd.DataFrame({
            "pid": self.pid,
            "d": [np.sqrt(v[f]) for v, f in zip(self.d2, found)],
            "id": [v[f] for v, f in zip(self.ids, found)],
            "w": [v[f] for v, f in zip(self.w, found)],
        })


def _own_reach(k: int, axes: np.ndarray, include_self: bool):
    """Query points of a block, grouped by an upper bound of their k-th distance.

    The bound comes from the block's own points. A few far-off points then do not
    widen the search of all the others.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                pid, x, w = _points(row, len(axes))
                asks = np.asarray(row.is_query, bool)
                if not asks.any():
                    continue
                best = _Nearest(pid[asks], x[asks], k, include_self)
                base = np.asarray(row.is_base, bool)
                if base.any():
                    best.offer(pid[base], x[base], w[base])
                reach = np.sqrt(best.reach2())
                order, cut = np.argsort(reach), math.ceil(len(reach) * NEAR_SHARE)
                for g, part in enumerate((order[:cut], order[cut:])):
                    if not len(part):
                        continue
                    box = best.x[part] @ axes
                    item = {"pid": best.pid[part], "x": best.x[part].ravel(),
                            "w": w[asks][part], "is_base": np.zeros(len(part), np.int32)}
                    out.append((row.block * REACH_GROUPS + g, box.min(axis=0), box.max(axis=0),
                                float(reach[part].max()), item))
            yield pd.DataFrame(out, columns=["a", "alo", "ahi", "radius", "item"])

    return run


def _search(k: int, dims: int, include_self: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            for row in batch.itertuples():
                pid, x, w = _points(row, dims)
                if row.gap2 < 0:
                    if best is not None:
                        yield best.frame()
                    best = _Nearest(pid, x, k, include_self)
                    reach = np.inf
                elif row.gap2 <= reach:
                    base = np.asarray(row.is_base, bool)
                    best.offer(pid[base], x[base], w[base])
                    reach = best.reach2().max() * (1 + SLACK)
        if best is not None:
            yield best.frame()

    return run


def _item() -> Column:
    return F.struct("pid", "x", "w", "is_base").alias("item")


def knn(
    points: DataFrame, features: list[str], k: int, include_self: bool = True
) -> DataFrame:
    """The k nearest base rows of every query point.

    ``points``: pid, w (copies of the point), features, and 0/1 ``is_query`` /
    ``is_base`` (absent: every point is both). Result: pid and ``nbrs``, an array
    of (d, id, w) by distance then id, holding at least k rows counting copies.
    """
    blocks = pack(points, features)
    with small_batches(points.sparkSession, WIDE_ROWS):
        reach = store(
            blocks.rows.select("block", "pid", "x", "w", "is_query", "is_base").mapInPandas(
                _own_reach(k, blocks.axes, include_self),
                "a long, alo array<double>, ahi array<double>, radius double, item struct<"
                "pid: array<bigint>, x: array<double>, w: array<bigint>, is_base: array<int>>",
            ), "reach",
        )
    copies = F.aggregate(F.zip_with("w", "is_base", lambda w, base: w * base), F.lit(0).cast("long"), lambda n, w: n + w)
    bases = blocks.rows.filter(F.array_max("is_base") == 1).select(
        F.col("block").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), copies.alias("n")
    )
    pairs = nearest_pairs(reach.drop("item"), bases, blocks, "near", k if include_self else k + 1)
    found = meet(
        pairs,
        reach.select("a", "item"),
        blocks.rows.select(F.col("block").alias("b"), _item()),
        _search(k, blocks.dims, include_self),
        "pid long, d array<double>, id array<bigint>, w array<bigint>", "nearest",
    )
    # a point has at most MAX_STREAMS streams, and each holds at most k candidates
    zipped = F.arrays_zip("d", "id", "w")
    return found.groupBy("pid").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list(zipped))), 1, k).alias("nbrs")
    )


def kth_distance(nbrs: Column, k: int) -> Column:
    """Distance of the k-th neighbour when every neighbour counts ``w`` times."""
    state = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("d"))

    def step(acc: Column, n: Column) -> Column:
        seen = acc["seen"] + n["w"]
        return F.struct(
            seen.alias("seen"),
            F.when(acc["d"].isNull() & (seen >= k), n["d"]).otherwise(acc["d"]).alias("d"),
        )

    return F.aggregate(nbrs, state, step, lambda acc: acc["d"])


def first_k(nbrs: Column, k: int) -> Column:
    """Neighbours as (d, id, m) where the multiplicities m add up to k."""
    state = F.struct(
        F.lit(0).cast("long").alias("seen"),
        F.array().cast("array<struct<d:double,id:bigint,m:bigint>>").alias("out"),
    )

    def step(acc: Column, n: Column) -> Column:
        take = F.least(n["w"], F.lit(k) - acc["seen"])
        entry = F.struct(n["d"].alias("d"), n["id"].alias("id"), take.alias("m"))
        return F.struct(
            (acc["seen"] + F.greatest(take, F.lit(0))).alias("seen"),
            F.when(take > 0, F.concat(acc["out"], F.array(entry))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(nbrs, state, step, lambda acc: acc["out"])
