"""Exact DBSCAN over blocks of nearby points.

Work that grows with the square of a dense region is avoided in three places:
points that already have enough neighbours inside their own block are core and
ask no further; boxes whose core points already belong to one component are not
compared again; and a task reports links between components, not between points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.components import components, stars
from reviewlens.operators.neighbors import (
    WIDE_ROWS, Blocks, collapse, meet, near_pairs, pack, squared_distances,
)
from reviewlens.session import small_batches, store

MIN_SAMPLES = 10
EPS_CANDIDATES = [0.3, 0.4, 0.5, 0.6, 0.7]
NOISE_RANGE = (0.01, 0.05)
NOISE_TARGET = 0.03
FALLBACK_EPS = 0.5
NOISE = -1

_COUNTED = ("block long, pid array<bigint>, x array<double>, w array<bigint>, near array<bigint>, "
            "n_open int, olo array<double>, ohi array<double>")
_SPLIT = ("block long, core_pid array<bigint>, core_x array<double>, core_comp array<bigint>, "
          "clo array<double>, chi array<double>, rest_pid array<bigint>, rest_x array<double>, "
          "rlo array<double>, rhi array<double>")


def _box(x: np.ndarray):
    return (x.min(axis=0), x.max(axis=0)) if len(x) else (None, None)


def _count_inside(eps: float, min_samples: int, axes: np.ndarray):
    """Neighbours within a point's own block, itself included."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                x = np.asarray(row.x).reshape(-1, len(axes))
                near = (squared_distances(x, x) <= eps * eps) @ np.asarray(row.w, np.int64)
                still_open = near < min_samples
                lo, hi = _box(x[still_open] @ axes)
                out.append((row.block, row.pid, row.x, row.w, near, int(still_open.sum()), lo, hi))
            yield pd.DataFrame(out, columns=["block", "pid", "x", "w", "near", "n_open", "olo", "ohi"])

    return run


def _count_outside(eps: float, min_samples: int, dims: int):
    """Neighbours of open points in partner blocks, until all have enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = x = seen = start = None
        for batch in batches:
            for row in batch.itertuples():
                here = np.asarray(row.x).reshape(-1, dims)
                if row.gap2 < 0:
                    if pid is not None:
                        yield pd.DataFrame({"a": block, "pid": pid, "more": seen})
                    near = np.asarray(row.near, np.int64)
                    is_open = near < min_samples
                    block, pid, x = row.a, np.asarray(row.pid)[is_open], here[is_open]
                    start, seen = near[is_open], np.zeros(int(is_open.sum()), np.int64)
                elif (start + seen < min_samples).any():
                    seen += (squared_distances(x, here) <= eps * eps) @ np.asarray(row.w, np.int64)
        if pid is not None:
            yield pd.DataFrame({"a": block, "pid": pid, "more": seen})

    return run


def _local_components(pid: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Smallest pid reachable inside one block."""
    order = np.argsort(pid)
    comp, left = np.full(len(pid), -1, np.int64), np.ones(len(pid), bool)
    for start in order:
        if not left[start]:
            continue
        front = np.zeros(len(pid), bool)
        front[start] = True
        while front.any():
            comp[front] = pid[start]
            left &= ~front
            front = linked[front].any(axis=0) & left
    return comp


def _split_blocks(eps: float, min_samples: int, axes: np.ndarray):
    """Core points with their component inside the block, and all other points."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                pid, x = np.asarray(row.pid, np.int64), np.asarray(row.x).reshape(-1, len(axes))
                near = np.array(row.near, np.int64)
                if row.more is not None and len(row.more):
                    more = {m["pid"]: m["more"] for m in row.more}
                    near += np.array([more.get(p, 0) for p in pid], np.int64)
                core = near >= min_samples
                cx, rx = x[core], x[~core]
                comp = _local_components(pid[core], squared_distances(cx, cx) <= eps * eps)
                out.append((row.block, pid[core], cx.ravel(), comp, *_box(cx @ axes),
                            pid[~core], rx.ravel(), *_box(rx @ axes)))
            yield pd.DataFrame(out, columns=[
                "block", "core_pid", "core_x", "core_comp", "clo", "chi",
                "rest_pid", "rest_x", "rlo", "rhi"])

    return run


def _link(eps: float, dims: int):
    """Components that touch, as a forest over everything this task has seen."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def find(c: int) -> int:
            while parent.setdefault(c, c) != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        x = comp = None
        for batch in batches:
            for row in batch.itertuples():
                here = np.asarray(row.x).reshape(-1, dims)
                there = np.asarray(row.comp, np.int64)
                if row.gap2 < 0:
                    x, comp = here, there
                    continue
                roots = np.array([find(c) for c in comp.tolist()])
                others = np.array([find(c) for c in there.tolist()])
                if (roots == roots[0]).all() and (others == roots[0]).all():
                    continue
                i, j = np.nonzero(squared_distances(x, here) <= eps * eps)
                for u, v in np.unique(np.stack([roots[i], others[j]], axis=1), axis=0).tolist():
                    u, v = find(u), find(v)
                    if u != v:
                        parent[max(u, v)] = min(u, v)
        links = [(c, find(c)) for c in list(parent)]
        yield pd.DataFrame([e for e in links if e[0] != e[1]], columns=["u", "v"], dtype="int64")

    return run


def _border(eps: float, dims: int):
    """Components with a core point within reach of a point that is not core."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = x = None
        for batch in batches:
            for row in batch.itertuples():
                here = np.asarray(row.x).reshape(-1, dims)
                if row.gap2 < 0:
                    pid, x = np.asarray(row.comp, np.int64), here
                    continue
                i, j = np.nonzero(squared_distances(x, here) <= eps * eps)
                pairs = np.unique(
                    np.stack([pid[i], np.asarray(row.comp, np.int64)[j]], axis=1), axis=0
                )
                yield pd.DataFrame(pairs, columns=["pid", "comp"])

    return run


def _leaf(rows: DataFrame, side: str, lo: str, hi: str, *extra: Column) -> DataFrame:
    return rows.select(
        F.col("block").alias(side), F.col(lo).alias(f"{side}lo"), F.col(hi).alias(f"{side}hi"), *extra
    )


def _split(blocks: Blocks, eps: float, min_samples: int) -> DataFrame:
    """Blocks parted into core and other points, by exact neighbour counts."""
    spark, dims = blocks.rows.sparkSession, blocks.dims
    radius = F.lit(float(eps)).alias("radius")
    with small_batches(spark, WIDE_ROWS):
        counted = store(
            blocks.rows.select("block", "pid", "x", "w")
            .mapInPandas(_count_inside(eps, min_samples, blocks.axes), _COUNTED), "counted",
        )
    pairs = near_pairs(
        _leaf(counted.filter("n_open > 0"), "a", "olo", "ohi", radius),
        _leaf(blocks.rows, "b", "lo", "hi"), blocks, "open_pairs",
    ).filter("a <> b")
    item = F.struct("pid", "x", "w", "near").alias("item")
    more = meet(
        pairs, counted.select(F.col("block").alias("a"), item),
        counted.select(F.col("block").alias("b"), item),
        _count_outside(eps, min_samples, dims), "a long, pid long, more long", "more",
    )
    per_block = (
        more.groupBy("a", "pid").agg(F.sum("more").alias("more"))
        .groupBy(F.col("a").alias("block")).agg(F.collect_list(F.struct("pid", "more")).alias("more"))
    )
    with small_batches(spark, WIDE_ROWS):
        return store(
            counted.select("block", "pid", "x", "near").join(per_block, "block", "left")
            .mapInPandas(_split_blocks(eps, min_samples, blocks.axes), _SPLIT), "split",
        )


def _connect(blocks: Blocks, split: DataFrame, eps: float) -> DataFrame:
    """(node, root) over all block-local components."""
    dims = blocks.dims
    core = split.filter(F.size("core_pid") > 0)
    nodes = core.select(F.explode(F.array_distinct("core_comp")).alias("node"))
    item = F.struct(F.col("core_x").alias("x"), F.col("core_comp").alias("comp")).alias("item")
    queries = core.select(F.col("block").alias("a"), item)
    bases = core.select(F.col("block").alias("b"), item)
    radius = F.lit(float(eps)).alias("radius")

    # neighbours along the curve first: they join up most of a dense region
    follow = core.select(
        F.col("block").alias("a"), (F.col("block") + 1).alias("b"), F.lit(0.0).alias("gap2")
    )
    near = meet(store(follow, "follow"), queries, bases, _link(eps, dims), "u long, v long", "links")
    first = store(components(nodes, near), "roots")

    # then all boxes in reach, but for those already known to be one component
    roots = (
        core.select("block", F.explode(F.array_distinct("core_comp")).alias("node"))
        .join(first, "node").groupBy("block")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
    )
    tagged = store(core.select("block", "clo", "chi").join(roots, "block"), "tagged")
    apart = (F.col("alow") != F.col("blow")) | (F.col("ahigh") != F.col("bhigh")) | (
        F.col("alow") != F.col("ahigh")
    )
    pairs = near_pairs(
        _leaf(tagged, "a", "clo", "chi", radius, F.col("low").alias("alow"), F.col("high").alias("ahigh")),
        _leaf(tagged, "b", "clo", "chi", F.col("low").alias("blow"), F.col("high").alias("bhigh")),
        blocks, "core_pairs", apart & (F.col("a") <= F.col("b")),
        {"alow": F.min, "ahigh": F.max}, {"blow": F.min, "bhigh": F.max},
    ).filter("a < b")
    links = meet(pairs, queries, bases, _link(eps, dims), "u long, v long", "links")
    return components(nodes, near.union(links))


def dbscan_points(blocks: Blocks, eps: float, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """(pid, label): the smallest core pid of the cluster, or -1.

    A border point takes the smallest label among the clusters that reach it.
    """
    split = _split(blocks, eps, min_samples)
    roots = store(_connect(blocks, split, eps), "roots")
    core = (
        split.select(F.explode(F.arrays_zip("core_pid", "core_comp")).alias("e"))
        .select(F.col("e.core_pid").alias("pid"), F.col("e.core_comp").alias("node"))
        .join(roots, "node").select("pid", F.col("root").alias("label"))
    )
    rest = split.filter(F.size("rest_pid") > 0)
    pairs = near_pairs(
        _leaf(rest, "a", "rlo", "rhi", F.lit(float(eps)).alias("radius")),
        _leaf(split.filter(F.size("core_pid") > 0), "b", "clo", "chi"), blocks, "border_pairs",
    )
    reached = meet(
        pairs,
        rest.select(F.col("block").alias("a"),
                    F.struct(F.col("rest_x").alias("x"), F.col("rest_pid").alias("comp")).alias("item")),
        split.select(F.col("block").alias("b"),
                     F.struct(F.col("core_x").alias("x"), F.col("core_comp").alias("comp")).alias("item")),
        _border(eps, blocks.dims), "pid long, comp long", "border",
    )
    border = (
        reached.join(roots, reached["comp"] == roots["node"]).groupBy("pid")
        .agg(F.min("root").alias("label"))
    )
    others = (
        rest.select(F.explode("rest_pid").alias("pid")).join(border, "pid", "left")
        .select("pid", F.coalesce("label", F.lit(NOISE)).cast("long").alias("label"))
    )
    return core.unionByName(others)


def _stored(points: DataFrame, key: str, features: list[str]) -> tuple[DataFrame, DataFrame]:
    rows = store(points.select(F.col(key).cast("long").alias(key), *features), "scaled")
    return rows, store(collapse(rows, key, features), "distinct")


def _expand(rows: DataFrame, distinct: DataFrame, labels: DataFrame, key: str, features: list[str],
            out: str) -> DataFrame:
    """Give every row the label of its point."""
    labelled = distinct.select("pid", *features).join(labels, "pid").select(
        *features, F.col("label").alias(out)
    )
    return rows.join(labelled, features).select(key, out)


def dbscan(
    points: DataFrame, key: str, features: list[str], eps: float, min_samples: int = MIN_SAMPLES
) -> DataFrame:
    """(key, dbscan_cluster) for every row."""
    rows, distinct = _stored(points, key, features)
    labels = dbscan_points(pack(distinct, features), eps, min_samples)
    return _expand(rows, distinct, labels, key, features, "dbscan_cluster")


# ---- all radii from one neighbour search ---------------------------------------------------
#
# A radius is a level: the place of the smallest candidate radius that reaches. A
# point has the level from which on it is core; two core points are linked from
# the level on at which both are core and within the radius. Every pair of blocks
# reports a spanning forest of its own links, of lowest levels, which joins up at
# every level what all its links would. Cutting all forests at a level gives the
# clusters of that radius.

def _count_levels(radii: list[float], dims: int):
    """Neighbours of every point of a block within each radius, by place in the block."""
    limits = [r * r for r in radii]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = x = near = None

        def made() -> pd.DataFrame:
            return pd.DataFrame({"a": block, "at": np.arange(len(x)), "near": near.tolist()})

        for batch in batches:
            for row in batch.itertuples():
                here = np.asarray(row.x).reshape(-1, dims)
                if row.gap2 < 0:
                    if x is not None:
                        yield made()
                    block, x, near = row.a, here, np.zeros((len(here), len(limits)), np.int64)
                    continue
                d2, w = squared_distances(x, here), np.asarray(row.w, np.int64)
                for level, limit in enumerate(limits):
                    near[:, level] += (d2 <= limit) @ w
        if x is not None:
            yield made()

    return run


def spanning_edges(i: np.ndarray, j: np.ndarray, level: np.ndarray, n: int) -> np.ndarray:
    """Places of the edges of a spanning forest of lowest levels (Boruvka)."""
    order = np.argsort(level, kind="stable")
    i, j = i[order], j[order]
    comp, live, chosen = np.arange(n), np.arange(len(i)), []
    while True:
        live = live[comp[i[live]] != comp[j[live]]]
        if not len(live):
            return order[np.concatenate(chosen)] if chosen else order[:0]
        best = np.full(n, len(i))
        np.minimum.at(best, comp[i[live]], live)
        np.minimum.at(best, comp[j[live]], live)
        picked = np.unique(best[best < len(i)])
        chosen.append(picked)
        parent = np.arange(n)
        for u, v in zip(comp[i[picked]].tolist(), comp[j[picked]].tolist(), strict=True):
            while parent[u] != u:
                u = parent[u]
            while parent[v] != v:
                v = parent[v]
            parent[max(u, v)] = min(u, v)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        comp = parent[comp]


def _forests(radii: list[float], dims: int):
    """(u, v, level): forest edges between two blocks; and for u = v the level
    from which on a point is core or within the radius of a core point."""
    limits, never = np.array([r * r for r in radii]), len(radii)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = pid = x = own = reached = None

        def points() -> pd.DataFrame:
            return pd.DataFrame({"u": pid, "v": pid, "level": reached})

        for batch in batches:
            for row in batch.itertuples():
                here, there = np.asarray(row.x).reshape(-1, dims), np.asarray(row.pid, np.int64)
                level = np.asarray(row.level, np.int64)
                if row.gap2 < 0:
                    if pid is not None:
                        yield points()
                    block, pid, x, own, reached = row.a, there, here, level, level.copy()
                    continue
                d2 = squared_distances(x, here)
                apart = np.maximum(np.searchsorted(limits, d2.ravel()).reshape(d2.shape), level[None, :])
                reached = np.minimum(reached, apart.min(axis=1))
                if row.b < block:
                    continue  # the other way round
                apart = np.maximum(apart, own[:, None])
                i, j = np.nonzero(apart < never)
                same = row.b == block
                picked = spanning_edges(i, j if same else j + len(pid), apart[i, j], len(pid) + (0 if same else len(there)))
                yield pd.DataFrame({"u": pid[i[picked]], "v": there[j[picked]], "level": apart[i[picked], j[picked]]})
        if pid is not None:
            yield points()

    return run


def reach_levels(blocks: Blocks, radii: list[float], min_samples: int) -> tuple[DataFrame, DataFrame]:
    """(pid, w, core, reached: the levels from which on a point is core, and in a
    cluster) and (u, v, level: forest edges), for rising ``radii``; both stored.

    Block pairs are searched once, for the largest radius. A level of
    ``len(radii)`` means never.
    """
    never, widest = len(radii), F.lit(float(radii[-1])).alias("radius")
    pairs = near_pairs(
        _leaf(blocks.rows, "a", "lo", "hi", widest), _leaf(blocks.rows, "b", "lo", "hi"), blocks, "reach_pairs"
    )
    item = F.struct("pid", "x", "w").alias("item")
    counted = meet(
        pairs, blocks.rows.select(F.col("block").alias("a"), item), blocks.rows.select(F.col("block").alias("b"), item),
        _count_levels(radii, blocks.dims), "a long, at int, near array<bigint>", "near",
    )
    summed = counted.groupBy("a", "at").agg(*[F.sum(F.col("near")[i]).alias(f"n{i}") for i in range(never)])
    level = F.coalesce(*[F.when(F.col(f"n{i}") >= min_samples, F.lit(i)) for i in range(never)], F.lit(never))
    per_block = summed.select("a", F.struct("at", level.alias("level")).alias("e")).groupBy(F.col("a").alias("block")).agg(
        F.sort_array(F.collect_list("e")).alias("e")  # one entry per point of a block
    )
    levelled = store(
        blocks.rows.select("block", "pid", "x", "w").join(per_block.select("block", F.col("e.level").alias("level")), "block"),
        "levelled",
    )
    item = F.struct("pid", "x", "level").alias("item")
    found = meet(
        pairs, levelled.select(F.col("block").alias("a"), item), levelled.select(F.col("block").alias("b"), item),
        _forests(radii, blocks.dims), "u long, v long, level int", "forests",
    )
    reached = found.filter("u = v").groupBy(F.col("u").alias("pid")).agg(F.min("level").alias("reached"))
    points = levelled.select(F.explode(F.arrays_zip("pid", "w", "level")).alias("p")).select(
        "p.pid", "p.w", F.col("p.level").alias("core")
    )
    return store(points.join(reached, "pid"), "reach"), found.filter("u <> v")


def dbscan_eps_sweep(
    points: DataFrame, key: str, features: list[str],
    candidates: list[float] = tuple(EPS_CANDIDATES), min_samples: int = MIN_SAMPLES,
) -> DataFrame:
    """Clusters and noise per radius, and the chosen radius.

    Noise counts rows, not points. All radii come from one neighbour search; a
    cluster is a core point that no forest edge of its radius joins to a smaller.
    """
    _, distinct = _stored(points, key, features)
    radii = sorted(set(candidates))
    reach, forest = reach_levels(pack(distinct, features), radii, min_samples)
    counts = reach.agg(*[
        F.struct(
            F.count_if(F.col("core") <= i).alias("cores"),
            F.coalesce(F.sum(F.when(F.col("reached") > i, F.col("w"))), F.lit(0)).alias("noise"),
            F.coalesce(F.sum("w"), F.lit(0)).alias("rows"),
        ).alias(f"l{i}") for i in range(len(radii))
    ]).first()
    joined, rows = None, []
    for i, eps in enumerate(radii):
        new = forest.filter(F.col("level") == i).select("u", "v")
        joined = stars(new if joined is None else new.unionByName(joined.select(F.col("hi").alias("u"), F.col("lo").alias("v"))))
        at = counts[f"l{i}"]
        share = at["noise"] / at["rows"] if at["rows"] else None
        rows.append((float(eps), at["cores"] - joined.count(), at["noise"], share))
    sweep = points.sparkSession.createDataFrame(rows, "eps double, n_clusters long, n_noise long, noise_frac double")
    chosen = choose_eps(sweep).scalar()
    return sweep.withColumn("_best", chosen).withColumn(
        "chosen", (F.col("eps") == F.col("_best")).cast("int")
    ).drop("_best")


def choose_eps(sweep: DataFrame) -> DataFrame:
    """The radius whose noise is nearest 3 %, preferably inside 1-5 % (one row)."""
    within = F.col("noise_frac").between(*NOISE_RANGE)
    gap = F.abs(F.col("noise_frac") - NOISE_TARGET)
    best = sweep.agg(F.min(F.struct(
        (~within).cast("int").alias("outside"), F.round(gap, 12).alias("gap"), "eps", "noise_frac"
    )).alias("b"))
    usable = (F.col("b.outside") == 0) | (F.col("b.noise_frac") > 0)
    return best.select(F.when(usable, F.col("b.eps")).otherwise(F.lit(FALLBACK_EPS)).alias("eps"))


def noise_contrast(labelled: DataFrame, features: list[str]) -> DataFrame:
    """Feature means of noise against clustered rows."""
    group = F.when(F.col("dbscan_cluster") == NOISE, "noise").otherwise("clustered")
    return labelled.groupBy(group.alias("group")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"mean_{f}") for f in features]
    )
