"""Neighbour search, DBSCAN and outlier factors against brute force."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from reviewlens.operators import anomaly as A
from reviewlens.operators import dbscan as D
from reviewlens.operators import neighbors as N
from reviewlens.operators.components import components
from reviewlens.operators.validation import nearest_known
from reviewlens.session import store


def cloud(n, d, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)) * np.linspace(0.3, 1.2, d), 2)
    x[:copies] = x[0]
    return x


def frame(spark, x, ids, key="user_id"):
    names = [f"f{i}" for i in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=names)
    pdf[key] = ids
    return spark.createDataFrame(pdf), names


@pytest.mark.parametrize("n,d,copies,k", [(1500, 6, 400, 7), (40, 3, 0, 5), (700, 12, 0, 3)])
def test_knn(spark, n, d, copies, k):
    x = cloud(n, d, 1, copies)
    df, names = frame(spark, x, np.arange(n))
    points = store(N.collapse(df, "user_id", names), "points")
    near = N.knn(points, names, k).withColumn("kd", N.kth_distance(F.col("nbrs"), k))
    got = near.withColumn("n", F.aggregate(
        N.first_k(F.col("nbrs"), k), F.lit(0).cast("long"), lambda t, e: t + e["m"])).toPandas()
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = np.sort(dist, axis=1)[:, k - 1]
    assert len(got) == len(np.unique(x, axis=0))
    assert np.allclose(got["kd"], want[got["pid"]], atol=1e-12)
    assert (got["n"] == k).all()


def brute_dbscan(ids, x, eps, min_samples):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_samples
    comp = {}
    for start in np.argsort(ids):
        if core[start] and start not in comp:
            comp[start], todo = ids[start], [start]
            while todo:
                at = todo.pop()
                for v in np.nonzero(near[at] & core)[0]:
                    if v not in comp:
                        comp[v] = ids[start]
                        todo.append(v)
    labels = []
    for i in range(len(x)):
        reach = [comp[v] for v in np.nonzero(near[i] & core)[0]]
        labels.append(comp[i] if core[i] else min(reach, default=-1))
    return np.array(labels)


@pytest.mark.parametrize("n,d,eps,min_samples", [(1800, 3, 0.253, 6), (900, 10, 1.601, 8), (900, 2, 0.0501, 4)])
def test_dbscan(spark, n, d, eps, min_samples):
    x = cloud(n, d, 2, 150)
    ids = np.random.default_rng(3).permutation(n) + 5
    df, names = frame(spark, x, ids)
    got = D.dbscan(df, "user_id", names, eps, min_samples).toPandas().set_index("user_id")
    want = brute_dbscan(ids, x, eps, min_samples)
    assert len(got) == n
    assert (got.loc[ids, "dbscan_cluster"].to_numpy() == want).all()
    assert len(set(want)) > 1


def test_dbscan_two_blobs_and_an_outlier(spark):
    x = np.array([[0, 0]] * 3 + [[0, 0.5]] * 3 + [[9, 9], [9, 9.1], [9.1, 9], [9, 8.9]] + [[50, 50]], float)
    df, names = frame(spark, x, np.arange(len(x)))
    got = D.dbscan(df, "user_id", names, 0.5, 4).toPandas().set_index("user_id")["dbscan_cluster"]
    assert got.loc[range(6)].nunique() == 1 and got[10] == -1
    assert got.loc[range(6, 10)].nunique() == 1 and got[0] != got[6]


def test_choose_eps(spark):
    def chosen(rows):
        return D.choose_eps(spark.createDataFrame(rows, "eps double, noise_frac double")).first()[0]

    assert chosen([(0.3, 0.2), (0.5, 0.04), (0.6, 0.02), (0.7, 0.005)]) == 0.5
    assert chosen([(0.3, 0.2), (0.5, 0.06)]) == 0.5
    assert chosen([(0.3, 0.0), (0.7, 0.0)]) == 0.5


def test_components_of_a_long_chain(spark):
    nodes = spark.range(60).select(F.col("id").alias("node"))
    edges = spark.range(49).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = {r.node: r.root for r in components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(50)) and all(got[i] == i for i in range(50, 60))


def test_local_outlier_factor(spark):
    x = cloud(900, 4, 5, 60)
    fit, new, k = x[:600], x[600:], 9
    df, names = frame(spark, fit, np.arange(600), "key")
    rows, _ = frame(spark, new, np.arange(300), "key")
    got = A.local_outlier_factor(df, rows, "key", names, k).toPandas().set_index("key")["lof_score"]

    def nearest(a, drop_self):
        dist = np.sqrt(((a[:, None] - fit[None]) ** 2).sum(-1))
        if drop_self:
            np.fill_diagonal(dist, np.inf)
        # ties go to the point whose smallest row number is smaller
        first = {tuple(v): i for i, v in reversed(list(enumerate(fit)))}
        rank = np.array([first[tuple(v)] for v in fit])
        order = np.lexsort((np.broadcast_to(rank, dist.shape), np.round(dist ** 2, 9)), axis=1)[:, :k]
        return order, np.take_along_axis(dist, order, axis=1)

    order, dist = nearest(fit, True)
    kdist = dist[:, -1]
    density = 1 / (np.maximum(dist, kdist[order]).mean(1) + 1e-10)
    order, dist = nearest(new, False)
    mine = 1 / (np.maximum(dist, kdist[order]).mean(1) + 1e-10)
    want = density[order].mean(1) / mine
    close = np.isclose(got.loc[range(300)].to_numpy(), want, rtol=1e-6)
    assert close.mean() > 0.97  # equal distances may pick another of several tied neighbours


def test_factor_of_a_grid_is_near_one(spark):
    grid = np.array([[i, j] for i in range(20) for j in range(20)], float)
    df, names = frame(spark, grid, np.arange(400), "key")
    rows, _ = frame(spark, np.array([[9.5, 9.5], [60.0, 60.0]]), [0, 1], "key")
    got = A.local_outlier_factor(df, rows, "key", names, 8, rate=0.05).orderBy("key").collect()
    assert got[0].lof_score == pytest.approx(1.0, abs=0.15) and got[0].lof_pred == 0
    assert got[1].lof_score > 5 and got[1].lof_pred == 1


def test_nearest_known(spark):
    x = cloud(500, 3, 7)
    known, names = frame(spark, x[:400], np.arange(400))
    new, _ = frame(spark, x[400:], np.arange(400, 500))
    got = nearest_known(known, new, names).toPandas().set_index("user_id")
    mean, std = x[:400].mean(0), x[:400].std(0)
    a, b = (x[400:] - mean) / std, (x[:400] - mean) / std
    dist = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    assert np.allclose(got.loc[range(400, 500), "distance"], dist.min(1))


def test_isolation_forest_ranks_the_far_point_first(spark):
    x = np.vstack([cloud(2000, 4, 9), [[9.0, 9.0, 9.0, 9.0]]])
    df, names = frame(spark, x, [f"r{i}" for i in range(len(x))], "review_id")
    forest = A.isolation_forest(df.filter("review_id <> 'r2000'"), names, trees=50, sample=64)
    per_tree = forest.groupBy("tree").count().toPandas()["count"]
    assert len(per_tree) == 50 and per_tree.max() <= 127
    scored = A.with_forest_scores(forest, df, df, names, 0.1)
    rows = scored.orderBy(F.desc("isolation_forest_score")).collect()
    assert rows[0].review_id == "r2000" and 0 < rows[-1].isolation_forest_score <= 1
    assert sum(r.isolation_forest_pred for r in rows) == pytest.approx(200, abs=3)


@pytest.mark.parametrize("gap, k", [(500.0, 5), (500.0, 300)])
def test_points_apart_do_not_meet_all_blocks(spark, monkeypatch, gap, k):
    """Queries far from every base point meet the base blocks on their side only."""
    rng = np.random.default_rng(6)
    base, new = rng.uniform(0, 100, (6_000, 2)), rng.uniform(0, 20, (600, 2)) - [gap, 0]
    df, names = frame(spark, np.vstack([base, new]), np.arange(6_600), "pid")
    table = df.withColumns({
        "w": F.lit(1).cast("long"), "is_query": (F.col("pid") >= 6_000).cast("int"), "is_base": (F.col("pid") < 6_000).cast("int"),
    })
    pairs = []
    whole = N.nearest_pairs
    monkeypatch.setattr(N, "nearest_pairs", lambda *a: pairs.append(whole(*a)) or pairs[-1])
    got = {r["pid"]: r["nbrs"] for r in N.knn(table, names, k).collect()}
    dist = np.sqrt(((new[:, None] - base[None]) ** 2).sum(-1))
    dist.sort(axis=1)
    for i in range(600):
        assert [n["d"] for n in got[6_000 + i][:k]] == pytest.approx(dist[i, :k].tolist())
    blocks = pairs[0].select("a").distinct().count() * 24  # 24 blocks of base points, or a few more
    if k == 5:
        assert pairs[0].count() < blocks / 2
