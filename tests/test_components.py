"""Components and the radius sweep beside plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_neighbors import brute_dbscan, cloud, frame

from reviewlens.operators import components as components_module
from reviewlens.operators import dbscan as D
from reviewlens.operators.components import components, hubs, stars, with_low


def plain_roots(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    return [find(i) for i in range(n)]


def graphs():
    rng = np.random.default_rng(1)
    chain = [(i, i + 1) for i in range(199)]
    yield 900, chain + [(200 + int(a), 200 + int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [
        (600 + int(a), 600 + int(b)) for a, b in zip(rng.permutation(256), rng.permutation(256))]
    yield 200, [(199, i) for i in range(150)] + [(150, 151), (150, 150)]
    yield 50, [(i, j) for i in range(20) for j in range(20)] + [(30, 20), (20, 31)]
    yield 10, []


@pytest.mark.parametrize("few", [100_000, 0])
@pytest.mark.parametrize("n, edges", list(graphs()))
def test_components_match_a_plain_search(spark, monkeypatch, n, edges, few):
    monkeypatch.setattr(components_module, "FEW_EDGES", few)
    nodes = spark.createDataFrame([(i,) for i in range(n)], "node long")
    table = spark.createDataFrame(edges + edges[:3], "u long, v long")
    got = {r["node"]: r["root"] for r in components(nodes, table).collect()}
    assert [got[i] for i in range(n)] == plain_roots(n, edges)


@pytest.mark.parametrize("centre", [0, 1_000_000])
def test_a_hub_goes_to_no_single_task(spark, centre):
    """A star of 10^6 nodes: no task holds more than twice the median."""
    edges = spark.range(1, 1_000_000).select(F.lit(centre).cast("long").alias("u"), F.col("id").alias("v"))
    made = stars(edges)
    assert made.count() == 999_999 and made.agg(F.max("lo")).first()[0] == min(centre, 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = edges.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
        side = "lo" if centre == 0 else "hi"
        stats = plain.groupBy(F.col(side).alias("node")).agg(
            F.min("lo" if side == "hi" else "hi").alias("low"), F.count(F.lit(1)).alias("n")
        )
        hot = hubs(stats, 999_999)
        assert [h[0] for h in hot] == [centre]
        sizes = [r[1] for r in with_low(plain, side, stats, hot).groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("n, d, radii, min_samples", [
    (700, 2, [0.02, 0.05, 0.051, 0.3], 4), (300, 8, [0.9, 1.6], 5),
])
def test_sweep_matches_a_run_for_every_radius(spark, n, d, radii, min_samples):
    x, ids = cloud(n, d, 2, 60), np.arange(n)
    df, names = frame(spark, x, ids)
    got = {r["eps"]: r for r in D.dbscan_eps_sweep(df, "user_id", names, radii, min_samples).collect()}
    assert sorted(got) == sorted(radii)
    for eps in radii:
        want = brute_dbscan(ids, x, eps, min_samples)
        assert got[eps]["n_noise"] == (want == -1).sum()
        assert got[eps]["n_clusters"] == len(set(want.tolist()) - {-1})


def test_spanning_edges_join_what_all_edges_join():
    rng = np.random.default_rng(9)
    for _ in range(30):
        n, m = int(rng.integers(2, 40)), int(rng.integers(0, 200))
        i, j, level = rng.integers(0, n, m), rng.integers(0, n, m), rng.integers(0, 4, m)
        picked = D.spanning_edges(i, j, level, n)
        assert len(picked) < n
        for limit in range(4):
            whole, few = level <= limit, picked[level[picked] <= limit]
            assert plain_roots(n, zip(i[whole], j[whole])) == plain_roots(n, zip(i[few], j[few]))
