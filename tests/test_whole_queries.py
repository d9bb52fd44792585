"""Queries that report the whole job beside the shorter ones of the same name."""

from __spark_entry__ import queries
from reviewlens.operators import fusion as T

SF = "/root/testdata/sf0.001"


def test_feature_table_has_rules_clusters_and_noise(spark):
    given, learned = (queries()[f"feature_table_{x}"](spark, SF) for x in ("whole", "learned"))
    for df in (given, learned):
        assert set(T.TABLE_FEATURES) <= set(df.columns)
        for c in T.CLUSTER_COLUMNS + T.RULE_FEATURES:
            assert df.select(c).distinct().count() > 1, c
    assert learned.filter("kmeans_cluster_id < 0").count() == 0
    assert given.count() == learned.count() == queries()["feature_table"](spark, SF).count()


def test_six_rankings_and_five_layers(spark):
    rankings, pairs, rates = (queries()[f"{x}_whole"](spark, SF) for x in (
        "signal_rankings", "topk_jaccard", "detection_rates"))
    counts = {r["signal"]: r["count"] for r in rankings.groupBy("signal").count().collect()}
    assert len(counts) == 6 and len(set(counts.values())) == 1
    assert pairs.select("signal_a", "signal_b").distinct().count() == 15
    assert {r["layer"] for r in rates.collect()} == {"rules", "kmeans", "dbscan", "supervised", "anomaly"}


def test_write_cubes_writes_all_four(spark, monkeypatch):
    from reviewlens.sources import files

    written, write = {}, files.write_cubes
    monkeypatch.setattr(files, "write_cubes", lambda cubes, root: written.update(write(cubes, root)) or written)
    names = {"time_x_rating", "tenure_x_rating", "time_x_tenure", "full_3d"}
    queries()["write_cubes"](spark, SF)
    assert names <= set(written)
    rows = queries()["write_cubes_whole"](spark, SF).collect()
    assert {r["cube"] for r in rows} == names
    assert len({r["total_reviews"] for r in rows}) == 1


def test_feature_deltas_see_all_16_features(spark, monkeypatch):
    from reviewlens.operators import metrics as M

    asked, deltas = [], M.feature_deltas
    monkeypatch.setattr(M, "feature_deltas", lambda df, features: asked.extend(features) or deltas(df, features))
    rows = queries()["feature_deltas_whole"](spark, SF).collect()
    assert len(set(asked)) == 16 and len(rows) == 20
    assert {"review_length", "word_count"} <= {r["feature"] for r in rows}
