"""Model bundle, stacked metrics, category codes and the text threshold on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.functions import encoding as EN
from reviewlens.functions.ordered import medians_and_deviations
from reviewlens.operators import bundle as BU
from reviewlens.operators import models as ML

FEATURES = ["a", "b", "kmeans_cluster_id"]
CLUSTERS = [-1, 0, 1]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0.4).astype(int)
    rows = [(f"r{i}", int(i % 40), None if i % 9 == 0 else float(x[i, 0]), float(x[i, 1]), int(i % 3) - 1, int(y[i]),
             "train" if i % 4 else "test") for i in range(400)]
    raw = spark.createDataFrame(
        rows, "review_id string, user_id int, a double, b double, kmeans_cluster_id int, is_spam int, part string"
    ).cache()
    columns = ML.model_columns(FEATURES, CLUSTERS)
    ready = ML.prepare(raw, FEATURES, CLUSTERS).cache()
    train = ready.filter("part = 'train'")
    models = {
        "decision_tree": ML.train_decision_tree(train, columns),
        "random_forest": ML.train_random_forest(train, columns, trees=5, depth=3),
        "mlp": ML.train_mlp(train, columns),
    }
    hot = BU.one_hot(raw.filter("part = 'train'"), "kmeans_cluster_id", CLUSTERS)
    found = BU.bundle(models, hot, FEATURES, CLUSTERS)
    new = raw.filter("part = 'test'").withColumn("y", F.col("is_spam")).drop("part")
    return models, found, new, ready.filter("part = 'test'")


def test_one_pass_scores_as_the_models_do(spark, fitted, tmp_path):
    models, found, new, ready = fitted
    joint = BU.joint_scores(found, new, ["review_id", "user_id", "y"])
    tuned = BU.tuned(found, joint)
    again = BU.load_bundle(spark, BU.save_bundle(tuned, str(tmp_path / "bundle")))
    got = {r["review_id"]: r for r in BU.with_predictions(again, BU.joint_scores(again, new, ["review_id", "user_id", "y"])).collect()}
    assert len(got) == 100
    limits = {r["model"]: r["optimal_threshold"] for r in tuned.thresholds.collect()}
    for name, model in models.items():
        for r in ML.score(model, ready, ["review_id"]).collect():
            mine = got[r["review_id"]]
            assert mine[f"{name}_score"] == pytest.approx(r["score"], abs=1e-9)
            assert mine[f"{name}_pred"] == int(mine[f"{name}_score"] >= limits[name])
    best = tuned.thresholds.orderBy(F.desc("auc_roc"), F.desc("model")).first()["model"]
    assert {r["best_model"] for r in got.values()} == {best}
    flags = {r["user_id"]: r for r in BU.reviewer_flags(again, new).collect()}
    assert len(flags) == len({r["user_id"] for r in got.values()})
    for user, r in flags.items():
        assert r["score"] == max(g[f"{best}_score"] for g in got.values() if g["user_id"] == user)
        assert r["flagged"] == int(r["score"] >= limits[best])


def test_importance_is_the_forests(fitted):
    models, found, _, _ = fitted
    want = models["random_forest"].stages[-1].featureImportances.toArray()
    got = {r["feature"]: r["importance"] for r in BU.importance(found).collect()}
    assert [got[c] for c in ML.model_columns(FEATURES, CLUSTERS)] == pytest.approx(want.tolist())


def test_ensemble_outputs(spark):
    rng = np.random.default_rng(3)
    score = np.round(rng.uniform(size=200), 3)
    y = (rng.uniform(size=200) < score).astype(int)
    df = spark.createDataFrame([(i, float(s), int(t)) for i, (s, t) in enumerate(zip(score, y))], "user_id int, score double, y int")

    def f1(limit):
        tp = ((score >= limit) & (y == 1)).sum()
        return 2 * tp / ((score >= limit).sum() + y.sum())

    best = max(sorted(set(score)), key=lambda t: (round(f1(t), 9), -t))
    row = BU.ensemble_metrics(df).first()
    assert row["n_eval"] == 200 and row["brier"] == pytest.approx(((score - y) ** 2).mean())
    assert row["f1_at_05"] == pytest.approx(f1(0.5), abs=1e-6) and row["f1_at_optimal"] == pytest.approx(f1(best), abs=1e-6)
    predicted = BU.ensemble_predictions(df).collect()
    assert all(r["pred_at_optimal_threshold"] == int(r["score"] >= row["optimal_threshold"]) for r in predicted)


def test_codes_of_seen_and_unseen_values(spark, tmp_path):
    train = spark.createDataFrame([("b", 1), (None, 1), ("", 2), ("a", 2), ("b", None)], "s string, n int")
    encoder = EN.load_encoder(spark, EN.save_encoder(EN.fit_encoder(train, ["s", "n"]), str(tmp_path / "codes")))
    rows = spark.createDataFrame([("a", 1), (None, 7), ("zz", None), ("", 2)], "s string, n int")
    got = {(r["s"], r["n"]): (r["s_code"], r["n_code"]) for r in EN.encode(rows, encoder, ["s", "n"]).collect()}
    assert got == {("a", 1): (3, 2), (None, 7): (1, 0), ("zz", None): (0, 1), ("", 2): (2, 3)}
    assert EN.encode(rows, EN.fit_encoder(train.limit(0), ["s"]), ["s"]).agg(F.sum("s_code")).first()[0] == 0


def test_median_and_deviation_in_one_pass(spark):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(size=301), 2), np.round(rng.exponential(size=301), 1)
    df = spark.createDataFrame([(float(x), float(y) if i % 5 else None) for i, (x, y) in enumerate(zip(a, b))], "a double, b double")
    got = {r["feature"]: (r["median"], r["deviation"]) for r in medians_and_deviations(df, ["a", "b"]).collect()}
    for name, v in (("a", a), ("b", np.array([y for i, y in enumerate(b) if i % 5]))):
        assert got[name] == (pytest.approx(np.median(v)), pytest.approx(np.median(np.abs(v - np.median(v)))))
