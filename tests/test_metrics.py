"""Metrics, quantiles, splits and calibration on small hand-checked inputs."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from reviewlens.functions import ordered as O
from reviewlens.operators import calibration as C
from reviewlens.operators import fusion as T
from reviewlens.operators import metrics as M
from reviewlens.operators import splits as S
from reviewlens.operators import validation as V


def scores(spark, pairs):
    return spark.createDataFrame([(float(s), y) for s, y in pairs], "score double, y int")


def value(df):
    return df.first()[0]


@pytest.mark.parametrize("pairs,auc", [
    ([(0.9, 1), (0.8, 1), (0.2, 0)], 1.0), ([(0.1, 1), (0.8, 0)], 0.0),
    ([(0.5, 1), (0.5, 0), (0.5, 0)], 0.5), ([(0.9, 1), (0.5, 0), (0.5, 1), (0.1, 0)], 0.875),
])
def test_auc(spark, pairs, auc):
    assert value(M.auc_roc(scores(spark, pairs))) == pytest.approx(auc)


def test_against_sorted_sweep(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 3000)
    s = rng.normal(size=3000) + y
    s[::3] = np.round(s[::3], 1)
    df = scores(spark, zip(s, y.tolist()))
    order = np.argsort(-s, kind="stable")
    last = np.r_[np.nonzero(np.diff(s[order]))[0], len(s) - 1]
    tp, fp = np.cumsum(y[order])[last], np.cumsum(1 - y[order])[last]
    precision, recall = tp / (tp + fp), tp / y.sum()
    assert value(M.average_precision(df)) == pytest.approx((np.diff(np.r_[0, recall]) * precision).sum())
    f1 = 2 * precision * recall / (precision + recall + 1e-10)
    best = M.best_f1_threshold(df).first()
    assert best.f1 == pytest.approx(f1.max()) and best.threshold == pytest.approx(s[order][last][f1.argmax()])
    assert value(M.recall_at_fpr(df)) == pytest.approx(recall[fp / (1 - y).sum() <= 0.1].max())
    assert M.roc_curve(df).count() == len(last)
    summary = M.summary(df.withColumn("m", F.lit("a")), ["m"]).first()
    assert summary.f1_optimal == pytest.approx(f1.max())


def test_ece_edges(spark):
    df = scores(spark, [(0.0, 0), (1.0, 1), (0.1, 0), (0.95, 1)])
    bins = {r.bin: r.n for r in M.reliability_curve(df).collect()}
    assert bins == {0: 1, 1: 1, 9: 2}
    assert value(M.ece(df)) == pytest.approx((0.1 + 0.05) / 4)
    assert value(M.brier(df)) == pytest.approx((0.01 + 0.0025) / 4)


def test_f1_without_positives(spark):
    row = M.f1_at(scores(spark, [(0.1, 0), (0.2, 0)]), 0.5).first()
    assert (row.f1_spam, row.f1_macro) == (0.0, 0.5)


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(6)
    x = np.r_[rng.normal(size=2000), np.full(1000, 0.25)]
    g = rng.integers(0, 2, len(x))
    df = spark.createDataFrame(list(zip(g.tolist(), x.tolist())), "g int, x double")
    probs = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0]
    for r in O.quantiles(df, "x", probs, ["g"]).collect():
        assert r.q == pytest.approx(np.quantile(x[g == r.g], probs)) and r.n == (g == r.g).sum()
    half = df.withColumn("w", F.lit(2))
    doubled = np.repeat(x, 2)
    assert O.quantiles(half, "x", probs, weight="w").first().q == pytest.approx(np.quantile(doubled, probs))


def test_deal_equals_a_window(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    dealt = O.deal(df, "k", ["s"], 4, 1, "hand")
    sizes = dealt.groupBy("s", "hand").count().toPandas()["count"]
    assert dealt.count() == 5000 and sizes.max() - sizes.min() <= 1
    again = {(r.k, r.hand) for r in O.deal(df, "k", ["s"], 4, 1, "hand").collect()}
    assert again == {(r.k, r.hand) for r in dealt.collect()}


def test_folds_keep_users_and_balance(spark):
    reviews = spark.range(20000).select(
        F.col("id").alias("review_id"), F.pmod(F.hash("id"), F.lit(4000)).alias("user_id"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(8)) == 0).cast("int").alias("is_spam"),
    )
    parts = S.split_80_10_10(reviews)
    assert S.group_disjointness(parts).count() == 0
    report = {r.part: r for r in S.part_report(parts).collect()}
    assert report["train"].n_rows / 20000 == pytest.approx(0.8, abs=0.01)
    rates = [r.positive_rate for r in report.values()]
    assert max(rates) - min(rates) < 0.01
    split = S.train_test(reviews)
    assert split.filter("part = 'test'").count() / 20000 == pytest.approx(0.2, abs=0.01)
    some = S.train_subsample(reviews, 0.75)
    assert some.count() / 20000 == pytest.approx(0.75, abs=0.02)


def test_impute_scale_and_weights(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5.0, None), (2, 3.0, 5.0, None), (3, None, 5.0, None), (4, 100.0, 5.0, None)],
        "i int, a double, b double, c double")
    filled = T.median_impute(df, df, ["a", "b", "c"]).orderBy("i").collect()
    assert filled[2].a == 3.0 and filled[0].c == 0.0
    scaled = T.robust_scale(df, df, ["a", "b"]).orderBy("i").collect()
    assert scaled[0].a == pytest.approx(-2 / (1.4826 * 2)) and scaled[3].a == 5.0
    assert scaled[0].b == 0.0 and scaled[2].a == 0.0
    weights = {r.y: r for r in T.class_weights(scores(spark, [(0, 1), (0, 0), (0, 0), (0, 0)])).collect()}
    assert weights[1].balanced_weight == 2.0 and weights[0].mean_one_weight == pytest.approx(0.5)


def test_isotonic_is_monotone(spark):
    rng = np.random.default_rng(8)
    s = np.round(rng.uniform(size=2000), 2)
    y = (rng.uniform(size=2000) < s).astype(int)
    df = spark.createDataFrame(
        [(i, float(a), int(b), i % 2) for i, (a, b) in enumerate(zip(s, y))],
        "review_id int, score double, y int, half int")
    out = C.isotonic(df, ["review_id", "score"]).orderBy("score").toPandas()["isotonic"].to_numpy()
    assert (np.diff(out) >= -1e-12).all()
    report = {r.variant: r for r in C.calibration_report(df).collect()}
    assert set(report) == {"uncalibrated", "platt", "isotonic"}
    assert all(0 <= r.brier <= 0.3 and 0 <= r.ece <= 0.2 for r in report.values())


def test_jaccard(spark):
    rows = [("a", u, 10.0 - u, 0.0) for u in range(6)] + [("b", u, float(u), 0.0) for u in range(6)] \
        + [("c", 99, 1.0, 0.0)]
    ranked = spark.createDataFrame(rows, "signal string, user_id int, key1 double, key2 double")
    got = {(r.k, r.signal_a, r.signal_b): (r.intersection, r.union) for r in
           V.topk_jaccard(ranked, ["a", "b", "c"], [2, 4]).collect()}
    assert got[(2, "a", "b")] == (0, 4) and got[(4, "a", "b")] == (2, 6)
    assert got[(4, "a", "c")] == (0, 5) and len(got) == 6


def test_detection_rates(spark):
    flags = spark.createDataFrame([("easy", 1), ("easy", 0), ("hard", 0)], "tier string, l2 int")
    got = {r.tier: (r.n_profiles, r.rate) for r in V.detection_rates(flags, ["l2"]).collect()}
    assert got == {"easy": (2, 0.5), "hard": (1, 0.0), "overall": (3, pytest.approx(1 / 3))}


def test_target_encoding_uses_the_fit_half(spark):
    fit = spark.createDataFrame([(0, 1), (0, 0), (1, 0)], "c int, y int")
    rows = spark.createDataFrame([(0, 0), (1, 1), (7, 1)], "c int, y int")
    got = {r.c: r.rate for r in V.target_encode(fit, rows, "c", "rate").collect()}
    assert got == {0: 0.5, 1: 0.0, 7: pytest.approx(1 / 3)}


def test_rows_without_a_score_enter_no_metric(spark):
    df = spark.createDataFrame(
        [(0.9, 1), (0.2, 0), (None, 1), (None, 0), (0.4, None)], "score double, y int"
    )
    assert sum(r["n"] for r in M.reliability_curve(df).collect()) == 2
    assert value(M.ece(df)) == pytest.approx((0.1 + 0.2) / 2)
    cells = M.f1_at(df, 0.5).first()
    assert (cells["tp"], cells["fp"], cells["fn"], cells["tn"]) == (1, 0, 0, 1)
    judged = df.withColumn("outcome", M.outcome(F.col("score") >= 0.5, F.col("y"))).withColumn("g", F.lit("a"))
    assert sorted(r["outcome"] for r in M.error_buckets(judged, ["g"]).collect()) == ["TN", "TP"]
    assert value(M.without_score(df)) == 3


def test_null_groups_and_strata_stay(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a", float(i)) for i in range(20)], "id int, g string, v double")
    medians = {r["g"]: r["q"][0] for r in O.quantiles(df, "v", [0.5], ["g"]).collect()}
    assert medians == {"a": 9.0, None: 10.0}
    dealt = O.deal(df, "id", ["g"], 2, 1, "hand").collect()
    assert len(dealt) == 20 and {(r["g"], r["hand"]) for r in dealt} == {("a", 0), ("a", 1), (None, 0), (None, 1)}


@pytest.mark.parametrize("n", [100, 257, 300, 600, 5_000])
def test_every_tree_gets_its_rows(spark, n):
    from reviewlens.operators import anomaly

    drawn = anomaly._samples(spark.range(n), "id", n, 300, 256, 42)
    sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert len(sizes) == 300 and min(sizes) >= min(256, n)
