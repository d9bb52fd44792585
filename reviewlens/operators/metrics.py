"""Ranking and threshold metrics from (score, y) pairs.

Scores are aggregated to one row per distinct value first; cumulative counts
come from ``summed_counts``, so no step sorts all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.ordered import summed_counts
from reviewlens.session import store

SWEEP_POINTS = 197
ECE_BINS = 10


def score_counts(df: DataFrame, score: str = "score", y: str = "y", by: list[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum((1 - F.col(y)).cast("long")).alias("neg"),
    )


def curve(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Per distinct score s: tp and fp of the rule ``score >= s``, with P and N."""
    by = list(by)
    counts = store(counts, "scores")
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    summed = summed_counts(counts, "score", ["pos", "neg"], by, descending=True)
    summed = summed.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})
    if by:
        return summed.join(F.broadcast(totals), by)
    both = totals.select(F.struct("P", "N")).scalar()
    return summed.withColumn("_t", both).select("*", "_t.*").drop("_t")


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return F.col("tp") / F.col("P")


def auc_expr() -> Column:
    """Area under the ROC curve by trapezoids; tied scores count one half."""
    return F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)) / (F.max("P") * F.max("N"))


def ap_expr() -> Column:
    """Sum over thresholds of the step in recall times the precision."""
    return F.sum(F.col("pos") / F.col("P") * _precision())


def f1_expr() -> Column:
    p, r = _precision(), _recall()
    return 2 * p * r / (p + r + 1e-10)


def best_f1_struct() -> Column:
    """Largest F1 and its threshold; among equals the smallest threshold."""
    return F.max(F.struct(f1_expr().alias("f1"), (-F.col("score")).alias("neg_threshold")))


def recall_at_fpr_expr(limit: float) -> Column:
    within = F.col("fp") / F.col("N") <= limit
    return F.coalesce(F.max(F.when(within, _recall())), F.lit(0.0))


def auc_roc(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    return curve(score_counts(df, score, y)).agg(auc_expr().alias("auc_roc"))


def average_precision(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    return curve(score_counts(df, score, y)).agg(ap_expr().alias("avg_precision"))


def best_f1_threshold(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    best = curve(score_counts(df, score, y)).agg(best_f1_struct().alias("b"))
    return best.select((-F.col("b.neg_threshold")).alias("threshold"), F.col("b.f1").alias("f1"))


def recall_at_fpr(df: DataFrame, limit: float = 0.1, score: str = "score", y: str = "y") -> DataFrame:
    return curve(score_counts(df, score, y)).agg(recall_at_fpr_expr(limit).alias("recall_at_fpr"))


def roc_curve(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """One point per distinct score, from the highest threshold down."""
    return curve(score_counts(df, score, y)).select(
        F.col("score").alias("threshold"),
        (F.col("fp") / F.col("N")).alias("fpr"), _recall().alias("tpr"),
    )


def pr_curve(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    return curve(score_counts(df, score, y)).select(
        F.col("score").alias("threshold"), _precision().alias("precision"), _recall().alias("recall")
    )


def summary(df: DataFrame, by: list[str], score: str = "score", y: str = "y") -> DataFrame:
    """AUC, best F1, its threshold, average precision and recall at FPR 0.1 per group."""
    points = curve(score_counts(df, score, y, by), by)
    measured = points.groupBy(*by).agg(
        auc_expr().alias("auc_roc"), best_f1_struct().alias("b"),
        ap_expr().alias("avg_precision"), recall_at_fpr_expr(0.1).alias("recall_at_fpr_0_1"),
    )
    return measured.select(
        *by, "auc_roc", F.col("b.f1").alias("f1_optimal"),
        (-F.col("b.neg_threshold")).alias("optimal_threshold"),
        "avg_precision", "recall_at_fpr_0_1",
    )


def confusion(predicted: Column, y: str = "y") -> list[Column]:
    actual = F.col(y) == 1
    return [
        F.count_if(actual & predicted).alias("tp"), F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"), F.count_if(~actual & ~predicted).alias("tn"),
    ]


def _f1(tp: Column, wrong: Column) -> Column:
    return F.when(2 * tp + wrong > 0, 2 * tp / (2 * tp + wrong)).otherwise(F.lit(0.0))


def f1_columns() -> list[Column]:
    """F1 of the positive class and the mean of both classes from tp, fp, fn, tn."""
    wrong = F.col("fp") + F.col("fn")
    spam, rest = _f1(F.col("tp"), wrong), _f1(F.col("tn"), wrong)
    return [spam.alias("f1_spam"), ((spam + rest) / 2).alias("f1_macro")]


def f1_at(df: DataFrame, threshold: float | Column, score: str = "score", y: str = "y") -> DataFrame:
    """Confusion counts and F1 of the rule ``score >= threshold``."""
    limit = F.lit(threshold) if isinstance(threshold, float) else threshold
    return with_score(df, score, y).agg(*confusion(F.col(score) >= limit, y)).select("*", *f1_columns())


def _grid() -> list[float]:
    step = (0.99 - 0.01) / (SWEEP_POINTS - 1)
    return [round(0.01 + i * step, 4) for i in range(SWEEP_POINTS)]


def macro_f1_sweep(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Macro F1 at 197 fixed thresholds.

    Each score counts for the grid points up to it, so scores are reduced to
    their place on the grid and then summed from the top.
    """
    grid = _grid()
    place = F.size(F.filter(F.lit(grid), lambda g: g <= F.col("score")))
    cells = score_counts(df, score, y).groupBy(place.alias("place")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    reached = (
        cells.select(F.explode(F.sequence(F.lit(0), "place")).alias("i"), "pos", "neg")
        .groupBy("i").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp"))
    )
    return (
        cells.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        .select("P", "N", F.posexplode(F.lit(grid)).alias("i", "threshold"))
        .withColumn("i", F.col("i") + 1)
        .join(reached, "i", "left").na.fill(0, ["tp", "fp"])
        .withColumns({"fn": F.col("P") - F.col("tp"), "tn": F.col("N") - F.col("fp")})
        .select("threshold", *f1_columns())
    )


def best_macro_threshold(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """The smallest grid threshold with the largest macro F1."""
    best = macro_f1_sweep(df, score, y).agg(
        F.max(F.struct("f1_macro", (-F.col("threshold")).alias("t"))).alias("b")
    )
    return best.select((-F.col("b.t")).alias("threshold"), F.col("b.f1_macro").alias("f1_macro"))


def brier(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(y), 2)).alias("brier"))


def with_score(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Rows that have a score and a label; the others enter no metric."""
    return df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())


def without_score(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """How many rows the metrics leave out (one row)."""
    left_out = F.col(score).isNull() | F.col(y).isNull()
    return df.agg(F.count(F.when(left_out, 1)).alias("n_without_score"))


def reliability_curve(
    df: DataFrame, bins: int = ECE_BINS, score: str = "score", y: str = "y", by: list[str] = ()
) -> DataFrame:
    """Mean score and share of positives per equal-width bin of the score."""
    edge = F.floor(F.col(score) * bins).cast("int")
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), edge))
    return with_score(df, score, y).groupBy(*by, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"), F.avg(F.col(y).cast("double")).alias("positive_rate"),
    )


def ece(
    df: DataFrame, bins: int = ECE_BINS, score: str = "score", y: str = "y", by: list[str] = ()
) -> DataFrame:
    """Gap between score and share of positives, weighted by bin size."""
    gap = F.abs(F.col("mean_score") - F.col("positive_rate"))
    return reliability_curve(df, bins, score, y, by).groupBy(*by).agg(
        (F.sum(F.col("n") * gap) / F.sum("n")).alias("ece")
    )


def outcome(predicted: Column, y: Column) -> Column:
    """TP, FP, FN or TN; null without a prediction or a label."""
    return (
        F.when((y == 1) & predicted, "TP").when((y == 0) & predicted, "FP")
        .when((y == 1) & ~predicted, "FN").when((y == 0) & ~predicted, "TN")
    )


def error_buckets(scored: DataFrame, buckets: list[str]) -> DataFrame:
    """Rows per bucket and outcome; ``scored`` carries an ``outcome`` column."""
    known = scored.filter(F.col("outcome").isNotNull())
    return known.groupBy(*buckets, "outcome").agg(F.count(F.lit(1)).alias("count"))


def error_rates(scored: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Share of wrong rows as a table: ``row`` down, ``column`` across."""
    wrong = F.col("outcome").isin("FP", "FN").cast("int")
    return (
        scored.filter(F.col("outcome").isNotNull()).withColumn("_wrong", wrong).groupBy(row).pivot(column, values)
        .agg(F.avg("_wrong")).na.fill(0.0)
    )


def feature_deltas(scored: DataFrame, features: list[str], top: int = 10) -> DataFrame:
    """Features whose means differ most between wrong and right rows of one side:
    FP against TP, and FN against TN."""
    means = scored.agg(*[
        F.avg(F.when(F.col("outcome") == o, F.col(f))).alias(f"{o}_{f}")
        for f in features for o in ("TP", "FP", "FN", "TN")
    ])
    listed = F.array(*[
        F.struct(
            F.lit(f"{a}-{b}").alias("contrast"), F.lit(f).alias("feature"),
            (F.col(f"{a}_{f}") - F.col(f"{b}_{f}")).alias("delta"),
        )
        for f in features for a, b in (("FP", "TP"), ("FN", "TN"))
    ])
    long = means.select(F.inline(listed)).withColumn("abs_delta", F.abs("delta"))
    parts = [
        long.filter(F.col("contrast") == c).orderBy(F.desc("abs_delta"), "feature").limit(top)
        for c in ("FP-TP", "FN-TN")
    ]
    return parts[0].unionByName(parts[1])
