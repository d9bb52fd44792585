"""Splits that keep a reviewer whole, halves by label, and fold checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.ordered import deal
from reviewlens.session import store

SEED = 42


def _size_class(count: Column) -> Column:
    """0, 1, 2-3, 4-7, ...: reviewers of similar weight are dealt together."""
    return F.when(count == 0, 0).otherwise(F.floor(F.log2(count.cast("double"))) + 1).cast("int")


def user_folds(
    reviews: DataFrame, folds: int, seed: int = SEED, user: str = "user_id", y: str = "is_spam"
) -> DataFrame:
    """(user, fold): reviewers dealt evenly within classes of equal review count
    and equal number of positives, so folds agree in size and in label rate."""
    users = reviews.groupBy(user).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(y).cast("long")).alias("_pos")
    )
    classed = users.select(
        user, _size_class(F.col("_n")).alias("_nc"), _size_class(F.col("_pos")).alias("_pc")
    )
    return deal(store(classed, "users"), user, ["_nc", "_pc"], folds, seed, "fold").select(user, "fold")


def group_stratified_folds(
    reviews: DataFrame, folds: int = 5, seed: int = SEED, user: str = "user_id", y: str = "is_spam"
) -> DataFrame:
    """Reviews with a ``fold`` column; all reviews of a reviewer share it."""
    return reviews.join(user_folds(reviews, folds, seed, user, y), user)


def holdout_fold(assigned: DataFrame, test_size: float = 0.2) -> DataFrame:
    """The fold whose share of rows is nearest to ``test_size`` (one row)."""
    sizes = assigned.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    gap = F.abs(F.col("n") / sizes.agg(F.sum("n")).scalar() - test_size)
    return sizes.withColumn("gap", gap).agg(
        F.min(F.struct(F.round("gap", 12).alias("gap"), "fold")).getField("fold").alias("fold")
    )


def train_test(
    reviews: DataFrame, test_size: float = 0.2, seed: int = SEED, user: str = "user_id",
    y: str = "is_spam",
) -> DataFrame:
    """Reviews with ``part`` train or test by the fold nearest to ``test_size``."""
    assigned = group_stratified_folds(reviews, max(2, round(1 / test_size)), seed, user, y)
    chosen = holdout_fold(assigned, test_size).scalar()
    return assigned.withColumn("_f", chosen).withColumn(
        "part", F.when(F.col("fold") == F.col("_f"), "test").otherwise("train")
    ).drop("fold", "_f")


def split_80_10_10(
    reviews: DataFrame, seed: int = SEED, user: str = "user_id", y: str = "is_spam"
) -> DataFrame:
    """Reviews with ``part`` train, val or test: a fifth is dealt out, then halved."""
    fifths = user_folds(reviews, 5, seed, user, y).withColumnRenamed("fold", "_fifth")
    held = reviews.join(fifths.filter(F.col("_fifth") == 0), user, "left_semi")
    halves = user_folds(held, 2, seed + 1, user, y).withColumnRenamed("fold", "_half")
    parts = fifths.join(halves, user, "left").select(
        user,
        F.when(F.col("_fifth") != 0, "train").when(F.col("_half") == 0, "val")
        .otherwise("test").alias("part"),
    )
    return reviews.join(parts, user)


def stratified_half(
    df: DataFrame, key: str = "review_id", y: str = "y", seed: int = SEED
) -> DataFrame:
    """Rows with ``half`` 0 or 1, each label split evenly."""
    return deal(df, key, [y], 2, seed, "half")


def train_subsample(
    train: DataFrame, fraction: float, seed: int = SEED, user: str = "user_id", y: str = "is_spam"
) -> DataFrame:
    """Whole reviewers making up about ``fraction`` of the training rows."""
    folds = max(2, round(1 / min(fraction, 1 - fraction))) if 0 < fraction < 1 else 2
    wanted = folds if fraction >= 1 else max(1, round(fraction * folds))
    return group_stratified_folds(train, folds, seed, user, y).filter(
        F.col("fold") < wanted
    ).drop("fold")


def group_disjointness(assigned: DataFrame, user: str = "user_id", part: str = "part") -> DataFrame:
    """Reviewers found in more than one part; a sound split gives no rows."""
    return assigned.select(user, part).distinct().groupBy(user).agg(
        F.count(F.lit(1)).alias("n_parts")
    ).filter(F.col("n_parts") > 1)


def part_report(assigned: DataFrame, part: str = "part", user: str = "user_id", y: str = "is_spam") -> DataFrame:
    """Rows, reviewers and label rate per part, from per-reviewer counts."""
    users = assigned.groupBy(part, user).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos")
    )
    return users.groupBy(part).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_users"),
        (F.sum("pos") / F.sum("n")).alias("positive_rate"),
    )
