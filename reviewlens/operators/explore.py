"""Exploratory queries over reviews and reviewers."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import clip
from reviewlens.functions.ordered import describe_by
from reviewlens.operators.reviewers import reviewer_rates, seller_concentration

SPAMMER_RATE = 0.5
BURST_WEEK_REVIEWS = 3
HIGH_CORRELATION = 0.85

# histogram column -> (lower bound, upper bound, bins); values beyond are clipped
PROFILE_HISTOGRAMS = {
    "review_count": (0.0, 50.0, 30),
    "tenure_days": (0.0, 1000.0, 30),
    "reviews_per_week": (0.0, 50.0, 30),
    "max_seller_fraction": (0.0, 1.0, 20),
    "burst_score": (0.0, 20.0, 20),
    "rating_entropy": (0.0, 2.5, 25),
}


def dataset_summary(reviews: DataFrame) -> DataFrame:
    """Counts, distincts, date range and null counts in one row.

    Distinct values are counted after an aggregate by (user, product), so no
    single key has to hold all rows.
    """
    pairs = reviews.groupBy("user_id", "prod_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first"), F.max("date").alias("last"),
        *[
            F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}")
            for c in ("rating", "label", "date")
        ],
    )
    return pairs.agg(
        F.sum("n").alias("total_reviews"),
        F.countDistinct("user_id").alias("unique_reviewers"),
        F.countDistinct("prod_id").alias("unique_products"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
        F.sum("null_rating").alias("null_rating"),
        F.sum("null_label").alias("null_label"),
        F.sum("null_date").alias("null_date"),
    )


def with_share(counts: DataFrame, count: str = "n_reviews") -> DataFrame:
    """Add the percentage of the grand total to a small table of counts."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn("pct", F.col(count) * 100.0 / total)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return with_share(df.groupBy(column).agg(F.count(F.lit(1)).alias("n_reviews")))


def class_balance(reviews: DataFrame) -> DataFrame:
    return value_counts(reviews, "is_spam")


def rate_by(reviews: DataFrame, *keys: str) -> DataFrame:
    """Reviews and spam rate per key."""
    return reviews.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_reviews"), F.avg("is_spam").alias("spam_rate")
    )


def monthly_spam_rate(reviews: DataFrame) -> DataFrame:
    """Spam rate per month, beside the mean of the monthly rates."""
    months = rate_by(reviews, "year_month")
    return months.withColumn("mean_of_months", months.agg(F.avg("spam_rate")).scalar())


def monthly_volume(reviews: DataFrame) -> DataFrame:
    """Genuine and spam reviews side by side per month."""
    return (
        reviews.groupBy("year_month").pivot("is_spam", [0, 1]).count().na.fill(0)
        .withColumnsRenamed({"0": "legitimate", "1": "spam"})
    )


def weekly_burst_reviewers(reviews: DataFrame) -> DataFrame:
    """Spam rate of reviewers with three or more reviews in one Monday week."""
    weeks = reviews.groupBy(
        "user_id", F.date_trunc("week", "review_date").alias("week")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("is_spam").alias("spam"))
    users = weeks.groupBy("user_id").agg(
        F.max((F.col("n") >= BURST_WEEK_REVIEWS).cast("int")).alias("is_burst_reviewer"),
        F.sum("n").alias("n"), F.sum("spam").alias("spam"),
    )
    return users.groupBy("is_burst_reviewer").agg(
        F.count(F.lit(1)).alias("n_reviewers"),
        F.sum("n").alias("n_reviews"),
        (F.sum("spam") / F.sum("n")).alias("spam_rate"),
    )


def dow_spam_rate(reviews: DataFrame) -> DataFrame:
    return rate_by(
        reviews.withColumn("day_name", F.date_format("review_date", "EEEE")), "day_name"
    )


def rating_by_label(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("is_spam", "rating").agg(F.count(F.lit(1)).alias("n_reviews"))


def spam_rate_by_rating(reviews: DataFrame) -> DataFrame:
    return rate_by(reviews, "rating")


def reviewer_classes(reviewers: DataFrame) -> DataFrame:
    return reviewers.withColumn("is_spammer", (F.col("spam_rate") > SPAMMER_RATE).cast("int"))


def reviewer_activity(reviews: DataFrame) -> DataFrame:
    """Tenure described for spammers and for everyone else."""
    return describe_by(reviewer_classes(reviewer_rates(reviews)), "tenure_days", ["is_spammer"])


def concentration_by_class(reviews: DataFrame, reviewers: DataFrame) -> DataFrame:
    """Seller concentration described per reviewer class."""
    classes = reviewer_classes(reviewers).select("user_id", "is_spammer")
    return describe_by(
        seller_concentration(reviews).join(classes, "user_id"), "concentration", ["is_spammer"]
    )


def text_stats_by_label(reviews: DataFrame) -> DataFrame:
    measures = ["review_length", "word_count", "exclamation_count", "question_count",
                "capital_ratio", "avg_word_length"]
    return reviews.groupBy("label").agg(*[F.avg(c).alias(f"mean_{c}") for c in measures])


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r for each pair of columns, all pairs in one aggregate."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    listed = F.array(*[
        F.struct(
            F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"r{i}").alias("r")
        )
        for i, (a, b) in enumerate(pairs)
    ])
    return wide.select(F.inline(listed)).withColumn(
        "is_high", (F.abs("r") > HIGH_CORRELATION).cast("int")
    )


def histograms(
    df: DataFrame, bins: dict[str, tuple[float, float, int]], by: list[str] = ()
) -> DataFrame:
    """Fixed-width bins of several columns at once, with counts and densities."""
    by = list(by)
    entries = []
    for name, (low, high, n_bins) in bins.items():
        width = (high - low) / n_bins
        place = F.floor((clip(F.col(name).cast("double"), low, high) - low) / width)
        entries.append(F.struct(
            F.lit(name).alias("feature"),
            F.least(place, F.lit(n_bins - 1)).cast("int").alias("bin"),
            F.lit(low).alias("low"), F.lit(width).alias("width"),
        ))
    counts = (
        df.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")
        .filter(F.col("bin").isNotNull())
        .groupBy(*by, "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("low"), F.min("width").alias("width"))
    )
    totals = counts.groupBy(*by, "feature").agg(F.sum("n").alias("total"))
    return counts.join(totals, [*by, "feature"]).select(
        *by, "feature", "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        "n", (F.col("n") / F.col("total") / F.col("width")).alias("density"),
    )
