"""Reviewer profiles: one row per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import per_week
from reviewlens.operators.reviews import burst_window
from reviewlens.session import store

RATINGS = [1, 2, 3, 4, 5]
INPUTS = ["user_id", "prod_id", "rating", "is_spam", "review_length", "word_count", "review_date"]


def _spread(n: str, total: str, squares: str) -> Column:
    """Sample standard deviation from sums; null below two values."""
    variance = (F.col(squares) - F.col(total) * F.col(total) / F.col(n)) / (F.col(n) - 1)
    return F.when(F.col(n) > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))


def _sums(reviews: DataFrame) -> DataFrame:
    """Sums per user. They are added up before rows move, so a reviewer with a
    huge share of all rows arrives as one row of every task."""
    rating = F.col("rating").cast("double")
    return reviews.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_spam").alias("spam"),
        F.count(rating).alias("n_rating"),
        F.sum(rating).alias("s_rating"),
        F.sum(rating * rating).alias("ss_rating"),
        F.sum("review_length").alias("s_length"),
        F.count("review_length").alias("n_length"),
        F.sum("word_count").alias("s_words"),
        F.count("word_count").alias("n_words"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
        F.count("review_date").alias("n_dated"),
        *[F.count_if(F.col("rating") == r).alias(f"r{r}") for r in RATINGS],
    )


def _sellers(reviews: DataFrame) -> DataFrame:
    """Distinct sellers and reviews of the most reviewed one, per user, from narrow
    counts per (user, product): a huge reviewer is spread over their products."""
    pairs = reviews.groupBy("user_id", "prod_id").agg(F.count(F.lit(1)).alias("of_seller"))
    return pairs.groupBy("user_id").agg(
        F.max("of_seller").alias("top_seller"), F.count("prod_id").alias("unique_sellers")
    )


def _entropy() -> Column:
    total = sum((F.col(f"r{r}") for r in RATINGS[1:]), F.col("r1"))
    terms = [
        F.when(F.col(f"r{r}") > 0, -(F.col(f"r{r}") / total) * F.log2(F.col(f"r{r}") / total))
        .otherwise(F.lit(0.0))
        for r in RATINGS
    ]
    return sum(terms[1:], terms[0])


def _per_user(reviews: DataFrame) -> DataFrame:
    """Both in one row per user; each column comes from one side. A null user is a user."""
    both = _sums(reviews).unionByName(_sellers(reviews), allowMissingColumns=True)
    return both.groupBy("user_id").agg(*[F.max(c).alias(c) for c in both.columns if c != "user_id"])


def _with_measures(per_user: DataFrame) -> DataFrame:
    tenure = F.datediff("last_review_date", "first_review_date")
    return per_user.select(
        "user_id",
        F.col("n").alias("review_count"),
        F.col("spam").alias("spam_count"),
        (F.col("spam") / F.col("n")).alias("spam_rate"),
        (F.col("s_rating") / F.col("n_rating")).alias("avg_rating"),
        F.coalesce(_spread("n_rating", "s_rating", "ss_rating"), F.lit(0.0)).alias("rating_std"),
        (F.col("s_length") / F.col("n_length")).alias("avg_review_length"),
        (F.col("s_words") / F.col("n_words")).alias("avg_word_count"),
        "first_review_date", "last_review_date", "unique_sellers",
        tenure.alias("tenure_days"),
        per_week(F.col("n"), tenure).alias("reviews_per_week"),
        (F.col("top_seller") / F.col("n")).alias("max_seller_fraction"),
        # the gaps between ordered dates add up to the tenure
        F.when(F.col("n_dated") > 1, tenure / (F.col("n_dated") - 1)).otherwise(F.lit(0.0))
        .alias("avg_days_between_reviews"),
        _entropy().alias("rating_entropy"),
    )


def reviewer_base(reviews: DataFrame) -> DataFrame:
    """Counts, means, spread, first and last date, distinct sellers."""
    return _with_measures(_per_user(reviews)).withColumn(
        "rating_std", F.when(F.col("review_count") > 1, F.col("rating_std"))
    ).select(
        "user_id", "review_count", "spam_count", "avg_rating", "rating_std",
        "avg_review_length", "avg_word_count", "first_review_date", "last_review_date",
        "unique_sellers",
    )


def reviewer_rates(reviews: DataFrame) -> DataFrame:
    """Spam rate, tenure, reviews per week; the spread of one review is 0."""
    return _with_measures(_per_user(reviews)).select(
        "user_id", "spam_rate", "tenure_days", "reviews_per_week", "rating_std"
    )


def max_seller_fraction(reviews: DataFrame) -> DataFrame:
    return _with_measures(_per_user(reviews)).select("user_id", "max_seller_fraction")


def avg_days_between_reviews(reviews: DataFrame) -> DataFrame:
    return _with_measures(_per_user(reviews)).select("user_id", "avg_days_between_reviews")


def rating_entropy(reviews: DataFrame) -> DataFrame:
    return _with_measures(_per_user(reviews)).select("user_id", "rating_entropy")


def burst_score(reviews: DataFrame) -> DataFrame:
    """The largest number of reviews in any eight-day stretch ending on a review."""
    return burst_window(reviews).groupBy("user_id").agg(
        F.max("window_count").cast("int").alias("burst_score")
    )


def reviewer_profile(reviews: DataFrame) -> DataFrame:
    """All reviewer measures. What they need of the reviews is stored first, as it
    is read three times; both sides arrive partitioned by user, so the join itself
    moves no rows."""
    reviews = store(reviews.select(*INPUTS), "reviews")
    return (
        _with_measures(_per_user(reviews))
        .join(burst_score(reviews), "user_id", "left")
        .withColumn("burst_score", F.coalesce("burst_score", F.lit(1)))
    )


def seller_concentration(reviews: DataFrame) -> DataFrame:
    """Total reviews and share of the most reviewed seller, per reviewer."""
    return _with_measures(_per_user(reviews)).select(
        "user_id", F.col("review_count").alias("total"),
        F.col("max_seller_fraction").alias("concentration"),
    )


def reviewer_features_eda(reviews: DataFrame) -> DataFrame:
    """The exploratory variant: text means, spam rate and concentration."""
    texts = reviews.groupBy("user_id").agg(
        F.avg("word_count").alias("mean_review_length"),
        F.avg("exclamation_count").alias("mean_exclamations"),
        F.avg("capital_ratio").alias("mean_caps_ratio"),
    )
    core = _with_measures(_per_user(reviews)).select(
        "user_id",
        F.col("review_count").alias("total_reviews"),
        F.col("avg_rating").alias("mean_rating"),
        "rating_std", "spam_rate",
        F.col("max_seller_fraction").alias("concentration"),
    )
    return core.join(texts, "user_id", "left").na.fill(0.0)
