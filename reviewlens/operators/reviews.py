"""Review-level features and the master join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions.columns import date_parts, spam_flag, text_measures


def review_features(reviews: DataFrame, text: str = "review_text", date: str = "date") -> DataFrame:
    """Label, calendar and text features in one projection, row count unchanged."""
    day = F.to_date(F.col(date), "yyyy-MM-dd") if dict(reviews.dtypes)[date] == "string" \
        else F.col(date).cast("date")
    return reviews.withColumns({
        "is_spam": spam_flag("label"),
        **date_parts(day),
        **text_measures(F.col(text)),
    })


def review_master(metadata: DataFrame, content: DataFrame, product_map: DataFrame) -> DataFrame:
    """Metadata with text by (user, product, date) and the seller's name.

    Both are plain left joins: Spark broadcasts the name map when it is small.
    """
    key = ["user_id", "prod_id", "date"]
    names = product_map.withColumnRenamed("numeric_id", "prod_id")
    return metadata.join(content.select(*key, "review_text"), key, "left").join(
        names, "prod_id", "left"
    )


def dedup_reviews(
    reviews: DataFrame, order: list[str], key: tuple[str, ...] = ("user_id", "prod_id", "date", "label")
) -> DataFrame:
    """The first row per key in the given order, whatever the task order.

    ``min`` of a struct combines before the shuffle, so a key with very many
    copies costs one row per input partition and needs no sort.
    """
    rest = [c for c in reviews.columns if c not in key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return reviews.groupBy(*key).agg(first).select(*key, "_first.*")


def review_gaps(reviews: DataFrame, order: str = "review_id") -> DataFrame:
    """Days since the same reviewer's previous review, per review.

    Equal days are collapsed first: a day's first review looks back to the
    previous active day, its other reviews have gap 0. A reviewer's window then
    holds at most one row per calendar day, however many reviews there are.
    """
    dated = reviews.filter(F.col("review_date").isNotNull())
    days = dated.groupBy("user_id", "review_date").agg(F.min(order).alias("_first"))
    by_day = Window.partitionBy("user_id").orderBy("review_date")
    looked_back = days.withColumn(
        "_gap", F.datediff("review_date", F.lag("review_date").over(by_day))
    )
    return dated.join(looked_back, ["user_id", "review_date"]).select(
        "user_id", order, "review_date",
        F.when(F.col(order) == F.col("_first"), F.col("_gap")).otherwise(F.lit(0))
        .alias("days_since_prev"),
    )


def burst_window(reviews: DataFrame, lookback_days: int = 7) -> DataFrame:
    """Reviews of the same reviewer in the days [d - lookback, d], per (user, day).

    Both ends count. Days are pre-aggregated, so the window never holds more than
    one row per calendar day and reviewer.
    """
    per_day = reviews.groupBy("user_id", "review_date").agg(F.count(F.lit(1)).alias("n_reviews"))
    frame = (
        Window.partitionBy("user_id").orderBy(F.unix_date("review_date"))
        .rangeBetween(-lookback_days, 0)
    )
    return per_day.withColumn("window_count", F.sum("n_reviews").over(frame))
