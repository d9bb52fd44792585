"""OLAP cubes over reviews: month, rating and tenure against six measures.

Reviews are summed per reviewer, month and rating before the reviewer's
attributes are joined, so a hot reviewer joins as many rows as there are months
and ratings. The joined rows become cells of all three dimensions; every cube is
made of cells, with sums and counts in place of averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import bin_tenure

DIMENSIONS = ["year_month", "rating_int", "tenure_bin"]
_AVERAGED = {
    "review_length": "avg_review_length",
    "reviews_per_week": "avg_reviewer_velocity",
    "max_seller_fraction": "avg_max_seller_fraction",
}


def cube_input(reviews: DataFrame, reviewers: DataFrame) -> DataFrame:
    """Finest cells: the dimensions, ``n``, ``spam``, and ``s_``, ``n_``: sum and
    number of the values of each averaged column."""
    own = reviews.groupBy("user_id", "year_month", F.col("rating").cast("int").alias("rating_int")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_spam").alias("spam"),
        F.sum("review_length").alias("s_review_length"), F.count("review_length").alias("n_review_length"),
    )
    attributes = reviewers.select("user_id", "tenure_days", "reviews_per_week", "max_seller_fraction")
    joined = own.join(attributes, "user_id", "left").withColumn("tenure_bin", bin_tenure(F.col("tenure_days"), "cube"))

    def weighted(c: str) -> list[Column]:
        return [F.sum(F.col(c) * F.col("n")).alias(f"s_{c}"), F.sum(F.when(F.col(c).isNotNull(), F.col("n"))).alias(f"n_{c}")]

    return joined.groupBy(*DIMENSIONS).agg(
        *[F.sum(c).alias(c) for c in ("n", "spam", "s_review_length", "n_review_length")],
        *weighted("reviews_per_week"), *weighted("max_seller_fraction"),
    )


def measures() -> list[Column]:
    """The six measures of a group of cells."""
    return [
        F.sum("n").alias("total_reviews"),
        F.sum("spam").alias("spam_count"),
        (F.sum("spam") / F.sum("n")).alias("spam_rate"),
        *[(F.sum(f"s_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0))).alias(name) for c, name in _AVERAGED.items()],
    ]


def cube(cells: DataFrame, dimensions: list[str]) -> DataFrame:
    return cells.groupBy(*dimensions).agg(*measures()).orderBy(*dimensions)


def cube_time_x_rating(cells: DataFrame) -> DataFrame:
    return cube(cells, ["year_month", "rating_int"])


def cube_tenure_x_rating(cells: DataFrame) -> DataFrame:
    return cube(cells, ["tenure_bin", "rating_int"])


def cube_time_x_tenure(cells: DataFrame) -> DataFrame:
    return cube(cells, ["year_month", "tenure_bin"])


def cube_full_3d(cells: DataFrame) -> DataFrame:
    return cube(cells, DIMENSIONS)


def cube_all(cells: DataFrame) -> DataFrame:
    """All groupings with subtotals. ``grouping_mask`` has one bit per dimension,
    set where the dimension is rolled up."""
    return cells.cube(*DIMENSIONS).agg(F.grouping_id().cast("int").alias("grouping_mask"), *measures())


def spam_rate_by_tenure(cells: DataFrame) -> DataFrame:
    return cells.groupBy("tenure_bin").agg(
        F.sum("n").alias("total_reviews"), (F.sum("spam") / F.sum("n")).alias("spam_rate")
    )
