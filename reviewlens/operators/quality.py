"""Data-quality checks: one aggregate per table, reported as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_COLUMNS = ["user_id", "prod_id", "rating", "label", "review_date", "is_spam"]
SPAM_RATE_TOLERANCE = 0.005
LABELS = [-1, 1]
RATINGS = [1, 2, 3, 4, 5]


def _rows(facts: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """One (check, expected, actual, passed) row per check from a one-row frame."""
    listed = F.array(*[
        F.struct(
            F.lit(name).alias("check"),
            expected.cast("string").alias("expected"),
            actual.cast("string").alias("actual"),
            F.coalesce(expected == actual, F.lit(False)).cast("int").alias("passed"),
        )
        for name, expected, actual in checks
    ])
    return facts.select(F.inline(listed))


def dq_row_counts(
    reviews: DataFrame, reviewers: DataFrame, sellers: DataFrame, expected: dict[str, Column]
) -> DataFrame:
    """Row count of each table against the expected one."""
    tables = {"reviews": reviews, "reviewers": reviewers, "sellers": sellers}
    parts = [
        _rows(
            df.agg(F.count(F.lit(1)).alias("n")),
            [(f"rows_{name}", expected[name].cast("long"), F.col("n"))],
        )
        for name, df in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def dq_spam_rate(reviews: DataFrame, expected: float) -> DataFrame:
    return reviews.agg(F.avg("is_spam").alias("actual")).select(
        F.lit("spam_rate").alias("check"), F.lit(expected).alias("expected"), "actual",
        (F.abs(F.col("actual") - expected) < SPAM_RATE_TOLERANCE).cast("int").alias("passed"),
    )


def dq_nulls(reviews: DataFrame) -> DataFrame:
    """Nulls per key column, all in one pass."""
    facts = reviews.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in KEY_COLUMNS])
    return _rows(facts, [(f"nulls_{c}", F.lit(0).cast("long"), F.col(c)) for c in KEY_COLUMNS])


def dq_ranges(
    reviews: DataFrame, reviewers: DataFrame, first_date: str, last_date: str
) -> DataFrame:
    """Out-of-range values, and the date range against the expected one."""
    def outside(c: str, low: float, high: float) -> Column:
        return F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(c)

    none = F.lit(0).cast("long")
    of_reviewers = reviewers.agg(
        F.count_if(F.col("tenure_days") < 0).alias("tenure_days"),
        outside("spam_rate", 0, 1), outside("max_seller_fraction", 0, 1),
        F.count_if(F.col("review_count") < 1).alias("review_count"),
    )
    of_reviews = reviews.agg(
        outside("rating", 1, 5),
        F.min("review_date").alias("first"), F.max("review_date").alias("last"),
    )
    return _rows(
        of_reviewers,
        [(f"range_{c}", none, F.col(c))
         for c in ("tenure_days", "spam_rate", "max_seller_fraction", "review_count")],
    ).unionByName(_rows(of_reviews, [
        ("range_rating", none, F.col("rating")),
        ("first_date", F.lit(first_date), F.col("first").cast("string")),
        ("last_date", F.lit(last_date), F.col("last").cast("string")),
    ]))


def dq_domains(reviews: DataFrame, raw: DataFrame) -> DataFrame:
    """Label and rating domains, and that the transform kept every row."""
    def present(c: str, values: list[int]) -> list[Column]:
        return [F.max((F.col(c) == v).cast("int")).alias(f"{c}_{i}") for i, v in enumerate(values)]

    def covered(c: str, values: list[int]) -> Column:
        total = sum((F.col(f"{c}_{i}") for i in range(1, len(values))), F.col(f"{c}_0"))
        return total.cast("long")

    facts = reviews.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("label").isin(*LABELS)).alias("stray_labels"),
        F.count_if(~F.col("rating").isin(*RATINGS)).alias("stray_ratings"),
        *present("label", LABELS), *present("rating", RATINGS),
    ).withColumn("n_raw", raw.agg(F.count(F.lit(1))).scalar())
    none = F.lit(0).cast("long")
    return _rows(facts, [
        ("labels_outside", none, F.col("stray_labels")),
        ("labels_present", F.lit(len(LABELS)).cast("long"), covered("label", LABELS)),
        ("ratings_outside", none, F.col("stray_ratings")),
        ("ratings_present", F.lit(len(RATINGS)).cast("long"), covered("rating", RATINGS)),
        ("rows_kept", F.col("n_raw"), F.col("n")),
    ])


def dq_report(parts: list[DataFrame], spam_rate: DataFrame) -> DataFrame:
    """All checks as one table."""
    report = spam_rate.select(
        "check", F.col("expected").cast("string").alias("expected"),
        F.round("actual", 4).cast("string").alias("actual"), "passed",
    )
    for part in parts:
        report = report.unionByName(part)
    return report
