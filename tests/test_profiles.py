"""Hand-computed reviewer, seller and review features."""

import datetime as dt
import math

import pytest

from pyspark.sql import functions as F

from reviewlens.functions import columns as C
from reviewlens.operators import reviewers as RW
from reviewlens.operators import reviews as RV
from reviewlens.operators import sellers as SL


def day(n):
    return dt.date(2012, 3, 1) + dt.timedelta(days=n)


def make(spark, rows):
    """rows: user, product, rating, label, day number"""
    raw = spark.createDataFrame(
        [(f"r{i}", u, p, float(s), y, day(n), "good food") for i, (u, p, s, y, n) in enumerate(rows)],
        "review_id string, user_id int, prod_id int, rating double, label int, date date, "
        "review_text string",
    )
    return RV.review_features(raw).withColumn("business_name", F.lit("x"))


def test_text_measures_of_odd_texts(spark):
    texts = [None, "", "   ", " a b ", "Hi THERE! Ok?", "tab\there\nline"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {
        r.i: r for r in df.select(
            "i", *[c.alias(n) for n, c in C.text_measures(F.col("t")).items()]
        ).collect()
    }
    assert (got[0].review_length, got[0].word_count, got[0].capital_ratio) == (0, 0, 0.0)
    assert (got[1].review_length, got[1].word_count, got[1].capital_ratio) == (0, 1, 0.0)
    assert got[3].word_count == 4
    assert got[4].exclamation_count == 1 and got[4].question_count == 1
    assert got[4].capital_ratio == pytest.approx(7 / 13)
    assert got[5].word_count == 3 and got[5].avg_word_length == pytest.approx(11 / 3)


def test_usable_text(spark):
    df = spark.createDataFrame(
        [("  nan  ", 1), ("long enough text", 1), ("short", 1), (None, 0), ("no label at all", None)],
        "t string, y int",
    )
    assert [r.t for r in C.usable_text_filter(df, "t", "y").collect()] == ["long enough text"]


def test_one_review_reviewer(spark):
    row = RW.reviewer_profile(make(spark, [(1, 1, 5, -1, 0)])).first()
    assert (row.rating_std, row.tenure_days, row.avg_days_between_reviews) == (0.0, 0, 0.0)
    assert (row.reviews_per_week, row.burst_score, row.spam_rate, row.rating_entropy) == (1.0, 1, 1.0, 0.0)


def test_burst_window_counts_both_ends(spark):
    seven = make(spark, [(1, 1, 3, 1, 0), (1, 1, 3, 1, 7), (2, 1, 3, 1, 0), (2, 1, 3, 1, 8)])
    scores = {r.user_id: r.burst_score for r in RW.burst_score(seven).collect()}
    assert scores == {1: 2, 2: 1}


def test_entropy_and_gaps(spark):
    rows = [(1, i, i, 1, 10 * i) for i in range(1, 6)] + [(2, 1, 4, 1, 0), (2, 1, 4, 1, 0), (2, 2, 4, 1, 9)]
    reviews = make(spark, rows)
    profile = {r.user_id: r for r in RW.reviewer_profile(reviews).collect()}
    assert profile[1].rating_entropy == pytest.approx(math.log2(5))
    assert profile[1].avg_days_between_reviews == pytest.approx(10.0)
    assert profile[2].max_seller_fraction == pytest.approx(2 / 3)
    assert profile[2].unique_sellers == 2
    gaps = sorted(
        (r.days_since_prev for r in RV.review_gaps(reviews).filter("user_id = 2").collect()),
        key=lambda v: (v is not None, v),
    )
    assert gaps == [None, 0, 9]


def test_mean_gap_equals_window_mean(spark):
    reviews = make(spark, [(u, u % 3, 1 + u % 5, 1, (u * 37 + k * k * 5) % 200) for u in range(20) for k in range(6)])
    by_window = {
        r.user_id: r.m for r in RV.review_gaps(reviews).groupBy("user_id")
        .agg(F.avg("days_since_prev").alias("m")).collect()
    }
    for r in RW.avg_days_between_reviews(reviews).collect():
        assert r.avg_days_between_reviews == pytest.approx(by_window[r.user_id])


def test_half_is_not_suspicious(spark):
    reviews = make(spark, [(1, 9, 5, -1, 0), (1, 9, 5, 1, 3), (2, 9, 5, -1, 0), (2, 8, 5, -1, 0)])
    sellers = {r.prod_id: r for r in SL.seller_profile(reviews, RW.reviewer_profile(reviews)).collect()}
    assert sellers[9].suspicious_reviewer_fraction == 0.5
    assert sellers[8].suspicious_reviewer_fraction == 1.0
    assert sellers[9].unique_reviewers == 2 and sellers[9].active_days == 3


@pytest.mark.parametrize("scheme,expected", [
    ("cube", ["new", "moderate", "moderate", "established", "established", "veteran", "veteran"]),
    ("basket", ["new", "moderate", "moderate", "moderate", "established", "established", "veteran"]),
    ("error", ["new", "moderate", "moderate", "moderate", "moderate", "established", "established"]),
])
def test_tenure_bins(spark, scheme, expected):
    days = [29, 30, 89, 180 if scheme != "cube" else 90, 364, 365, 366]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d int")
    got = [r.b for r in df.select("i", C.bin_tenure(F.col("d"), scheme).alias("b")).orderBy("i").collect()]
    assert got == expected


def test_missing_tenure(spark):
    df = spark.createDataFrame([(None,)], "d int")
    row = df.select(*[C.bin_tenure(F.col("d"), s).alias(s) for s in ("cube", "basket", "error")]).first()
    assert (row.cube, row.basket, row.error) == ("veteran", None, "unknown")


def test_small_column_helpers(spark):
    df = spark.createDataFrame([(1, 2.0)], "total_reviews int, rating double")
    assert C.rename_present(df, {"total_reviews": "review_count", "nope": "x", "rating": "total_reviews"}).columns \
        == ["review_count", "rating"]
    assert C.prefixed(df, "user_", ["rating"]).columns == ["user_total_reviews", "rating"]
    assert C.align_columns(df, ["rating", "other"]).first().asDict() == {"rating": 2.0, "other": 0.0}
    hot = C.one_hot(df.withColumn("c", F.lit(1)), "c", [0, 1]).first()
    assert (hot.c_0, hot.c_1) == (0.0, 1.0)
    assert C.feature_names(df.withColumn("spam_rate", F.lit(0.1)), ["rating", "total_reviews"]) == ["total_reviews", "rating"]


def test_text_of_white_space_only_is_not_usable(spark):
    rows = [(1, "\n" * 12, 1), (2, "\t \n" * 6, 1), (3, "\n a text that is long enough \t", 1), (4, " NaN ", 0), (5, None, 1)]
    df = spark.createDataFrame(rows, "id int, text string, y int")
    assert [tuple(r) for r in C.usable_text_filter(df, "text", "y").collect()] == [(3, "a text that is long enough", 1)]
