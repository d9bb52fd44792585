"""Review, reviewer and seller queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions import columns as C
from reviewlens.operators import reviewers as RW
from reviewlens.operators import reviews as RV
from reviewlens.operators import sellers as SL
from reviewlens.plans.registry import query, r, rounded, with_ctes
from reviewlens.plans.sql import CORE, DOC_FEATURES, L1, WITH_PROFILES, WITH_SELLERS
from reviewlens.sources import fixture
from reviewlens.sources.fixture import table

REVIEW_COLUMNS = [
    "review_id", "is_spam", "review_date", "year", "month", "week_number", "day_of_week",
    "year_month", "review_length", "word_count", "exclamation_count", "question_count",
    "capital_ratio", "avg_word_length",
]


@query("spam_flag", with_ctes([CORE], """
    SELECT review_id, CASE WHEN label = -1 THEN 1 ELSE 0 END AS is_spam FROM core"""))
def spam_flag(spark, sf):
    return fixture.raw_reviews(spark, sf).select("review_id", C.spam_flag().alias("is_spam"))


_TRIMMED = f"trim(text, '{C.WHITE_SPACE}')"


@query("usable_text_filter", f"""
    SELECT doc_id, {_TRIMMED} AS text, toxic FROM documents JOIN labels USING (doc_id)
    WHERE length({_TRIMMED}) > 10 AND lower({_TRIMMED}) <> 'nan' AND toxic IS NOT NULL""")
def usable_text_filter(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return C.usable_text_filter(docs.select("doc_id", "text", "toxic"), "text", "toxic")


@query("align_columns", with_ctes([DOC_FEATURES], f"""
    SELECT doc_id, CAST(word_count AS DOUBLE) AS word_count, CAST(0 AS DOUBLE) AS rating,
           {r('capital_ratio', 'capital_ratio')} FROM doc_features"""))
def align_columns(spark, sf):
    docs = table(spark, sf, "documents")
    measured = docs.select("doc_id", *[c.alias(n) for n, c in C.text_measures(F.col("text")).items()])
    return rounded(C.align_columns(measured, ["word_count", "rating", "capital_ratio"], ["doc_id"]))


@query("review_features", with_ctes(L1, f"""
    SELECT review_id, is_spam, review_date, year, month, week_number, day_of_week, year_month,
           review_length, word_count, exclamation_count, question_count,
           {r('capital_ratio', 'capital_ratio')}, {r('avg_word_length', 'avg_word_length')}
    FROM reviews"""))
def review_features(spark, sf):
    # the view applies the same expressions, the text ones once per shared document
    return rounded(fixture.reviews(spark, sf).select(*REVIEW_COLUMNS))


@query("review_master", with_ctes([CORE], """
    SELECT user_id, prod_id, date, label, c.text AS review_text, s_name AS business_name
    FROM core
    LEFT JOIN (SELECT user_id, prod_id, date, text
               FROM (SELECT user_id, prod_id, date, doc_id,
                            row_number() OVER (PARTITION BY user_id, prod_id, date
                                               ORDER BY review_id) AS n FROM core)
               JOIN documents USING (doc_id) WHERE n = 1) c USING (user_id, prod_id, date)
    LEFT JOIN supplier ON s_suppkey = prod_id"""))
def review_master(spark, sf):
    raw = fixture.raw_reviews(spark, sf)
    content = RV.dedup_reviews(
        raw.select("user_id", "prod_id", "date", "review_id", "review_text"),
        ["review_id"], ("user_id", "prod_id", "date"),
    )
    return RV.review_master(
        raw.select("user_id", "prod_id", "date", "label"), content, fixture.product_map(spark, sf)
    ).select("user_id", "prod_id", "date", "label", "review_text", "business_name")


@query("dedup_reviews", with_ctes([CORE], """
    SELECT user_id, prod_id, date, label, review_id, rating
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, prod_id, date, label
                                       ORDER BY review_id) AS n FROM core)
    WHERE n = 1"""))
def dedup_reviews(spark, sf):
    raw = fixture.raw_reviews(spark, sf).select(
        "user_id", "prod_id", "date", "label", "review_id", "rating"
    )
    return RV.dedup_reviews(raw, ["review_id"])


@query("review_gaps", with_ctes([CORE], """
    SELECT user_id, review_id, date AS review_date,
           CAST(date - lag(date) OVER (PARTITION BY user_id ORDER BY date, review_id) AS INTEGER)
             AS days_since_prev
    FROM core"""))
def review_gaps(spark, sf):
    return RV.review_gaps(fixture.reviews(spark, sf))


@query("burst_window", with_ctes([CORE], """
    SELECT DISTINCT user_id, date AS review_date,
           count(*) OVER (PARTITION BY user_id, date) AS n_reviews,
           count(*) OVER (PARTITION BY user_id ORDER BY date
             RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS window_count
    FROM core"""))
def burst_window(spark, sf):
    return RV.burst_window(fixture.reviews(spark, sf))


@query("reviewer_base", with_ctes(WITH_PROFILES, f"""
    SELECT user_id, review_count, spam_count, {r('avg_rating', 'avg_rating')},
           CASE WHEN review_count > 1 THEN round(rating_std, 6) END AS rating_std,
           {r('avg_review_length', 'avg_review_length')}, {r('avg_word_count', 'avg_word_count')},
           first_review_date, last_review_date, unique_sellers
    FROM profiles"""))
def reviewer_base(spark, sf):
    return rounded(RW.reviewer_base(fixture.reviews(spark, sf)))


@query("reviewer_rates", with_ctes(WITH_PROFILES, f"""
    SELECT user_id, {r('spam_rate', 'spam_rate')}, tenure_days,
           {r('reviews_per_week', 'reviews_per_week')}, {r('rating_std', 'rating_std')}
    FROM profiles"""))
def reviewer_rates(spark, sf):
    return rounded(RW.reviewer_rates(fixture.reviews(spark, sf)))


for _name in ("max_seller_fraction", "avg_days_between_reviews", "rating_entropy"):
    def _one_measure(spark, sf, measure=getattr(RW, _name)):
        return rounded(measure(fixture.reviews(spark, sf)))

    query(_name, with_ctes(WITH_PROFILES, f"SELECT user_id, {r(_name, _name)} FROM profiles"))(
        _one_measure
    )


@query("burst_score", with_ctes(WITH_PROFILES, "SELECT user_id, burst_score FROM profiles"))
def burst_score(spark, sf):
    return RW.burst_score(fixture.reviews(spark, sf))


_PROFILE_DOUBLES = [
    "spam_rate", "avg_rating", "rating_std", "avg_review_length", "avg_word_count",
    "reviews_per_week", "max_seller_fraction", "avg_days_between_reviews", "rating_entropy",
]


@query("reviewer_profile", with_ctes(WITH_PROFILES, f"""
    SELECT user_id, review_count, spam_count, first_review_date, last_review_date, unique_sellers,
           tenure_days, burst_score, {', '.join(r(c, c) for c in _PROFILE_DOUBLES)}
    FROM profiles"""))
def reviewer_profile(spark, sf):
    return rounded(RW.reviewer_profile(fixture.reviews(spark, sf)))


_SELLER_DOUBLES = [
    "spam_rate", "avg_rating", "rating_std", "review_velocity", "suspicious_reviewer_fraction"
]


@query("seller_profile", with_ctes(WITH_SELLERS, f"""
    SELECT prod_id, business_name, total_reviews, spam_reviews, unique_reviewers, active_days,
           {', '.join(r(c, c) for c in _SELLER_DOUBLES)}
    FROM sellers"""))
def seller_profile(spark, sf):
    reviews = fixture.reviews(spark, sf)
    return rounded(SL.seller_profile(reviews, RW.reviewer_rates(reviews)))


@query("suspicious_reviewer_fraction", with_ctes(WITH_SELLERS, f"""
    SELECT prod_id, {r('suspicious_reviewer_fraction', 'suspicious_reviewer_fraction')}
    FROM sellers"""))
def suspicious_reviewer_fraction(spark, sf):
    reviews = fixture.reviews(spark, sf)
    return rounded(SL.suspicious_reviewer_fraction(reviews, RW.reviewer_rates(reviews)))


@query("reviewer_features_eda", with_ctes(WITH_PROFILES, f"""
    SELECT user_id, p.review_count AS total_reviews, {r('p.avg_rating', 'mean_rating')},
           {r('p.rating_std', 'rating_std')}, {r('p.spam_rate', 'spam_rate')},
           {r('p.max_seller_fraction', 'concentration')},
           {r('e.words', 'mean_review_length')}, {r('e.bangs', 'mean_exclamations')},
           {r('e.caps', 'mean_caps_ratio')}
    FROM profiles p JOIN (SELECT user_id, avg(word_count) AS words, avg(exclamation_count) AS bangs,
                                 avg(capital_ratio) AS caps FROM reviews GROUP BY user_id) e
      USING (user_id)"""))
def reviewer_features_eda(spark, sf):
    return rounded(RW.reviewer_features_eda(fixture.reviews(spark, sf)))
