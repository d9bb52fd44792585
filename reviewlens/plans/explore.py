"""OLAP, exploratory and data-quality queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from reviewlens.operators import explore as E
from reviewlens.operators import olap as O
from reviewlens.operators import quality as Q
from reviewlens.operators import reviewers as RW
from reviewlens.operators import sellers as SL
from reviewlens.plans.registry import query, r, rounded, with_ctes
from reviewlens.plans.sql import CORE, L1, WITH_CUBES, WITH_PROFILES, WITH_SELLERS
from reviewlens.sources import fixture
from reviewlens.sources.fixture import table

_MEASURES = f"""count(*) AS total_reviews, CAST(sum(is_spam) AS BIGINT) AS spam_count,
    {r('avg(is_spam)', 'spam_rate')}, {r('avg(review_length)', 'avg_review_length', 5)},
    {r('avg(reviews_per_week)', 'avg_reviewer_velocity')},
    {r('avg(max_seller_fraction)', 'avg_max_seller_fraction')}"""


def _reported(df):
    return rounded(df.withColumn("avg_review_length", F.round("avg_review_length", 5)))


def _cube_input(spark, sf):
    reviews = fixture.reviews(spark, sf)
    return O.cube_input(reviews, RW.reviewer_profile(reviews))


for _name, _dims in {
    "cube_time_x_rating": "year_month, rating_int",
    "cube_tenure_x_rating": "tenure_bin, rating_int",
    "cube_time_x_tenure": "year_month, tenure_bin",
    "cube_full_3d": "year_month, rating_int, tenure_bin",
}.items():
    def _cube(spark, sf, build=getattr(O, _name)):
        return _reported(build(_cube_input(spark, sf)))

    query(_name, with_ctes(
        WITH_CUBES, f"SELECT {_dims}, {_MEASURES} FROM cube_input GROUP BY {_dims}"
    ))(_cube)


@query("cube_all", with_ctes(WITH_CUBES, f"""
    SELECT year_month, rating_int, tenure_bin,
           CAST(grouping(year_month, rating_int, tenure_bin) AS INTEGER) AS grouping_mask, {_MEASURES}
    FROM cube_input GROUP BY CUBE (year_month, rating_int, tenure_bin)"""))
def cube_all(spark, sf):
    return _reported(O.cube_all(_cube_input(spark, sf)))


@query("spam_rate_by_tenure", with_ctes(WITH_CUBES, f"""
    SELECT tenure_bin, count(*) AS total_reviews, {r('avg(is_spam)', 'spam_rate')}
    FROM cube_input GROUP BY tenure_bin"""))
def spam_rate_by_tenure(spark, sf):
    return rounded(O.spam_rate_by_tenure(_cube_input(spark, sf)))


@query("dataset_summary", with_ctes([CORE], """
    SELECT count(*) AS total_reviews, count(DISTINCT user_id) AS unique_reviewers,
           count(DISTINCT prod_id) AS unique_products, min(date) AS first_date, max(date) AS last_date,
           CAST(count(*) - count(rating) AS BIGINT) AS null_rating,
           CAST(count(*) - count(label) AS BIGINT) AS null_label,
           CAST(count(*) - count(date) AS BIGINT) AS null_date
    FROM core"""))
def dataset_summary(spark, sf):
    return E.dataset_summary(fixture.reviews(spark, sf))


@query("class_balance", with_ctes(L1, f"""
    SELECT is_spam, count(*) AS n_reviews,
           {r('count(*) * 100.0 / (SELECT count(*) FROM reviews)', 'pct')}
    FROM reviews GROUP BY is_spam"""))
def class_balance(spark, sf):
    return rounded(E.class_balance(fixture.reviews(spark, sf)))


def _rates(keys: str, source: str = "reviews") -> str:
    return f"""SELECT {keys}, count(*) AS n_reviews, {r('avg(is_spam)', 'spam_rate')}
    FROM {source} GROUP BY ALL"""


@query("monthly_spam_rate", with_ctes(L1, f"""
    SELECT year_month, n_reviews, round(rate, 6) AS spam_rate,
           round((SELECT avg(m) FROM (SELECT avg(is_spam) AS m FROM reviews GROUP BY year_month)), 6)
             AS mean_of_months
    FROM (SELECT year_month, count(*) AS n_reviews, avg(is_spam) AS rate FROM reviews
          GROUP BY year_month)"""))
def monthly_spam_rate(spark, sf):
    return rounded(E.monthly_spam_rate(fixture.reviews(spark, sf)))


@query("monthly_volume", with_ctes(L1, """
    SELECT year_month, CAST(sum(1 - is_spam) AS BIGINT) AS legitimate,
           CAST(sum(is_spam) AS BIGINT) AS spam
    FROM reviews GROUP BY year_month"""))
def monthly_volume(spark, sf):
    return E.monthly_volume(fixture.reviews(spark, sf))


@query("weekly_burst_reviewers", with_ctes(L1, f"""
    SELECT CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS is_burst_reviewer,
           count(DISTINCT reviews.user_id) AS n_reviewers, count(*) AS n_reviews,
           {r('avg(is_spam)', 'spam_rate')}
    FROM reviews LEFT JOIN
      (SELECT DISTINCT user_id FROM reviews GROUP BY user_id, date_trunc('week', review_date)
       HAVING count(*) >= 3) b USING (user_id)
    GROUP BY 1"""))
def weekly_burst_reviewers(spark, sf):
    return rounded(E.weekly_burst_reviewers(fixture.reviews(spark, sf)))


@query("dow_spam_rate", with_ctes(L1, _rates("dayname(review_date) AS day_name")))
def dow_spam_rate(spark, sf):
    return rounded(E.dow_spam_rate(fixture.reviews(spark, sf)))


@query("rating_by_label", with_ctes(L1, """
    SELECT is_spam, rating, count(*) AS n_reviews FROM reviews GROUP BY is_spam, rating"""))
def rating_by_label(spark, sf):
    return E.rating_by_label(fixture.reviews(spark, sf))


@query("spam_rate_by_rating", with_ctes(L1, _rates("rating")))
def spam_rate_by_rating(spark, sf):
    return rounded(E.spam_rate_by_rating(fixture.reviews(spark, sf)))


def _described(value: str) -> str:
    quarters = ", ".join(
        r(f"quantile_cont({value}, {q})", f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)
    )
    return f"""count({value}) AS n_rows, {r(f'avg({value})', 'mean')},
        {r(f'stddev_samp({value})', 'std')}, {r(f'min({value})', 'min')}, {quarters},
        {r(f'max({value})', 'max')}"""


_IS_SPAMMER = "CAST(spam_rate > 0.5 AS INTEGER) AS is_spammer"


@query("reviewer_activity", with_ctes(WITH_PROFILES, f"""
    SELECT {_IS_SPAMMER}, {_described('tenure_days')} FROM profiles GROUP BY 1"""))
def reviewer_activity(spark, sf):
    return rounded(E.reviewer_activity(fixture.reviews(spark, sf)))


@query("concentration_by_class", with_ctes(WITH_PROFILES, f"""
    SELECT {_IS_SPAMMER}, {_described('max_seller_fraction')} FROM profiles GROUP BY 1"""))
def concentration_by_class(spark, sf):
    reviews = fixture.reviews(spark, sf)
    return rounded(E.concentration_by_class(reviews, RW.reviewer_rates(reviews)))


_TEXT = ["review_length", "word_count", "exclamation_count", "question_count", "capital_ratio",
         "avg_word_length"]


@query("text_stats_by_label", with_ctes(L1, f"""
    SELECT label, {', '.join(r(f'avg({c})', f'mean_{c}', 5) for c in _TEXT)}
    FROM reviews GROUP BY label"""))
def text_stats_by_label(spark, sf):
    return rounded(E.text_stats_by_label(fixture.reviews(spark, sf)), 5)


CORRELATED = ["review_count", "avg_rating", "rating_std", "avg_review_length", "tenure_days",
              "max_seller_fraction", "burst_score", "rating_entropy", "spam_rate"]


@query("feature_correlation", with_ctes(WITH_PROFILES, " UNION ALL ".join(
    f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r,
        CAST(abs(corr({a}, {b})) > 0.85 AS INTEGER) AS is_high FROM profiles"""
    for a, b in combinations(CORRELATED, 2)
)))
def feature_correlation(spark, sf):
    profiles = RW.reviewer_profile(fixture.reviews(spark, sf))
    return rounded(E.correlations(profiles, CORRELATED))


def _histogram(name: str, low: float, high: float, bins: int) -> str:
    width = (high - low) / bins
    place = f"""CAST(least({bins - 1}, floor((greatest(CAST({low} AS DOUBLE),
        least(CAST({high} AS DOUBLE), {name})) - {low}) / CAST({width!r} AS DOUBLE))) AS INTEGER)"""
    return f"""SELECT '{name}' AS feature, {place} AS bin,
        {r(f'{low} + {place} * CAST({width!r} AS DOUBLE)', 'bin_start')}, count(*) AS n,
        {r(f'count(*) / (SELECT count(*) FROM profiles) / CAST({width!r} AS DOUBLE)', 'density')}
        FROM profiles GROUP BY 2"""


@query("feature_histograms", with_ctes(WITH_PROFILES, " UNION ALL ".join(
    _histogram(n, *b) for n, b in E.PROFILE_HISTOGRAMS.items()
)))
def feature_histograms(spark, sf):
    profiles = RW.reviewer_profile(fixture.reviews(spark, sf))
    return rounded(E.histograms(profiles, E.PROFILE_HISTOGRAMS))


def _check(name: str, expected: str, actual: str) -> str:
    return f"""SELECT '{name}' AS "check", CAST({expected} AS VARCHAR) AS expected,
        CAST({actual} AS VARCHAR) AS actual, CAST(({expected}) = ({actual}) AS INTEGER) AS passed"""


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_ROW_CHECKS = [
    _check("rows_reviews", "(SELECT count(*) FROM lineitem)", "(SELECT count(*) FROM core)"),
    _check("rows_reviewers", "(SELECT count(DISTINCT user_id) FROM core)",
           "(SELECT count(*) FROM profiles)"),
    _check("rows_sellers", "(SELECT count(*) FROM supplier)", "(SELECT count(*) FROM sellers)"),
]
_NULL_CHECKS = [
    _check(f"nulls_{c}", "CAST(0 AS BIGINT)", f"(SELECT count(*) - count({c}) FROM reviews)")
    for c in Q.KEY_COLUMNS
]
_RANGE_CHECKS = [
    _check(f"range_{c}", "CAST(0 AS BIGINT)", f"(SELECT count(*) FROM {t} WHERE {bad})")
    for c, t, bad in [
        ("tenure_days", "profiles", "tenure_days < 0"),
        ("spam_rate", "profiles", "spam_rate < 0 OR spam_rate > 1"),
        ("max_seller_fraction", "profiles", "max_seller_fraction < 0 OR max_seller_fraction > 1"),
        ("review_count", "profiles", "review_count < 1"),
        ("rating", "reviews", "rating < 1 OR rating > 5"),
    ]
] + [
    _check("first_date", "'1995-01-02'", "CAST((SELECT min(date) FROM core) AS VARCHAR)"),
    _check("last_date", "'2001-11-04'", "CAST((SELECT max(date) FROM core) AS VARCHAR)"),
]
_DOMAIN_CHECKS = [
    _check("labels_outside", "CAST(0 AS BIGINT)",
           "(SELECT count(*) FROM core WHERE label NOT IN (-1, 1))"),
    _check("labels_present", "CAST(2 AS BIGINT)", "(SELECT count(DISTINCT label) FROM core)"),
    _check("ratings_outside", "CAST(0 AS BIGINT)",
           "(SELECT count(*) FROM core WHERE rating NOT IN (1, 2, 3, 4, 5))"),
    _check("ratings_present", "CAST(5 AS BIGINT)", "(SELECT count(DISTINCT rating) FROM core)"),
    _check("rows_kept", "(SELECT count(*) FROM core)", "(SELECT count(*) FROM reviews)"),
]
EXPECTED_SPAM_RATE = 0.132
_FIRST, _LAST = "1995-01-02", "2001-11-04"


def _counts(spark, sf, reviews, profiles):
    sellers = SL.seller_profile(reviews, profiles)
    expected = {
        "reviews": table(spark, sf, "lineitem").agg(F.count(F.lit(1))).scalar(),
        "reviewers": reviews.select("user_id").distinct().agg(F.count(F.lit(1))).scalar(),
        "sellers": table(spark, sf, "supplier").agg(F.count(F.lit(1))).scalar(),
    }
    return Q.dq_row_counts(reviews, profiles, sellers, expected)


@query("dq_row_counts", with_ctes(WITH_SELLERS, _union(_ROW_CHECKS)))
def dq_row_counts(spark, sf):
    reviews = fixture.reviews(spark, sf)
    return _counts(spark, sf, reviews, RW.reviewer_profile(reviews))


@query("dq_spam_rate", with_ctes(L1, f"""
    SELECT 'spam_rate' AS "check", CAST({EXPECTED_SPAM_RATE} AS DOUBLE) AS expected,
           {r('avg(is_spam)', 'actual')},
           CAST(abs(avg(is_spam) - {EXPECTED_SPAM_RATE}) < 0.005 AS INTEGER) AS passed
    FROM reviews"""))
def dq_spam_rate(spark, sf):
    return rounded(Q.dq_spam_rate(fixture.reviews(spark, sf), EXPECTED_SPAM_RATE))


@query("dq_nulls", with_ctes(L1, _union(_NULL_CHECKS)))
def dq_nulls(spark, sf):
    return Q.dq_nulls(fixture.reviews(spark, sf))


@query("dq_ranges", with_ctes(WITH_PROFILES, _union(_RANGE_CHECKS)))
def dq_ranges(spark, sf):
    reviews = fixture.reviews(spark, sf)
    return Q.dq_ranges(reviews, RW.reviewer_profile(reviews), _FIRST, _LAST)


@query("dq_domains", with_ctes(L1, _union(_DOMAIN_CHECKS)))
def dq_domains(spark, sf):
    return Q.dq_domains(fixture.reviews(spark, sf), fixture.metadata(spark, sf))


@query("dq_report", with_ctes(WITH_SELLERS, _union([
    f"""SELECT 'spam_rate' AS "check", '{EXPECTED_SPAM_RATE}' AS expected,
        CAST((SELECT round(avg(is_spam), 4) FROM reviews) AS VARCHAR) AS actual,
        CAST(abs((SELECT avg(is_spam) FROM reviews) - {EXPECTED_SPAM_RATE}) < 0.005 AS INTEGER)
          AS passed""",
    *_ROW_CHECKS, *_NULL_CHECKS, *_RANGE_CHECKS, *_DOMAIN_CHECKS,
])))
def dq_report(spark, sf):
    reviews = fixture.reviews(spark, sf)
    profiles = RW.reviewer_profile(reviews)
    return Q.dq_report(
        [
            _counts(spark, sf, reviews, profiles),
            Q.dq_nulls(reviews),
            Q.dq_ranges(reviews, profiles, _FIRST, _LAST),
            Q.dq_domains(reviews, fixture.metadata(spark, sf)),
        ],
        Q.dq_spam_rate(reviews, EXPECTED_SPAM_RATE),
    )
