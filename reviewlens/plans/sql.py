"""SQL building blocks: the review view and the profiles as table expressions."""

from __future__ import annotations

_DATE = "CAST(l_shipdate AS DATE)"
_RATING = "CAST(ceil(l_quantity / 10) AS INTEGER)"

DOC_FEATURES = ("doc_features", r"""
  SELECT doc_id,
         CAST(length(text) AS INTEGER) AS review_length,
         CAST(len(regexp_split_to_array(text, '\s+')) AS INTEGER) AS word_count,
         CAST(length(text) - length(replace(text, '!', '')) AS INTEGER) AS exclamation_count,
         CAST(length(text) - length(replace(text, '?', '')) AS INTEGER) AS question_count,
         CASE WHEN length(text) > 0 THEN
           CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS DOUBLE) / length(text)
         ELSE 0.0 END AS capital_ratio,
         CAST(length(regexp_replace(text, '\s+', '', 'g')) AS DOUBLE)
           / len(regexp_split_to_array(text, '\s+')) AS avg_word_length
  FROM documents""")

CORE = ("core", f"""
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, {_DATE}) AS review_id,
         CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey + 1000000 ELSE o_custkey END AS user_id,
         l_suppkey AS prod_id,
         {_RATING} AS rating,
         CASE WHEN l_returnflag = 'R' AND {_RATING} IN (1, 5) THEN -1 ELSE 1 END AS label,
         {_DATE} AS date,
         (l_orderkey * 7 + l_linenumber) % (SELECT count(*) FROM documents) AS doc_id,
         round((l_discount + l_tax) / 0.2, 2) AS raw_score,
         round(l_quantity / 50, 2) AS score2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

REVIEWS = ("reviews", """
  SELECT core.*, CASE WHEN label = -1 THEN 1 ELSE 0 END AS is_spam,
         date AS review_date,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(weekofyear(date) AS INTEGER) AS week_number,
         CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
         strftime(date, '%Y-%m') AS year_month,
         s_name AS business_name,
         review_length, word_count, exclamation_count, question_count, capital_ratio,
         avg_word_length
  FROM core LEFT JOIN doc_features USING (doc_id)
  LEFT JOIN supplier ON s_suppkey = prod_id""")

PROFILES = ("profiles", """
  SELECT b.*, b.spam_count / CAST(b.review_count AS DOUBLE) AS spam_rate,
         CAST(last_review_date - first_review_date AS INTEGER) AS tenure_days,
         CASE WHEN last_review_date > first_review_date
              THEN review_count / ((last_review_date - first_review_date) / CAST(7 AS DOUBLE))
              ELSE CAST(review_count AS DOUBLE) END AS reviews_per_week,
         top_seller / CAST(review_count AS DOUBLE) AS max_seller_fraction,
         coalesce(mean_gap, 0.0) AS avg_days_between_reviews,
         CAST(top_burst AS INTEGER) AS burst_score,
         entropy AS rating_entropy
  FROM (SELECT user_id, count(*) AS review_count, CAST(sum(is_spam) AS BIGINT) AS spam_count,
               avg(rating) AS avg_rating, coalesce(stddev_samp(rating), 0.0) AS rating_std,
               avg(review_length) AS avg_review_length, avg(word_count) AS avg_word_count,
               min(review_date) AS first_review_date, max(review_date) AS last_review_date,
               count(DISTINCT prod_id) AS unique_sellers
        FROM reviews GROUP BY user_id) b
  JOIN (SELECT user_id, max(n) AS top_seller FROM
          (SELECT user_id, prod_id, count(*) AS n FROM reviews GROUP BY user_id, prod_id)
        GROUP BY user_id) USING (user_id)
  LEFT JOIN (SELECT user_id, avg(gap) AS mean_gap FROM
          (SELECT user_id, review_date - lag(review_date) OVER
             (PARTITION BY user_id ORDER BY review_date, review_id) AS gap FROM reviews)
        GROUP BY user_id) USING (user_id)
  JOIN (SELECT user_id, max(n) AS top_burst FROM
          (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY review_date
             RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS n FROM reviews)
        GROUP BY user_id) USING (user_id)
  JOIN (SELECT user_id, -sum(p * log2(p)) AS entropy FROM
          (SELECT user_id, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS p
           FROM reviews GROUP BY user_id, rating)
        GROUP BY user_id) USING (user_id)""")

SELLERS = ("sellers", """
  SELECT s.*, spam_reviews / CAST(total_reviews AS DOUBLE) AS spam_rate,
         CASE WHEN active_days > 0 THEN total_reviews / (active_days / CAST(7 AS DOUBLE))
              ELSE CAST(total_reviews AS DOUBLE) END AS review_velocity,
         suspicious / CAST(unique_reviewers AS DOUBLE) AS suspicious_reviewer_fraction
  FROM (SELECT reviews.prod_id, min(business_name) AS business_name, count(*) AS total_reviews,
               CAST(sum(is_spam) AS BIGINT) AS spam_reviews,
               count(DISTINCT user_id) AS unique_reviewers, avg(rating) AS avg_rating,
               coalesce(stddev_samp(rating), 0.0) AS rating_std,
               CAST(max(review_date) - min(review_date) AS INTEGER) AS active_days,
               count(DISTINCT CASE WHEN profiles.spam_rate > 0.5 THEN user_id END) AS suspicious
        FROM reviews LEFT JOIN profiles USING (user_id) GROUP BY reviews.prod_id) s""")

CUBE_INPUT = ("cube_input", """
  SELECT reviews.*, rating AS rating_int, tenure_days, reviews_per_week, max_seller_fraction,
         CASE WHEN tenure_days < 30 THEN 'new' WHEN tenure_days < 90 THEN 'moderate'
              WHEN tenure_days < 365 THEN 'established' ELSE 'veteran' END AS tenure_bin
  FROM reviews LEFT JOIN profiles USING (user_id)""")

SCORED = ("scored", """
  SELECT review_id, user_id, prod_id, rating, date,
         CASE WHEN label = -1 THEN 1 ELSE 0 END AS y,
         greatest(0.0, least(1.0, raw_score)) AS score, score2
  FROM core""")

BASKETS = ("baskets", """
  SELECT user_id, spam_rate,
         CASE WHEN review_count <= 2 THEN 'review_count=Low' WHEN review_count <= 10
              THEN 'review_count=Medium' ELSE 'review_count=High' END AS i1,
         CASE WHEN tenure_days < 30 THEN 'tenure=new' WHEN tenure_days <= 180 THEN 'tenure=moderate'
              WHEN tenure_days <= 365 THEN 'tenure=established' ELSE 'tenure=veteran' END AS i2,
         CASE WHEN max_seller_fraction < 0.5 THEN 'seller_conc=Low' ELSE 'seller_conc=High' END AS i3,
         CASE WHEN burst_score <= 2 THEN 'burst=Normal' ELSE 'burst=Bursty' END AS i4
  FROM profiles""")

SUBSETS = ("subsets", """
  SELECT list_sort([x FOR x IN [i1, i2, i3, i4] IF x IS NOT NULL]) AS items,
         count(*) AS freq, sum(spam_rate) AS spam
  FROM baskets GROUP BY CUBE (i1, i2, i3, i4)
  HAVING len([x FOR x IN [i1, i2, i3, i4] IF x IS NOT NULL]) > 0""")

ITEMSETS = ("itemsets", """
  SELECT items, freq, freq / CAST((SELECT count(*) FROM baskets) AS DOUBLE) AS support,
         CAST(len(items) AS INTEGER) AS size
  FROM subsets WHERE freq / CAST((SELECT count(*) FROM baskets) AS DOUBLE) >= 0.05""")

RULES = ("rules", """
  SELECT a.items AS antecedents, c.items AS consequents, f.support AS support,
         f.support / a.support AS confidence, f.support / a.support / c.support AS lift
  FROM itemsets f
  JOIN itemsets a ON a.size < f.size AND len(list_intersect(a.items, f.items)) = a.size
  JOIN itemsets c ON c.items = list_sort([x FOR x IN f.items IF NOT list_contains(a.items, x)])
  WHERE f.support / a.support / c.support >= {lift}""")

RATED_RULES = ("rated_rules", """
  SELECT rules.*, coalesce(s.spam / s.freq, 0.0) AS antecedent_spam_rate
  FROM rules LEFT JOIN subsets s ON s.items = antecedents""")


def rules(lift: float) -> tuple[str, str]:
    return RULES[0], RULES[1].format(lift=lift)


L1 = [DOC_FEATURES, CORE, REVIEWS]
WITH_PROFILES = [*L1, PROFILES]
WITH_SELLERS = [*WITH_PROFILES, SELLERS]
WITH_CUBES = [*WITH_PROFILES, CUBE_INPUT]
WITH_BASKETS = [*WITH_PROFILES, BASKETS]
WITH_ITEMSETS = [*WITH_BASKETS, SUBSETS, ITEMSETS]


def with_rules(lift: float) -> list[tuple[str, str]]:
    return [*WITH_ITEMSETS, rules(lift), RATED_RULES]
