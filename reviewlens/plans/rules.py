"""Basket and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators import baskets as B
from reviewlens.operators import reviewers as RW
from reviewlens.plans.registry import query, r, rounded, with_ctes
from reviewlens.plans.sql import WITH_BASKETS, WITH_ITEMSETS, with_rules
from reviewlens.session import hand_over
from reviewlens.sources import fixture

# spam in the test tables depends on the rating only, so rules stay near the mean
CUTOFF = 0.13


def profiles(spark, sf):
    """Reviewer profiles as the first stage hands them on."""
    return hand_over(
        spark, sf, "reviewer_profiles", lambda: RW.reviewer_profile(fixture.reviews(spark, sf))
    )


def baskets(spark, sf):
    return B.encode_baskets(RW.reviewer_profile(fixture.reviews(spark, sf)))


def rules(encoded):
    return B.rule_spam_rate(B.association_rules(B.frequent_itemsets(encoded)), encoded)


def handed_rules(spark, sf):
    """Spam rules as the mining stage hands them on."""
    return hand_over(
        spark, sf, "spam_rules",
        lambda: B.spam_rules(rules(B.encode_baskets(profiles(spark, sf))), CUTOFF),
    )


@query("encode_baskets", with_ctes(WITH_BASKETS, f"""
    SELECT user_id, array_to_string(list_sort([i1, i2, i3, i4]), '|') AS basket,
           {r('spam_rate', 'spam_rate')}
    FROM baskets"""))
def encode_baskets(spark, sf):
    return rounded(baskets(spark, sf).withColumn("basket", F.array_join("basket", "|")))


@query("basket_item_stats", with_ctes(WITH_BASKETS, f"""
    SELECT item, count(*) AS count, {r('avg(spam_rate)', 'spam_rate_mean')}
    FROM (SELECT unnest([i1, i2, i3, i4]) AS item, spam_rate FROM baskets) GROUP BY item"""))
def basket_item_stats(spark, sf):
    return rounded(B.basket_item_stats(baskets(spark, sf)))


@query("frequent_itemsets", with_ctes(WITH_ITEMSETS, f"""
    SELECT array_to_string(items, '|') AS items, freq, {r('support', 'support')}, size
    FROM itemsets"""))
def frequent_itemsets(spark, sf):
    found = B.frequent_itemsets(baskets(spark, sf))
    return rounded(found.withColumn("items", F.array_join("items", "|")))


def _flat(df):
    return df.withColumns({
        "antecedents": F.array_join("antecedents", "|"),
        "consequents": F.array_join("consequents", "|"),
    })


_SIDES = "array_to_string(antecedents, '|') AS antecedents, array_to_string(consequents, '|') AS consequents"
_STRENGTH = f"{r('support', 'support')}, {r('confidence', 'confidence')}, {r('lift', 'lift')}"
_RATE = r("antecedent_spam_rate", "antecedent_spam_rate")


@query("association_rules", with_ctes(with_rules(1.2), f"SELECT {_SIDES}, {_STRENGTH} FROM rules"))
def association_rules(spark, sf):
    return rounded(_flat(B.association_rules(B.frequent_itemsets(baskets(spark, sf)))))


@query("rule_spam_rate", with_ctes(
    with_rules(1.2), f"SELECT {_SIDES}, {_STRENGTH}, {_RATE} FROM rated_rules"))
def rule_spam_rate(spark, sf):
    return rounded(_flat(rules(baskets(spark, sf))))


@query("spam_rules", with_ctes(with_rules(1.2), f"""
    SELECT {_SIDES}, {_STRENGTH}, {_RATE} FROM rated_rules
    WHERE antecedent_spam_rate > {CUTOFF}"""))
def spam_rules(spark, sf):
    return rounded(_flat(B.spam_rules(rules(baskets(spark, sf)), CUTOFF)))


_TOP = ("top_rules", f"""
    SELECT *, support * confidence * lift * antecedent_spam_rate AS rule_weight
    FROM rated_rules WHERE antecedent_spam_rate > {CUTOFF}
    ORDER BY round(support * confidence * lift * antecedent_spam_rate, 12) DESC,
             antecedents, consequents LIMIT 50""")


@query("rule_weight", with_ctes([*with_rules(1.2), _TOP], f"""
    SELECT {_SIDES}, {_STRENGTH}, {_RATE}, {r('rule_weight', 'rule_weight')} FROM top_rules"""))
def rule_weight(spark, sf):
    return rounded(_flat(B.rule_weight(B.spam_rules(rules(baskets(spark, sf)), CUTOFF))))


# the four measures unrounded, for queries that join them
_MEASURES = ("rule_measures", """
  SELECT user_id, CAST(count(CASE WHEN hit THEN 1 END) AS INTEGER) AS l2_rule_match_count,
         coalesce(max(CASE WHEN hit THEN rule_weight END), 0.0) AS l2_rule_max_weight,
         avg(share * rule_weight) AS l2_rule_partial_mean,
         max(share * rule_weight) AS l2_rule_partial_max
  FROM (SELECT user_id, rule_weight,
               len(list_intersect(antecedents, [i1, i2, i3, i4])) = len(antecedents) AS hit,
               len(list_intersect(antecedents, [i1, i2, i3, i4]))
                 / CAST(len(antecedents) AS DOUBLE) AS share
        FROM baskets, top_rules)
  GROUP BY user_id""")
WITH_RULE_MEASURES = [*with_rules(1.2), _TOP, _MEASURES]


def handed_rule_features(spark, sf):
    """Rule measures of every reviewer, by the rules the mining stage hands on."""
    return B.rule_features(B.encode_baskets(profiles(spark, sf)), B.rule_weight(handed_rules(spark, sf)))


@query("rule_features", with_ctes([*with_rules(1.2), _TOP], """
    SELECT user_id,
           CAST(count(CASE WHEN hit THEN 1 END) AS INTEGER) AS l2_rule_match_count,
           round(coalesce(max(CASE WHEN hit THEN rule_weight END), 0.0), 6) AS l2_rule_max_weight,
           round(avg(share * rule_weight), 6) AS l2_rule_partial_mean,
           round(max(share * rule_weight), 6) AS l2_rule_partial_max
    FROM (SELECT user_id, rule_weight,
                 len(list_intersect(antecedents, [i1, i2, i3, i4])) = len(antecedents) AS hit,
                 len(list_intersect(antecedents, [i1, i2, i3, i4]))
                   / CAST(len(antecedents) AS DOUBLE) AS share
          FROM baskets, top_rules)
    GROUP BY user_id"""))
def rule_features(spark, sf):
    encoded = B.encode_baskets(profiles(spark, sf))
    return rounded(B.rule_features(encoded, B.rule_weight(handed_rules(spark, sf))))


@query("rule_flag", with_ctes([*with_rules(1.2)], f"""
    SELECT user_id, CAST(max(CAST(len(list_intersect(antecedents, [i1, i2, i3, i4]))
                                  = len(antecedents) AS INTEGER)) AS INTEGER) AS rule_flag
    FROM baskets, (SELECT * FROM rated_rules WHERE antecedent_spam_rate > {CUTOFF})
    GROUP BY user_id"""))
def rule_flag(spark, sf):
    return B.rule_flag(B.encode_baskets(profiles(spark, sf)), handed_rules(spark, sf))
