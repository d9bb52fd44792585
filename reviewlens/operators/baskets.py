"""Behaviour baskets, frequent itemsets and association rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import bin_tenure

MIN_SUPPORT = 0.05
MIN_LIFT = 1.2
SPAM_RATE_CUTOFF = 0.20
TOP_RULES = 50
MAX_LISTED_ITEMS = 20  # longer baskets have too many subsets to list; use mine_itemsets


def basket_items() -> Column:
    """Sorted items of one reviewer; a missing measure leaves its item out."""
    count, days = F.col("review_count"), F.col("tenure_days")
    share, burst = F.col("max_seller_fraction"), F.col("burst_score")
    items = F.array(
        F.when(count <= 2, "review_count=Low").when(count <= 10, "review_count=Medium")
        .when(count > 10, "review_count=High"),
        F.concat(F.lit("tenure="), bin_tenure(days, "basket")),
        F.when(share < 0.5, "seller_conc=Low").when(share >= 0.5, "seller_conc=High"),
        F.when(burst <= 2, "burst=Normal").when(burst > 2, "burst=Bursty"),
    )
    return F.array_sort(F.array_compact(items))


def encode_baskets(reviewers: DataFrame) -> DataFrame:
    return reviewers.select("user_id", basket_items().alias("basket"), "spam_rate")


def basket_totals(baskets: DataFrame) -> DataFrame:
    """Distinct baskets with their reviewers and summed spam rate: a few dozen rows
    however many reviewers there are."""
    return baskets.groupBy("basket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("spam_rate").alias("spam")
    )


def basket_item_stats(baskets: DataFrame) -> DataFrame:
    """Count and mean spam rate per item."""
    return (
        basket_totals(baskets)
        .select(F.explode("basket").alias("item"), "n", "spam")
        .groupBy("item")
        .agg(F.sum("n").alias("count"), (F.sum("spam") / F.sum("n")).alias("spam_rate_mean"))
    )


def _subsets(items: Column, size: Column) -> Column:
    """Every non-empty subset: bit b of the mask decides about item b."""
    too_long = F.raise_error(F.lit(f"a basket has more than {MAX_LISTED_ITEMS} items: use mine_itemsets"))
    size = F.when(size <= MAX_LISTED_ITEMS, size).otherwise(too_long.cast("int"))
    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), size) - 1).cast("int"))
    return F.transform(
        masks,
        lambda mask: F.filter(
            items, lambda _, b: F.call_function("shiftright", mask, b).bitwiseAND(F.lit(1)) == 1
        ),
    )


def subset_totals(baskets: DataFrame) -> DataFrame:
    """Reviewers and spam rate of everyone whose basket contains the itemset."""
    return (
        basket_totals(baskets).filter(F.size("basket") > 0)
        .select(F.explode(_subsets(F.col("basket"), F.size("basket"))).alias("items"), "n", "spam")
        .groupBy("items")
        .agg(F.sum("n").alias("freq"), F.sum("spam").alias("spam"))
    )


def frequent_itemsets(baskets: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Itemsets with support of at least ``min_support``.

    Behaviour baskets are short and few are distinct, so subsets of distinct
    baskets are counted. ``mine_itemsets`` takes baskets of any length.
    """
    total = baskets.agg(F.count(F.lit(1))).scalar()
    return (
        subset_totals(baskets)
        .select("items", "freq", (F.col("freq") / total).alias("support"),
                F.size("items").alias("size"))
        .filter(F.col("support") >= min_support)
    )


def mine_itemsets(baskets: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """The same by FP-growth, for baskets of any length."""
    model = FPGrowth(itemsCol="basket", minSupport=min_support).fit(baskets)
    total = baskets.agg(F.count(F.lit(1))).scalar()
    return model.freqItemsets.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / total).alias("support"),
        F.size("items").alias("size"),
    )


def association_rules(itemsets: DataFrame, min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules for every way to cut an itemset in two, kept from ``min_lift`` up."""
    supports = itemsets.select("items", "support")
    cuts = (
        itemsets.filter(F.col("size") > 1)
        .select("items", "support", F.explode(_subsets(F.col("items"), F.col("size"))).alias("antecedents"))
        .filter(F.size("antecedents") < F.size("items"))
        .withColumn("consequents", F.array_sort(F.array_except("items", "antecedents")))
    )
    left = supports.select(F.col("items").alias("antecedents"), F.col("support").alias("s_a"))
    right = supports.select(F.col("items").alias("consequents"), F.col("support").alias("s_c"))
    confidence = F.col("support") / F.col("s_a")
    return (
        cuts.join(left, "antecedents").join(right, "consequents")
        .select("antecedents", "consequents", "support", confidence.alias("confidence"),
                (confidence / F.col("s_c")).alias("lift"))
        .filter(F.col("lift") >= min_lift)
    )


def rule_spam_rate(rules: DataFrame, baskets: DataFrame) -> DataFrame:
    """Add the mean spam rate of reviewers whose basket holds the antecedent.

    Containment becomes an equality: the antecedent is looked up among the
    subsets of the distinct baskets.
    """
    rates = subset_totals(baskets).select(
        F.col("items").alias("antecedents"),
        (F.col("spam") / F.col("freq")).alias("antecedent_spam_rate"),
    )
    return rules.join(rates, "antecedents", "left").withColumn(
        "antecedent_spam_rate", F.coalesce("antecedent_spam_rate", F.lit(0.0))
    )


def spam_rules(rules: DataFrame, cutoff: float = SPAM_RATE_CUTOFF) -> DataFrame:
    return rules.filter(F.col("antecedent_spam_rate") > cutoff).orderBy(
        F.desc("antecedent_spam_rate"), "antecedents", "consequents"
    )


def rule_weight(rules: DataFrame, top: int = TOP_RULES) -> DataFrame:
    """The heaviest rules: support x confidence x lift x antecedent spam rate."""
    weight = (
        F.col("support") * F.col("confidence") * F.col("lift") * F.col("antecedent_spam_rate")
    )
    return (
        rules.withColumn("rule_weight", weight)
        # equal weights up to rounding noise fall back to the rule's items
        .orderBy(F.desc(F.round("rule_weight", 12)), "antecedents", "consequents")
        .limit(top)
    )


def _rule_list(rules: DataFrame) -> Column:
    return rules.agg(F.collect_list(F.struct("antecedents", "rule_weight"))).scalar()


def _matches(items: Column):
    return lambda r: F.size(F.array_except(r["antecedents"], items)) == 0


def basket_rule_features(distinct_baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """Rule measures per distinct basket; ``rules`` is the bounded top list."""
    items = F.col("basket")

    def partial(r: Column) -> Column:
        overlap = F.size(F.array_intersect(r["antecedents"], items))
        return overlap / F.size(r["antecedents"]) * r["rule_weight"]

    scored = distinct_baskets.withColumn("_rules", _rule_list(rules))
    hits = F.filter("_rules", _matches(items))
    partials = F.transform("_rules", partial)
    total = F.aggregate(partials, F.lit(0.0), lambda acc, x: acc + x)
    usable = (F.size("_rules") > 0) & (F.size(items) > 0)
    weights = F.transform(hits, lambda r: r["rule_weight"])
    return scored.select(
        "basket",
        F.size(hits).alias("l2_rule_match_count"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("l2_rule_max_weight"),
        F.when(usable, total / F.size("_rules")).otherwise(F.lit(0.0)).alias("l2_rule_partial_mean"),
        F.when(usable, F.array_max(partials)).otherwise(F.lit(0.0)).alias("l2_rule_partial_max"),
    )


def rule_features(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """Four rule measures per reviewer, worked out once per distinct basket.

    The lookup holds one row per distinct basket (48 for the four attributes),
    which is the bound that allows the broadcast.
    """
    lookup = basket_rule_features(baskets.select("basket").distinct(), rules)
    return baskets.select("user_id", "basket").join(F.broadcast(lookup), "basket").drop("basket")


def rule_flag(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """1 where the basket holds the antecedent of any rule."""
    antecedents = rules.agg(F.collect_set("antecedents")).scalar()
    matched = F.exists("_rules", lambda a: F.size(F.array_except(a, F.col("basket"))) == 0)
    lookup = (
        baskets.select("basket").distinct()
        .withColumn("_rules", antecedents)
        .select("basket", matched.cast("int").alias("rule_flag"))
    )
    return baskets.select("user_id", "basket").join(F.broadcast(lookup), "basket").select(
        "user_id", "rule_flag"
    )
