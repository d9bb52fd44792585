"""Itemsets against FP-growth, rules against brute force, rule features by hand."""

from itertools import combinations

import pytest

from reviewlens.operators import baskets as B


@pytest.fixture(scope="module")
def encoded(spark):
    people = [
        (i, 1 + (i * 7) % 14, (i * 53) % 500, ((i * 3) % 10) / 10, 1 + i % 4, (i % 5) / 10)
        for i in range(200)
    ]
    return B.encode_baskets(spark.createDataFrame(
        people, "user_id int, review_count int, tenure_days int, max_seller_fraction double, "
                "burst_score int, spam_rate double",
    )).cache()


def test_missing_measure_leaves_item_out(spark):
    df = spark.createDataFrame(
        [(1, None, 10, 0.5, 2, 0.0)],
        "user_id int, review_count int, tenure_days int, max_seller_fraction double, "
        "burst_score int, spam_rate double",
    )
    assert B.encode_baskets(df).first().basket == ["burst=Normal", "seller_conc=High", "tenure=new"]


def test_itemsets_equal_fp_growth(encoded):
    def listed(df):
        return {(tuple(r["items"]), r.freq) for r in df.collect()}

    assert listed(B.frequent_itemsets(encoded, 0.05)) == listed(B.mine_itemsets(encoded, 0.05))


def test_rules_equal_brute_force(encoded):
    rows = [(frozenset(r.basket), r.spam_rate) for r in encoded.collect()]
    itemsets = B.frequent_itemsets(encoded, 0.05)
    support = {frozenset(r["items"]): r.support for r in itemsets.collect()}
    want = {}
    for whole, s in support.items():
        for n in range(1, len(whole)):
            for left in map(frozenset, combinations(sorted(whole), n)):
                lift = s / support[left] / support[whole - left]
                if lift >= 1.05:
                    hit = [rate for b, rate in rows if left <= b]
                    want[(left, whole - left)] = (lift, sum(hit) / len(hit))
    rules = B.rule_spam_rate(B.association_rules(itemsets, 1.05), encoded)
    got = {
        (frozenset(r.antecedents), frozenset(r.consequents)): (r.lift, r.antecedent_spam_rate)
        for r in rules.collect()
    }
    assert got.keys() == want.keys() and got
    for key, value in want.items():
        assert got[key] == pytest.approx(value)


def test_rule_features_by_hand(spark):
    baskets = spark.createDataFrame(
        [(1, ["a", "b"]), (2, ["c"]), (3, [])], "user_id int, basket array<string>")
    rules = spark.createDataFrame(
        [(["a"], ["x"], 0.2), (["a", "c"], ["x"], 0.8)],
        "antecedents array<string>, consequents array<string>, rule_weight double")
    got = {r.user_id: r for r in B.rule_features(baskets, rules).collect()}
    assert got[1].l2_rule_match_count == 1 and got[1].l2_rule_max_weight == 0.2
    assert got[1].l2_rule_partial_mean == pytest.approx((0.2 + 0.4) / 2)
    assert got[1].l2_rule_partial_max == pytest.approx(0.4)
    assert got[2].l2_rule_match_count == 0 and got[2].l2_rule_partial_max == pytest.approx(0.4)
    assert got[3].l2_rule_partial_mean == 0.0
    none = B.rule_features(baskets, rules.filter("false")).collect()
    assert {r.l2_rule_partial_mean for r in none} == {0.0}
    flags = {r.user_id: r.rule_flag for r in B.rule_flag(baskets, rules).collect()}
    assert flags == {1: 1, 2: 0, 3: 0}


def test_spam_rules_use_the_cutoff(spark):
    rules = spark.createDataFrame(
        [(["a"], ["b"], 0.2), (["c"], ["d"], 0.21)],
        "antecedents array<string>, consequents array<string>, antecedent_spam_rate double")
    assert [r.antecedents for r in B.spam_rules(rules).collect()] == [["c"]]
