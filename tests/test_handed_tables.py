"""What handed tables leave on disk, and lookups that need no shuffle."""

import os

import pandas as pd
from pyspark.sql import functions as F

from reviewlens import session
from reviewlens.operators import fusion as T
from reviewlens.operators import reviewers as RW
from reviewlens.operators import sellers as SL
from reviewlens.plans import learned
from reviewlens.sources import files, fixture


def test_tables_kept_on_the_way_go_when_the_handed_table_is_written(spark):
    kept = []

    def build():
        first = session.store(spark.range(10).withColumn("k", F.col("id") % 3), "first")
        kept.extend(first.inputFiles())
        inner = session.hand_over(spark, "test", "inner", lambda: session.store(first.groupBy("k").count(), "second"))
        return inner.filter("count > 3")

    assert session.hand_over(spark, "test", "outer", build).count() == 1
    assert session.hand_over(spark, "test", "inner", build).count() == 3
    assert kept and not any(os.path.exists(f.removeprefix("file:").replace("//", "/")) for f in kept)
    alone = session.store(spark.range(3), "alone")
    assert alone.count() == 3


def _shuffles(spark):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    return set(tracker.shuffleStatuses().keys().mkString(",").split(",")) - {""}


def test_shuffle_files_go_with_the_write(spark):
    before = _shuffles(spark)
    session.store(spark.range(1000).groupBy(F.col("id") % 7).count(), "counts")
    assert not _shuffles(spark) - before
    session.hand_over(spark, "test", "counts", lambda: spark.range(1000).groupBy(F.col("id") % 7).count())
    assert not _shuffles(spark) - before


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    before = _shuffles(spark)
    counts = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    files.write_table(counts, f"{tmp_path}/plain")
    files.write_table(counts, f"{tmp_path}/parted", ["k"])
    files.write_csv(counts, f"{tmp_path}/csv")
    assert not _shuffles(spark) - before
    assert spark.read.parquet(f"{tmp_path}/parted").count() == spark.read.parquet(f"{tmp_path}/plain").count() == 7


def _tables(spark, folder):
    def put(name, frame, schema):
        spark.createDataFrame(pd.DataFrame(frame), schema).write.parquet(f"{folder}/{name}.parquet")

    put("orders", {"o_orderkey": [1, 2, 3, 4], "o_custkey": [7, 7, 8, 9]}, "o_orderkey long, o_custkey long")
    put("documents", {"doc_id": [0, 1, 1, 2], "text": ["a b", "C d!", "C d!", None]}, "doc_id long, text string")
    put("supplier", {"s_suppkey": [5, 6, 6], "s_name": ["five", "six", "six again"]}, "s_suppkey long, s_name string")
    lines = [(1, 5), (1, 6), (2, 5), (2, 5), (3, 6), (4, 4)]
    dates = pd.to_datetime(["1995-01-01", "1995-01-02", "1995-02-01", "1995-02-01", "1995-03-01", "1995-03-05"])
    put("lineitem", {
        "l_orderkey": [o for o, _ in lines], "l_partkey": [1] * 6, "l_suppkey": [s for _, s in lines],
        "l_linenumber": [1, 2, 1, 2, 1, 1], "l_quantity": [3.0, 12.0, 25.0, 25.0, 50.0, 41.0], "l_discount": [0.1] * 6,
        "l_tax": [0.0] * 6, "l_returnflag": ["R", "N", "R", "R", "R", "N"], "l_shipdate": dates,
    }, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
       "l_tax double, l_returnflag string, l_shipdate timestamp")


def test_small_lookups_are_sent_and_large_ones_joined_by_key(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = fixture.reviews(spark, str(tmp_path))
        assert sent._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") == 2
        monkeypatch.setattr(fixture, "SENT_ROWS", 2)
        joined = fixture.reviews(spark, str(tmp_path))
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()
        assert sorted(map(str, sent.collect())) == sorted(map(str, joined.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_profiles_with_null_users_and_products(spark):
    rows = [(1, 5, 4, 1, 10, 2, "2020-01-01"), (1, 5, 2, 0, 20, 3, "2020-01-03"), (1, 6, None, 0, None, None, None),
            (1, None, 5, 0, 30, 4, "2020-02-01"), (None, 5, 3, 1, 7, 1, "2020-01-01"), (None, None, 3, 0, 9, 1, "2020-01-09")]
    reviews = spark.createDataFrame(
        rows, "user_id long, prod_id long, rating int, is_spam int, review_length int, word_count int, review_date string"
    ).withColumn("review_date", F.to_date("review_date"))
    got = {r.user_id: r for r in RW.reviewer_profile(reviews).collect()}
    assert set(got) == {1, None}
    one, none = got[1], got[None]
    assert (one.review_count, one.spam_count, one.unique_sellers, one.max_seller_fraction) == (4, 1, 2, 0.5)
    assert (one.avg_rating, one.avg_review_length, one.tenure_days, one.burst_score) == (11 / 3, 20.0, 31, 2)
    assert (none.review_count, none.unique_sellers, none.max_seller_fraction, none.tenure_days) == (2, 1, 0.5, 8)
    assert none.burst_score == 1 and none.avg_days_between_reviews == 8.0


def test_cluster_profile_reads_the_handed_profiles(spark, tmp_path):
    _tables(spark, tmp_path)
    learned.cluster_profile(spark, str(tmp_path)).collect()
    assert any(scope == str(tmp_path) and name == "reviewer_profiles" for _, scope, name in session._handed_over)


def _fused(spark, ids, with_own):
    """The feature table over reviews of two documents, one of them with two scores."""
    columns = {c: F.lit(1) for c in T.REVIEW_FEATURES}
    reviews = spark.createDataFrame(
        [(r, 1 + i % 2, 5, i % 2, i % 3) for i, r in enumerate(ids)], "review_id string, user_id long, prod_id long, is_spam int, doc_id long"
    ).withColumns(columns)
    people = spark.createDataFrame([(1,), (2,)], "user_id long").withColumns({c: F.lit(2.0) for c in T.REVIEWER_FEATURES})
    rules = people.select("user_id", *[F.lit(0.5).alias(c) for c in T.RULE_FEATURES])
    scores = spark.createDataFrame([(0, 0.25), (1, 0.5), (1, 0.75)], f"doc_id long, {T.TEXT_SCORE} double")
    if with_own:
        reviews, by_review = T.scored_reviews(reviews, scores)
    else:
        by_review = reviews.join(scores, "doc_id").select("review_id", T.TEXT_SCORE)
    return T.feature_table(reviews, people, rules, text_scores=by_review), by_review


def test_text_scores_of_unique_reviews_need_no_join_by_review(spark):
    unique, repeated, unnamed = list("abcdefg"), list("aabcdde"), ["a", "b", None, "c"]
    for ids, local in ((unique, True), (repeated, False), (unnamed, False)):
        got, by_review = _fused(spark, ids, True)
        want, _ = _fused(spark, ids, False)
        assert (by_review is None) == local
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert ("hashpartitioning(review_id" in got._jdf.queryExecution().executedPlan().toString()) <= (not local)


def test_sellers_with_null_users_and_products(spark):
    rows = [(5, 1, 4, 1, "2020-01-01"), (5, 1, 2, 0, "2020-01-08"), (5, 2, None, 0, None), (5, None, 3, 1, "2020-01-02"),
            (None, 2, 5, 0, "2020-01-01")]
    reviews = spark.createDataFrame(
        rows, "prod_id long, user_id long, rating int, is_spam int, review_date string"
    ).withColumn("review_date", F.to_date("review_date")).withColumn("business_name", F.lit("x"))
    reviewers = spark.createDataFrame([(1, 0.9), (2, 0.1)], "user_id long, spam_rate double")
    sellers = SL.seller_profile(reviews, reviewers)
    got = {r.prod_id: r for r in sellers.collect()}
    assert set(got) == {5, None}
    five = got[5]
    assert (five.total_reviews, five.spam_reviews, five.unique_reviewers, five.active_days) == (4, 2, 2, 7)
    assert (five.avg_rating, five.rating_std, five.suspicious_reviewer_fraction) == (3.0, 1.0, 0.5)
    assert (got[None].total_reviews, got[None].rating_std, got[None].suspicious_reviewer_fraction) == (1, 0.0, 0.0)
    plan = sellers._jdf.queryExecution().executedPlan().toString()  # only keys are dealt out by product and reviewer
    assert not any("user_id" in line.split("functions=")[0] and "sum(" in line for line in plan.split("\n"))
