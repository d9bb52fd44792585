"""Reviews as a view over the test tables: lineitem joined to orders.

A line of an order plays the review, its customer the reviewer, its supplier
the seller, and a document its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions.columns import date_parts, spam_flag, text_measures


SENT_ROWS = 400_000  # rows of a narrow table that is sent to all tasks at most, about 40 MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sent(narrow: DataFrame, rows: int) -> DataFrame:
    """A lookup table of so many narrow rows for a join: sent to all tasks while
    small, so that the reviews need not be dealt out anew; joined by key beyond."""
    return F.broadcast(narrow) if rows <= SENT_ROWS else narrow


def _rating() -> Column:
    return F.ceil(F.col("l_quantity") / 10).cast("int")


def _core(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n_docs = table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    date = F.col("l_shipdate").cast("date")
    rating = _rating()
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws(
            "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", date.cast("string")
        ).alias("review_id"),
        F.when(F.col("l_orderkey") % 3 == 0, F.col("l_orderkey") + 1_000_000)
        .otherwise(F.col("o_custkey")).alias("user_id"),
        F.col("l_suppkey").alias("prod_id"),
        rating.alias("rating"),
        F.when((F.col("l_returnflag") == "R") & rating.isin(1, 5), -1).otherwise(1).alias("label"),
        date.alias("date"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % n_docs).alias("doc_id"),
        F.round((F.col("l_discount") + F.col("l_tax")) / 0.2, 2).alias("raw_score"),
        F.round(F.col("l_quantity") / 50, 2).alias("score2"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user, product, rating, label, date: the raw fact table."""
    return _core(spark, sf_dir).select("user_id", "prod_id", "rating", "label", "date")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with their texts, before any feature is computed."""
    texts = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review_text"))
    return _core(spark, sf_dir).join(texts, "doc_id", "left").select(
        "review_id", "user_id", "prod_id", "rating", "label", "date", "review_text"
    )


def product_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("business_name"), F.col("s_suppkey").alias("numeric_id")
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched reviews. Many reviews share a document, so the text measures are
    taken once per document and only the numbers are joined."""
    documents = table(spark, sf_dir, "documents")
    measures = documents.select(
        "doc_id", *[c.alias(n) for n, c in text_measures(F.col("text")).items()]
    )
    names = product_map(spark, sf_dir).withColumnRenamed("numeric_id", "prod_id")
    return (
        _core(spark, sf_dir)
        .join(sent(measures, documents.count()), "doc_id", "left")
        .join(sent(names, names.count()), "prod_id", "left")
        .withColumn("is_spam", spam_flag("label"))
        .withColumns(date_parts(F.col("date")))
    )


def clipped_score() -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("raw_score")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with two given scores in [0, 1] and the label y."""
    return _core(spark, sf_dir).select(
        "review_id", "user_id", "prod_id", "rating", "date",
        spam_flag("label").alias("y"), clipped_score().alias("score"), "score2",
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that carry a label; y = toxic."""
    return table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id"
    ).select("doc_id", "text", "source", F.col("toxic").alias("y"))


def given_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and text_spam_prob, played by the toxic label."""
    labels = table(spark, sf_dir, "labels")
    return sent(labels.select("doc_id", F.col("toxic").cast("double").alias("text_spam_prob")), labels.count())
