"""Categories to numbers by a fitted dictionary, stored beside the model it serves.

The dictionary is a table, so a column of very many values is no problem, and it
is read again whenever new rows are scored. A value that was not in the training
rows gets the code 0; a null is a value like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.ordered import summed_counts
from reviewlens.session import store

UNSEEN = 0


def fit_encoder(train: DataFrame, columns: list[str], min_rows: int = 1) -> DataFrame:
    """(column, value, code, n): codes from 1 on in the order of the values, null
    first; values of fewer than ``min_rows`` rows are left to the unseen ones."""
    listed = train.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ])))
    counted = listed.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
    # every text gets a letter in front, so that a null, as the empty text, is the first and no other's equal
    named = counted.withColumns({
        "one": F.lit(1).cast("long"), "spelled": F.coalesce(F.concat(F.lit("v"), "value"), F.lit("")),
    })
    return summed_counts(store(named, "values"), "spelled", ["one"], ["column"]).select(
        "column", "value", F.col("cum_one").cast("int").alias("code"), "n"
    )


def save_encoder(encoder: DataFrame, path: str) -> str:
    encoder.write.mode("overwrite").parquet(path)
    return path


def load_encoder(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def encode(rows: DataFrame, encoder: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_code`` for every column; values the dictionary lacks get 0."""
    for c in columns:
        known = encoder.filter(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("code").alias(f"{c}_code")
        )
        same = F.col(f"`{c}`").cast("string").eqNullSafe(F.col("_value"))
        rows = rows.join(known, same, "left").drop("_value").withColumn(
            f"{c}_code", F.coalesce(f"{c}_code", F.lit(UNSEEN))
        )
    return rows

