"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.session import store

# What counts as white space between words.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
GAP_CHARACTERS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; no word: an empty array."""
    inner = F.btrim(text, F.lit(GAP_CHARACTERS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def running_totals(df: DataFrame, order: list[str], sums: list[str], name: str) -> DataFrame:
    """Add ``cum_<c>``, the sum of ``c`` up to and including a row in the order
    of the ``order`` columns over the whole table.

    The table is dealt out by ranges of the order and written once; each range
    is added up by itself, on top of the totals of the ranges before it. No
    task sees more than one range. Rows equal in all ``order`` columns may
    change places, so give enough columns to tell different rows apart.
    """
    dealt = store(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
        .select("_range", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in sums])
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        dealt.join(before, "_range")
        .withColumns({f"cum_{c}": F.sum(c).over(inside) + F.col(f"_b_{c}") for c in sums})
        .drop("_range", *[f"_b_{c}" for c in sums])
    )
