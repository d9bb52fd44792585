"""Global ordering work without a single-task window.

Each helper first aggregates equal values, deals the distinct values out by
ranges, and adds up whole ranges before it opens a window inside each. The
number of ranges follows the session's shuffle partitions, so none grows with
the data alone, and the answers are exact whatever the borders.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import store

ROWS_PER_DEAL = 4_096  # rows that share the leading digits of a hash, about


def _beside(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join on columns in which a null equals a null."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in columns})
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(named, same).drop(*[f"_r_{c}" for c in columns])


def summed_counts(
    counts: DataFrame, order: str, sums: list[str], by: list[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``cum_<c>``: the sum of ``c`` over rows up to and including this one.

    ``counts`` holds one row per (by..., order) value and should be a stored
    table, as it is read twice. Rows are ordered by ``order`` within each ``by``
    combination; a null in ``by`` is a combination of its own.
    """
    by = list(by)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    dealt = store(
        counts.repartitionByRange(*[F.col(c).asc() for c in by], direction)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = (
        Window.partitionBy(*by, F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        dealt.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
        .select(
            *by, "_range",
            *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in sums],
        )
    )
    inside = (
        Window.partitionBy(*by, "_range").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        _beside(dealt, before, [*by, "_range"])
        .withColumns({f"cum_{c}": F.sum(c).over(inside) + F.col(f"_b_{c}") for c in sums})
        .drop("_range", *[f"_b_{c}" for c in sums])
    )


def quantiles(
    df: DataFrame, value: str, probabilities: list[float], by: list[str] = (),
    accuracy: int | None = None, weight: str | None = None,
) -> DataFrame:
    """One row per ``by`` group with ``n`` and ``q``, an array of quantiles.

    Exact with linear interpolation; with ``accuracy`` set, approximate. A row
    counts ``weight`` times in the exact form.
    """
    by = list(by)
    df = df.filter(F.col(value).isNotNull())
    if accuracy is not None:
        return df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(value, probabilities, accuracy).cast("array<double>").alias("q"),
        )
    copies = F.sum(weight) if weight else F.count(F.lit(1))
    counts = store(df.groupBy(*by, value).agg(copies.cast("long").alias("n")), "counts")
    summed = summed_counts(counts, value, ["n"], by)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
    if by:
        placed = _beside(summed, totals, by)
    else:
        placed = summed.withColumn("_total", totals.scalar())
    after, first = F.col("cum_n"), F.col("cum_n") - F.col("n")

    def value_at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position < after), F.col(value).cast("double")))

    picks = []
    for i, p in enumerate(probabilities):
        spot = (F.col("_total") - 1) * F.lit(float(p))
        picks += [
            value_at(F.floor(spot)).alias(f"_lo{i}"),
            value_at(F.ceil(spot)).alias(f"_hi{i}"),
            F.max(spot - F.floor(spot)).alias(f"_f{i}"),
        ]
    picked = placed.groupBy(*by).agg(F.sum("n").alias("n"), *picks)
    return picked.select(
        *by, "n",
        F.array(*[
            F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")
            for i in range(len(probabilities))
        ]).alias("q"),
    )


def medians(df: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """Rows (feature, median) over all rows of the named columns."""
    long = df.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                for c in columns
            ])
        ).alias("e")
    ).select("e.feature", "e.value")
    return quantiles(long, "value", [0.5], ["feature"], accuracy).select(
        "feature", F.col("q")[0].alias("median")
    )


def medians_and_deviations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (feature, median, deviation): the median absolute deviation as well.

    ``df`` is read once: both are taken from the counts of distinct values.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("e")).select("e.feature", "e.value").filter(F.col("value").isNotNull())
    counts = store(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    middle = store(
        quantiles(counts, "value", [0.5], ["feature"], weight="n").select("feature", F.col("q")[0].alias("median")),
        "medians",
    )
    apart = counts.join(F.broadcast(middle), "feature").select(  # one row per column
        "feature", F.abs(F.col("value") - F.col("median")).alias("value"), "n"
    )
    deviations = quantiles(apart, "value", [0.5], ["feature"], weight="n")
    return middle.join(deviations.select("feature", F.col("q")[0].alias("deviation")), "feature")


def describe_by(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of one column per group."""
    moments = df.groupBy(*by).agg(
        F.count(value).alias("n_rows"),
        F.avg(value).alias("mean"),
        F.stddev(value).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    parts = quantiles(df, value, [0.25, 0.5, 0.75], by)
    return _beside(moments, parts.drop("n"), list(by)).select(
        *by, "n_rows", "mean", "std", "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max",
    )


def deal(df: DataFrame, key: str, strata: list[str], hands: int, seed: int, out: str) -> DataFrame:
    """Deal rows round-robin into ``hands`` per stratum, in the order of a hash.

    Same answer as ``row_number() over (partition by strata order by hash)``,
    but a stratum of any size is split by the leading digits of the hash, their
    number following the row count. A null stratum is one of its own.
    """
    digits = max(1, math.ceil(math.log(max(1, df.count() / ROWS_PER_DEAL), 16)))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    hashed = df.withColumn("_h", order).withColumn("_d", F.substring("_h", 1, digits))
    over_digits = (
        Window.partitionBy(*strata).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        hashed.groupBy(*strata, "_d").agg(F.count(F.lit(1)).alias("_n"))
        .select(*strata, "_d", F.coalesce(F.sum("_n").over(over_digits), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*strata, "_d").orderBy("_h", key)
    return (
        _beside(hashed.withColumn("_r", F.row_number().over(inside)), offsets, [*strata, "_d"])
        .withColumn(out, ((F.col("_r") + F.col("_before") - 1) % hands).cast("int"))
        .drop("_h", "_d", "_r", "_before")
    )
