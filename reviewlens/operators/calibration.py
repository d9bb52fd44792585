"""Calibration of scores: Platt scaling, isotonic regression, and their report.

Both are fitted on counts per distinct score. Platt scaling has two parameters;
every Newton step is one aggregate of five sums. Isotonic regression is the lower
hull of the summed counts: every range of scores pools its own violators into a
stack of blocks, written once. Stacks of neighbouring ranges are then merged by
the bridges of the common hull: a stretch of several ranges is cut at the block
end that lies deepest below its chord, and where none does, the stretch is one
pooled block. A round is one pass over the stored stacks and reports one row per
open stretch, of which there are fewer than ranges; blocks never meet in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions.columns import logit
from reviewlens.functions.ordered import summed_counts
from reviewlens.operators import metrics as M
from reviewlens.session import store

NEWTON_STEPS = 50
NEWTON_TOLERANCE = 1e-12
_EXACT = "decimal(18,0)"


# ---- Platt scaling -------------------------------------------------------------------------

def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def fit_platt(rows: DataFrame, score_column: str = "score") -> tuple[float, float]:
    """(slope, intercept) of the logistic regression of y on the logit of the score.

    Newton's method; a step is halved while it does not raise the likelihood, so
    separable scores end after ``NEWTON_STEPS`` with finite parameters. One class
    alone, or no rows, gives (0, logit of the share) or (0, 0).
    """
    counts = store(M.score_counts(rows, score_column), "scores").withColumn("x", logit(F.col("score")))
    pos, n = counts.agg(F.sum("pos"), F.sum(F.col("pos") + F.col("neg"))).first()
    if not n:
        return 0.0, 0.0
    if pos in (0, n):
        return 0.0, logit_of(pos / n)

    def sums(a: float, b: float):
        z = F.lit(a) * F.col("x") + F.lit(b)
        p, m = sigmoid(z), F.col("pos") + F.col("neg")
        likelihood = -F.col("pos") * F.log1p(F.exp(-z)) - F.col("neg") * (z + F.log1p(F.exp(-z)))
        slope, bend = F.col("pos") - m * p, m * p * (1 - p)
        return counts.agg(
            F.sum(likelihood), F.sum(slope * F.col("x")), F.sum(slope), F.sum(bend * F.col("x") * F.col("x")),
            F.sum(bend * F.col("x")), F.sum(bend),
        ).first()

    a, b = 0.0, math.log(pos / (n - pos))
    here = sums(a, b)
    for _ in range(NEWTON_STEPS):
        _, ga, gb, haa, hab, hbb = here
        det = haa * hbb - hab * hab
        if det <= 0:
            break  # a single score, or likelihood flat: nothing more to learn
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        there, scale = sums(a + da, b + db), 1.0
        while there[0] < here[0] - 1e-9 * abs(here[0]) and scale > 1e-6:
            scale /= 2
            there = sums(a + scale * da, b + scale * db)
        a, b, here = a + scale * da, b + scale * db, there
        if max(abs(da), abs(db)) < NEWTON_TOLERANCE * (1 + abs(a) + abs(b)):
            break
    return a, b


def logit_of(p: float, margin: float = 1e-6) -> float:
    p = min(max(p, margin), 1 - margin)
    return math.log(p / (1 - p))


def platt_column(parameters: tuple[float, float], score_column: str = "score") -> Column:
    slope, intercept = parameters
    return sigmoid(F.lit(slope) * logit(F.col(score_column)) + F.lit(intercept))


def platt(rows: DataFrame, keep: list[str], score_column: str = "score") -> DataFrame:
    """Fitted on half 0, applied to half 1."""
    parameters = fit_platt(rows.filter(F.col("half") == 0), score_column)
    return rows.filter(F.col("half") == 1).select(*keep, platt_column(parameters, score_column).alias("platt"))


# ---- isotonic regression -------------------------------------------------------------------

def _pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The stack of one range: neighbouring blocks whose means fall are pooled."""
    lows, highs, pos, n = [], [], [], []
    at = None
    for batch in batches:
        for at, score, p, m in zip(*(batch[c].tolist() for c in ("range", "score", "pos", "n")), strict=True):
            low = score
            while pos and pos[-1] * m >= p * n[-1]:
                low = lows.pop()
                highs.pop()
                p, m = p + pos.pop(), m + n.pop()
            lows.append(low)
            highs.append(score)
            pos.append(p)
            n.append(m)
    if at is not None:
        last = np.zeros(len(n), bool)
        last[-1] = True
        yield pd.DataFrame({
            "range": at, "lo": lows, "hi": highs, "p": np.cumsum(np.array(pos, np.int64)),
            "n": np.cumsum(np.array(n, np.int64)), "last": last,
        })


def pooled_ranges(counts: DataFrame) -> DataFrame:
    """(range, lo, hi, pos, n, p, m, last), stored: blocks with rising means
    inside a range, their counts, and the counts summed up to their end. Ranges
    are numbered from 0 without gaps."""
    dealt = counts.select("score", "pos", (F.col("pos") + F.col("neg")).alias("n")).repartitionByRange("score")
    local = store(
        dealt.withColumn("range", F.spark_partition_id()).sortWithinPartitions("score")
        .mapInPandas(_pooled, "range int, lo double, hi double, p long, n long, last boolean"), "pooled",
    )
    ranges = Window.partitionBy(F.lit(0)).orderBy("range")  # one row per range
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    offsets = local.filter("last").select(
        "range", (F.row_number().over(ranges) - 1).alias("place"),
        F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("m0"),
    )
    inside = Window.partitionBy("range").orderBy("lo")
    steps = local.withColumns({
        "pos": F.col("p") - F.coalesce(F.lag("p").over(inside), F.lit(0)),
        "cnt": F.col("n") - F.coalesce(F.lag("n").over(inside), F.lit(0)),
    })
    return store(
        steps.join(F.broadcast(offsets), "range").select(
            F.col("place").alias("range"), "lo", "hi", "pos", F.col("cnt").alias("n"),
            (F.col("p") + F.col("p0")).alias("p"), (F.col("n") + F.col("m0")).alias("m"), "last",
        ), "blocks",
    )


def _beside_blocks(blocks: DataFrame, stretches: list[tuple], how: str) -> DataFrame:
    """Blocks beside the stretch (id, first and last range, summed counts at its
    start and end) that holds their end; there are fewer stretches than ranges."""
    named = blocks.sparkSession.createDataFrame(
        stretches, "id int, first int, final int, p0 long, m0 long, p1 long, m1 long"
    ).select("id", "p0", "m0", "p1", "m1", F.explode(F.sequence("first", "final")).alias("at"))
    held = (F.col("range") == F.col("at")) & (F.col("m") > F.col("m0")) & (F.col("m") <= F.col("m1"))
    return blocks.join(F.broadcast(named), held, how)


def bridges(blocks: DataFrame) -> list[tuple]:
    """The stretches over several ranges that are one block of the whole fit."""
    ends = blocks.filter("last").agg(F.max("range"), F.max("p"), F.max("m")).first()
    if ends[0] is None:
        return []
    open_, done = [(0, ends[0], 0, 0, ends[1], ends[2])], []
    while open_ := [s for s in open_ if s[0] < s[1]]:
        def exact(x: str, y: str) -> Column:
            return (F.col(x) - F.col(y)).cast(_EXACT)

        below = exact("p", "p0") * exact("m1", "m0") - exact("p1", "p0") * exact("m", "m0")
        deepest = _beside_blocks(blocks, [(i, *s) for i, s in enumerate(open_)], "inner").groupBy("id").agg(
            F.min(F.struct(below.alias("below"), "m", "p", "range", "last")).alias("b")
        ).select("id", "b.*").collect()
        cut = {row["id"]: row for row in deepest if row["below"] < 0}
        done += [s for i, s in enumerate(open_) if i not in cut]
        open_ = [
            part for i, row in cut.items() for (first, final, p0, m0, p1, m1) in [open_[i]]
            for part in ((first, row["range"], p0, m0, row["p"], row["m"]),
                         (row["range"] + int(row["last"]), final, row["p"], row["m"], p1, m1))
        ]
    return done


def fit_isotonic(rows: DataFrame, score_column: str = "score") -> DataFrame:
    """(lo, hi, value), stored: the blocks of the monotone least-squares fit of y."""
    blocks = pooled_ranges(M.score_counts(rows, score_column))
    spans = bridges(blocks)
    if not spans:
        return store(blocks.select("lo", "hi", (F.col("pos") / F.col("n")).alias("value")), "isotonic")
    placed = _beside_blocks(blocks, [(i, *s) for i, s in enumerate(spans)], "left")
    merged = placed.filter("id IS NOT NULL").groupBy("id").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), (F.sum("pos") / F.sum("n")).alias("value")
    )
    alone = placed.filter("id IS NULL").select("lo", "hi", (F.col("pos") / F.col("n")).alias("value"))
    return store(merged.drop("id").unionByName(alone), "isotonic")


def isotonic_values(scores: DataFrame, blocks: DataFrame) -> DataFrame:
    """(score, isotonic) per distinct score: the block's value, on a straight line
    between two blocks, and flat beyond the first and the last one."""
    wanted = scores.filter(F.col("score").isNotNull()).select("score", F.lit(0).alias("k")).distinct()
    marks = store(
        wanted.unionByName(blocks.select(F.col("lo").alias("score"), F.lit(1).alias("k")))
        .groupBy("score").agg(F.sum("k").alias("k"), F.max(1 - F.col("k")).alias("wanted")), "marks",
    )
    ranked = store(summed_counts(marks, "score", ["k"]), "ranked")
    numbered = store(
        blocks.join(ranked.filter("k = 1").select(F.col("score").alias("lo"), F.col("cum_k").alias("at")), "lo"), "numbered"
    )
    following = numbered.select((F.col("at") - 1).alias("at"), F.col("lo").alias("next_lo"), F.col("value").alias("next_value"))
    line = numbered.join(following, "at", "left")
    slope = (F.col("next_value") - F.col("value")) / (F.col("next_lo") - F.col("hi"))
    value = F.when((F.col("score") <= F.col("hi")) | F.col("next_lo").isNull(), F.col("value")).otherwise(
        F.col("value") + slope * (F.col("score") - F.col("hi"))
    )
    asked = ranked.filter("wanted = 1").select("score", F.greatest("cum_k", F.lit(1)).alias("at"))
    return asked.join(line, "at").select("score", value.alias("isotonic"))


def isotonic(rows: DataFrame, keep: list[str | Column], score_column: str = "score") -> DataFrame:
    """Fitted on half 0, applied to half 1; null scores, or no fitted row, give null."""
    blocks = fit_isotonic(rows.filter(F.col("half") == 0), score_column)
    held = rows.filter(F.col("half") == 1)
    values = isotonic_values(held.select(F.col(score_column).cast("double").alias("score")), blocks)
    named = values.withColumnRenamed("score", "_score")
    joined = held.join(named, F.col(score_column).cast("double") == F.col("_score"), "left")
    return joined.select(*keep, "isotonic")


def calibration_report(rows: DataFrame) -> DataFrame:
    """Brier score and ECE of the raw, Platt and isotonic scores on half 1.

    Platt values are a projection of the score, isotonic ones are joined per
    distinct score: the rows are read once and never joined to themselves.
    """
    parameters = fit_platt(rows.filter(F.col("half") == 0))
    held = isotonic(rows, ["y", "score", platt_column(parameters).alias("platt")])
    long = held.select("y", F.inline(F.array(*[
        F.struct(F.lit(name).alias("variant"), F.col(c).alias("p"))
        for name, c in (("uncalibrated", "score"), ("platt", "platt"), ("isotonic", "isotonic"))
    ])))
    errors = long.groupBy("variant").agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"))
    return errors.join(M.ece(long, score="p", by=["variant"]), "variant")
