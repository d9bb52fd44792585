"""Isotonic and Platt fits beside the library and plain versions."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from reviewlens.functions.columns import logit
from reviewlens.operators import calibration as C


def frame(spark, score, y, half=None):
    half = np.arange(len(score)) % 2 if half is None else half
    rows = [(i, None if np.isnan(a) else float(a), int(b), int(h)) for i, (a, b, h) in enumerate(zip(score, y, half))]
    return spark.createDataFrame(rows, "review_id int, score double, y int, half int")


def plain_blocks(score, y):
    """(lo, hi, positives, rows), pooled one after the other."""
    stack = []
    for x in np.unique(score):
        block = [x, x, int(y[score == x].sum()), int((score == x).sum())]
        while stack and stack[-1][2] * block[3] >= block[2] * stack[-1][3]:
            low, _, p, n = stack.pop()
            block = [low, block[1], block[2] + p, block[3] + n]
        stack.append(block)
    return stack


SHAPES = {
    "rising": lambda s, u: u < s,
    "falling": lambda s, u: u > s,
    "flat": lambda s, u: u < 0.3,
    "waves": lambda s, u: u < 0.5 + 0.5 * np.sin(25 * s),
    "step": lambda s, u: s > 0.5,
    "exact steps": lambda s, u: (np.floor(s * 40) % 2 == 0),
}


@pytest.mark.parametrize("shape, parts", [("rising", 9), ("falling", 9), ("flat", 1), ("step", 9), ("exact steps", 9), ("waves", 40)])
def test_isotonic_blocks_match_pooling_in_one_place(spark, shape, parts):
    rng = np.random.default_rng(parts)
    score = np.round(rng.uniform(size=1_500), 3)
    y = SHAPES[shape](score, rng.uniform(size=1_500)).astype(int)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = C.fit_isotonic(frame(spark, score, y)).orderBy("lo").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = plain_blocks(score, y)
    values = np.array([r["value"] for r in got])
    assert (np.diff(values) >= 0).all()

    def spread(blocks):
        return [v for v, lo, hi in blocks for x in np.unique(score) if lo <= x <= hi]

    assert spread([(r["value"], r["lo"], r["hi"]) for r in got]) == pytest.approx(spread([(p / n, a, b) for a, b, p, n in want]))


def test_isotonic_matches_the_library_between_and_beyond(spark):
    rng = np.random.default_rng(4)
    score, half = rng.uniform(size=4_000), np.arange(4_000) % 2
    score[half == 0] = 0.1 + 0.8 * score[half == 0]  # half 1 reaches beyond
    y = (rng.uniform(size=4_000) < score).astype(int)
    df = frame(spark, score, y, half)
    model = IsotonicRegression(featuresCol="score", labelCol="y", predictionCol="want").fit(
        df.filter("half = 0").withColumn("y", F.col("y").cast("double"))
    )
    both = C.isotonic(df, ["review_id", "score"]).join(model.transform(df).select("review_id", "want"), "review_id").toPandas()
    assert len(both) == 2_000
    assert both["isotonic"].to_numpy() == pytest.approx(both["want"].to_numpy(), abs=1e-9)


def test_many_distinct_scores(spark):
    """10^5 distinct scores; on a small machine the plain version still holds them."""
    df = spark.range(100_000).select(
        F.col("id").alias("review_id"), ((F.col("id") * 7919 % 100_003) / 100_003).alias("score"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) < 1000 * ((F.col("id") * 7919 % 100_003) / 100_003)).cast("int").alias("y"),
        F.lit(0).alias("half"),
    )
    rows = df.toPandas()
    order = np.argsort(rows["score"].to_numpy())
    stack = []
    for x, label in zip(rows["score"].to_numpy()[order], rows["y"].to_numpy()[order]):
        block = (x, x, int(label), 1)
        while stack and stack[-1][2] * block[3] >= block[2] * stack[-1][3]:
            low, _, p, n = stack.pop()
            block = (low, block[1], block[2] + p, block[3] + n)
        stack.append(block)
    got = C.fit_isotonic(df).orderBy("lo").collect()
    assert [(r["lo"], r["hi"]) for r in got] == [(a, b) for a, b, _, _ in stack]


def test_platt_matches_the_library(spark):
    rng = np.random.default_rng(6)
    score = np.clip(rng.beta(2, 2, size=3_000), 0, 1)
    y = (rng.uniform(size=3_000) < score**2).astype(int)
    df = frame(spark, score, y)
    ready = VectorAssembler(inputCols=["l"], outputCol="features").transform(df.withColumn("l", logit(F.col("score"))))
    model = LogisticRegression(labelCol="y", maxIter=500, tol=1e-12).fit(ready.filter("half = 0"))
    want = model.transform(ready).select("review_id", vector_to_array("probability")[1].alias("want"))
    both = C.platt(df, ["review_id"]).join(want, "review_id").toPandas()
    assert both["platt"].to_numpy() == pytest.approx(both["want"].to_numpy(), abs=1e-5)


@pytest.mark.parametrize("score, y", [
    ([], []), ([0.4] * 6, [1] * 6), ([0.4] * 6, [0, 1, 0, 0, 1, 0]), ([0.1, 0.1, 0.9, 0.9], [0, 0, 1, 1]),
    ([np.nan, 0.2, np.nan, 0.3], [1, 0, 1, 1]),
])
def test_odd_tables(spark, score, y):
    df = frame(spark, np.array(score, float), np.array(y, int))
    held = [r for r in C.platt(df, ["score"]).collect()]
    assert all(r["platt"] is None if r["score"] is None else 0 <= r["platt"] <= 1 for r in held)
    assert all(
        r["isotonic"] is None or 0 <= r["isotonic"] <= 1 for r in C.isotonic(df, ["score"]).collect()
    )
