"""Cluster features, scaling, K-Means with choice of K, cluster reports."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import spread

CLUSTER_FEATURES = [
    "review_count", "reviews_per_week", "tenure_days", "avg_rating", "rating_std",
    "unique_sellers", "max_seller_fraction", "burst_score", "rating_entropy", "avg_review_length",
]
LOG_FEATURES = ["review_count", "reviews_per_week", "tenure_days", "burst_score", "unique_sellers"]
PROFILE_FEATURES = [
    "review_count", "tenure_days", "burst_score", "max_seller_fraction", "rating_entropy",
    "avg_rating", "rating_std", "unique_sellers",
]
K_RANGE = range(2, 13)
AMBIGUOUS_K = 5
SEED = 42
CONCURRENT_FITS = 8
BASE_SPAM_RATE = 0.132

# fixed values: feature -> (comparison, ratio to the overall mean, tag), first match wins
PROFILE_TAGS = {
    "tenure_days": [("<", 0.7, "New"), (">", 1.5, "Veteran")],
    "burst_score": [(">", 1.4, "bursty")],
    "max_seller_fraction": [(">", 1.3, "concentrated"), ("<", 0.7, "diverse")],
    "review_count": [(">", 1.8, "active"), ("<", 0.5, "low-activity")],
    "rating_entropy": [("<", 0.6, "uniform-rating"), (">", 1.4, "varied-rating")],
    "unique_sellers": [(">", 1.5, "multi-seller")],
    "spam_rate": [(">", 1.5, "high-spam"), ("<", 0.5, "low-spam")],
}
# fixed values: note texts by spam rate over the base rate
NOTE_SUSPICIOUS = ("Spam rate %.1f%% is %.1fx the dataset average; "
                   "behavioural features indicate suspicious review patterns.")
NOTE_ELEVATED = ("Spam rate %.1f%% is moderately elevated; "
                 "mix of suspicious and borderline reviewers.")
NOTE_ORGANIC = ("Spam rate %.1f%% is well below average; "
                "likely organic reviewers with normal purchasing behaviour.")
NOTE_AVERAGE = ("Spam rate %.1f%% is near the dataset average (%.1f%%); "
                "no strong signal of spam or organic dominance.")


def cluster_features(reviewers: DataFrame) -> DataFrame:
    """The ten behaviour measures, skewed ones as log1p, beside id and spam rate."""
    known = reviewers.na.drop(how="all", subset=CLUSTER_FEATURES)
    return known.select(
        "user_id",
        *[
            (F.log1p(c) if c in LOG_FEATURES else F.col(c).cast("double")).alias(c)
            for c in CLUSTER_FEATURES
        ],
        "spam_rate",
    )


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population deviation per column (a deviation of 0 becomes 1)."""
    return df.agg(F.struct(*[
        F.struct(
            F.avg(c).alias("mean"),
            F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(F.lit(1.0)).alias("std"),
        ).alias(c)
        for c in columns
    ]).alias("scaler"))


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: list[str]) -> DataFrame:
    """z-scores with given statistics, so new rows scale like the old ones."""
    fitted = df.withColumn("_s", scaler.scalar())
    return fitted.withColumns({
        c: (F.col(c) - F.col(f"_s.{c}.mean")) / F.col(f"_s.{c}.std") for c in columns
    }).drop("_s")


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    return apply_scaler(df, fit_scaler(df, columns), columns)


def as_vectors(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out).transform(df)


def best_kmeans(
    vectors: DataFrame, ks: list[int], restarts: int, seed: int = SEED
) -> dict[int, KMeansModel]:
    """For each k the fit with the least inertia over several seeds.

    The fits are independent, so a few of them are submitted side by side.
    """
    def fit(job: tuple[int, int]) -> KMeansModel:
        return KMeans(k=job[0], seed=seed + job[1], maxIter=50).fit(vectors)

    jobs = [(k, i) for k in ks for i in range(restarts)]
    with ThreadPool(CONCURRENT_FITS) as pool:
        models = pool.map(inheritable_thread_target(vectors.sparkSession)(fit), jobs, 1)
    best: dict[int, KMeansModel] = {}
    for (k, _), model in zip(jobs, models):
        if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = model
    return best


def kmeans_sweep(
    scaled: DataFrame, columns: list[str], ks: range = K_RANGE, restarts: int = 10
) -> DataFrame:
    """Inertia and silhouette for each k; all reviewers count, none are sampled."""
    vectors = spread(as_vectors(scaled, columns).select("user_id", "features")).select("features")
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    try:
        for k, model in best_kmeans(vectors, list(ks), restarts).items():
            silhouette = ClusteringEvaluator().evaluate(model.transform(vectors))
            rows.append((k, float(model.summary.trainingCost), float(silhouette)))
    finally:
        vectors.unpersist()
    return scaled.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def choose_k(sweep: DataFrame) -> DataFrame:
    """Elbow (farthest from the chord), silhouette peak, and the recommended k.

    When the two are more than two apart the answer is 5.
    """
    ends = sweep.agg(F.struct(
        F.min("k").alias("k0"), F.max("k").alias("k1"),
        F.min_by("inertia", "k").alias("i0"), F.max_by("inertia", "k").alias("i1"),
    ))
    rise = F.col("e.i1") - F.col("e.i0")
    run = (F.col("e.k1") - F.col("e.k0")).cast("double")
    off = F.abs(run * (F.col("e.i0") - F.col("inertia")) - (F.col("e.k0") - F.col("k")) * rise)
    picked = sweep.withColumn("e", ends.scalar()).agg(
        F.max(F.struct(off.alias("v"), (-F.col("k")).alias("k"))).alias("elbow"),
        F.max(F.struct(F.col("silhouette").alias("v"), (-F.col("k")).alias("k"))).alias("peak"),
    ).select((-F.col("elbow.k")).alias("elbow_k"), (-F.col("peak.k")).alias("silhouette_k"))
    return picked.withColumn(
        "recommended_k",
        F.when(F.abs(F.col("elbow_k") - F.col("silhouette_k")) > 2, AMBIGUOUS_K)
        .otherwise(F.col("silhouette_k")),
    )


def kmeans_assign(
    scaled: DataFrame, columns: list[str], k: int, restarts: int = 20, seed: int = SEED
) -> DataFrame:
    """(user_id, cluster_id); clusters are numbered in the order of their centres."""
    vectors = spread(as_vectors(scaled, columns).select("user_id", "features"))
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = best_kmeans(vectors, [k], restarts, seed)[k]
    finally:
        vectors.unpersist()
    centres = [tuple(c) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    number = F.lit([order.index(i) for i in range(len(centres))])
    return model.transform(vectors).select(
        "user_id", F.get(number, F.col("prediction")).cast("int").alias("cluster_id")
    )


def nearest_centroid(
    scaled: DataFrame, centroids: DataFrame, columns: list[str], cluster: str = "cluster_id"
) -> DataFrame:
    """Each row takes the nearest of a few given centroids; ties go to the smaller id.

    ``centroids`` has one row per cluster, so it travels as one array.
    """
    listed = centroids.agg(F.collect_list(F.struct(
        F.array(*[F.col(c).cast("double") for c in columns]).alias("x"), F.col(cluster).alias("id")
    )))
    point = F.array(*columns)

    def distance(c: Column) -> Column:
        steps = F.zip_with(c["x"], point, lambda p, q: (p - q) * (p - q))
        total = F.aggregate(steps, F.lit(0.0), lambda t, v: t + v)
        return F.struct(F.round(total, 12).alias("d2"), c["id"].alias("id"))

    best = F.array_min(F.transform("_c", distance))
    return scaled.withColumn("_c", listed.scalar()).select(
        "user_id", best["id"].alias(cluster), F.sqrt(best["d2"]).alias("distance")
    )


def kmeans_summary(assigned: DataFrame, features: DataFrame) -> DataFrame:
    """Size, spam rate and five feature means per cluster."""
    return assigned.join(features, "user_id", "left").groupBy("cluster_id").agg(
        F.count("user_id").alias("size"),
        F.avg("spam_rate").alias("spam_rate_mean"),
        F.stddev("spam_rate").alias("spam_rate_std"),
        *[F.avg(c).alias(f"avg_{c}")
          for c in ("review_count", "tenure_days", "burst_score", "rating_entropy")],
    )


def cluster_summary(assigned: DataFrame, rates: DataFrame, cluster: str) -> DataFrame:
    """Size and mean spam rate per cluster."""
    return assigned.join(rates.select("user_id", "spam_rate"), "user_id", "left").groupBy(cluster).agg(
        F.count("user_id").alias("size"), F.avg("spam_rate").alias("spam_rate_mean")
    )


def _tag(feature: str) -> Column:
    if feature == "spam_rate":
        ratio = F.col("spam_rate_mean") / BASE_SPAM_RATE
    else:
        overall = F.col(f"g.{feature}")
        ratio = F.when(overall != 0, F.col(feature) / overall)
    tag = None
    for sign, bound, name in PROFILE_TAGS[feature]:
        hit = ratio < bound if sign == "<" else ratio > bound
        tag = F.when(hit, name) if tag is None else tag.when(hit, name)
    return tag


def _note() -> Column:
    rate = F.col("spam_rate_mean")
    percent, ratio = rate * 100, rate / BASE_SPAM_RATE
    return (
        F.when(ratio > 2.0, F.format_string(NOTE_SUSPICIOUS, percent, ratio))
        .when(ratio > 1.3, F.format_string(NOTE_ELEVATED, percent))
        .when(ratio < 0.5, F.format_string(NOTE_ORGANIC, percent))
        .otherwise(F.format_string(NOTE_AVERAGE, percent, F.lit(BASE_SPAM_RATE * 100)))
    )


def cluster_profile(assigned: DataFrame, features: DataFrame, cluster: str) -> DataFrame:
    """Tags and a note per cluster from its means against the overall means.

    Ratios are taken on the features as supplied (log1p values stay log1p).
    """
    overall = features.agg(F.struct(*[F.avg(c).alias(c) for c in PROFILE_FEATURES]))
    means = assigned.join(features, "user_id", "left").groupBy(cluster).agg(
        F.count("user_id").alias("size"), F.avg("spam_rate").alias("spam_rate_mean"),
        *[F.avg(c).alias(c) for c in PROFILE_FEATURES],
    )
    tags = F.concat_ws(" ", *[_tag(f) for f in PROFILE_TAGS])
    capital = F.concat(F.upper(F.substring(tags, 1, 1)), F.substr(tags, F.lit(2)))
    return means.withColumn("g", overall.scalar()).select(
        cluster, "size", F.round("spam_rate_mean", 4).alias("spam_rate_mean"),
        F.when(tags == "", "Average").otherwise(capital).alias("dominant_profile"),
        _note().alias("notes"),
    )
