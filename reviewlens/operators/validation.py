"""Agreement between signals, detection of given profiles, ablation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.selection import topk_by
from reviewlens.operators.clustering import apply_scaler, fit_scaler
from reviewlens.operators.neighbors import collapse, knn
from reviewlens.session import store

K_VALUES = [500, 1000, 2000, 5000, 10_000]
SUMMARY_K = 2000
FLAG_RATE = 0.20


def reviewer_scores(scores: DataFrame, score: str, how: str = "max") -> DataFrame:
    """Review scores aggregated to one per reviewer."""
    return scores.groupBy("user_id").agg(F.expr(f"{how}({score})").alias(score))


def cluster_ranking(assigned: DataFrame, rates: DataFrame, cluster: str) -> DataFrame:
    """(user_id, key1, key2): mean spam rate of the reviewer's cluster."""
    joined = assigned.select("user_id", cluster).join(rates.select("user_id", "spam_rate"), "user_id")
    means = joined.groupBy(cluster).agg(F.avg("spam_rate").alias("key1"))
    return joined.join(means, cluster).select("user_id", "key1", F.lit(0.0).alias("key2"))


def plain_ranking(df: DataFrame, key1: str, key2: str | None = None) -> DataFrame:
    return df.select(
        "user_id", F.col(key1).cast("double").alias("key1"),
        (F.col(key2).cast("double") if key2 else F.lit(0.0)).alias("key2"),
    )


def signal_rankings(signals: dict[str, DataFrame], holdout: DataFrame) -> DataFrame:
    """Long table (signal, user_id, key1, key2) over holdout reviewers.

    Higher keys rank first, then the smaller user id.
    """
    wanted = holdout.select("user_id").distinct()
    parts = [
        df.join(wanted, "user_id", "left_semi").select(F.lit(name).alias("signal"), "user_id", "key1", "key2")
        for name, df in signals.items()
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def topk_jaccard(
    rankings: DataFrame, signals: list[str], ks: list[int] = tuple(K_VALUES)
) -> DataFrame:
    """Intersection, union and Jaccard of the top-K sets of every signal pair."""
    ks = list(ks)
    known = store(rankings.filter(F.col("signal").isin(*signals)), "rankings")
    ranked = store(
        topk_by(known, max(ks), ["signal"], "-key1", "-key2", "user_id").select("signal", "user_id", "rank"), "top"
    )
    a = ranked.select("user_id", F.col("signal").alias("signal_a"), F.col("rank").alias("ra"))
    b = ranked.select("user_id", F.col("signal").alias("signal_b"), F.col("rank").alias("rb"))
    place = {s: i for i, s in enumerate(signals)}
    position = F.create_map(*[F.lit(v) for kv in place.items() for v in kv])
    shared = (
        a.join(b, "user_id").filter(position[F.col("signal_a")] < position[F.col("signal_b")])
        .groupBy("signal_a", "signal_b")
        .agg(*[F.count_if((F.col("ra") <= k) & (F.col("rb") <= k)).alias(f"i{k}") for k in ks])
    )
    sizes = ranked.groupBy("signal").agg(*[F.count_if(F.col("rank") <= k).alias(f"n{k}") for k in ks])
    counts = sizes.agg(F.map_from_entries(F.collect_list(
        F.struct("signal", F.array(*[F.col(f"n{k}") for k in ks]))
    )))
    pairs = F.array(*[
        F.struct(F.lit(x).alias("signal_a"), F.lit(y).alias("signal_b"))
        for x, y in combinations(signals, 2)
    ])
    listed = counts.select(F.inline(pairs)).join(shared, ["signal_a", "signal_b"], "left").na.fill(0)
    per_k = F.array(*[
        F.struct(
            F.lit(k).alias("k"), F.col(f"i{k}").alias("intersection"),
            (_size("signal_a", i) + _size("signal_b", i) - F.col(f"i{k}")).alias("union"),
        )
        for i, k in enumerate(ks)
    ])
    jaccard = F.when(F.col("union") > 0, F.col("intersection") / F.col("union")).otherwise(F.lit(0.0))
    return (
        listed.withColumn("_n", counts.scalar())
        .select("signal_a", "signal_b", F.inline(per_k))
        .select("k", "signal_a", "signal_b", "intersection", "union", jaccard.alias("jaccard"))
    )


def _size(signal: str, i: int) -> Column:
    return F.coalesce(F.try_element_at("_n", F.col(signal))[i], F.lit(0))


def jaccard_matrix(overlaps: DataFrame, ks: list[int] = tuple(K_VALUES)) -> DataFrame:
    """Signal pairs down, K across."""
    return overlaps.groupBy("signal_a", "signal_b").pivot("k", list(ks)).agg(F.first("jaccard"))


def agreement_extremes(overlaps: DataFrame, k: int = SUMMARY_K) -> DataFrame:
    """The strongest and the weakest pair at one K."""
    pair = F.concat_ws(" vs ", "signal_a", "signal_b")
    at_k = overlaps.filter(F.col("k") == k).select(pair.alias("pair"), "jaccard")
    return at_k.agg(
        F.max(F.struct("jaccard", "pair")).alias("hi"), F.min(F.struct("jaccard", "pair")).alias("lo")
    ).select(
        F.col("hi.pair").alias("strongest"), F.col("hi.jaccard").alias("strongest_jaccard"),
        F.col("lo.pair").alias("weakest"), F.col("lo.jaccard").alias("weakest_jaccard"),
    )


def nearest_known(
    known: DataFrame, new: DataFrame, columns: list[str], key: str = "user_id"
) -> DataFrame:
    """(key, known_id, distance): the nearest known reviewer of each new profile.

    Both frames hold raw or log features; the scale is fitted on the known ones.
    Ties go to the smaller id.
    """
    scaler = fit_scaler(known, columns)
    scaled = {
        1: apply_scaler(known.select(key, *columns), scaler, columns),
        0: apply_scaler(new.select(key, *columns), scaler, columns),
    }
    rows = store(
        scaled[1].withColumn("is_base", F.lit(1)).unionByName(scaled[0].withColumn("is_base", F.lit(0))),
        "profiles",
    )
    points = store(
        collapse(rows, key, columns, ["is_base"])
        .withColumn("pid", F.col("pid") * 2 + F.col("is_base"))
        .withColumn("is_query", 1 - F.col("is_base")), "profile_points",
    )
    first = F.col("nbrs")[0]
    found = knn(points, columns, 1).select(
        "pid", F.shiftright(first["id"], 1).alias("known_id"), first["d"].alias("distance")
    )
    located = points.filter("is_query = 1").select("pid", *columns).join(found, "pid").drop("pid")
    return rows.filter("is_base = 0").join(located, columns).select(key, "known_id", "distance")


def nearest_cluster(nearest: DataFrame, assigned: DataFrame, cluster: str, key: str = "user_id") -> DataFrame:
    """Each new profile takes the cluster of its nearest known reviewer, or -1."""
    labels = assigned.select(F.col("user_id").alias("known_id"), cluster)
    return nearest.join(labels, "known_id", "left").select(
        key, F.coalesce(cluster, F.lit(-1)).alias(cluster)
    )


def cluster_flag(
    placed: DataFrame, summary: DataFrame, cluster: str, cutoff: float = FLAG_RATE,
    noise_is_flagged: bool = False, key: str = "user_id",
) -> DataFrame:
    """1 where the cluster's mean spam rate is above the cutoff (or it is noise)."""
    flagged = F.coalesce(F.col("spam_rate_mean") > cutoff, F.lit(False))
    if noise_is_flagged:
        flagged = flagged | (F.col(cluster) == -1)
    return placed.join(summary.select(cluster, "spam_rate_mean"), cluster, "left").select(
        key, flagged.cast("int").alias("cluster_flag")
    )


def model_flag(
    scores: DataFrame, threshold: DataFrame, score: str = "score", key: str = "user_id"
) -> DataFrame:
    """1 where a reviewer's largest review score reaches the tuned threshold (one row)."""
    best = scores.groupBy(key).agg(F.max(score).alias("max_score"))
    return best.withColumn("_t", threshold.scalar()).select(
        key, "max_score", (F.col("max_score") >= F.col("_t")).cast("int").alias("model_flag")
    )


def detection_rates(flags: DataFrame, layers: list[str], tier: str = "tier") -> DataFrame:
    """Share of flagged profiles per layer and tier, and overall."""
    wide = flags.rollup(tier).agg(
        F.count(F.lit(1)).alias("n_profiles"), *[F.avg(c).alias(c) for c in layers]
    )
    long = F.array(*[F.struct(F.lit(c).alias("layer"), F.col(c).alias("rate")) for c in layers])
    return wide.select(F.coalesce(tier, F.lit("overall")).alias(tier), "n_profiles", F.inline(long))


def target_encode(fit: DataFrame, rows: DataFrame, cluster: str, out: str, y: str = "y") -> DataFrame:
    """The cluster's label rate among ``fit`` rows; unseen clusters get the overall rate."""
    rates = fit.groupBy(cluster).agg(F.avg(F.col(y).cast("double")).alias(out))
    overall = fit.agg(F.avg(F.col(y).cast("double"))).scalar()
    return rows.join(rates, cluster, "left").withColumn("_o", overall).withColumn(
        out, F.coalesce(out, "_o")
    ).drop("_o")
