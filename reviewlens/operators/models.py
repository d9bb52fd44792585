"""Supervised models on the feature table, and stacking."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import one_hot
from reviewlens.operators import metrics as M
from reviewlens.operators.fusion import median_impute, with_balanced_weight
from reviewlens.session import spread

SEED = 42
APPROXIMATE = 10_000
MODELS = ["decision_tree", "random_forest", "mlp"]


def model_columns(features: list[str], cluster_ids: list[int]) -> list[str]:
    """Feature columns after the cluster id became 0/1 columns."""
    plain = [c for c in features if c != "kmeans_cluster_id"]
    if "kmeans_cluster_id" not in features:
        return plain
    return plain + [f"kmeans_cluster_id_{i}" for i in cluster_ids]


def prepare(table: DataFrame, features: list[str], cluster_ids: list[int]) -> DataFrame:
    """Imputed doubles with training medians; ids, label ``y`` and ``part`` are kept.

    ``table`` carries ``part`` (train / test).
    """
    if "kmeans_cluster_id" in features:
        table = one_hot(table, "kmeans_cluster_id", cluster_ids)
    columns = model_columns(features, cluster_ids)
    train = table.filter(F.col("part") == "train")
    filled = median_impute(table, train, columns, APPROXIMATE)
    return filled.select(
        "review_id", "user_id", "part", F.col("is_spam").cast("int").alias("y"), *columns
    )


def _assembled(columns: list[str], scaled: bool, classifier) -> Pipeline:
    stages = [VectorAssembler(inputCols=columns, outputCol="_raw" if scaled else "features")]
    if scaled:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True))
    return Pipeline(stages=[*stages, classifier])


def train_decision_tree(train: DataFrame, columns: list[str]) -> PipelineModel:
    classifier = DecisionTreeClassifier(
        labelCol="y", weightCol="weight", maxDepth=10, seed=SEED, maxMemoryInMB=1024
    )
    return _assembled(columns, True, classifier).fit(spread(with_balanced_weight(train)))


def train_random_forest(
    train: DataFrame, columns: list[str], trees: int = 300, depth: int = 16
) -> PipelineModel:
    classifier = RandomForestClassifier(
        labelCol="y", weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED,
        maxMemoryInMB=2048, cacheNodeIds=True,
    )
    return _assembled(columns, False, classifier).fit(spread(with_balanced_weight(train)))


def train_mlp(train: DataFrame, columns: list[str]) -> PipelineModel:
    """Hidden layers of 128 and 64; every row counts the same."""
    classifier = MultilayerPerceptronClassifier(
        labelCol="y", layers=[len(columns), 128, 64, 2], seed=SEED, maxIter=100
    )
    return _assembled(columns, True, classifier).fit(spread(train))


TRAINERS = {
    "decision_tree": train_decision_tree,
    "random_forest": train_random_forest,
    "mlp": train_mlp,
}


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, columns: list[str], like: DataFrame) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return like.sparkSession.createDataFrame(
        list(zip(columns, weights)), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def score(model: PipelineModel, rows: DataFrame, keep: list[str], out: str = "score") -> DataFrame:
    prob = vector_to_array("probability")[1]
    ready = rows if "weight" in rows.columns else rows.withColumn("weight", F.lit(1.0))
    return model.transform(ready).select(*keep, prob.alias(out))


def model_metrics(scored: DataFrame) -> DataFrame:
    """AUC, AP, best threshold and F1 per model; ``scored``: model, y, score.

    ``is_best`` marks the model with the largest AUC.
    """
    tuned = M.summary(scored, ["model"])
    at_half = scored.groupBy("model").agg(*M.confusion(F.col("score") >= 0.5)).select(
        "model", M.f1_columns()[0].alias("f1_default")
    )
    best = tuned.agg(F.max(F.struct("auc_roc", "model")).getField("model")).scalar()
    return (
        tuned.drop("recall_at_fpr_0_1").join(at_half, "model")
        .withColumn("_b", best).withColumn("is_best", (F.col("model") == F.col("_b")).cast("int"))
        .drop("_b")
    )


def min_max(df: DataFrame, column: str, out: str) -> DataFrame:
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")))
    spread = F.col("_b.hi") - F.col("_b.lo") + 1e-9
    return df.withColumn("_b", bounds.scalar()).withColumn(
        out, (F.col(column) - F.col("_b.lo")) / spread
    ).drop("_b")


def stack(rows: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Balanced logistic regression fitted on half 0; scores of half 1."""
    fit, held = rows.filter(F.col("half") == 0), rows.filter(F.col("half") == 1)
    classifier = LogisticRegression(labelCol="y", weightCol="weight", maxIter=200)
    model = _assembled(columns, True, classifier).fit(spread(with_balanced_weight(fit)))
    return score(model, held, keep)
