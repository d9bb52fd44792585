"""Text classifier as a spark.ml pipeline over whole texts."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import usable_text
from reviewlens.operators.fusion import with_balanced_weight
from reviewlens.session import spread

HASHED_TERMS = 1 << 16


def fit_text_model(train: DataFrame, text: str = "text", y: str = "y") -> PipelineModel:
    """Weighted logistic regression on hashed tf-idf terms."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_terms", pattern=r"\W+"),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=HASHED_TERMS),
        IDF(inputCol="_tf", outputCol="_tfidf", minDocFreq=2),
        LogisticRegression(featuresCol="_tfidf", labelCol=y, weightCol="weight",
                           regParam=0.01, maxIter=50),
    ]
    return Pipeline(stages=stages).fit(spread(with_balanced_weight(train, y)))


def text_spam_prob(
    model: PipelineModel, texts: DataFrame, keep: list[str], threshold: float = 0.5
) -> DataFrame:
    """Probability rounded to six places, and the two predictions; null for a text that is not usable."""
    prob = F.when(usable_text(F.col("text")), F.round(vector_to_array("probability")[1], 6))
    filled = texts.withColumns({"weight": F.lit(1.0), "text": F.coalesce("text", F.lit(""))})
    return model.transform(filled).select(
        *keep, prob.alias("text_spam_prob")
    ).withColumns({
        "pred_default": (F.col("text_spam_prob") >= 0.5).cast("int"),
        "pred_optimal": (F.col("text_spam_prob") >= threshold).cast("int"),
    })

