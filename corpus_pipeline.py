"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before
it kept; all but the last return the columns of the documents table. ``run``
applies them in order, each result written to the shared folder and read again.
Null and empty texts, repeated rows, empty tables and further columns are
treated as the operators' own descriptions say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import jaccard_join, mixing, quality_model, secret_scan, sentencepiece_lattice
from reviewlens.llm.common import table
from reviewlens.llm.queries import fold, tokenizer_path
from reviewlens.plans.catalog import ship_package
from reviewlens.session import store


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects.

    The labels outside the held-out fold are learnt on the stage's documents; a
    row is kept when its own text scores high enough.
    """
    ship_package(spark)
    forest = quality_model.fit_forest(*quality_model.training_rows(
        docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2), "doc_id", "text", "quality",
        quality_model.SAMPLE_ROWS,
    ))
    scored = quality_model.score_documents(docs, forest, F.col("text"), score_col="_quality")
    return scored.filter(F.col("_quality") >= quality_model.THRESHOLD).select(*_columns(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates, that of the smallest id."""
    ship_package(spark)
    return jaccard_join.one_of_each_class(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; a null text stays null, n_chars follows the text."""
    ship_package(spark)
    others = [F.col(f"`{c}`").alias(f"_in_{c}") for c in docs.columns]
    scanned = secret_scan.redact(secret_scan.scan_secrets(docs.select("doc_id", "text", *others), carry=tuple(
        f"_in_{c}" for c in docs.columns
    )))
    changed = F.size("spans") > 0
    made = {
        "text": F.when(changed, F.col("text")).otherwise(F.col("_in_text")),
        "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("_in_n_chars"))
        if "n_chars" in docs.columns else None,
    }
    return scanned.select(*[(made[c] if c in made else F.col(f"`_in_{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the weighted mix, each as often as the mix takes it."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document of the mix under the piece model."""
    ship_package(spark)
    return sentencepiece_lattice.encoding_summary(docs, tokenizer_path("piece_bpe_32k.model"))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

ORACLE_SQL = None  # trees, Markov models and merges are beyond SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = store(docs, "stage")
    return docs
