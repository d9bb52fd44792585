"""Registered queries of the operators, thin over their own interfaces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import (
    decontaminate, jaccard_join, language_id, merkle, mixing, nearest, part_codes, quality_model, quality_rules,
    secret_scan, sentencepiece_lattice, sharding, token_counts,
)
from reviewlens.llm.common import table

TOKEN_LIMIT = 2_048

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of the rule cascade for every document."""
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    base_failed = F.coalesce(quality_rules.BASE_RULES[0].rejects() | quality_rules.BASE_RULES[1].rejects(), F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), "kept",
    )


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    scanned = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str):
        own = secret_scan.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == own)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secret_scan.spelled(F.col("base")), 256).alias("base_sha256"),
        secret_scan.spelled(F.col("spans")).alias("spans"),
    )


def fold(column: str, folds: int):
    """The fold of a row: crc32 of its id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the piece model, and whether they decode to it."""
    return sentencepiece_lattice.encoding_summary(
        table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")
    )


@query
def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt outside the held-out fold."""
    scored = quality_model.classify_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), training=fold("doc_id", 4) != 2
    )
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted"
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes, equal texts together."""
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    predicted = language_id.predict_languages(docs, training=fold("doc_id", 5) != 0)
    return predicted.select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at similarity 0.8 over five-word shingles."""
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query
def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat ten consecutive words of a test item."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and proofs of all documents; every fifth text, by checksum of its id, is tampered with."""
    docs = table(spark, sf_dir, "documents")
    changed = merkle.leaf_of([
        merkle.lower_cased(F.col(c)) if c == "text" else F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")
    ])
    manifest = merkle.build_manifest(docs, carry={"tampered_leaf": F.when(fold("doc_id", 5) == 0, changed)})
    checked = merkle.verify(manifest, F.coalesce("tampered_leaf", "leaf"))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight codes of sixteen entries for every embedding, and their errors."""
    codes, codebooks = part_codes.compress(table(spark, sf_dir, "embeddings"))
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return part_codes.label_errors(codes).select(
        "vec_id", code.alias("code"), "error", "label_error",
        F.lit(part_codes.codebooks_digest(codebooks)).alias("codebooks_sha256"),
    )
