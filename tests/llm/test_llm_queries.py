"""The registered queries over whole small tables, beside SQL or a plain version."""

import hashlib
import zlib

import brute
import numpy as np
import pytest

import corpus_pipeline
from check_oracles import compare, rows_of, tables
from reviewlens.llm import oracles, secret_scan
from reviewlens.llm.queries import QUERIES, tokenizer_path
from reviewlens.session import store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(SF)


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_shards_match_sql(spark, con, documents):
    got = QUERIES["op7_sharding"](spark, SF)
    ran = con.execute(oracles.SHARDING_WITHOUT_CHECKSUM)
    names = [d[0] for d in ran.description]
    want = rows_of(names, ran.fetchall())
    rows = got.collect()
    assert rows_of(got.columns, [tuple(None if c == "text_crc32" else r[c] for c in got.columns) for r in rows]) == want
    assert all(r["text_crc32"] == zlib.crc32(documents[r["doc_id"]].encode()) for r in rows)


def test_nearest_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    data, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    got = {}
    for r in QUERIES["op1_nearest_vectors"](spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = 0
    for at in np.flatnonzero(ids % 20 == 0):
        near = data @ data[at]
        near[at] = -np.inf
        best = ids[np.lexsort((ids, -near))[:20]]
        hits += len(set(best.tolist()) & set(got[ids[at]]))
    assert hits >= 0.9 * 20 * len(got)


def test_secrets(spark, documents):
    for r in QUERIES["op3_secret_scan"](spark, SF).collect():
        spans = brute.base_spans(documents[r["doc_id"]] or "")
        spelled = ",".join(f"{k}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in spans) for n in ("assign", "access", "hex")]


def test_tokens(spark, documents):
    import sentencepiece
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for r in QUERIES["op6_token_counts"](spark, SF).collect():
        assert r["n_tokens"] == len(library.encode(documents[r["doc_id"]] or "", add_special_tokens=False).ids)
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for r in QUERIES["op4_sentencepiece"](spark, SF).collect():
        assert r["n_tokens"] == len(pieces.encode(documents[r["doc_id"]] or "")) and r["round_trip"]


def test_held_out_quality_and_language(spark):
    scored = QUERIES["op5_quality_model"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id"
    ).filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    named = QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in named]) > 0.97


def test_pipeline_stages(spark):
    """Every stage beside a plain version of it on the stage's own input."""
    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs = []
    for _, stage in corpus_pipeline.STAGES:
        inputs.append([r.asDict() for r in docs.collect()])
        columns = docs.columns
        docs = store(stage(spark, docs, SF), "test-stage")
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    raw, good, single, clean, mixed = inputs
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    assert np.mean([(i in kept) == (q == 1) for i, q in labels.items()]) > 0.95
    classes = brute.jaccard_classes([r["text"] for r in good])
    assert len(single) == len({root for root, _ in classes})
    before = {r["doc_id"]: r for r in single}
    for r in clean:
        text = before[r["doc_id"]]["text"]
        spans = brute.base_spans(text)
        assert not brute.base_spans(r["text"]) and (spans or r == before[r["doc_id"]])
        if spans:
            assert secret_scan.MARK in r["text"] and r["n_chars"] == len(r["text"])
    words = sum(len(brute.words(r["text"])) for r in clean)
    assert 0.9 * words <= sum(len(brute.words(r["text"])) for r in mixed) <= words
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in docs.collect()) == sorted(
        (r["doc_id"], len(library.encode(r["text"]))) for r in mixed
    )
