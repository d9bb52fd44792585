"""Text vectors: independent of partitions, near for texts of one topic, beside a plain decomposition."""

import random

import numpy as np
import pyarrow as pa
import pytest

from reviewlens.operators import text_vectors as TV


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    topics = [[f"{t}{i}" for i in range(25)] for t in ("food", "car", "book")]
    rows = [(i, " ".join(rng.choices(topics[i % 3], k=30))) for i in range(240)]
    return [*rows, (240, None), (241, "short"), (242, "nan"), (243, " " * 40), (244, "?!" * 20)]


def test_vectors_do_not_depend_on_partitions(spark, texts):
    df = spark.createDataFrame(texts, "id int, text string")
    got = []
    for parts in (1, 16):
        made = TV.text_vectors(df.repartition(parts), ["id"], buckets=512, size=8)
        got.append({r["id"]: r["embedding"] for r in made.collect()})
    a, b = (np.array([g[i] for i in range(240)]) for g in got)
    assert np.allclose(a @ a.T, b @ b.T, atol=1e-6)  # equal up to a rotation
    assert all(g[i] is None for g in got for i in (240, 241, 242, 243)) and np.allclose(got[0][244], 0)
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    near = unit @ unit.T
    same = (np.arange(240)[:, None] - np.arange(240)[None]) % 3 == 0
    assert near[same].mean() > near[~same].mean() + 0.5


def test_vectors_match_a_plain_decomposition(spark, texts):
    df = spark.createDataFrame(texts[:60], "id int, text string")
    lists = [r["h"] for r in df.select(TV.bucket_list(df["text"], 64).alias("h")).collect()]
    counts = np.zeros((64, 64))
    for h in lists:
        for i in range(len(h)):
            for j in range(i + 1, min(len(h), i + 1 + TV.WINDOW)):
                counts[h[i], h[j]] += 1
                counts[h[j], h[i]] += 1
    totals = counts.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.nan_to_num(np.maximum(np.log(counts * totals.sum() / np.outer(totals, totals)), 0), posinf=0)
    got = TV.bucket_vectors(df.select(TV.bucket_list(df["text"], 64).alias("h")), 64, 56, rounds=6)
    values, vectors = np.linalg.eigh(weight)
    best = np.argsort(-np.abs(values))[:56]
    want = vectors[:, best] * np.sqrt(np.abs(values[best]))
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-2)


def test_pairs_are_counted_across_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    lists = [rng.integers(0, 9, size=n).tolist() for n in (0, 1, 2, 3, 40, 7)]
    df = spark.createDataFrame([(h,) for h in lists], "h array<int>").repartition(2)
    want = {}
    for h in lists:
        for i, x in enumerate(h):
            for y in h[i + 1:i + 1 + TV.WINDOW]:
                want[x, y] = want.get((x, y), 0) + 1
                want[y, x] = want.get((y, x), 0) + 1
    batch = pa.record_batch([pa.array(lists, pa.list_(pa.int32()))], ["h"])
    monkeypatch.setattr(TV, "WORDS_AT_ONCE", 5)
    monkeypatch.setattr(TV, "PAIRS_AT_ONCE", 3)
    sent = [r for part in TV._count_pairs(TV.WINDOW)(iter([batch, batch])) for r in part.to_pylist()]
    one_way = {}
    for r in sent:
        key = (r["pair"] >> 32, r["pair"] & 0xFFFFFFFF)
        one_way[key] = one_way.get(key, 0) + r["n"]
    assert one_way == {(a, b): 2 * n if a < b else n for (a, b), n in want.items() if a <= b}
    assert {(r["a"], r["b"]): r["n"] for r in TV.pair_counts(df).collect()} == want
    assert TV.pair_counts(df.filter("false")).count() == 0


def test_products_of_all_tasks_are_gathered_at_once(spark, monkeypatch):
    """One task after the other, a round took as long as all of its tasks together."""
    def refuse(*_, **__):
        raise AssertionError("one task at a time")

    pairs = spark.createDataFrame([(0, 1, 2), (1, 0, 2)], "a int, b int, n long").coalesce(1)
    monkeypatch.setattr(type(pairs), "toLocalIterator", refuse)
    got = TV._times(pairs, np.array([2.0, 2.0, 0.0]), np.eye(3, 2))
    assert np.allclose(got, np.log(2) * np.array([[0, 1], [1, 0], [0, 0]]))
    assert np.allclose(TV._times(pairs.filter("false"), np.ones(3), np.eye(3, 2)), 0)
