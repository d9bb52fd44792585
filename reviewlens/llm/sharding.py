"""Deal documents into shards of nearly equal size, equal texts together.

Groups of equal texts are atomic and lie in a fixed order. The smallest capacity
that lets a greedy walk fill no more than the given number of shards is searched
by bisection, several capacities to a round, and the groups are cut there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import running_totals, text_or_empty
from reviewlens.session import store

SHARDS = 8
PROBES = 128  # capacities tried in one round of the search


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32 and the digest that names a text's group."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("digest"),
    )


def _walk(ends: DataFrame, total: int, capacities: list[int], shards: int, largest: int) -> list[list[int]]:
    """Greedy cuts for every capacity: each next cut is the last group end that
    the capacity still reaches. One pass over the nearby group ends per cut;
    it returns at most one row per capacity."""
    cuts: list[list[int]] = [[] for _ in capacities]
    at = [0] * len(capacities)
    for _ in range(shards - 1):
        limits = [a + c for a, c in zip(at, capacities, strict=True)]
        ordered = sorted(set(limits))
        near = ends.filter(F.col("end").between(ordered[0] - largest, ordered[-1]))
        below = F.size(F.filter(F.lit(ordered), lambda limit: limit < F.col("end")))  # limits not reached
        found = {r["below"]: r["end"] for r in near.groupBy(below.alias("below")).agg(F.max("end").alias("end")).collect()}
        reached, last = {}, 0
        for i, limit in enumerate(ordered):
            last = max(last, found.get(i, 0))
            reached[limit] = last
        at = [max(a, reached[limit]) for limit, a in zip(limits, at, strict=True)]
        for own, cut in zip(cuts, at, strict=True):
            own.append(cut)
    return cuts


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int, probes: int = PROBES) -> tuple[int, list[int]]:
    """(capacity, cuts): the smallest capacity that needs no more than ``shards``
    shards, and its greedy cuts as running sizes.

    ``ends`` holds the running size at the end of every group, ``largest`` the
    largest group. Only the capacities and cuts of a round come to the driver.
    """
    low = max(largest, -(-total // shards))  # no smaller capacity can do
    high = low + largest  # this one always does
    best: tuple[int, list[int]] | None = None
    while best is None or low < high:
        step = max(1, -(-(high - low) // probes))
        capacities = sorted({*range(low, high, step), high})
        walks = _walk(ends, total, capacities, shards, largest)
        feasible = [total - cuts[-1] <= c if cuts else True for c, cuts in zip(capacities, walks, strict=True)]
        first = feasible.index(True)
        best, high = (capacities[first], walks[first]), capacities[first]
        low = capacities[first - 1] + 1 if first else high
    return best


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
    probes: int = PROBES,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and ``slot``, the place inside the shard.

    Groups lie in the order of their text digest, documents of a group by id.
    Null texts form one group and have size 1 and no checksum; an empty text
    is a text. Equal rows get neighbouring slots. With fewer groups than shards
    some shards stay empty; an empty table gives an empty result. Other columns
    are not looked at.
    """
    sizes = store(document_sizes(docs, id_col, text_col).withColumn("one", F.lit(1)), "sizes")
    placed = store(running_totals(sizes, ["digest", "doc_id"], ["size", "one"], "by-digest"), "placed")
    groups = placed.groupBy("digest").agg(F.max("cum_size").alias("end"), F.sum("size").alias("group_size"))
    ends = store(groups.select("end", "group_size"), "group-ends")
    total, largest = ends.agg(F.max("end"), F.max("group_size")).first()
    if total is None:
        return placed.select(
            "doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.col("one").cast("long").alias("slot")
        )
    _, cuts = minimax_cuts(ends, total, largest, shards, probes)
    shard = sum([(F.col("cum_size") > F.lit(c)).cast("int") for c in cuts], F.lit(0))
    sharded = placed.withColumn("shard", shard)
    first = store(sharded.groupBy("shard").agg(F.min("cum_one").alias("first")), "shard-starts")
    starts = {row["shard"]: row["first"] for row in first.collect()}  # one row per shard
    start = F.lit(0).cast("long")
    for number, value in starts.items():
        start = F.when(F.col("shard") == number, F.lit(value)).otherwise(start)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("cum_one") - start).cast("long").alias("slot"),
    )
