"""Mix sources to target weights by weighted fair queueing.

The documents of a source queue up in shuffled order, again and again up to the
allowed repeats. A queued copy finishes at (source words up to its end) /
(target words of the source). All copies are range-sorted by finish time and the
queue is cut where the total budget is reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import running_totals, text_or_empty, word_count
from reviewlens.session import store

# Weights by position in the order of the source names, and repeats.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
ROWS_PER_BLOCK = 512
SEED = 17


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and its place in the order.

    The budget is the sum of all sizes. It is shared by weight; a target stops
    at ``max_repeats`` times its source, and what it leaves is shared by weight
    among the others. Sources are taken by how soon they fill up: the first one
    that does not fill up sets the level for itself and all after it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight_list = F.array(*[F.lit(w) for w in weights])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size",
        F.get(weight_list, (F.row_number().over(by_name) - 1) % len(weights)).cast("long").alias("weight"),
        F.sum("source_size").over(Window.partitionBy(F.lit(0))).alias("budget"),
    ).withColumn("cap", max_repeats * F.col("source_size"))
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    ranked = sources.select(
        "*",
        (F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))).alias("left"),
        F.sum("weight").over(later).alias("weight_left"),
        F.row_number().over(by_ratio).alias("place"),
    ).withColumn("open", F.col("left") * F.col("weight") <= F.col("cap") * F.col("weight_left"))
    level = Window.partitionBy(F.lit(0))
    first_open = F.min(F.when(F.col("open"), F.struct("place", "left", "weight_left"))).over(level)
    return ranked.withColumn("level", first_open).select(
        "source", "source_size", "weight", "budget",
        F.when(F.col("place") < F.col("level.place"), F.col("cap").cast("double")).otherwise(
            (F.col("level.left") * F.col("weight")).cast("double") / F.col("level.weight_left").cast("double")
        ).alias("target"),
    )


def _shuffle_key(seed: int, column: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(column).cast("string"), F.lit(""))))


def queue_documents(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED
) -> DataFrame:
    """Place every document in its source's shuffled queue: ``queued`` words up
    to its end in the first round, with the source's size and target.

    ``sizes`` is a stored table (doc_id, row, source, size). Queues are cut into
    blocks by the leading digits of the shuffle hash, their number following
    the row count, so a source with most of the rows is spread over many tasks.
    """
    rows = sizes.count()
    blocks = max(1, -(-rows // ROWS_PER_BLOCK))
    leading = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long")
    keyed = sizes.withColumn("shuffled", _shuffle_key(seed, "doc_id")).select(
        "*",
        F.floor(leading * blocks / F.lit(2**32)).cast("int").alias("block"),
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source"))).alias("queue"),
    )
    targets = source_targets(sizes, weights, max_repeats).withColumn(
        "queue", F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source")))
    ).drop("source")
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("queue", "block").agg(F.sum("size").alias("_words"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        .drop("_words").join(targets, "queue")
    )
    inside = (
        Window.partitionBy("queue", "block").orderBy("shuffled", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        keyed.join(offsets, ["queue", "block"])
        .withColumn("queued", F.col("_before") + F.sum("size").over(inside))
        .drop("_before", "block", "weight")
    )


def _copies(queued: DataFrame, max_repeats: int) -> DataFrame:
    """One row per queued copy with its virtual finish time."""
    turns = F.sequence(F.lit(0), F.lit(max_repeats - 1))
    finish = (F.col("turn") * F.col("source_size") + F.col("queued")).cast("double") / F.col("target")
    return (
        queued.filter(F.col("target") > 0).withColumn("turn", F.explode(turns)).withColumn("finish", finish)
    )


ORDER = ["finish", "queue", "turn", "shuffled", "doc_id", "size", "row"]


def fair_queue(docs_sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED):
    """(queued documents, cut): the place of every document and the last queued
    copy that still fits the budget, as a row of the ``ORDER`` columns or None."""
    queued = store(queue_documents(docs_sizes, weights, max_repeats, seed), "queued")
    copies = _copies(queued, max_repeats).select(*ORDER, "budget")
    summed = running_totals(copies, ORDER, ["size"], "copies")
    fits = summed.filter(F.col("cum_size") <= F.col("budget"))
    return queued, fits.agg(F.max(F.struct(*ORDER)).alias("cut")).first()["cut"]


def _precedes_cut(cut, turn: Column) -> Column:
    """Does the copy of this turn come no later than the cut?"""
    finish = (turn * F.col("source_size") + F.col("queued")).cast("double") / F.col("target")
    own = [finish, F.col("queue"), turn, F.col("shuffled"), F.col("doc_id"), F.col("size"), F.col("row")]
    decided = F.lit(True)
    for mine, name in reversed(list(zip(own, ORDER, strict=True))):
        if name == "doc_id" and cut[name] is None:  # nulls come first in an ascending order
            decided = F.when(mine.isNull(), decided).otherwise(False)
            continue
        limit = F.lit(cut[name])
        decided = F.when(F.coalesce(mine < limit, F.lit(True)), True).otherwise(
            F.when(mine == limit, decided).otherwise(False)
        )
    return decided


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: size, source_size, target, ``copies`` in the mix, taken.

    The same rows give the same mix in every run. A null source is a source of
    its own, after all others. Documents without words have size 0 and take
    nothing. Equal rows stay apart; of them it does not matter which is taken.
    If no source has a word, nothing is taken. Other columns are not looked at.
    ``row_col`` may name a number that tells equal rows apart; it comes back as ``row``.
    """
    sizes = store(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row"),
            F.col(source_col).cast("string").alias("source"),
            word_count(text_or_empty(text_col)).alias("size"),
        ),
        "sizes",
    )
    queued, cut = fair_queue(sizes, weights, max_repeats, seed)
    if cut is None:
        copies = F.lit(0)
    else:
        turns = [_precedes_cut(cut, F.lit(t)).cast("int") for t in range(max_repeats)]
        copies = F.when(F.col("target") > 0, sum(turns[1:], turns[0])).otherwise(0)
    return queued.withColumn("copies", copies).select(
        "doc_id", "row", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it.

    The rows are numbered in a written copy of the table, so that equal rows and
    null ids find their own number of copies again. Takes the options of
    :func:`mix_sources`.
    """
    numbered = store(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "numbered")
    taken = mix_sources(numbered, row_col="_mix_row", **options).filter(F.col("copies") > 0).select(
        F.col("row").alias("_mix_row"), F.col("copies").alias("_mix_copies")
    )
    return (
        numbered.join(taken, "_mix_row")
        .withColumn("_mix_turn", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
