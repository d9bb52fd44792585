"""Merkle manifest of a dataset: leaves, subroots, root and inclusion proofs by lag and lead windows.

Every row is a leaf; the leaves of a source form a tree, and the roots of the
sources form one more. Runs of 16 consecutive nodes have one parent. On every
level a window over each run holds, for every node, its siblings at the fixed
offsets -15 to 15, masked by the node's slot and the length of its run; the rows
of first children hash their parents. A run is a window of its own, so a source
of any size is spread over all tasks, and no level needs more than one shuffle.

Levels are built upwards and written to the shared folder, each a sixteenth of
the one below. Then paths are handed down: a node's path is its own siblings and
the path of its parent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import store

FANOUT = 16  # consecutive nodes under one parent

# Which letters tampering lowers.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STEP = "struct<left: string, right: string>"


def hashed(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(columns: list[Column]) -> Column:
    """The digest of a row: for each value ``-`` if null, else its length in
    UTF-8 bytes, ``:`` and the value."""
    def spelled(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return hashed(*[spelled(c) for c in columns])


def positions(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """Add ``pos``, the place of a row in its ``by`` group from 0 on, and ``n``,
    the rows of the group; written to the shared folder on the way.

    Rows are dealt by ranges of (by, order). A group has one count per range it
    reaches into, and these counts are added up, not its rows.
    """
    ranges = [F.col(c).asc_nulls_first() for c in by]
    dealt = store(rows.repartitionByRange(*ranges, *order).withColumn("_range", F.spark_partition_id()), "merkle-rows")
    group = Window.partitionBy(*by, F.lit(0))
    before = dealt.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_k")).select(
        *[F.col(c).alias(f"_b_{c}") for c in by], F.col("_range").alias("_b_range"), F.sum("_k").over(group).alias("n"),
        F.coalesce(
            F.sum("_k").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    same = F.col("_range") == F.col("_b_range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    return dealt.withColumn("_row", F.row_number().over(inside)).join(before, same).withColumn(
        "pos", F.col("_before") + F.col("_row") - 1
    ).drop("_range", "_row", "_before", "_b_range", *[f"_b_{c}" for c in by])


def with_siblings(nodes: DataFrame, by: list[str]) -> DataFrame:
    """Add ``run`` (the place of the parent), ``slot``, and ``left`` and
    ``right``: the digests of the siblings before and after a node, joined."""
    slot = F.pmod("pos", F.lit(FANOUT))
    placed = nodes.withColumns({"slot": slot, "run": F.floor(F.col("pos") / FANOUT)})
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT)
    run = Window.partitionBy(*by, "run").orderBy("pos")
    left = [F.when(F.col("slot") >= k, F.lag("digest", k).over(run)) for k in range(FANOUT - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < length, F.lead("digest", k).over(run)) for k in range(1, FANOUT)]
    return placed.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)})


def parents(nodes: DataFrame, by: list[str]) -> DataFrame:
    """The next level: one row per run of trees that still have several nodes."""
    first = with_siblings(nodes.filter(F.col("n") > 1), by).filter(F.col("slot") == 0)
    return first.select(
        *by, F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"),
        hashed(F.col("digest"), F.col("right")).alias("digest"),
    )


def levels(leaves: DataFrame, by: list[str]) -> list[DataFrame]:
    """All levels of the trees of the ``by`` groups, each stored; ``leaves`` are
    stored rows with ``pos``, ``n`` and ``digest``."""
    out = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(store(parents(out[-1].select(*by, "pos", "n", "digest"), by), "merkle-level"))
        most = -(-most // FANOUT)
    return out


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys in which a null equals a null; the right ones go."""
    named, same = right.withColumnsRenamed({k: f"_r_{k}" for k in keys}), F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(named, same).drop(*[f"_r_{k}" for k in keys])


def hand_down(tree: list[DataFrame], by: list[str], tops: DataFrame | None, given: list[str]) -> DataFrame:
    """The lowest level with ``path``, an array of (left, right) from a node up
    to the top, and the ``given`` columns of ``tops``.

    ``tops`` has one row per ``by`` group: the ``path`` from the group's root on.
    """
    above = None
    for nodes in reversed(tree):
        top = nodes.filter(F.col("n") == 1)
        top = _beside(top, tops, by) if tops is not None else top.withColumn("path", F.array().cast(f"array<{_STEP}>"))
        if above is None:
            above = top
            continue
        parent = above.select(*by, F.col("pos").alias("run"), F.col("path").alias("_above"), *given)
        inner = _beside(with_siblings(nodes.filter(F.col("n") > 1), by), parent, [*by, "run"])
        step = F.struct("left", "right").cast(_STEP)
        inner = inner.withColumn("path", F.concat(F.array(step), "_above"))
        above = top.unionByName(inner.select(*top.columns))
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda digest, step: hashed(step["left"], digest, step["right"]))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


@dataclass(frozen=True)
class Manifest:
    """``rows``: doc_id, source, leaf, subroot, path; ``root``: its digest, null without rows."""

    rows: DataFrame
    root: Column


def build_manifest(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
    value_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), carry: dict[str, Column] | None = None,
) -> Manifest:
    """Leaf, subroot and path to the root of every row.

    ``value_cols`` go into the leaf in this order; ``carry`` names further
    columns to keep, as expressions over ``docs``. Any value may be null. Rows
    without a source are a source of their own, the first. In a source rows go
    by id, a null id first; rows of equal ids go by leaf, so rows that are equal
    in all values may change places without changing a digest. Every row is a
    leaf, repeated ones too; other columns are not looked at. Without rows there
    are no rows and no root. Texts are read once and hashed whole.
    """
    carry = carry or {}
    leaves = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        leaf_of([F.col(f"`{c}`") for c in value_cols]).alias("digest"), *[c.alias(name) for name, c in carry.items()],
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()]
    hashed_once = store(leaves, "merkle-digests")  # ranges are drawn from a sample, which would hash texts again
    tree = levels(store(positions(hashed_once, ["source"], order), "merkle-leaves"), ["source"])
    tops = [nodes.filter(F.col("n") == 1).select("source", "digest") for nodes in tree]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    upper = levels(
        store(positions(subroots, [], [F.col("source").asc_nulls_first()]), "merkle-subroots"), []
    )
    root = upper[-1].agg(F.max("digest")).scalar()
    above = hand_down(upper, [], None, []).select("source", F.col("digest").alias("subroot"), "path")
    rows = hand_down(tree, ["source"], store(above, "merkle-paths"), ["subroot"])
    return Manifest(rows.select("doc_id", "source", F.col("digest").alias("leaf"), "subroot", "path", *carry), root)


def verify(manifest: Manifest, leaf: Column) -> DataFrame:
    """The manifest's rows with ``folded_root``, to which ``leaf`` and the stored
    siblings lead, ``root``, and ``verified``, whether the two are equal."""
    known = manifest.rows.withColumns({"root": manifest.root, "folded_root": folded(leaf, F.col("path"))})
    return known.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_cased(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
