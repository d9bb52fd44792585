"""Quoted delimited files read in parallel, however large a single file is.

A line end inside quotes is part of a field, so a line cannot be understood
before it is known whether the file is inside quotes where the line begins. A
line maps the state before it (outside or inside quotes) to the state after it;
the maps of lines, and of whole splits, are put together. Three steps:

1. every split of every file is mapped on its own, from two flags per line;
2. the maps of a file's splits, one row each, are put together in order: this
   gives the state in which each split begins;
3. every split is cut into records; a record that crosses a split comes out in
   pieces, which are the only rows that move, and are joined.

The lines themselves are never shuffled. Records are parsed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.session import store

MAX_PIECES = 64  # splits that one record may reach into
_PIECE = "file string, block long, at long, piece string, starts boolean, ends boolean"


def _pattern(separator: str) -> tuple[str, str]:
    """Lines that end outside quotes: begun outside, and begun inside.

    A field is quoted if its first character is a quote; a doubled quote inside
    stands for one, and what follows a closing quote belongs to the field.
    """
    sep = "\\" + separator if separator in "|.^$*+?()[]{}\\" else separator
    closed = f'[^"]*+(?:""[^"]*+)*+"[^{sep}]*+'
    field = f'(?:"{closed}|(?!")[^{sep}]*+)'
    return f"^{field}(?:{sep}{field})*+$", f"^{closed}(?:{sep}{field})*+$"


def _lines(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """file, block, value, and whether the line ends inside quotes when it begins
    outside (``from_out``) or inside (``from_in``); in the order of the file."""
    outside, inside = _pattern(separator)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        (~F.col("value").rlike(outside)).alias("from_out"), (~F.col("value").rlike(inside)).alias("from_in"),
    )


def _map_splits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per split of the task: the states after it."""
    at, out, inn = None, False, True
    for batch in batches:
        for file, block, a, b in zip(batch["file"], batch["block"], batch["from_out"], batch["from_in"], strict=True):
            if (file, block) != at:
                if at is not None:
                    yield pd.DataFrame([(*at, out, inn)], columns=["file", "block", "from_out", "from_in"])
                at, out, inn = (file, block), False, True
            out, inn = (b if out else a), (b if inn else a)
    if at is not None:
        yield pd.DataFrame([(*at, out, inn)], columns=["file", "block", "from_out", "from_in"])


def split_states(splits: DataFrame) -> DataFrame:
    """(file, block, inside): whether each split begins inside quotes.

    A split that ends alike from both states settles what follows; between such
    splits only turns (the state changes over) count. Rows are splits, so even a
    file of many terabytes is a small group here.
    """
    order = Window.partitionBy("file").orderBy("block")
    turn = ((F.col("from_out")) & ~F.col("from_in")).cast("int")
    turns = splits.withColumn("turns", F.sum(turn).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    settled = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out").cast("int") + F.col("turns"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    count = F.coalesce(F.last(settled, ignorenulls=True).over(earlier), F.lit(0)) + F.coalesce(F.last("turns").over(earlier), F.lit(0))
    return turns.select("file", "block", (count % 2 == 1).alias("inside"))


def _cut_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records and pieces of records of the task's splits, in order."""
    here, number, held, starts, inside = None, 0, [], True, False
    for batch in batches:
        out = []
        columns = (batch[c].tolist() for c in ("file", "block", "value", "from_out", "from_in", "inside"))
        for file, block, line, a, b, first in zip(*columns, strict=True):
            if (file, block) != here:
                if held:
                    out.append((*here, number, "\n".join(held), starts, False))
                here, number, held, starts, inside = (file, block), 0, [], not first, first
            held.append(line)
            inside = b if inside else a
            if not inside:
                out.append((file, block, number, "\n".join(held), starts, True))
                number, held, starts = number + 1, [], True
        yield pd.DataFrame(out, columns=["file", "block", "at", "piece", "starts", "ends"])
    if held:
        yield pd.DataFrame([(*here, number, "\n".join(held), starts, False)],
                           columns=["file", "block", "at", "piece", "starts", "ends"])


@contextmanager
def _split_size(spark: SparkSession, size: int | None):
    """Both passes over a file must cut it alike."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if size is not None:
        spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _joined(pieces: DataFrame) -> DataFrame:
    """(file, block, at, record, broken): pieces put together to records.

    A record that never ends, or reaches into more than ``MAX_PIECES`` splits, is
    broken and stays in pieces, so that no task holds it whole.
    """
    order = Window.partitionBy("file").orderBy("block", "at")
    number = F.sum(F.col("starts").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = pieces.withColumn("record", number)
    together = Window.partitionBy("file", "record")
    judged = numbered.withColumn(
        "broken", ~F.max("ends").over(together) | (F.count(F.lit(1)).over(together) > MAX_PIECES)
    )
    whole = judged.filter(~F.col("broken")).groupBy("file", "record").agg(
        F.min("block").alias("block"), F.min(F.struct("block", "at")).getField("at").alias("at"),
        F.sort_array(F.collect_list(F.struct("block", "at", "piece"))).alias("p"),
    ).select("file", "block", "at", F.array_join(F.col("p.piece"), "\n").alias("record"), F.lit(False).alias("broken"))
    return whole.unionByName(
        judged.filter("broken").select("file", "block", "at", F.col("piece").alias("record"), "broken")
    )


def read_records(spark: SparkSession, path: str, separator: str = ",", split_bytes: int | None = None) -> DataFrame:
    """(file, block, at, record, broken) of all records, written to the shared
    folder on the way; ``block`` and ``at`` give their order in the file."""
    with _split_size(spark, split_bytes):
        lines = _lines(spark, path, separator)
        splits = store(
            lines.select("file", "block", "from_out", "from_in")
            .mapInPandas(_map_splits, "file string, block long, from_out boolean, from_in boolean"), "splits",
        )
        entered = split_states(splits).filter("inside")  # few: a split must begin inside quotes
        placed = lines.join(F.broadcast(entered), ["file", "block"], "left")
        pieces = store(
            placed.select("file", "block", "value", "from_out", "from_in", F.coalesce("inside", F.lit(False)).alias("inside"))
            .mapInPandas(_cut_records, _PIECE), "records",
        )
    whole = pieces.filter(F.col("starts") & F.col("ends"))
    return whole.select("file", "block", "at", F.col("piece").alias("record"), F.lit(False).alias("broken")).unionByName(
        _joined(pieces.filter(~(F.col("starts") & F.col("ends"))))
    )


def read_csv_tolerant(
    spark: SparkSession, path: str, schema: T.StructType, separator: str = ",", split_bytes: int | None = None,
    header: bool = True,
) -> DataFrame:
    """CSV, every file with a ``header`` line or none; malformed records come back in ``_malformed``, not lost.

    A record is malformed if its number of fields or a value does not fit the
    schema, or if a quote is never closed; then the rest of the file is one
    malformed record, or several, one for each split. Empty lines are left out.
    """
    records = read_records(spark, path, separator, split_bytes)
    heading = F.lit(header) & (F.col("block") == 0) & (F.col("at") == 0)
    text = F.regexp_replace("record", "\r$", "")
    kept = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed", "quote": '"', "escape": '"',
               "sep": separator, "maxCharsPerColumn": "-1", "multiLine": "true"}
    parsed = records.filter(~heading & (text != "")).select(
        text.alias("record"), "broken", F.from_csv(text, _ddl(kept), options).alias("r")
    )
    return parsed.select(*[
        F.when(~F.col("broken"), F.col("r").getField(f.name)).alias(f.name) for f in schema.fields
    ], F.when(F.col("broken"), F.col("record")).otherwise(F.col("r._malformed")).alias("_malformed"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

