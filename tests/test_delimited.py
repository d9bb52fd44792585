"""Parallel reading of quoted files beside the csv module, and packed writing."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.sources import delimited, files

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])


def written(rows, header=("id", "text", "n")):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def texts(count, seed=1):
    rng = random.Random(seed)
    parts = ["a", "b,c", '"', '""', "\n", "\n\n", "long words here ", "é", '",', ',"', "'", '\n"x', "x\ny", "r\r\ns"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(count)]


@pytest.mark.parametrize("split_bytes", [300, 4_000, None])
def test_records_match_the_csv_module(spark, tmp_path, split_bytes):
    rows = [(i, t, i * 2) for i, t in enumerate(texts(900))]
    rows.append((900, "line\n" * 400 + '"quoted"\n' * 200, 5))  # reaches over many splits
    (tmp_path / "a.csv").write_text(written(rows))
    (tmp_path / "b.csv").write_text(written([(1000, "second\nfile", 1)]))
    records = delimited.read_records(spark, str(tmp_path), split_bytes=split_bytes)
    want = sorted([written([r]).split("\n", 1)[1][:-1] for r in [*rows, (1000, "second\nfile", 1)]] + ["id,text,n"] * 2)
    assert sorted(r["record"] for r in records.filter("NOT broken").collect()) == want
    got = files.read_csv_tolerant(spark, str(tmp_path), SCHEMA, split_bytes=split_bytes).collect()
    assert all(r["_malformed"] is None for r in got)
    assert sorted((r["id"], r["text"] or "", r["n"]) for r in got) == sorted([*rows, (1000, "second\nfile", 1)])


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "one.csv").write_text(written([(i, "some\ntext", i) for i in range(4_000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    records = delimited.read_records(spark, str(tmp_path / "one.csv"), split_bytes=4_000)
    assert records.select("block").distinct().count() > 8 and records.count() == 4_001
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before  # left as it was


def test_broken_lines_are_kept_apart(spark, tmp_path):
    text = written([(1, "fine", 1)]) + 'x,not a number,1\n2,too,many,fields\n3,few\n\n4,5" pipe,7\n5,"closed" late,8\r\n'
    (tmp_path / "bad.csv").write_text(text + '6,"never closed\n7,inside,1\n8,inside,2\n' + "9,inside,3\n" * 200)
    got = files.read_csv_tolerant(spark, str(tmp_path), SCHEMA, split_bytes=500).collect()
    good = sorted((r["id"], r["text"], r["n"]) for r in got if r["_malformed"] is None)
    assert [g for g in good if g[0] in (1, 4)] == [(1, "fine", 1), (4, '5" pipe', 7)]
    bad = [r["_malformed"] for r in got if r["_malformed"] is not None]
    assert {"x,not a number,1", "2,too,many,fields", "3,few"} <= set(bad)
    lost = [b for b in bad if "inside" in b]
    assert len(lost) > 1 and sum(b.count("inside") for b in lost) == 202


def test_state_of_splits(spark):
    rng = random.Random(4)
    maps = [(f, b, rng.random() < 0.5, rng.random() < 0.5) for f in "ab" for b in range(60)]
    splits = spark.createDataFrame(maps, "file string, block long, from_out boolean, from_in boolean")
    got = {(r["file"], r["block"]): r["inside"] for r in delimited.split_states(splits).collect()}
    for f in "ab":
        state = False
        for _, b, out, inn in [m for m in maps if m[0] == f]:
            assert got[f, b] == state
            state = inn if state else out


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,text,n\n")
    (tmp_path / "e.csv").write_text("")
    assert files.read_csv_tolerant(spark, str(tmp_path), SCHEMA).count() == 0


def test_packed_files(spark, tmp_path):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
            F.concat(F.lit("m"), (F.col("id") % 40).cast("string"))
        ).alias("month"), "id", F.lpad(F.col("id").cast("string"), 30, "x").alias("text"),
    ).repartition(64)
    path, size = str(tmp_path / "t"), 100_000
    files.write_table(df, path, ["month"], file_bytes=size)
    back = spark.read.parquet(path)
    assert back.count() == 60_000 and back.agg(F.sum("id")).first()[0] == 60_000 * 59_999 // 2
    per_file = back.select("month", F.col("_metadata.file_path").alias("file")).distinct()
    counted = {r["month"]: r["count"] for r in per_file.groupBy("month").count().collect()}
    total = df.agg(F.sum(files.row_bytes(df))).first()[0]
    assert sum(counted.values()) <= total / size + len(counted) + 1
    assert counted["hot"] > 5 and all(n == 1 for m, n in counted.items() if m != "hot")
