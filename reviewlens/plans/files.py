"""Source and sink queries: tables go out to the shared folder and come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions.columns import feature_names, rename_present
from reviewlens.operators import olap as O
from reviewlens.operators import reviewers as RW
from reviewlens.operators import sellers as SL
from reviewlens.plans.registry import query, r, rounded, with_ctes
from reviewlens.plans.rules import profiles
from reviewlens.plans.sql import CORE, L1, PROFILES, WITH_CUBES
from reviewlens.session import scratch_path, store
from reviewlens.sources import files, fixture
from reviewlens.sources.fixture import table

_LINE_ENDS = r"[\r\n]"


def _tsv(df, spark, name):
    """Write columns as tab-separated lines, the way the raw files come."""
    path = scratch_path(spark, name)
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).write.text(path)
    return path


@query("read_review_metadata", with_ctes([CORE], """
    SELECT CAST(user_id AS INTEGER) AS user_id, CAST(prod_id AS INTEGER) AS prod_id,
           CAST(rating AS DOUBLE) AS rating, label, CAST(date AS VARCHAR) AS date FROM core"""))
def read_review_metadata(spark, sf):
    path = _tsv(fixture.metadata(spark, sf), spark, "metadata")
    return rounded(files.read_review_metadata(spark, path))


@query("read_edges", with_ctes([CORE], """
    SELECT CAST(user_id AS INTEGER) AS user_id, CAST(prod_id AS INTEGER) AS prod_id,
           CAST(rating AS DOUBLE) AS rating FROM core"""))
def read_edges(spark, sf):
    edges = fixture.metadata(spark, sf).select("user_id", "prod_id", "rating")
    return rounded(files.read_edges(spark, _tsv(edges, spark, "edges")))


@query("read_id_map", """
    SELECT s_name AS business_name, CAST(s_suppkey AS INTEGER) AS numeric_id FROM supplier""")
def read_id_map(spark, sf):
    return files.read_product_map(spark, _tsv(fixture.product_map(spark, sf), spark, "products"))


@query("read_user_map", """
    SELECT c_name AS original_id, CAST(c_custkey AS INTEGER) AS numeric_id FROM customer""")
def read_user_map(spark, sf):
    names = table(spark, sf, "customer").select("c_name", "c_custkey")
    return files.read_user_map(spark, _tsv(names, spark, "users"))


def _content(spark, sf):
    """Documents as content lines; a line holds one text, so line ends become blanks."""
    return table(spark, sf, "documents").select(
        "doc_id", "n_chars", "source", F.regexp_replace("text", _LINE_ENDS, " ").alias("text")
    )


@query("read_review_content", """
    SELECT CAST(doc_id AS INTEGER) AS user_id, CAST(n_chars AS INTEGER) AS prod_id, source AS date,
           regexp_replace(text, '[\\r\\n]', ' ', 'g') AS review_text FROM documents""")
def read_review_content(spark, sf):
    return files.read_review_content(spark, _tsv(_content(spark, sf), spark, "content"))


# the bare texts lack ids, so they come back as rejects
@query("reject_counts", """
    SELECT CASE WHEN len(string_split(t, chr(9))) < 3 THEN 'too few fields'
                ELSE 'id is not a number' END AS reason, count(*) AS n_lines
    FROM (SELECT regexp_replace(text, '[\\r\\n]', ' ', 'g') AS t FROM documents) GROUP BY 1""")
def reject_counts(spark, sf):
    lines = _content(spark, sf)
    mixed = lines.select(F.concat_ws("\t", "doc_id", "n_chars", "source", "text").alias("value"))
    path = scratch_path(spark, "mixed")
    mixed.union(lines.select("text")).write.text(path)
    return files.reject_counts(spark, path)


@query("write_table", with_ctes(L1, f"""
    SELECT year_month, count(*) AS n_reviews, {r('avg(rating)', 'avg_rating')}
    FROM reviews GROUP BY year_month"""))
def write_table(spark, sf):
    path = files.write_table(
        fixture.reviews(spark, sf), scratch_path(spark, "reviews"), ["year_month"]
    )
    back = spark.read.schema("rating int, year_month string").parquet(path)
    return rounded(back.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.avg("rating").alias("avg_rating")
    ))


@query("write_csv", """
    SELECT doc_id, lang, source, n_chars, text FROM documents""")
def write_csv(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    path = files.write_csv(docs, scratch_path(spark, "documents"))
    back = files.read_csv_tolerant(spark, path, docs.schema)
    return back.filter("_malformed IS NULL").drop("_malformed")


@query("read_csv_tolerant", """
    SELECT doc_id, lang, source, n_chars, text, CAST(NULL AS VARCHAR) AS malformed FROM documents
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, doc_id || ',too,many,fields,in,this,line' FROM documents
    WHERE doc_id % 7 = 3""")
def read_csv_tolerant(spark, sf):
    """Whole texts with line ends inside quotes, broken lines among them; every file is read in many splits."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    line = F.to_csv(F.struct(*docs.columns), {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                                              "ignoreTrailingWhiteSpace": "false", "quoteAll": "true"})
    broken = F.concat(F.col("doc_id").cast("string"), F.lit(",too,many,fields,in,this,line"))
    lines = F.when(F.col("doc_id") % 7 == 3, F.array(line, broken)).otherwise(F.array(line))
    path = scratch_path(spark, "lines")
    docs.select(F.explode(lines).alias("value")).write.text(path)
    back = files.read_csv_tolerant(spark, path, docs.schema, split_bytes=1 << 18, header=False)
    fine = F.col("_malformed").isNull()
    return back.select(*[F.when(fine, F.col(c)).alias(c) for c in docs.columns], F.col("_malformed").alias("malformed"))


@query("write_table_sized", with_ctes(L1, f"""
    SELECT year_month, count(*) AS n_reviews, {r('avg(rating)', 'avg_rating')}, true AS files_bounded
    FROM reviews GROUP BY year_month"""))
def write_table_sized(spark, sf):
    """Reviews by month in files of a quarter megabyte; are there as few as bytes and months ask for?"""
    reviews, size = store(fixture.reviews(spark, sf), "reviews"), 1 << 18
    path = files.write_table(reviews, scratch_path(spark, "sized"), ["year_month"], file_bytes=size)
    back = spark.read.schema("rating int, year_month string").parquet(path)
    totals = reviews.groupBy("year_month").agg(F.sum(files.row_bytes(reviews)).alias("bytes"))
    by_file = back.groupBy("year_month", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total")
    )
    by_month = by_file.groupBy("year_month").agg(
        F.sum("n").alias("n_reviews"), (F.sum("total") / F.sum("n")).alias("avg_rating"), F.count(F.lit(1)).alias("n_files")
    )
    return rounded(by_month.join(totals, "year_month").select(
        "year_month", "n_reviews", "avg_rating", (F.col("n_files") <= F.ceil(F.col("bytes") / size)).alias("files_bounded")
    ))


@query("write_metrics", with_ctes(L1, f"""
    SELECT count(*) AS n_reviews, CAST(sum(is_spam) AS BIGINT) AS n_spam, {r('avg(is_spam)', 'spam_rate')},
           {r('avg(review_length)', 'avg_review_length')} FROM reviews"""))
def write_metrics(spark, sf):
    """A row of metrics as JSON, read back."""
    measured = fixture.reviews(spark, sf).agg(
        F.count(F.lit(1)).alias("n_reviews"), F.sum(F.col("is_spam").cast("long")).alias("n_spam"),
        F.avg(F.col("is_spam").cast("double")).alias("spam_rate"), F.avg("review_length").alias("avg_review_length"),
    )
    path = files.write_metrics(measured, scratch_path(spark, "metrics"))
    return rounded(spark.read.schema(measured.schema).json(path))


_OLD_NAMES = {"n_reviews": "review_count", "mean_rating": "avg_rating", "n_sellers": "unique_sellers", "burst": "burst_score"}
_MODEL_INPUTS = ["review_count", "avg_rating", "unique_sellers", "tenure_days", "burst_score"]


@query("model_inputs", with_ctes([*L1, PROFILES], f"""
    SELECT user_id, review_count, {r('avg_rating', 'avg_rating')}, unique_sellers, tenure_days, burst_score FROM profiles"""))
def model_inputs(spark, sf):
    """Profiles under older column names, renamed where needed; only declared features are left, so no label enters."""
    new_to_old = {new: old for old, new in _OLD_NAMES.items() if new != "burst_score"}  # one keeps its name
    older = profiles(spark, sf).withColumnsRenamed(new_to_old)
    renamed = rename_present(older, _OLD_NAMES)
    return rounded(renamed.select("user_id", *feature_names(renamed, _MODEL_INPUTS)))


@query("write_tables", with_ctes(L1, """
    SELECT 'reviews_enriched' AS "table", count(*) AS n_rows FROM reviews
    UNION ALL SELECT 'reviewer_profiles', count(DISTINCT user_id) FROM reviews
    UNION ALL SELECT 'seller_profiles', count(DISTINCT prod_id) FROM reviews"""))
def write_tables(spark, sf):
    reviews, people = fixture.reviews(spark, sf), profiles(spark, sf)
    sellers = store(SL.seller_profile(reviews, people), "sellers")  # written twice
    paths = files.write_tables(reviews, people, sellers, scratch_path(spark, "tables"))
    counts = [
        spark.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table"), "n_rows")
        for name in ("reviews_enriched", "reviewer_profiles", "seller_profiles")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("write_cubes", with_ctes(L1, """
    SELECT 'time_x_rating' AS cube, CAST(sum(n) AS BIGINT) AS total_reviews, count(*) AS n_cells
    FROM (SELECT count(*) AS n FROM reviews GROUP BY year_month, rating)"""))
def write_cubes(spark, sf):
    return _cube_totals(spark, _written_cubes(spark, sf), "time_x_rating")


_CUBES = {
    "time_x_rating": (O.cube_time_x_rating, "year_month, rating_int"),
    "tenure_x_rating": (O.cube_tenure_x_rating, "tenure_bin, rating_int"),
    "time_x_tenure": (O.cube_time_x_tenure, "year_month, tenure_bin"),
    "full_3d": (O.cube_full_3d, "year_month, rating_int, tenure_bin"),
}


def _written_cubes(spark, sf):
    reviews = fixture.reviews(spark, sf)
    cells = store(O.cube_input(reviews, RW.reviewer_profile(reviews)), "cells")
    cubes = {name: build(cells) for name, (build, _) in _CUBES.items()}
    return files.write_cubes(cubes, scratch_path(spark, "cubes"))


def _cube_totals(spark, paths, name):
    back = spark.read.option("header", True).csv(paths[f"{name}_csv"])
    return back.agg(
        F.first(F.lit(name)).alias("cube"),
        F.sum(F.col("total_reviews").cast("long")).alias("total_reviews"),
        F.count(F.lit(1)).alias("n_cells"),
    )


@query("write_cubes_whole", with_ctes(WITH_CUBES, " UNION ALL ".join(f"""
    SELECT '{name}' AS cube, CAST(sum(n) AS BIGINT) AS total_reviews, count(*) AS n_cells
    FROM (SELECT count(*) AS n FROM cube_input GROUP BY {dimensions})"""
    for name, (_, dimensions) in _CUBES.items())))
def write_cubes_whole(spark, sf):
    paths = _written_cubes(spark, sf)
    totals = [_cube_totals(spark, paths, name) for name in _CUBES]
    return totals[0].unionByName(totals[1]).unionByName(totals[2]).unionByName(totals[3])
