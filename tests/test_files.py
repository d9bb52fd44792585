"""Readers on awkward lines, writers, models on disk."""

from pyspark.sql import types as T

from reviewlens.operators import text_model as TX
from reviewlens.operators.clustering import choose_k
from reviewlens.operators.models import load_model, save_model
from reviewlens.sources import files


def test_content_keeps_tabs_and_counts_rejects(spark, tmp_path):
    path = tmp_path / "content"
    path.write_text(
        '1\t2\t2012-01-01\tgood\tfood, "nice"\n3\t4\t2012-01-02\nx\t4\t2012-01-02\thello\nonly one\n'
    )
    rows = files.read_review_content(spark, str(path)).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, 2, "2012-01-01", 'good\tfood, "nice"'), (3, 4, "2012-01-02", "")]
    counts = {r.reason: r.n_lines for r in files.reject_counts(spark, str(path)).collect()}
    assert counts == {"id is not a number": 1, "too few fields": 1}


def test_maps_and_metadata(spark, tmp_path):
    (tmp_path / "meta").write_text("5\t6\t4.0\t-1\t2012-01-01\n")
    (tmp_path / "map").write_text('Joe "Big" Diner\t7\n')
    assert tuple(files.read_review_metadata(spark, str(tmp_path / "meta")).first()) == (5, 6, 4.0, -1, "2012-01-01")
    assert tuple(files.read_product_map(spark, str(tmp_path / "map")).first()) == ('Joe "Big" Diner', 7)


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi", twice'), (2, "two\nlines"), (3, " padded ")]
    df = spark.createDataFrame(rows, "id int, text string")
    path = files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv_tolerant(spark, path, df.schema).orderBy("id").collect()
    assert [(r.id, r.text) for r in back] == rows


def test_malformed_csv_is_kept_apart(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,n\n1,2\nx,y\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    df = files.read_csv_tolerant(spark, str(tmp_path / "bad.csv"), schema).cache()
    assert df.count() == 2 and df.filter("_malformed IS NOT NULL").count() == 1


def test_partitioned_table_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([(1, "2012-01"), (2, "2012-02")], "id int, year_month string")
    path = files.write_table(df, str(tmp_path / "t"), ["year_month"])
    assert spark.read.parquet(path).filter("year_month = '2012-02'").first().id == 2
    back = spark.read.json(files.write_metrics(df.limit(1), str(tmp_path / "m")))
    assert back.count() == 1


def test_text_model_round_trip(spark, tmp_path):
    rows = [(i, "cheap pills buy now" if i % 4 == 0 else "lovely dinner with friends", int(i % 4 == 0))
            for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, text string, y int")
    model = TX.fit_text_model(df)
    again = load_model(save_model(model, str(tmp_path / "model")))
    probs = {r.doc_id: r.text_spam_prob for r in TX.text_spam_prob(again, df, ["doc_id"]).collect()}
    assert min(probs[i] for i in range(0, 60, 4)) > max(p for i, p in probs.items() if i % 4)
    odd = spark.createDataFrame([(1, None), (2, "nan"), (3, " short ")], "doc_id int, text string")
    assert [r["text_spam_prob"] for r in TX.text_spam_prob(model, odd, ["doc_id"]).collect()] == [None] * 3


def test_choose_k(spark):
    def picked(rows):
        return choose_k(spark.createDataFrame(rows, "k int, inertia double, silhouette double")).first()

    near = picked([(2, 100.0, 0.2), (3, 40.0, 0.6), (4, 30.0, 0.3), (5, 25.0, 0.1)])
    assert (near.elbow_k, near.silhouette_k, near.recommended_k) == (3, 3, 3)
    far = picked([(2, 100.0, 0.2), (3, 40.0, 0.3), (4, 30.0, 0.3), (5, 25.0, 0.1), (6, 22.0, 0.1), (7, 20.0, 0.9)])
    assert far.recommended_k == 5
