"""Readers, writers, preprocessing, the star schema, selection."""

from __future__ import annotations

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import language, preprocess
from millrace.ml import evaluate, features, models, rules
from millrace.operators.commission_etl import star
from millrace.sources import readers, writers


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a", "b"], 'x, "y"\nz'), (2, None, None)], "id int, codes array<string>, text string")
    writers.write_csv(rows, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"), "id int, codes string, text string").orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a|b", 'x, "y"\nz'), (2, None, None)]
    assert readers.read_csv(spark, str(tmp_path / "c"), empty_as="").where("id = '2'").first()["text"] == ""


def test_label_folder(spark, tmp_path):
    for name in ("check_list_US_2018", "check_list_AU_CA_TH_2018"):
        (tmp_path / f"{name}.csv").write_text("filename,label\nf1,yes\n")
    rows = {r["country"] for r in readers.read_label_folder(spark, str(tmp_path), {"AU_CA_TH": "many"}).collect()}
    assert rows == {"US", "many"}


def test_upsert(spark):
    old = spark.createDataFrame([("a", "yes"), ("b", "no")], "f string, label string")
    new = spark.createDataFrame([("b", "yes"), ("c", "no"), ("a", None)], "f string, label string")
    assert dict(readers.upsert_labels(old, new, ["f"], "label").collect()) == {"a": "yes", "b": "yes", "c": "no"}


def test_page_store(spark):
    one = spark.createDataFrame([("f", "s")], "name string, content string")
    children = spark.createDataFrame([("f", 2, "c2"), ("f", 1, "c1"), ("g", 1, None)], "name string, n int, content string")
    blobs = spark.createDataFrame([("h", bytearray(b"blob"))], "name string, data binary")
    got = {r["name"]: r["html"] for r in readers.page_store(one, children, blobs, ["name"]).collect()}
    assert got == {"f": ["s", "c1", "c2"], "h": ["blob"]}


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("f", ["A", "B"]), (None, [])], "name string, codes array<string>")
    writers.write_code_lines(rows, ["name"], "codes", str(tmp_path / "t"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["\t", "f\tA\tB"]
    writers.write_record(spark, {"a": 1, "b": None}, str(tmp_path / "r"))
    writers.write_unique(rows, ["name"], str(tmp_path / "u"))
    with pytest.raises(ValueError):
        writers.write_unique(rows.unionByName(rows), ["name"], str(tmp_path / "u"))
    rest, failed = writers.split_failed(rows, rows.where("name = 'f'"), ["name"])
    assert (rest.count(), failed.count()) == (1, 1)
    for n in range(2):
        writers.register_run(spark, str(tmp_path / "runs"), accuracy=n)
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2
    assert len(writers.run_id()) == 14


def test_word_counts(spark, tmp_path):
    (tmp_path / "w.txt").write_text("the cat\nThe dog")
    assert dict(readers.word_counts(spark, str(tmp_path / "w.txt")).collect()) == {"THE": 2, "CAT": 1, "DOG": 1}


def test_rule_words():
    assert preprocess.rule_words("THE fare (CNY100), not/before") == ["fare", "CNY", "100", "not", "/", "before"]
    assert preprocess.rule_words(None) == []
    assert preprocess.chunk_words("COMISSIONS 10DEC HKG2407FF538 TRVL") == ["COMMISSION", "10", "DEC", "HKG2407FF538", "TRAVEL"]
    assert preprocess.correct_months(["Janury", "OCTOBR", "cat", "Oct"]) == ["January", "OCTOBER", "cat", "Oct"]
    assert preprocess.stems("The 3 companies walked, passes") == ["company", "walk", "pass"]
    assert preprocess.stems(None) == []


def test_preprocess_columns(spark):
    rows = spark.createDataFrame([("Sales 10Dec",), (None,)], "t string")
    got = rows.select(preprocess.chunk_words_of(F.col("t")).alias("w"), preprocess.stems_of(F.col("t")).alias("s")).collect()
    assert got[0]["w"] == ["Sales", "10", "Dec"] and got[1]["w"] == [] and got[1]["s"] == []
    cjk = spark.createDataFrame([("中国人 a 好",), ("",)], "t string").select(language.bigrams(F.col("t")).alias("b")).collect()
    assert cjk[0]["b"] == ["中国", "国人", "好"] and cjk[1]["b"] == []
    assert spark.createDataFrame([("ﬁ",), (None,)], "t string").select(language.nfkd(F.col("t"))).collect()[0][0] == "fi"


def test_star_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.COMMISSION)
    airports = spark.createDataFrame([], "code string, country string, city string, zone string")
    made = star(empty, airports, 2)
    assert [d.count() for d in (made.commissions, made.locations, made.location_map, made.rejected)] == [0, 0, 0, 0]


def test_vocabulary_is_kept(spark):
    rows = spark.createDataFrame([(1, {"a": "x", "b": "true", "n": "2.5"}), (2, {"a": "y", "z": None})], "id int, features map<string,string>")
    pairs = features.as_pairs(rows, "id")
    names = features.vocabulary_of(pairs)
    assert names == ["a=x", "a=y", "b", "n"]
    new = features.as_pairs(spark.createDataFrame([(3, {"a": "unseen", "b": "false", "n": "1"})], "id int, features map<string,string>"), "id")
    assert features.vectors(new, "id", names).first()["features"].toArray().tolist() == [0, 0, 0, 1]


def test_selection_and_folds(spark):
    rows = [(i, Vectors.dense(float(i % 2), float(i % 3 == 0), 1.0), float(i % 2)) for i in range(60)]
    data = spark.createDataFrame(rows, ["id", "features", "label"])
    tree = models.fit("tree", data, 3)
    assert evaluate.important(tree, ["odd", "third", "one"])[0][0] == "odd"
    kept, names = evaluate.keep_features(data, ["odd", "third", "one"], ["one", "odd"])
    assert names == ["odd", "one"] and len(kept.first()["features"]) == 2
    assert len(evaluate.select_varied(data).first()["features"]) == 2
    assert evaluate.select_chi2(data, 1).first()["features"].toArray().tolist() == [0.0]
    predicted = evaluate.leave_out(data, "id", lambda d: models.fit("tree", d, 3), 3)
    assert predicted.count() == 60 and evaluate.wrong_rows(predicted, "id").count() == 0


def test_rule_features(spark):
    rows = spark.createDataFrame([(1, "CALL THE fare desk now please", {"x_adhoc": True}), (2, "other fare", {"x_adhoc": False}), (3, None, None)], "id int, text string, tags map<string,boolean>")
    assert [r[0] for r in rows.orderBy("id").select(rules.adhoc_by_tags(F.col("tags"))).collect()] == [True, None, None]
    flags = rows.orderBy("id").select(*rules.phrase_flags(F.col("text"), {"desk": "fare DESK"})).collect()
    assert [r["desk"] for r in flags] == [True, False, False]
    assert rules.registry(spark, [("a", "flag"), ("b", "number")], ["x", "y"]).count() == 4
    bags = {r["id"]: r["words"] for r in rules.bags(rows.where("id < 3"), "id", "text").collect()}
    assert bags[2] == ["fare", "other"]
    words = rows.withColumn("w", F.split("text", " ")).orderBy("id")
    assert [r[0] for r in words.select(rules.context_flag(F.col("w"), "fare", ["desk"])).collect()] == [True, False, False]
    assert [r[0] for r in words.select(rules.context_flag(F.col("w"), "fare", ["desk"], ["now"])).collect()] == [False, False, False]
    assert [r[0] for r in words.select(rules.context_flag(F.col("w"), "fare", ["desk"], ["now"], strict_reference=True)).collect()] == [True, False, False]


def test_log_odds_and_two_levels(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "id int, label int")
    pairs = spark.createDataFrame([(i, "odd" if i % 2 else "even") for i in range(20)], "id int, word string")
    odds = dict(evaluate.word_log_odds(pairs, labels, "id", "label").collect())
    assert odds["odd"] > 0 > odds["even"]
    docs = spark.createDataFrame([(i, ("red apple " if i % 2 else "blue sea ") + f"w{i % 4}") for i in range(24)], "id int, text string")
    assert evaluate.two_level_clusters(docs, "id", "text", 2, 2).count() == 24


def test_votes_sweeps_and_splits(spark):
    from millrace.operators.relational import three_way_split

    rows = [(i, Vectors.dense(float(i % 2), float(i % 5)), float(i % 2)) for i in range(40)]
    data = spark.createDataFrame(rows, ["id", "features", "label"])
    trees = [models.fit("tree", data, 2) for _ in range(3)]
    assert models.vote(trees, data, "id").where("label = prediction").count() == 40
    assert set(models.silhouette_sweep(data, "id", [2, 3])) == {2, 3}
    parts = dict(three_way_split(data, ["id"]).groupBy("part").count().collect())
    assert set(parts) == {"test", "dev", "train"} and sum(parts.values()) == 40
    assert three_way_split(data, ["id"]).collect() == three_way_split(data, ["id"]).collect()


def test_jdbc_and_grids(spark, tmp_path):
    """The embedded database that Spark brings along, if it does."""
    from millrace.sources.readers import read_jdbc

    url = f"jdbc:derby:{tmp_path}/db;create=true"
    try:
        spark.range(20).selectExpr("cast(id as int) as ID", "cast(id * 2 as int) as TWICE").write.format("jdbc").options(url=url, dbtable="T", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    except Exception as e:
        import pytest

        pytest.skip(str(e)[:100])
    rows = read_jdbc(spark, url, "T", ["TWICE"], driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", partitionColumn="ID", lowerBound="0", upperBound="20", numPartitions="3")
    assert rows.rdd.getNumPartitions() == 3 and sorted(r["TWICE"] for r in rows.collect()) == list(range(0, 40, 2))


def test_boosting_grids(spark):
    from pyspark.ml.linalg import Vectors

    from millrace.ml import models

    data = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2), float(i % 7)])) for i in range(80)], ["label", "features"])
    best = models.select_grids(data, {"maxDepth": (1, 2), "maxIter": (2, 3)}, 2)
    assert best.transform(data).where("prediction <> label").count() == 0
