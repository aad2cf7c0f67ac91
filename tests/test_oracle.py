"""Every registered query against its DuckDB text, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from millrace.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return round(value, 6) if math.isfinite(value) else str(value)
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{Path(sf_dir) / name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.fixture(scope="module")
def larger():
    path = Path("/root/testdata/sf0.01")
    if not path.exists():
        pytest.skip("the test tables are not here")
    return str(path)


def test_language_detection_is_right(spark, larger):
    right, total = QUERIES["lang_detect"](spark, larger).selectExpr("count_if(lang = detected)", "count(*)").first()
    assert right / total > 0.95


@pytest.mark.parametrize("kind", ["tree", "forest", "bayes", "svc"])
def test_models_learn_their_labels(spark, larger, kind):
    """About as often right as the most frequent label, or, where classes are weighed alike, right on half of each class."""
    found = QUERIES[f"model_{kind}"](spark, larger).groupBy("label", "prediction").count().collect()
    total = sum(r["count"] for r in found)
    by_label = {label: sum(r["count"] for r in found if r["label"] == label) for label in {r["label"] for r in found}}
    right = {r["label"]: r["count"] for r in found if r["label"] == r["prediction"]}
    recall = sum(right.get(label, 0) / n for label, n in by_label.items()) / len(by_label)
    assert total > 300 and (sum(right.values()) >= 0.95 * max(by_label.values()) or recall >= 0.5)


def test_leave_out_and_two_level_clusters(spark, larger):
    from millrace.ml import evaluate, models
    from millrace.plans.features import _training

    data, _ = _training(spark, larger)
    found = evaluate.leave_out(data, "doc_id", lambda rows: models.fit("tree", rows, 0), 3)
    assert found.count() == data.count() and evaluate.wrong_rows(found, "doc_id").count() < 0.7 * data.count()
    docs = spark.read.parquet(f"{larger}/documents.parquet").where("lang = 'en'").select("doc_id", "text")
    parts = evaluate.two_level_clusters(docs, "doc_id", "text", 3, 2)
    assert parts.where("cluster = 0 and part is null or cluster <> 0 and part is not null").count() == 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
