"""How queries read large inputs: what is shared, kept or counted early."""

from __future__ import annotations

import math

import numpy as np
import pytest


def test_mutual_information_counts_documents_not_pairs(spark):
    from millrace.ml import features as X

    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["b", "c"]), (2, ["a"]), (3, ["b"]), (4, None), (9, ["a", "z"])], "id int, words array<string>")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, None)], "id int, y int")
    made = X.mutual_information(docs, labels, "id", "words", "y")
    got = {r["word"]: r["mi"] for r in made.collect()}

    def part(n, row, size):
        return n / 4 * math.log(n * 4 / (row * size)) if n else 0.0

    def mi(n, sizes):  # n: documents with the word by class
        return sum(part(x, sum(n), s) + part(s - x, 4 - sum(n), s) for x, s in zip(n, sizes, strict=True))

    want = {"a": mi((2, 0, 0), (2, 1, 1)), "b": mi((1, 1, 0), (2, 1, 1)), "c": mi((1, 0, 0), (2, 1, 1))}
    assert got.keys() == want.keys() and all(math.isclose(got[w], want[w], abs_tol=1e-12) for w in want)
    assert {r["word"] for r in X.mutual_information(docs, labels, "id", "words", "y", 2).collect()} == {"a", "b"}


def test_holdout_runs_fits_on_kept_rows(spark, sf_dir, monkeypatch):
    from millrace.plans import features as P

    class Seen(Exception):
        pass

    def fit(kind, data, size):
        plan = data._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" in plan and "parquet" not in plan and "Join" not in plan
        raise Seen

    monkeypatch.setattr(P.M, "fit", fit)
    with pytest.raises(Seen):
        P.holdout_runs(spark, sf_dir)


def test_tf_idf_counts_words_once(spark, sf_dir):
    from millrace.functions.text import tf_idf

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = tf_idf(docs, "doc_id", "text", 2)
    made.collect()
    assert "ReusedExchange" in made._jdf.queryExecution().executedPlan().toString()


def test_file_counts_do_not_shuffle_the_words_of_texts(spark):
    from millrace.operators.tourcodes import file_counts

    codes = spark.createDataFrame([("x1",), ("y2",), (None,)], "code string")
    sheets = spark.createDataFrame([(1, ["x1"], "y2 z", "paper", None), (2, [], "Y2 x1 y2", "filed", None)], "sheet int, tourcodes array<string>, text string, faretype string, extension_date date")
    made = file_counts(codes, sheets)
    assert {(r["code"], r["faretype"], r["file_cnt"]) for r in made.collect()} == {("x1", "paper", 1), ("y2", "paper", 2)}
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= 1


def test_squares_of_near_points_lose_no_digits():
    from millrace.ml.silhouette import squares

    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 8)) + 1e6
    y = np.concatenate([x[:20], x[20:30] + 1e-7, rng.normal(size=(10, 8)) * 1e6])
    want = ((x[:, None] - y[None]) ** 2).sum(axis=2)
    np.testing.assert_allclose(squares(x, y), want, rtol=1e-9, atol=0)
    assert (squares(x, x).diagonal() == 0).all()
