"""Tags of word lists in Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from millrace.functions import tagging as G


def test_word_tags_keep_lists_nulls_and_order(spark):
    lists = [["from", "HKG", "x1"], None, [], ["fares", None, "fares"], ["going"] * 1000]
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, words array<string>").repartition(1)
    got = {r["id"]: r["tags"] for r in rows.select("id", G.word_tags(F.col("words")).alias("tags")).collect()}
    assert got == {i: None if ws is None else [None if w is None else G.tag_word(w) for w in ws] for i, ws in enumerate(lists)}


def test_tag_tokens_stay_in_arrow(spark):
    lists = [["from", "HKG", "x1"], None, [], ["going"] * 1000]
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, words array<string>").repartition(1)
    tables = {"x1": "KNOWN"}
    made = rows.select("id", G.tag_tokens(F.col("words"), tables).alias("t"))
    got = {r["id"]: None if r["t"] is None else [(x["word"], x["tag"]) for x in r["t"]] for r in made.collect()}
    assert got == {i: None if ws is None else [(w, G.tag_word(w, tables)) for w in ws] for i, ws in enumerate(lists)}
    assert "ArrowEvalPython" in made._jdf.queryExecution().executedPlan().toString() and "array<struct<word" in made.dtypes[1][1]
    kind = pa.list_(pa.string())
    pieces = G._tagged(pa.array(lists, kind).slice(1, 3), None)
    assert pieces.to_pylist() == [None, [], ["VBG"] * 1000]
