"""Nested records, fare sheets end to end, places."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from millrace.functions import tagging, text
from millrace.operators import nested, sheets

SHEET = """<p>INCENTIVE AGREEMENT. Originating from USA. Sales from 01Jan17 to 31Mar17</p>
<table><tr><th>RBD</th><th>FARE BASIS</th><th>ROUTE</th><th>AGENT DISCOUNT</th></tr>
<tr><td>J/C</td><td>JX</td><td>LAX - HKG</td><td>10%</td></tr><tr><td>Y</td><td>YX</td><td></td><td>5%</td></tr></table>
<p>RTW fares: no commission. travel from 01Feb17 to 30Apr17</p>"""


def test_commission_rows(spark):
    docs = spark.createDataFrame([(1, "US", SHEET), (2, "US", "<p>nothing</p>"), (3, "HK", SHEET), (4, "US", None)], "doc_id int, country string, html string")
    chosen = sheets.selected(docs, "incentive agreement", "US", spark.createDataFrame([(9,)], "doc_id int"))
    rows = sheets.commission_rows(chosen).orderBy("row", "rbd").collect()
    assert [(r["rbd"], r["agent_discount"], r["from_location"], r["to_location"]) for r in rows] == [("C", 10, ["LAX"], ["HKG"]), ("J", 10, ["LAX"], ["HKG"]), ("Y", 5, ["LAX"], ["HKG"])]
    one = rows[0]
    assert (one["originating"], one["sales_from"], one["sales_to"]) == (["+US"], "2017-01-01", "2017-03-31")
    assert (one["rtw_fare_comm"], one["ct_fare_comm"], one["trv_dis_date"]) == (0, 9999, "2017-04-30")
    assert sheets.selected(docs, "incentive agreement", "US", spark.createDataFrame([(1,)], "doc_id int")).count() == 0


def test_extension_records(spark):
    docs = spark.createDataFrame([
        (1, "sales from 20Sep17 Previous version valid upto 10Oct17", "iss_01Sep17.html"),
        (2, "Previous version valid upto 10Oct17", "iss_01Oct17.html"),
        (3, "nothing", "x"), (4, None, None),
    ], "doc_id int, text string, filename string")
    got = {r["doc_id"]: (r["effective_date"], r["days"]) for r in sheets.extension_records(docs).collect()}
    assert got == {1: (date(2017, 9, 20), 20), 2: (date(2017, 10, 1), 9)}


def test_nested(spark):
    rows = spark.sql("select named_struct('a', 'x', 'b', 'y') as c, array('p') as l, map('k', 1, 'm', 2) as one, map('k', 3) as two")
    changed = nested.set_field(nested.set_field(rows, "c.a", F.lit("z")), "c.d", F.lit(5))
    assert changed.select("c.*").first().asDict() == {"a": "z", "b": "y", "d": 5}
    assert nested.unset_field(rows, "c.a").select("c.*").columns == ["b"]
    assert rows.select(nested.add_to_set(F.col("l"), F.lit("q"), F.lit("p"))).first()[0] == ["p", "q"]
    assert nested.with_keys(rows, "c", ["a", "new"]).select("c.*").first().asDict() == {"a": "x", "new": None}
    merged, keys, back = rows.select(nested.merge_maps(F.col("one"), F.col("two")), nested.all_keys(F.col("one"), F.col("two")), nested.inverted(F.col("one"))).first()
    assert merged == {"m": 2, "k": 3} and keys == ["k", "m"] and back == {1: "k", 2: "m"}
    labels = spark.createDataFrame([("paper",), ("other",), (None,)], "l string")
    assert [r[0] for r in labels.select(nested.recode_labels(F.col("l"), {"paper": "no", "filed": "yes"})).collect()] == ["no", "other", None]


def test_shapes(spark):
    rows = spark.createDataFrame([("12",), ("1e3",), ("x",), ("٣",), (None,)], "t string")
    assert [r[0] for r in rows.select(F.coalesce(text.is_number(F.col("t")), F.lit(False))).collect()] == [True, True, False, True, False]
    cases = spark.createDataFrame([("ABC",), ("Abc",), ("abc",), ("aBc",), ("12",)], "t string")
    assert [r[0] for r in cases.select(text.case_of(F.col("t"))).collect()] == ["upper", "title", "lower", "mixed", None]
    words = spark.createDataFrame([("HKG1FF52",), ("HKX1FF520",)], "word string")
    known = spark.createDataFrame([("HKG1FF520", 1), ("HKG2FF52", 1)], "word string, freq long")
    assert text.code_candidates(words, known).collect() == [("HKG1FF52", "HKG1FF520")]
    assert spark.sql("select 'a <table 12>' as t").select(text.bookmark_number(F.col("t"))).first()[0] == 12


def test_places():
    known = frozenset(("SAN FRANCISCO", "SAN JOSE", "CA", "USA"))
    words = "San Francisco CA is cold compared to San Jose , CA".split()
    assert [p[0] for p in tagging.merge_places(words, known)] == ["San Francisco CA", "San Jose , CA"]
    assert tagging.merge_places([], known) == []
