"""Functions on small inputs: golden cases, nulls, empties."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import dates, extract, html_tables, language, tagging, text
from millrace.operators import joins, relational, windows


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]


@pytest.mark.parametrize("numbers, strict, day", [
    ((25, 12, 2017), False, date(2017, 12, 25)),
    ((10, 12, 7), False, date(2017, 12, 10)),
    ((12, 10, 7), False, date(2017, 10, 12)),
    ((31, 2, 2017), False, None),
    ((99, 99, 99), False, date(9999, 1, 1)),
])
def test_ymd(spark, numbers, strict, day):
    a, b, c = map(F.lit, numbers)
    assert spark.range(1).select(dates.ymd_date(a, b, c, strict)).first()[0] == day


def test_ymd_strict_reference(spark):
    year = spark.range(1).select(F.year(dates.ymd_date(F.lit(25), F.lit(12), F.lit(2017), True))).first()[0]
    assert year == 4017


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), max_size=5), max_size=5))
def test_grid_is_rectangular(rows):
    cells = html_tables.grid([[[["x"], down, right] for down, right in row] for row in rows])
    places = {(r, c) for r, c, _ in cells}
    assert len(places) == len(cells)
    if cells:
        assert len(cells) == len(rows) * (max(c for _, c in places) + 1)


def test_html_functions_take_anything(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<table>"), (4, "<style>.a{color:#F00}</style><p class=a>red</p><p>no")], "id int, html string")
    found = {r["id"]: (r["t"], r["c"]) for r in rows.select("id", html_tables.html_text(F.col("html")).alias("t"), html_tables.coloured_text(F.col("html")).alias("c")).collect()}
    assert found[1] == ("", []) and found[2] == ("", [])
    assert found[4] == ("red,no", ["red"])
    assert html_tables.tables_of(spark, rows, "id", "html").count() == 0


@pytest.mark.parametrize("words, label", [
    ("PREVIOUS VERSION WILL BE HONORED FOR TICKET ISSUE UPTO 13Sep17", "EXTENSION_DATE"),
    ("FROM 01JAN2018", "FROMDATE"),
    ("ORIGINATING OTHER THAN USA", "ORIGINS_EXCLUDED"),
    ("02 April 2017", "DATE"),
])
def test_chunks(words, label):
    tags = [tagging.tag_word(w) for w in words.split()]
    assert label in {s[0] for s in tagging.chunk(tags)}
    assert tagging.chunk([]) == []




@pytest.mark.parametrize("sentence, day", [
    ("Previous version will be honored for ticket issue upto 13Sep17", date(2017, 9, 13)),
    ("Previous version V2017 011 26 05 2017 will be honour for tkt iss up to 14Jun17", date(2017, 6, 14)),
    ("Wef 01May17, fares / validity revised and extended till 30Apr18.", None),
    ("Fares revised and extended to 31Mar18 Previous version V2016 003 Holiday Fares 01APR2017 31MAR2018", None),
    (None, None),
])
def test_extension_date(sentence, day):
    assert extract.extension_date(sentence) == day


def test_flights_and_origins():
    assert extract.flights("on CX7681/ CX7680") == ["+CX7681", "+CX7680"]
    assert extract.flights("EXCLUDING KA902/903") == ["-KA902", "-KA903"]
    assert extract.origins(None) == [] and extract.flights(None) == []
    assert extract.origins("Originating OTHER THAN USA (Below discounts apply to JFK-YVR also)") == ["-US"]


def test_language():
    assert language.detect("the cat and the dog") == "en"
    assert language.detect("le chat et la table dans une maison") == "fr"
    assert language.detect(None) == "" and language.detect("  ") == ""
    assert language.convert_phrases("漢語漢字", {"漢語": "汉语", "漢": "汉"}) == "汉语汉字"


def test_spelling(spark):
    words = spark.createDataFrame([("teh",), ("cat",), ("zzz",), ("",)], "word string")
    known = spark.createDataFrame([("the", 9), ("ten", 5), ("cat", 1)], "word string, freq long")
    assert dict(text.correct(words, known).collect()) == {"teh": "the", "cat": "cat", "zzz": "zzz", "": ""}


def test_typed_rejects(spark):
    rows = spark.createDataFrame([("1", "2017-01-01"), ("x", "2017-01-01"), ("", None)], "n string, d string")
    good, bad = relational.typed(rows, {"n": "int", "d": "date"})
    assert good.count() == 2 and bad.count() == 1


def test_period_join_matches_brute_force(spark):
    events = spark.createDataFrame([(i, "k" if i % 2 else "m", date(2017, 1 + i % 12, 1 + i)) for i in range(28)], "id int, k string, day date")
    periods = spark.createDataFrame([(1, "k", date(2017, 1, 5), date(2017, 3, 31)), (2, "m", date(2017, 2, 1), date(2017, 2, 1)), (3, "k", date(2017, 5, 1), date(2016, 1, 1)), (4, "k", None, date(2018, 1, 1))], "p int, k string, s date, e date")
    got = {(r["id"], r["p"]) for r in joins.in_periods(events, periods, ["k"], "day", "s", "e").collect()}
    want = {(e["id"], p["p"]) for e in events.collect() for p in periods.collect() if e["k"] == p["k"] and p["s"] and p["s"] <= e["day"] <= p["e"]}
    assert got == want and want


def test_fill_down_twice_changes_nothing(spark):
    cells = spark.createDataFrame([(1, i, t) for i, t in enumerate(["h", "", "", "a", "", "b"])], "k int, row int, text string")
    once = windows.fill_down(cells, ["k"], "row", "text")
    again = windows.fill_down(once.select("k", "row", F.col("filled").alias("text")), ["k"], "row", "text")
    assert [r["filled"] for r in once.orderBy("row").collect()] == ["h", "", "", "a", "a", "b"]
    assert once.select("row", "filled").collect() == again.select("row", "filled").collect()


def test_dense_keys_are_ranks(spark):
    rows = spark.range(200).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"))
    got = relational.dense_keys(rows, ["a", "b"], "fk", 4).orderBy("a", "b").collect()
    assert [r["fk"] for r in got] == list(range(35))


def test_resumable_stream(spark, tmp_path):
    from millrace.streaming.events import file_stream, hourly, run_available

    folder, seen = str(tmp_path / "in"), []
    batch = spark.sql("select timestamp '2024-01-01 10:05:00' as ts, 'click' as event_type, 2.0D as value")
    batch.write.parquet(folder)
    step = lambda df, n: seen.append(df.count())
    for _ in range(2):
        run_available(file_stream(spark, folder, batch.schema), step, str(tmp_path / "cp")).awaitTermination()
    batch.write.mode("append").parquet(folder)
    run_available(file_stream(spark, folder, batch.schema), step, str(tmp_path / "cp")).awaitTermination()
    assert sum(seen) == 2
    assert hourly(spark.read.parquet(folder)).first()["n"] == 2


def test_ada_boost_and_silhouette(spark):
    from pyspark.ml.linalg import Vectors

    from millrace.ml.models import AdaBoost, clusters, silhouette

    rows = [(i, Vectors.dense(float(i % 10), float(i % 3)), float(i % 10 > 4)) for i in range(100)]
    data = spark.createDataFrame(rows, ["id", "features", "label"])
    model = AdaBoost.fit(data.select("features", "label"), 3)
    right = model.transform(data).where("prediction = label").count()
    assert right == 100
    assert 0 < silhouette(clusters(data, 2), "id") <= 1
