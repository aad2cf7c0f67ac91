"""Choices among periods: the pairs that meet depend on different days and periods, not on rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.operators import tickets as T


def test_best_in_periods_is_best_of_in_periods(spark):
    rng = random.Random(4)
    events = spark.createDataFrame([(i, rng.choice([0, 1, None]), rng.randrange(40) or None) for i in range(400)], "id int, g int, d int").withColumn("day", F.date_add(F.lit("2020-01-20").cast("date"), F.col("d")))
    rows = [(i, rng.choice([0, 1, None]), a := rng.randrange(40), a + rng.randrange(-1, 9) if i % 40 else 9999999, rng.random() < 0.2) for i in range(200)]
    periods = spark.createDataFrame(rows, "p int, g int, a int, b int, first boolean")
    periods = periods.select("p", "g", "first", *[F.date_add(F.lit("2020-01-20").cast("date"), F.least(F.col(x), F.lit(2_000_000))).alias(y) for x, y in (("a", "s"), ("b", "e"))])
    order = [F.col("first"), F.col("s"), -F.col("p")]
    slow = J.best_of(J.in_periods(events, periods, ["g"], "day", "s", "e"), ["id"], order, ["p", "s"])
    quick = J.best_in_periods(events, periods, ["id"], ["g"], "day", "s", "e", order, ["p", "s"])
    assert sorted(map(tuple, quick.collect())) == sorted(map(tuple, slow.collect())) and quick.count() > 100


def _many(spark, n):
    spell = "array(named_struct('from', date'2020-01-01', 'to', date'2020-02-10'))"
    sheets = spark.range(n).selectExpr("id as sheet", "array('A') as tourcodes", "array('CX') as carriers", f"{spell} as sales", f"{spell} as travel", "false as change_fee")
    tickets = spark.range(n).selectExpr("id as ticket", "'A' as tour_code", "case id % 3 when 0 then 'CX' when 1 then 'KA' end as carrier", "date'2020-01-05' as sold", "case when id % 6 < 3 then date'2020-02-05' end as departs")
    return tickets, sheets


def test_tickets_and_sheets_that_say_the_same_meet_once(spark):
    tickets, sheets = _many(spark, 30_000)  # a row for each pair would be 900 million
    found = {r["ticket"]: r for r in T.match_tickets(tickets, sheets).collect()}
    assert set(found) == {i for i in range(30_000) if i % 6 == 0} and {r["sheet"] for r in found.values()} == {0}
    few = T.ticket_report(*_many(spark, 12)).collect()
    reason = lambda i: "no travel period" if i % 6 >= 3 else "matched" if i % 3 == 0 else "no carrier"
    assert {r["ticket"]: r["reason"] for r in few} == {i: reason(i) for i in range(12)}
    codes = sheets.select(F.lit("A").alias("tour_code"), F.lit(False).alias("fee_only")).distinct()
    assert T._fitting(tickets, sheets, codes).count() == 6
