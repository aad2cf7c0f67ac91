"""Queries of tickets and fare sheets, on small cases and on the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import tickets as T
from millrace.plans.registry import query, table

# two candidates, a match in the second period only, another carrier, a change fee, no sheet, days on both ends, an open end
_SHEETS = [
    (1, ["A1"], ["CX", "KA"], [("2017-01-01", "2017-03-31"), ("2017-06-01", "2017-06-30")], [("2017-01-01", "2017-12-31")], False),
    (2, ["A1", "B2"], ["CX"], [("2017-03-01", "2017-03-31")], [("2017-03-01", "2017-04-30")], False),
    (3, ["C3"], ["CX"], [("2017-01-01", "2017-12-31")], [("2016-01-01", "9999-12-31")], True),
    (4, ["C3"], ["CX"], [("2017-05-01", "2017-12-31")], [("2016-01-01", "9999-12-31")], False),
    (5, ["D4"], ["KA"], [("2016-01-01", "9999-12-31")], [("2017-01-01", "2017-02-01")], None),
    (6, ["E5"], None, None, [], False),
]
_TICKETS = [
    (10, "A1", "CX", "2017-03-15", "2017-04-01"), (11, "A1", "KA", "2017-03-15", "2017-04-01"), (12, "A1", "CX", "2017-06-30", "2017-12-31"), (13, "A1", "AA", "2017-03-31", "2017-04-01"),
    (14, "C3", "CX", "2017-08-01", "2018-01-01"), (15, "Z9", "CX", "2017-01-01", "2017-01-01"), (16, "D4", "KA", "2050-01-01", "2017-02-01"), (17, "D4", "KA", "2050-01-01", "2017-02-02"),
    (18, "A1", "CX", "2017-05-01", "2017-06-01"), (19, "E5", "CX", "2017-01-01", "2017-01-01"), (20, None, "CX", "2017-01-01", "2017-01-01"), (21, "B2", "CX", None, "2017-03-01"),
]


def _sql(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, list):
        return "[" + ", ".join(f"{{'from': date '{v[0]}', 'to': date '{v[1]}'}}" if isinstance(v, tuple) else _sql(v) for v in value) + "]"
    return str(value).lower() if isinstance(value, bool) else str(value) if isinstance(value, int) else f"'{value}'"


def _rows_sql(rows) -> str:
    return ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in rows)


_CASES_SQL = f"""with s as (select * from (values {_rows_sql(_SHEETS)}) v(sheet, tourcodes, carriers, sales, travel, change_fee)),
  t as (select ticket, tour_code, carrier, sold::date as sold, departs::date as departs from (values {_rows_sql(_TICKETS)}) v(ticket, tour_code, carrier, sold, departs)), """
#: Orders as sheets of a part group, sold for two spells; shipments as tickets.
_TABLES_SQL = """with s as (select o_orderkey as sheet, ['G' || (o_custkey % 50), 'H' || (o_custkey % 7)] as tourcodes, case o_orderstatus when 'P' then ['CX', 'KA'] else ['CX'] end as carriers,
    [{'from': o_orderdate::date, 'to': o_orderdate::date + 20}, {'from': o_orderdate::date + 200, 'to': o_orderdate::date + 210}] as sales,
    [{'from': o_orderdate::date + 10, 'to': case when o_orderkey % 5 = 0 then date '9999-12-31' else o_orderdate::date + 300 end}] as travel, o_custkey % 50 = 3 and o_orderpriority = '1-URGENT' as change_fee
    from orders where o_orderstatus <> 'O'),
  t as (select l_orderkey as ticket, 'G' || (l_suppkey % 60) as tour_code, case l_returnflag when 'R' then 'KA' else 'CX' end as carrier, l_shipdate::date as sold, l_shipdate::date + 30 as departs from lineitem where l_linenumber = 1), """
_MATCH_SQL = """n as (select s.*, unnest(list_distinct(tourcodes)) as tour_code from s),
  c as (select tour_code, coalesce(bool_or(change_fee), false) as fee_only, list_sort(list(distinct sheet)) as everyone, list_sort(list(distinct sheet) filter (change_fee)) as fee from n group by 1),
  p as (select n.* exclude (sales), unnest(sales) as sale from n),
  f as (select t.*, p.sheet, sale."from" as sales_from, sale."to" as sales_to, len(list_filter(travel, lambda x: departs between x."from" and x."to")) > 0 as travels, list_contains(carriers, carrier) as carried
        from t join p on t.tour_code = p.tour_code and sold between sale."from" and sale."to" join c on c.tour_code = t.tour_code where not fee_only or change_fee),
  m as (select ticket, sheet, sales_from, sales_to from f where travels and carried qualify row_number() over (partition by ticket order by sales_from desc, sheet, sales_to desc) = 1),
  r as (select t.ticket, case when m.sheet is not null then 'matched' when c.tour_code is null then 'no sheet' when not exists (from f where f.ticket = t.ticket) then 'no sales period'
               when not exists (from f where f.ticket = t.ticket and travels) then 'no travel period' else 'no carrier' end as reason, m.sheet,
               case when m.sheet is null then coalesce(case when fee_only then fee else everyone end, []) end as candidates from t left join m using (ticket) left join c on c.tour_code = t.tour_code) """


def _cases(spark):
    period = "array<struct<`from`:string,`to`:string>>"
    dates = "array<struct<`from`:date,`to`:date>>"
    sheets = spark.createDataFrame(_SHEETS, f"sheet bigint, tourcodes array<string>, carriers array<string>, sales {period}, travel {period}, change_fee boolean")
    tickets = spark.createDataFrame(_TICKETS, "ticket bigint, tour_code string, carrier string, sold string, departs string")
    return tickets.withColumns({c: F.col(c).cast("date") for c in ("sold", "departs")}), sheets.withColumns({c: F.col(c).cast(dates) for c in ("sales", "travel")})


def _tables(spark, sf):
    day, later = F.to_date("o_orderdate"), lambda n: F.date_add(F.to_date("o_orderdate"), n)
    spell = lambda a, b: F.struct(a.alias("from"), b.alias("to"))
    open_end = F.when(F.col("o_orderkey") % 5 == 0, F.lit("9999-12-31").cast("date")).otherwise(later(300))
    sheets = table(spark, sf, "orders").where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("sheet"),
        F.array(F.concat(F.lit("G"), F.col("o_custkey") % 50), F.concat(F.lit("H"), F.col("o_custkey") % 7)).alias("tourcodes"),
        F.when(F.col("o_orderstatus") == "P", F.array(F.lit("CX"), F.lit("KA"))).otherwise(F.array(F.lit("CX"))).alias("carriers"),
        F.array(spell(day, later(20)), spell(later(200), later(210))).alias("sales"),
        F.array(spell(later(10), open_end)).alias("travel"),
        ((F.col("o_custkey") % 50 == 3) & (F.col("o_orderpriority") == "1-URGENT")).alias("change_fee"),
    )
    sold = F.to_date("l_shipdate")
    tickets = table(spark, sf, "lineitem").where("l_linenumber = 1").select(
        F.col("l_orderkey").alias("ticket"), F.concat(F.lit("G"), F.col("l_suppkey") % 60).alias("tour_code"), F.when(F.col("l_returnflag") == "R", "KA").otherwise("CX").alias("carrier"), sold.alias("sold"), F.date_add(sold, 30).alias("departs")
    )
    return tickets, sheets


@query(_CASES_SQL + _MATCH_SQL + "select * from m")
def ticket_match_cases(spark, sf):
    return T.match_tickets(*_cases(spark))


@query(_CASES_SQL + _MATCH_SQL + "select * from r")
def ticket_report_cases(spark, sf):
    return T.ticket_report(*_cases(spark))


@query(_TABLES_SQL + _MATCH_SQL + "select * from m")
def ticket_match(spark, sf):
    return T.match_tickets(*_tables(spark, sf))


@query(_TABLES_SQL + _MATCH_SQL + "select * from r")
def ticket_report(spark, sf):
    return T.ticket_report(*_tables(spark, sf))
