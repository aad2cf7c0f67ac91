"""Queries of row-wise steps over texts, codes and dates that Spark makes of the given tables' columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates as D
from millrace.functions import extract as E
from millrace.functions import preprocess as P
from millrace.functions import shaping as S
from millrace.functions import text as T
from millrace.functions.language import nfkd
from millrace.operators import relational as R
from millrace.plans.registry import query, table
from millrace.plans.shaping import _TAG_SQL, document_tags


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'F' or o_orderstatus is null")
def orders_not_finished(spark, sf):
    return R.drop_value(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "F")


@query("select c_custkey, case c_mktsegment when 'BUILDING' then 'CONSTRUCTION' when 'MACHINERY' then null else c_mktsegment end as c_mktsegment from customer")
def segments_mapped(spark, sf):
    return R.map_values(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", {"BUILDING": "CONSTRUCTION", "MACHINERY": None})


@query("select o_orderkey, unnest(case o_orderpriority when '1-URGENT' then ['1', 'URGENT'] when '5-LOW' then ['5', 'LOW', 'LAST'] else [o_orderpriority] end) as o_orderpriority from orders")
def priorities_unwound(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return R.unwind_values(orders, "o_orderpriority", {"1-URGENT": ["1", "URGENT"], "5-LOW": ["5", "LOW", "LAST"]})


_RATES = "case l_linenumber when 3 then 'x' when 5 then '' else cast(cast(l_discount as decimal(4, 2)) as {text}) end"
_DAYS = "case when l_linenumber = 4 then '2017-02-30' when l_linenumber = 2 then null else {day} end"


@query(f"""with r as (select l_orderkey, l_linenumber, {_RATES.format(text='varchar')} as rate, {_DAYS.format(day="strftime(l_shipdate, '%Y-%m-%d')")} as day from lineitem)
   select l_orderkey, l_linenumber, try_cast(nullif(rate, '') as double) as rate, try_cast(day as date) as day from r
   where not (nullif(rate, '') is not null and try_cast(rate as double) is null) and not (day is not null and try_cast(day as date) is null)""")
def lines_typed(spark, sf):
    """Lines whose texts for rate and day can be read."""
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", _RATES.format(text="string") + " as rate", _DAYS.format(day="date_format(l_shipdate, 'yyyy-MM-dd')") + " as day")
    return R.typed(rows, {"rate": "double", "day": "date"})[0]


_AMOUNT = "case l_suppkey % 4 when 0 then 'USD' when 1 then 'hkd' when 2 then 'FEE' else '' end || cast(cast(l_quantity as int) as {text})"


@query(f"select l_orderkey, l_linenumber, case when length(w) >= 4 and upper(w[1:3]) in {T.CURRENCIES} and regexp_matches(w[4:4], '[0-9]') then [w[1:3], w[4:]] else [w] end as parts from (select *, {_AMOUNT.format(text='varchar')} as w from lineitem)")
def amounts_split(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", _AMOUNT.format(text="string") + " as w")
    return rows.select("l_orderkey", "l_linenumber", T.split_currency(F.col("w")).alias("parts"))


@query("select p_partkey, string_split(regexp_replace(t, ' ([0-9]+)', '|\\1', 'g'), '|') as pieces from (select p_partkey, p_name || ' ' || p_size || ' of ' || p_partkey || ' ' || p_brand as t from part)")
def notes_broken(spark, sf):
    """Part notes, broken before each number."""
    text = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), F.lit("of"), F.col("p_partkey").cast("string"), "p_brand")
    return table(spark, sf, "part").select("p_partkey", F.transform(T.break_at_numbers(F.split(text, " ")), lambda p: F.array_join(p, " ")).alias("pieces"))


_CODE = "case l_linenumber % 4 when 0 then 'IT ' || l_partkey when 1 then 'ITBCODE' || l_partkey when 2 then 'BCODE' || l_partkey else l_partkey || 'Q' end"


@query(f"""select l_orderkey, l_linenumber, clean from (select l_orderkey, l_linenumber, regexp_replace(regexp_replace(replace({_CODE}, ' ', ''), '^IT', ''), '^BCODE', '') as clean from lineitem)
   where clean in (select p_partkey::varchar from part)""")
def codes_of_master_list(spark, sf):
    """Lines whose code, cleaned, is on the master list of parts."""
    codes = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", T.clean_tourcode(F.expr(_CODE)).alias("clean"))
    return codes.join(table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("clean")), "clean", "left_semi")


_PERCENT = "case l_linenumber % 3 when 0 then cast(l_discount * 100 as int) || '%' when 1 then 'USD ' || cast(l_quantity as int) else 'net ' || cast(l_tax * 100 as int) || ' %' end"


@query(f"""select l_orderkey, l_linenumber, try_cast(nullif(regexp_extract(t, '(\\d+)[^%]*%\\s*$', 1), '') as int) as value, case when regexp_extract(t, '(\\d+)[^%]*%\\s*$', 1) <> '' then 'P' else 'T' end as unit
   from (select l_orderkey, l_linenumber, {_PERCENT.replace('l_discount * 100', 'round(l_discount * 100)').replace('l_tax * 100', 'round(l_tax * 100)')} as t from lineitem)""")
def percents_read(spark, sf):
    text = F.expr(_PERCENT.replace("l_discount * 100", "round(l_discount * 100)").replace("l_tax * 100", "round(l_tax * 100)"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", D.parse_percent(text).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


@query("""with o as (select o_orderkey, year(o_orderdate) + 20 as y, month(o_orderdate) as m, day(o_orderdate) as d from orders),
    t as (select o_orderkey, case o_orderkey % 3 when 0 then d when 1 then y else m end as a, case o_orderkey % 3 when 2 then d else m end as b, case o_orderkey % 3 when 1 then d else y end as c from o)
   select o_orderkey, case when a between 2010 and 9998 and b between 1 and 12 and c between 1 and 31 then make_date(a::int, b::int, c::int)
    when c between 2010 and 9998 and b between 1 and 12 and a between 1 and 31 then make_date(c::int, b::int, a::int) when c between 2010 and 9998 and a between 1 and 12 and b between 1 and 31 then make_date(c::int, a::int, b::int) end as day from t""")
def days_read(spark, sf):
    """Dates from three numbers whose order differs from order to order, twenty years later."""
    y, m, d = F.year("o_orderdate") + 20, F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    k = F.col("o_orderkey") % 3
    a, b, c = F.when(k == 0, d).when(k == 1, y).otherwise(m), F.when(k == 2, d).otherwise(m), F.when(k == 1, d).otherwise(y)
    return table(spark, sf, "orders").select("o_orderkey", D.ymd_date(a, b, c).alias("day"))


@query("""with e as (select l_orderkey, l_linenumber, (l_shipdate::date + interval 20 year)::date + (l_orderkey % 45)::int - 7 as x, (l_shipdate::date + interval 20 year)::date as b, (l_shipdate::date + interval 20 year)::date + (l_orderkey % 800)::int - 400 as f from lineitem), g as (select *, case when x - b between 1 and 30 then b else f end as e from e),
    h as (select l_orderkey, l_linenumber, case when x - e < -350 and year(x) = 2016 then x + interval 1 year else x end::date as x, case when x - e < -350 and year(x) <> 2016 then e - interval 1 year else e end::date as e from g)
    select l_orderkey, l_linenumber, x as extension_date, e as effective_date, (x - e)::int as days from h""")
def receipt_extensions(spark, sf):
    """Days around the shipping date as extensions of it, or of another day, twenty years later."""
    body = F.add_months(F.to_date("l_shipdate"), 240)
    days = F.date_add(body, F.expr("cast(l_orderkey % 45 - 7 as int)")), body, F.date_add(body, F.expr("cast(l_orderkey % 800 - 400 as int)"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", D.extension(*days).alias("e")).select("l_orderkey", "l_linenumber", "e.*")


@query("""select p_partkey, list_sort(['X' || p_partkey || 'FF8' || lpad((p_size % 100)::varchar, 2, '0'), 'X' || p_partkey || 'FF7' || lpad((p_size % 100)::varchar, 2, '0')]) as codes from part""")
def code_ranges(spark, sf):
    """Codes written as a range of endings, such as FF801/701, in full."""
    size = F.lpad((F.col("p_size") % 100).cast("string"), 2, "0")
    text = F.concat(F.lit("X"), F.col("p_partkey").cast("string"), F.lit("FF8"), size, F.lit("/7"), size)
    rows = table(spark, sf, "part").select("p_partkey", F.array(F.lit("see"), text).alias("words"))
    return E.tour_codes(rows, "p_partkey", "words").groupBy("p_partkey").agg(F.array_sort(F.collect_list("code")).alias("codes"))


@query("select p_partkey, case when p_partkey % 3 = 0 then null else p_size end as n from part")
def bookmark_numbers(spark, sf):
    line = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("table "), F.col("p_size").cast("string"))).otherwise(F.concat(F.col("p_name"), F.lit(" <table "), F.col("p_size").cast("string"), F.lit(">")))
    return table(spark, sf, "part").select("p_partkey", T.bookmark_number(line).alias("n"))


@query("select p_partkey, trim(regexp_replace(p_name || ' ' || p_type, '\\s+', ' ', 'g')) as cell from part")
def cells_cleaned(spark, sf):
    text = F.concat(F.lit('"'), F.col("p_name"), F.lit("\r\n "), F.col("p_type"), F.lit(' "'))
    return table(spark, sf, "part").select("p_partkey", T.clean_cell(nfkd(text)).alias("cell"))


@query(f"select n_nationkey, case when w in {T.WHOLE_NAMES} then w else regexp_replace(w, '^(TO|OR|AND)([A-Z]{{3,}})$', '\\1 \\2') end as split from (select n_nationkey, case n_nationkey % 3 when 0 then 'TO' when 1 then 'OR' else '' end || upper(replace(n_name, ' ', '')) as w from nation)")
def nations_unglued(spark, sf):
    word = F.concat(F.when(F.col("n_nationkey") % 3 == 0, "TO").when(F.col("n_nationkey") % 3 == 1, "OR").otherwise(""), F.upper(F.replace("n_name", F.lit(" "), F.lit(""))))
    return table(spark, sf, "nation").select("n_nationkey", T.unglue_route(word).alias("split"))


@query("""with o as (select o_orderkey, upper(strftime(o_orderdate, '%B')) as name, (2 + o_orderkey % 2)::int as p from orders)
   select o_orderkey, case when length(name) > 4 then name else name[:p - 1] || name[p + 1:p + 1] || name[p:p] || name[p + 2:] end as word from o""")
def months_corrected(spark, sf):
    """Months with two letters swapped, put right if the name is long enough."""
    name, at = F.upper(F.date_format("o_orderdate", "MMMM")), (F.col("o_orderkey") % 2 + 2).cast("int")
    typo = F.concat(F.expr("left(name, at - 1)"), F.expr("substr(name, at + 1, 1)"), F.expr("substr(name, at, 1)"), F.expr("substr(name, at + 2)"))
    rows = table(spark, sf, "orders").select("o_orderkey", name.alias("name"), at.alias("at")).select("o_orderkey", F.array(typo).alias("words"))
    return rows.select("o_orderkey", P.correct_months_of(F.col("words"))[0].alias("word"))


@query("select item_id, regexp_replace(array_to_string(regexp_extract_all(text, '[A-Za-z]+|[.,]'), ' '), ' ([.,])', '\\1', 'g') as sentence from benchmark")
def sentences_joined(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", S.sentence(F.regexp_extract_all("text", F.lit("[A-Za-z]+|[.,]"), F.lit(0))).alias("sentence"))


@query(f"""with t as (select doc_id, list_transform(regexp_extract_all(lower(text), '[a-z]+|[.,]'), lambda w: {_TAG_SQL}) as tags from documents where text is not null)
   select doc_id, (list_position(tags, 'NNS') - 1)::int as first_plural, (list_position(tags, 'MARK') - 1)::int as first_mark from t""")
def tag_places(spark, sf):
    """Where the first plural and the first full stop of each document stand."""
    tokens = document_tags(spark, sf).select("doc_id", F.transform("tags", lambda t: F.struct(F.lit("").alias("word"), t.alias("tag"))).alias("tokens"))
    at = lambda tag: S.position(F.col("tokens"), lambda t: t["tag"] == tag).cast("int")
    return tokens.select("doc_id", at("NNS").alias("first_plural"), at("MARK").alias("first_mark"))
