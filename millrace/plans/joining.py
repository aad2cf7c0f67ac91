"""Queries of joins, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import joins as J
from millrace.operators import relational as R
from millrace.operators import windows as W
from millrace.plans.registry import query, table

# --- joins


@query("""select c_custkey, n_name, case when n_nationkey is null then 'city' else 'airport' end as matched
          from customer left join (select * from nation where n_nationkey % 3 <> 0) on c_nationkey = n_nationkey""")
def join_left_ref(spark, sf):
    nation = table(spark, sf, "nation").where("n_nationkey % 3 <> 0").select("n_nationkey", "n_name")
    joined = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", "n_name", F.when(F.col("n_nationkey").isNull(), "city").otherwise("airport").alias("matched"))


@query("select s.s_suppkey, n.n_nationkey from supplier s join nation k on s.s_nationkey = k.n_nationkey left join nation n on upper(lower(k.n_name)) = upper(n.n_name)")
def join_upper_key(spark, sf):
    nation = table(spark, sf, "nation")
    named = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.lower("n_name").alias("name"))
    reference = nation.select("n_nationkey", "n_name")
    return named.join(reference, F.upper("name") == F.upper("n_name"), "left").select("s_suppkey", "n_nationkey")


@query("""select l_orderkey, l_partkey, o_custkey from (select l_orderkey, l_partkey, o_custkey, row_number() over (partition by l_orderkey order by l_partkey, l_linenumber) as r
          from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'O') where r = 1""")
def join_then_dedupe(spark, sf):
    rows = table(spark, sf, "lineitem").where("l_linestatus = 'O'").select("l_orderkey", "l_partkey", "l_linenumber")
    rows = R.keep_first(rows, ["l_orderkey"], ["l_partkey", "l_linenumber"])
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return rows.join(orders, "l_orderkey").select("l_orderkey", "l_partkey", "o_custkey")


@query("select o_orderkey, o_custkey from orders o where o_orderstatus = 'F' and not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l_returnflag = 'R')")
def anti_unmatched(spark, sf):
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey").join(returned, "o_orderkey", "left_anti")


@query("select distinct l_orderkey from lineitem where l_partkey in (select p_partkey from part where p_size = 10)")
def array_semi_join(spark, sf):
    orders = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("codes"))
    return J.array_members(orders, "codes", table(spark, sf, "part").where("p_size = 10"), "p_partkey").select("l_orderkey")


@query("select doc_id, source, quality from documents join labels using (doc_id) where toxic = 0")
def enrich_by_id(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").where("toxic = 0").select("doc_id", "quality"), "doc_id")


@query("select distinct l_partkey, o_orderkey, (o_orderdate::date + 30) as extension_date from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'P'")
def extension_dates_export(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 30).alias("extension_date"))
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return items.join(orders, "o_orderkey").select("l_partkey", "o_orderkey", "extension_date").distinct()


def _tickets(spark, sf):
    """Shipments as tickets and orders of the same year as periods of one customer group."""
    tickets = table(spark, sf, "lineitem").where("l_linenumber = 1").select("l_orderkey", (F.col("l_suppkey") % 10).alias("grp"), F.to_date("l_shipdate").alias("day"))
    starts = F.to_date("o_orderdate")
    periods = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    periods = periods.select("o_orderkey", (F.col("o_custkey") % 10).alias("grp"), starts.alias("start"), F.date_add(starts, 30).alias("end"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return tickets, periods


_TICKET_SQL = """with t as (select l_orderkey, (l_suppkey % 10) as grp, l_shipdate::date as day from lineitem where l_linenumber = 1),
  p as (select o_orderkey, o_custkey % 10 as grp, o_orderdate::date as s, o_orderdate::date + 30 as e, o_orderpriority = '1-URGENT' as urgent from orders where o_orderstatus = 'P'),
  j as (select t.*, p.o_orderkey, p.s, p.urgent from t join p on t.grp = p.grp and day between s and e),
  f as (select * from (select *, max(urgent::int) over (partition by l_orderkey) as a from j) where a = 0 or urgent),
  best as (select l_orderkey, o_orderkey, s from (select *, row_number() over (partition by l_orderkey order by s desc, o_orderkey) as r from f) where r = 1) """


def _matches(spark, sf):
    tickets, periods = _tickets(spark, sf)
    order = [F.col("urgent"), F.col("start"), -F.col("o_orderkey")]
    return J.best_in_periods(tickets, periods, ["l_orderkey"], ["grp"], "day", "start", "end", order, ["o_orderkey", "start"]).withColumnRenamed("start", "period_start")


@query(_TICKET_SQL + "select l_orderkey, o_orderkey, s as period_start from best")
def asof_period_match(spark, sf):
    return _matches(spark, sf)


@query(_TICKET_SQL + """select l_orderkey, case when best.o_orderkey is not null then 'matched' when exists (select 1 from p where p.grp = t.grp) then 'no period' else 'no sheet' end as reason
       from t left join best using (l_orderkey)""")
def unmatched_report(spark, sf):
    tickets, periods = _tickets(spark, sf)
    groups = periods.select("grp").distinct().withColumn("has_sheet", F.lit(True))
    days = J.in_periods(tickets.select("grp", "day").distinct(), periods.select("grp", "start", "end").distinct(), ["grp"], "day", "start", "end").select("grp", "day").distinct()
    matched = tickets.join(days, ["grp", "day"], "left_semi").select("l_orderkey").distinct().withColumn("matched", F.lit(True))
    joined = tickets.join(matched, "l_orderkey", "left").join(groups, "grp", "left")
    reason = F.when(F.col("matched"), "matched").when(F.col("has_sheet"), "no period").otherwise("no sheet")
    return joined.select("l_orderkey", reason.alias("reason"))


@query("select c_custkey, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def dict_lookup(spark, sf):
    regions = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return table(spark, sf, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "r_name")


@query("select l_suppkey as location, l_returnflag as pos from lineitem union select l_partkey, l_returnflag from lineitem")
def location_map(spark, sf):
    rows = table(spark, sf, "lineitem")
    both = rows.select(F.explode(F.array("l_suppkey", "l_partkey")).alias("location"), F.col("l_returnflag").alias("pos"))
    return both.distinct()


@query("select s_suppkey, case when s_nationkey = 3 then 'US/N' when s_nationkey = 5 then 'JKT/P' else n_name end as place from supplier left join nation on s_nationkey = n_nationkey")
def keyed_override(spark, sf):
    place = F.when(F.col("s_nationkey") == 3, "US/N").when(F.col("s_nationkey") == 5, "JKT/P").otherwise(F.col("n_name"))
    return table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", place.alias("place"))


#: Zones that a region stands for.
ZONES = {"ASIA": ["220", "310", "320", "330", "340"], "AMERICA": ["MX", "120", "140", "160", "170"]}


@query("""select n_nationkey, unnest(case r_name when 'ASIA' then ['220','310','320','330','340'] when 'AMERICA' then ['MX','120','140','160','170'] else [r_name] end) as zone
          from nation join region on n_regionkey = r_regionkey""")
def region_expand(spark, sf):
    named = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return R.unwind_values(named, "r_name", ZONES).select("n_nationkey", F.col("r_name").alias("zone"))


@query("""select s_suppkey, coalesce(n_name, '') || coalesce(r_name, '') as zone from supplier left join (select * from nation where n_nationkey <> 0) on s_nationkey = n_nationkey
          left join region on n_regionkey = r_regionkey where coalesce(n_name, '') || coalesce(r_name, '') <> ''""")
def zone_merge(spark, sf):
    nation = table(spark, sf, "nation").where("n_nationkey <> 0")
    joined = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    zone = F.concat(F.coalesce("n_name", F.lit("")), F.coalesce("r_name", F.lit("")))
    return joined.select("s_suppkey", zone.alias("zone")).where("zone <> ''")


# --- aggregates


@query("""select l_discount, l_tax, count(*) as n, count(*) / (select count(*) from lineitem where l_returnflag = 'N')::double as share
          from lineitem where l_returnflag = 'N' group by 1, 2""")
def rate_share(spark, sf):
    return A.shares(table(spark, sf, "lineitem").where("l_returnflag = 'N'").select("l_discount", "l_tax"), ["l_discount", "l_tax"])


@query("select l_linestatus, l_discount, count(*) as n from lineitem where l_discount <> 0.05 and l_discount <> 0 group by 1, 2")
def tourcode_counts(spark, sf):
    rows = table(spark, sf, "lineitem").where("l_discount <> 0.05D and l_discount <> 0D")
    return rows.groupBy("l_linestatus", "l_discount").agg(F.count("*").alias("n"))


@query("select l_suppkey, l_discount as mode_rate, n from (select l_suppkey, l_discount, count(*) as n, row_number() over (partition by l_suppkey order by count(*) desc, l_discount) as r from lineitem group by 1, 2) where r = 1")
def mode_per_group(spark, sf):
    return A.mode_of(table(spark, sf, "lineitem"), ["l_suppkey"], "l_discount").select("l_suppkey", F.col("l_discount").alias("mode_rate"), "n")


@query("select l_orderkey, l_linenumber, case when (l_quantity > 25)::int + (l_discount > 0.05)::int + (l_tax > 0.04)::int >= 2 then 1 else 0 end as vote from lineitem")
def majority_vote(spark, sf):
    votes = [F.expr(x).cast("int") for x in ("l_quantity > 25D", "l_discount > 0.05D", "l_tax > 0.04D")]
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", A.majority(*votes).alias("vote"))


def _guesses(spark, sf):
    labels = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return labels.select("doc_id", F.col("quality").alias("actual"), (F.col("n_chars") > 1000).cast("int").alias("guess"))


_GUESS_SQL = "with g as (select doc_id, quality as actual, (n_chars > 1000)::int as guess from labels join documents using (doc_id)) "


@query(_GUESS_SQL + "select actual, guess, count(*) as n from g group by 1, 2")
def confusion_matrix(spark, sf):
    return A.confusion(_guesses(spark, sf), "actual", "guess")


@query(_GUESS_SQL + "select actual, count(*) as total, count(*) filter (actual <> guess) as errors, 100.0::double * count(*) filter (actual <> guess) / count(*) as error_rate from g group by 1")
def error_rate_by_actual(spark, sf):
    sums = _guesses(spark, sf).groupBy("actual").agg(F.count("*").alias("total"), F.count_if(F.col("actual") != F.col("guess")).alias("errors"))
    return sums.withColumn("error_rate", F.lit(100.0) * F.col("errors") / F.col("total"))


@query(_GUESS_SQL + "select 100.0::double - 100.0::double * count(*) filter (actual <> guess) / count(*) as accuracy from g")
def accuracy(spark, sf):
    return _guesses(spark, sf).agg((F.lit(100.0) - F.lit(100.0) * F.count_if(F.col("actual") != F.col("guess")) / F.count("*")).alias("accuracy"))


@query(_GUESS_SQL + "select round(product(r), 9) as row_accuracy from (select 1.0::double - count(*) filter (actual <> guess) / count(*)::double as r from g group by actual)")
def row_accuracy(spark, sf):
    rates = _guesses(spark, sf).groupBy("actual").agg((F.lit(1.0) - F.count_if(F.col("actual") != F.col("guess")) / F.count("*")).alias("r"))
    return rates.agg(F.round(F.product("r"), 9).alias("row_accuracy"))


@query("select l_orderkey, bool_or(l_returnflag = 'R') as any_return, bool_or(l_discount > 0.08) as any_high from lineitem group by 1")
def bool_or_flags(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_return"), F.bool_or(F.expr("l_discount > 0.08D")).alias("any_high"))


@query("select l_suppkey, list_sort(list(distinct l_linenumber)) as lines from lineitem group by 1")
def unique_values(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_set("l_linenumber")).alias("lines"))


@query("select quality, toxic, count(*) as n from labels group by 1, 2")
def class_balance(spark, sf):
    return table(spark, sf, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))


@query(_GUESS_SQL + """, l as (select actual as label from g union select guess from g),
   c as (select label, (select count(*) from g where actual = label and guess = label) as r, (select count(*) from g where actual = label) as s, (select count(*) from g where guess = label) as p from l)
   select label, case when p = 0 then 0 else r / p::double end as precision, case when s = 0 then 0 else r / s::double end as recall, case when s + p = 0 then 0 else 2 * r / (s + p)::double end as f1, s as support from c""")
def classification_report(spark, sf):
    return A.report(_guesses(spark, sf), "actual", "guess")


@query("select doc_id, max(len(w))::bigint as longest from (select doc_id, unnest(string_split(text, ' ')) as w from documents) group by 1")
def longest_word(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_max(F.transform(F.split("text", " "), F.length)).cast("bigint").alias("longest"))


# --- windows


@query("select l_orderkey, l_linenumber, (dense_rank() over (order by l_suppkey, l_returnflag, l_linestatus) - 1)::bigint as loc_fk from lineitem")
def dense_fk(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")
    keys = R.dense_keys(rows, ["l_suppkey", "l_returnflag", "l_linestatus"], "loc_fk")
    return rows.join(keys, ["l_suppkey", "l_returnflag", "l_linestatus"]).select("l_orderkey", "l_linenumber", "loc_fk")


_CELLS = """with c as (select conv_id, turn, case when turn % 3 = 2 then '' else role end as text from conversations) """


def _cells(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 2, "").otherwise(F.col("role")).alias("text"))


@query(_CELLS + """select conv_id, turn, case when turn < 2 then text else last_value(case when turn < 2 or text <> '' then text end ignore nulls)
       over (partition by conv_id order by turn rows unbounded preceding) end as filled from c""")
def fill_down(spark, sf):
    return W.fill_down(_cells(spark, sf), ["conv_id"], "turn", "text").select("conv_id", "turn", "filled")


_SPARSE = "with c as (select conv_id, turn, case when (turn + conv_id) % 3 <> 0 then '' else role end as text from conversations) "


@query(_SPARSE + """select conv_id, turn, case when 2 * b > m + 1 and turn > 0 then coalesce(j, '') else text end as filled from c join
       (select conv_id, count(*) filter (text = '') as b, max(turn) as m, string_agg(text, ' ' order by turn) filter (turn > 0 and text <> '') as j from c group by 1) using (conv_id)""")
def sparse_col_fill(spark, sf):
    cells = table(spark, sf, "conversations").select("conv_id", "turn", F.when((F.col("turn") + F.col("conv_id")) % 3 != 0, "").otherwise(F.col("role")).alias("text"))
    return W.fill_sparse_columns(cells, ["conv_id"], "turn", "text").select("conv_id", "turn", "filled")


@query("select user_id, event_id, max((event_type = 'error')::int) over (partition by user_id order by ts, event_id rows between 4 preceding and current row) = 1 as recent from events")
def lookback_flag(spark, sf):
    events = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return events.select("user_id", "event_id", W.lookback(F.col("event_type") == "error", ["user_id"], "at").alias("recent"))


@query("select conv_id, turn, role, lag(role, 1, '<START>') over w as previous, lead(role, 1, '<END>') over w as following from conversations window w as (partition by conv_id order by turn)")
def neighbour_features(spark, sf):
    return W.neighbours(table(spark, sf, "conversations").select("conv_id", "turn", "role"), ["conv_id"], "turn", "role")


@query("""with w as (select doc_id, string_split(text, ' ') as a from documents), p as (select doc_id, a, unnest(range(0, len(a))) as i from w)
          select doc_id, i::bigint as pos, array_to_string(a[greatest(i - 2, 0) + 1 : i + 3], ' ') as around from p where a[i + 1] = 'the'""")
def context_window(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("a"))
    at = words.select("doc_id", "a", F.posexplode("a").alias("i", "word")).where("word = 'the'")
    return at.select("doc_id", F.col("i").cast("bigint").alias("pos"), F.array_join(W.context(F.col("a"), F.col("i"), 2), " ").alias("around"))


@query("select o_custkey, o_orderkey as last_order from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) as r from orders) where r = 1")
def latest_run(spark, sf):
    newest = F.max_by("o_orderkey", F.struct("o_orderdate", -F.col("o_orderkey")))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(newest.alias("last_order"))


@query("""select event_id, event_type from events where event_id not in (select event_id from events where event_id % 4 = 0) and event_type = 'click'""")
def incremental_batch(spark, sf):
    events = table(spark, sf, "events")
    processed = events.where("event_id % 4 = 0").select("event_id")
    return events.where("event_type = 'click'").join(processed, "event_id", "left_anti").select("event_id", "event_type")


@query("select window_start, event_type, count(*) as n, round(sum(value), 6) as total from (select time_bucket(interval '1 hour', ts) as window_start, event_type, value from events) group by 1, 2")
def hourly_events(spark, sf):
    """An extension: event-time windows, the same plan as the stream in millrace.streaming."""
    from millrace.streaming.events import hourly

    return hourly(table(spark, sf, "events")).withColumn("total", F.round("total", 6))


