"""Queries of readers and writers (written and read again), nested records and features of rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.html_tables import html_text
from millrace.functions.language import languages, nfkd
from millrace.ml import evaluate as V
from millrace.ml import rules as X
from millrace.operators import nested as N
from millrace.operators.commission_etl import star
from millrace.operators.ranks import quantiles, values_at_ranks
from millrace.operators.relational import typed
from millrace.operators.sheets import discontinue_date
from millrace.plans.registry import query, sink, table
from millrace.sources import readers as I
from millrace.sources import writers as O

# --- sources and sinks


@query("select p_partkey::varchar as p_partkey, p_name, coalesce(case when p_size % 7 = 0 then null else p_brand end, '') as p_brand from part")
def csv_text(spark, sf):
    """All columns as text, missing ones empty."""
    path = sink(spark, "csv")
    O.write_csv(table(spark, sf, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 7 != 0, F.col("p_brand")).alias("p_brand")), path)
    return I.read_csv(spark, path, empty_as="").select("p_partkey", "p_name", "p_brand")


@query("select p_partkey, p_name, p_size, p_retailprice from part")
def csv_typed(spark, sf):
    path = sink(spark, "csv")
    columns = "p_partkey bigint, p_name string, p_size int, p_retailprice double"
    O.write_csv(table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    return I.read_csv(spark, path, columns)


@query("select c_custkey, case when c_acctbal < 0 then 'false' else c_mktsegment end as c_mktsegment from customer")
def csv_missing_as_false(spark, sf):
    path = sink(spark, "csv")
    O.write_csv(table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment")), path)
    return I.read_csv(spark, path, "c_custkey bigint, c_mktsegment string", empty_as="false")


@query("select l_orderkey::varchar as l_orderkey, array_to_string(list_sort(list(distinct l_suppkey)), '|') as suppliers from lineitem group by 1")
def csv_of_arrays(spark, sf):
    path = sink(spark, "csv")
    O.write_csv(table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("suppliers")), path)
    return I.read_csv(spark, path)


@query("select doc_id::varchar as doc_id, quality::varchar as quality, case doc_id % 3 when 0 then 'HK' when 1 then 'NEW_ZEALAND' else 'AU/CA/TH' end as country from labels where quality is not null")
def label_folder(spark, sf):
    """Files named x_y_COUNTRY_z.csv in one folder; one name stands for several countries."""
    folder = sink(spark, "labels")
    rows = table(spark, sf, "labels").where("quality is not null").select("doc_id", "quality")
    for part, country in enumerate(("HK", "NEW_ZEALAND", "AU_CA_TH")):
        O.write_csv_file(rows.where(F.col("doc_id") % 3 == part), f"{folder}/train_fares_{country}_v1.csv")
    return I.read_label_folder(spark, f"{folder}/*.csv", {"AU_CA_TH": "AU/CA/TH"}).select("doc_id", "quality", "country")


@query("""select page_id, list(html order by ord) as html from (select page_id, 0 as ord, html from pages where page_id % 3 <> 0 union all select page_id, 1 + n, url || n from pages, (select unnest([0, 1]) as n) where page_id % 3 = 1
          union all select page_id, 1000000, 'blob' || page_id from pages where page_id % 3 = 0) where html is not null group by 1""")
def page_store(spark, sf):
    pages = table(spark, sf, "pages")
    single = pages.where("page_id % 3 <> 0").select("page_id", F.col("html").alias("content"))
    children = pages.where("page_id % 3 = 1").withColumn("n", F.explode(F.array(F.lit(1), F.lit(0)))).select("page_id", "n", F.concat("url", "n").alias("content"))
    blobs = pages.where("page_id % 3 = 0").select("page_id", F.concat(F.lit("blob"), "page_id").cast("binary").alias("data"))
    return I.page_store(single, children, blobs, ["page_id"])


@query("select p_partkey, p_name from part")
def unique_table(spark, sf):
    path = sink(spark, "parts")
    O.write_unique(table(spark, sf, "part").select("p_partkey", "p_name"), ["p_partkey"], path)
    return spark.read.parquet(path)


@query("""select * from (values ('commissions', 3::bigint), ('locations', 3), ('location_map', 9)) t(name, n)""")
def star_tables(spark, sf):
    """The three tables of the star schema, written with their keys asserted and read again."""
    columns = "tourcodes array<string>, originating array<string>, flights array<string>, pos array<string>, from_location array<string>, to_location array<string>, pcc array<string>, route string, agent_discount string, corporate_discount string, rtw_fare_comm string, ct_fare_comm string, sales_period_eff_date string, sales_period_dis_date string, tkt_dis_date string, trv_dis_date string, _id string"
    rows = [(["X1"], [], [], ["US"], ["LAX"], ["ASIA"], [], "", "10%", "3%", "9999", "9999", "2017-01-01", "", "", "", "a"), (["X2"], [], [], ["US"], ["LAX"], ["HKG"], [], "", "10%", "", "", "", "", "", "", "", "b"), (["X3"], [], [], [], ["SHA"], ["HKG"], [], "", "7", "", "", "", "", "", "", "", "c")]
    airports = spark.createDataFrame([("HKG", "HK", "HKG", "310"), ("SHA", "CN", "SHA", "320"), ("LAX", "US", "LAX", "001")], "code string, country string, city string, zone string")
    made = star(spark.createDataFrame(rows, columns), airports, 4)
    counts = None
    for name, keys in (("commissions", ["_id", "tourcodes", "loc_fk"]), ("locations", ["loc_fk"]), ("location_map", ["location", "pos", "zone"])):
        path = sink(spark, name)
        O.write_unique(getattr(made, name), keys, path)
        one = spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("select l_orderkey || chr(9) || (l_orderkey % 3) || chr(9) || array_to_string(list_sort(list(distinct l_suppkey)), chr(9)) as value from lineitem group by l_orderkey")
def code_lines(spark, sf):
    path = sink(spark, "lines")
    codes = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("codes"))
    O.write_code_lines(codes.withColumn("kind", F.col("l_orderkey") % 3), ["l_orderkey", "kind"], "codes", path)
    return spark.read.text(path)


@query("select 'r1' as run, '0.5' as accuracy, null::varchar as note")
def record_csv(spark, sf):
    path = sink(spark, "record")
    O.write_record(spark, {"run": "r1", "accuracy": 0.5, "note": None}, path)
    return I.read_csv(spark, path)


@query("select c_custkey, c_name from customer where c_nationkey = 3")
def snapshot_table(spark, sf):
    path = sink(spark, "snapshots")
    copied = O.snapshot_to(table(spark, sf, "customer").where("c_nationkey = 3").select("c_custkey", "c_name"), path, "20180101120000")
    return spark.read.parquet(copied)


@query("select word, count(*) as freq from (select unnest(regexp_extract_all(upper(regexp_replace(text, '[^ -~]', ' ', 'g')), '[A-Z]+')) as word from benchmark) group by 1")
def word_file_counts(spark, sf):
    path = sink(spark, "words")
    table(spark, sf, "benchmark").select(F.regexp_replace("text", "[^ -~]", " ").alias("value")).write.text(path)
    return I.word_counts(spark, path)


@query("select * from (values ('tree', 2::bigint), ('bayes', 2)) t(kind, runs)")
def run_registry(spark, sf):
    path = sink(spark, "runs")
    for kind in ("tree", "bayes", "tree", "bayes"):
        O.register_run(spark, path, kind=kind, accuracy=0.9)
    return spark.read.parquet(path).groupBy(F.col("facts.kind").alias("kind")).agg(F.count("*").alias("runs"))


@query("select 'run1' as run, category, total, errors, 1 - errors / total::double as accuracy from (select lang as category, count(*) as total, count(*) filter (quality <> (n_chars > 1000)::int) as errors from labels join documents using (doc_id) where lang in ('en', 'fr') group by 1)")
def scorecards(spark, sf):
    """One row for each run and category, appended to a table."""
    path = sink(spark, "scorecards")
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").select("lang", F.col("quality").alias("actual"), (F.col("n_chars") > 1000).cast("int").alias("guess"))
    for lang in ("en", "fr"):
        V.scorecard(rows.where(F.col("lang") == lang), "run1", lang).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("select '2018-04-09T10:20:30' as at, '20180409102030' as run")
def run_stamp(spark, sf):
    from datetime import datetime

    at = datetime(2018, 4, 9, 10, 20, 30)
    return spark.createDataFrame([(at.isoformat(), O.run_id(at))], "at string, run string")


# --- nested records


@query("select c_custkey, c_nationkey + 1 as a, c_name as b from customer")
def field_set(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", F.struct(F.col("c_nationkey").alias("a"), F.lit("old").alias("b")).alias("s"))
    return N.set_field(N.set_field(rows, "s.a", F.col("s.a") + 1), "s.b", F.col("c_name")).select("c_custkey", "s.*")


@query("select c_custkey, c_name as b from customer")
def field_unset(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.struct(F.col("c_nationkey").alias("a"), F.col("c_name").alias("b")).alias("s"), F.lit(1).alias("gone"))
    return N.unset_field(N.unset_field(rows, "s.a"), "gone").select("c_custkey", "s.*")


@query("select l_orderkey, list_sort(list_distinct(list_append(list_append(list(l_returnflag), 'A'), 'Z'))) as flags from lineitem group by 1")
def set_added(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("flags"))
    return rows.select("l_orderkey", F.array_sort(N.add_to_set(F.col("flags"), F.lit("A"), F.lit("Z"))).alias("flags"))


@query("select c_custkey, c_name as b, null::varchar as c from customer")
def keys_filled(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.struct(F.col("c_nationkey").alias("a"), F.col("c_name").alias("b")).alias("s"))
    return N.with_keys(rows, "s", ["b", "c"]).select("c_custkey", "s.*")


@query("select o_orderkey, unnest(['a', 'b', 'c']) as key, unnest([o_orderstatus, '2', o_orderpriority]) as value from orders")
def maps_merged(spark, sf):
    one = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    two = F.create_map(F.lit("a"), F.col("o_orderstatus"), F.lit("c"), F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", F.explode(N.merge_maps(one, two)).alias("key", "value"))


@query("select n_nationkey, n_name as key, 'name' as value from nation")
def map_inverted(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", F.explode(N.inverted(F.create_map(F.lit("name"), "n_name"))).alias("key", "value"))


# --- words and codes


@query("select p_partkey, t, regexp_full_match(t, '[0-9]+(\\.[0-9]+)?') as number, case when t ~ '^[0-9]' then null when upper(t) = t then 'upper' when lower(t) = t then 'lower' when regexp_full_match(t, '[A-Z][a-z]*') then 'title' else 'mixed' end as letters from (select p_partkey, unnest([p_brand[1:3], p_size::varchar, upper(p_name[1:1]) || lower(regexp_replace(p_name, '[^a-zA-Z]', '', 'g')[2:4]), 'aB', '1.5']) as t from part)")
def word_kinds(spark, sf):
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.lower(F.substring(F.regexp_replace("p_name", "[^a-zA-Z]", ""), 2, 3)))
    rows = table(spark, sf, "part").select("p_partkey", F.explode(F.array(F.substring("p_brand", 1, 3), F.col("p_size").cast("string"), name, F.lit("aB"), F.lit("1.5"))).alias("t"))
    return rows.select("p_partkey", "t", T.is_number(F.col("t")).alias("number"), T.case_of(F.col("t")).alias("letters"))


@query("select * from (values (0, 'a b c'), (1, 'x'), (2, null)) t(id, cell)")
def cell_text(spark, sf):
    rows = spark.createDataFrame([(0, '"a b\r\n c "'), (1, "ﬁx".replace("ﬁ", "")), (2, None)], "id int, cell string")
    return rows.select("id", T.clean_cell(nfkd(F.col("cell"))).alias("cell"))


@query("select * from (values ('HKG24FF5O1', 'HKG24FF501'), ('HKG24FF501', 'HKG24FF501')) t(word, candidate)")
def codes_after_mark(spark, sf):
    words = spark.createDataFrame([("HKG24FF5O1",), ("HKG24FF501",), ("HKX24FF501",)], "word string")
    return T.code_candidates(words, spark.createDataFrame([("HKG24FF501", 5)], "word string, freq int"))


@query("select * from (values (0, 12), (1, null)) t(id, n)")
def bookmark(spark, sf):
    return spark.createDataFrame([(0, "x <table 12>"), (1, "table 3")], "id int, line string").select("id", T.bookmark_number(F.col("line")).alias("n"))


@query("select o_custkey, min(o_orderdate::date) as first_day from orders group by 1")
def least_date(spark, sf):
    days = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(F.to_date("o_orderdate")).alias("days"))
    return days.select("o_custkey", F.array_min("days").alias("first_day"))


@query("""select unnest(['count', 'mean', 'stddev', 'min', 'median', 'max']) as statistic, unnest([count(o_totalprice)::double, round(avg(o_totalprice), 4), round(stddev(o_totalprice), 4), min(o_totalprice), round(quantile_cont(o_totalprice, 0.5), 4), max(o_totalprice)]) as o_totalprice,
          unnest([count(o_custkey)::double, round(avg(o_custkey), 4), round(stddev(o_custkey), 4), min(o_custkey)::double, round(quantile_cont(o_custkey, 0.5), 4), max(o_custkey)::double]) as o_custkey from orders""")
def describe_orders(spark, sf):
    columns = ["o_totalprice", "o_custkey"]
    kinds = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    orders = table(spark, sf, "orders")
    medians = {c: q[0] for c, q in quantiles(orders, columns, [0.5]).items()}
    one = orders.agg(*[f(c).cast("double").alias(f"{c}_{k}") for c in columns for k, f in kinds.items()], *[F.lit(medians[c]).cast("double").alias(f"{c}_median") for c in columns])
    rows = [F.struct(F.lit(k).alias("statistic"), *[F.round(f"{c}_{k}", 4).alias(c) for c in columns]) for k in (*kinds, "median")]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("""select l_returnflag, share, round(case share when 0.25 then q[1] when 0.5 then q[2] else q[3] end, 6) as value
   from (select l_returnflag, quantile_cont(l_extendedprice, [0.25, 0.5, 0.99]) as q from lineitem group by 1), (select unnest([0.25::double, 0.5, 0.99]) as share)""")
def price_quantiles(spark, sf):
    """Quantiles of each return flag's prices, by ranks."""
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("group"), F.col("l_extendedprice").alias("value"))
    sizes = {r["group"]: r["n"] for r in rows.groupBy("group").agg(F.count("value").alias("n")).collect()}  # a row for each flag
    places = {(g, s): (n - 1) * s for g, n in sizes.items() for s in (0.25, 0.5, 0.99)}
    found = values_at_ranks(rows, sorted({(g, k) for (g, _), p in places.items() for k in (int(p), min(int(p) + 1, sizes[g] - 1))}))
    made = [(g, s, (low := found[g, int(p)]) + (found[g, min(int(p) + 1, sizes[g] - 1)] - low) * (p - int(p))) for (g, s), p in places.items()]
    return spark.createDataFrame(made, "l_returnflag string, share double, value double").withColumn("value", F.round("value", 6))


# --- features of rules


@query("select o_orderkey, case when o_orderpriority = '1-URGENT' then true end as adhoc from orders")
def tag_flag(spark, sf):
    tags = F.create_map(F.lit("AdHoc notice"), F.col("o_orderpriority") == "1-URGENT", F.lit("other"), F.lit(True))
    return table(spark, sf, "orders").select("o_orderkey", X.adhoc_by_tags(tags).alias("adhoc"))


@query("select doc_id, contains(lower(text), 'license') as licence, contains(lower(text), 'the ') as the from documents")
def phrase_features(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *X.phrase_flags(F.col("text"), {"licence": "License", "the": "the "}))


@query("select doc_id, contains(lower(text), 'one-off ad hoc') as one_off, contains(lower(text), 'ad hoc notification') as notified, case when contains(lower(text), 'one-off ad hoc') or contains(lower(text), 'ad hoc notification') then 'no' end as label from (select doc_id, case doc_id % 4 when 0 then 'One-off Ad Hoc form' when 1 then 'x AD HOC NOTIFICATION y' else text end as text from documents)")
def keyword_flags(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, "One-off Ad Hoc form").when(F.col("doc_id") % 4 == 1, "x AD HOC NOTIFICATION y").otherwise(F.col("text")).alias("text"))
    flagged = docs.select("doc_id", *X.phrase_flags(F.col("text"), {"one_off": "one-off ad hoc", "notified": "ad hoc notification"}))
    return flagged.withColumn("label", F.when(F.col("one_off") | F.col("notified"), "no"))


@query("select feature, kind, field from (values ('n_days', 'number'), ('seaman', 'flag'), ('fee', 'currency')) f(feature, kind), (values ('sales'), ('travel')) t(field)")
def feature_registry(spark, sf):
    return X.registry(spark, [("n_days", "number"), ("seaman", "flag"), ("fee", "currency")], ["sales", "travel"])


@query("select item_id % 5 as rule, list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(regexp_replace(text, '[^a-zA-Z ]', ' ', 'g')), ' +', ' ', 'g')), ' '), lambda w: w <> ''))) as words from benchmark where item_id < 5")
def rule_bags(spark, sf):
    rules = table(spark, sf, "benchmark").where("item_id < 5").select((F.col("item_id") % 5).alias("rule"), F.lower(F.regexp_replace("text", "[^a-zA-Z ]", " ")).alias("text"))
    return X.bags(rules, "rule", "text")


@query("select * from (values (0, true, false), (1, false, false), (2, false, false)) t(id, near, near_without)")
def context_features(spark, sf):
    rows = spark.createDataFrame([(0, "no fee for change of ticket".split()), (1, "a b c".split()), (2, [])], "id int, words array<string>")
    return rows.select("id", X.context_flag(F.col("words"), "change", ["fee", "ticket"]).alias("near"), X.context_flag(F.col("words"), "change", ["fee"], ["ticket"]).alias("near_without"))


@query("""select doc_id, category, unnest(map_keys(f)) as name, unnest(map_values(f)) as value from (select doc_id, lang as category, map_concat(map {'n': n_chars::varchar}, case lang when 'en' then map {'licence': contains(lower(text), 'license')::varchar} when 'fr' then map {'les': contains(lower(text), ' les ')::varchar} else map {} end) as f from documents)""")
def category_features(spark, sf):
    """Each category has a list of phrases of its own; their flags join the features all have."""
    docs = table(spark, sf, "documents").withColumn("base", F.create_map(F.lit("n"), F.col("n_chars").cast("string")))
    made = X.category_features(docs, "lang", F.col("text"), F.col("base"), {"en": {"licence": "license"}, "fr": {"les": " les "}})
    return made.select("doc_id", F.col("lang").alias("category"), F.explode("features").alias("name", "value"))


# --- languages and dates of documents


@query("select * from (values (0, ['en']), (1, ['en', 'fr']), (2, []::varchar[]), (3, ['en', 'zh'])) t(id, found)")
def language_list(spark, sf):
    rows = [(0, "the fare is not valid for this and that"), (1, "the fare is for the people of the city. le tarif est pour les gens de la ville et des villages"), (2, " "), (3, "the fare is for the ticket of the day 运价适用于中国大陆始发的旅客与代理人")]
    return spark.createDataFrame(rows, "id int, text string").select("id", languages(F.col("text")).alias("found"))


@query("select page_id from pages where page_id % 10 = 0 or html is null")
def empty_texts(spark, sf):
    """Pages without any text, here every tenth is emptied."""
    pages = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 10 == 0, "<p> </p>").otherwise(F.col("html")).alias("html"))
    return pages.where(F.coalesce(F.trim(html_text(F.col("html"))), F.lit("")) == "").select("page_id")


@query("select * from (values (0, date '2017-04-30'), (1, null)) t(id, day)")
def discontinue_dates(spark, sf):
    rows = spark.sql("select * from values (0, array(named_struct('from', '2017-02-01', 'to', '2017-04-30'))), (1, array(named_struct('from', '2016-01-01', 'to', '9999-12-31'))) as t(id, p)")
    return rows.select("id", discontinue_date(F.col("p")).alias("day"))


@query("select n_nationkey from nation where n_nationkey % 2 = 0")
def typed_accepts(spark, sf):
    rows = table(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, "2017-01-31").otherwise("2017-02-31").alias("day"))
    return typed(rows, {"day": "date"})[0].select("n_nationkey")
