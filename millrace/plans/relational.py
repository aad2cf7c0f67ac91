"""Queries of scans, projections, filters and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import relational as R
from millrace.operators.commission_etl import CLEAN, LISTS
from millrace.plans.registry import query, table
from millrace.sources.readers import upsert_labels

@query("select doc_id, lang, source from documents where lang = 'en' and source in ('src0', 'src3', 'src7')")
def scan_predict(spark, sf):
    return table(spark, sf, "documents").where((F.col("lang") == "en") & F.col("source").isin("src0", "src3", "src7")).select("doc_id", "lang", "source")


@query("select doc_id, lang, source, quality from documents join labels using (doc_id) where lang = 'fr' and quality is not null")
def scan_train(spark, sf):
    docs = table(spark, sf, "documents").where("lang = 'fr'").select("doc_id", "lang", "source")
    return docs.join(table(spark, sf, "labels").where("quality is not null").select("doc_id", "quality"), "doc_id")


@query("""select doc_id, cast(coalesce(n.quality, o.quality) as int) as quality from labels o
          full join (select doc_id, 1 - quality as quality from labels where doc_id % 10 = 0 union all select doc_id, 2 from documents where doc_id % 50 = 1 and doc_id not in (select doc_id from labels)) n using (doc_id)""")
def label_upsert(spark, sf):
    old = table(spark, sf, "labels").select("doc_id", "quality")
    more = table(spark, sf, "documents").where("doc_id % 50 = 1").join(old, "doc_id", "left_anti").select("doc_id", F.lit(2).alias("quality"))
    new = old.where("doc_id % 10 = 0").select("doc_id", (1 - F.col("quality")).alias("quality")).unionByName(more)
    return upsert_labels(old, new, ["doc_id"], "quality").withColumn("quality", F.col("quality").cast("int"))


@query("select doc_id, source from documents where doc_id not in (select doc_id from labels where toxic = 1)")
def exclude_exceptions(spark, sf):
    failed = table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    return table(spark, sf, "documents").select("doc_id", "source").join(failed, "doc_id", "left_anti")


@query("select distinct p_brand from part")
def distinct_values(spark, sf):
    return table(spark, sf, "part").select("p_brand").distinct()


@query("""select o_orderkey, coalesce(quality, 0)::int as quality, coalesce(o_orderpriority, '') as o_orderpriority
          from orders left join labels on o_orderkey = doc_id""")
def fill_nulls(spark, sf):
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("o_orderkey"), "quality")
    joined = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").join(labels, "o_orderkey", "left")
    return joined.na.fill({"quality": 0, "o_orderpriority": ""})


@query("""select l_orderkey, l_linenumber,
            case when l_returnflag = 'N' then '9999-12-31' else strftime(l_shipdate, '%Y-%m-%d') end as end_date,
            case when l_quantity = 50 then null else l_quantity end as quantity from lineitem""")
def sentinel_dates(spark, sf):
    ship = F.when(F.col("l_returnflag") == "N", "").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", R.sentinel(ship, "", R.UNKNOWN_END).alias("end_date"), F.nullif("l_quantity", F.lit(50.0)).alias("quantity"))


_LOCATIONS = "(1,'CX AND KA'),(2,'SYSTEM'),(3,'FROM'),(4,'SHA OR HKG'),(5,'HKG'),(6,null),(7,'WUH, CAN, BJS, SHA OR HKG'),(8,'MEXICO ANDLATIN AMERICA'),(9,'OR'),(10,'CX AND KA SYSTEM'),(11,'MEXICO AND LATIN AMERICA')"


def _locations(spark):
    return spark.sql(f"select cast(id as bigint) as id, location from values {_LOCATIONS} as t(id, location)")


@query(f"""select id::bigint as id, case when location in ('CX AND KA', 'CX AND KA SYSTEM', 'SYSTEM') then 'ALL CX AND KA' when location = 'FROM' then null else location end as location
           from (values {_LOCATIONS}) t(id, location)""")
def value_map_clean(spark, sf):
    return R.map_values(_locations(spark), "location", CLEAN)


@query(f"""select id::bigint as id, unnest(case location when 'SHA OR HKG' then ['SHA','HKG'] when 'MEXICO ANDLATIN AMERICA' then ['MEXICO','LATIN AMERICA']
             when 'MEXICO AND LATIN AMERICA' then ['MEXICO','LATIN AMERICA'] when 'WUH, CAN, BJS, SHA OR HKG' then ['WUH','CAN','BJS','SHA','HKG'] else [location] end) as location
           from (values {_LOCATIONS}) t(id, location)""")
def unwind_locations(spark, sf):
    return R.unwind_values(_locations(spark), "location", LISTS)


_ROUTES = "(1,'BOS TO PVG'),(2,'CANADA TO'),(3,'SHA OR HKG'),(4,'TOWUH, CAN, BJS,'),(5,'USA ASIA'),(6,'XXX')"
_ROUTE_MAP = "('BOS TO PVG','BOS','PVG'),('CANADA TO','CANADA',null),('SHA OR HKG','SHA|HKG','SHA|HKG'),('TOWUH, CAN, BJS,',null,'WUH|CAN|BJS'),('USA ASIA','USA','ASIA')"


@query(f"""select id::bigint as id, coalesce(f, case when f is null and m.route is null then r.route end) as from_location, t as to_location
           from (values {_ROUTES}) r(id, route) left join (values {_ROUTE_MAP}) m(route, f, t) using (route)""")
def route_lookup_split(spark, sf):
    rows = spark.sql(f"select cast(id as bigint) as id, route from values {_ROUTES} as t(id, route)")
    lookup = spark.sql(f"select route, f, t, true as hit from values {_ROUTE_MAP} as t(route, f, t)")  # a fixed map
    return rows.join(F.broadcast(lookup), "route", "left").select("id", F.when(F.col("hit"), F.col("f")).otherwise(F.col("route")).alias("from_location"), F.col("t").alias("to_location"))


_RAW = "(1,'7.5','2017-03-01','12'),(2,'x','2017-03-01','3'),(3,'','2017-13-01','3'),(4,'','','') ,(5,'1',null,'4.5')"


@query(f"""select id::bigint as id, try_cast(nullif(rate,'') as double) as rate, try_cast(nullif(day,'') as date) as day, try_cast(nullif(n,'') as double) as n from (values {_RAW}) t(id, rate, day, n)
           where not (nullif(rate,'') is not null and try_cast(rate as double) is null) and not (nullif(day,'') is not null and try_cast(day as date) is null)
             and not (nullif(n,'') is not null and try_cast(n as double) is null)""")
def typed_load(spark, sf):
    rows = spark.sql(f"select cast(id as bigint) as id, rate, day, n from values {_RAW} as t(id, rate, day, n)")
    return R.typed(rows, {"rate": "double", "day": "date", "n": "double"})[0]


@query("select p_partkey::bigint as tour, count(*)::bigint as n from lineitem join part on p_partkey = l_partkey group by 1")
def tourcode_master_counts(spark, sf):
    orders = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("codes"))
    return orders.select(F.explode("codes").alias("tour")).groupBy("tour").agg(F.count("*").alias("n"))


@query("select l_orderkey, l_linenumber, case when l_linenumber in (0, 1, 4) then 'AB' when l_linenumber = 3 then 'A' when l_linenumber = 2 then 'B' end as journey from lineitem")
def recode_case(spark, sf):
    n = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(n.isin(0, 1, 4), "AB").when(n == 3, "A").when(n == 2, "B").alias("journey"))


@query("select doc_id, quality as commission, toxic as filed from labels where not (quality is null and toxic is null)")
def struct_expand(spark, sf):
    nested = table(spark, sf, "labels").select("doc_id", F.struct(F.col("quality").alias("commission"), F.col("toxic").alias("filed")).alias("classifications"))
    return nested.select("doc_id", "classifications.*").where("commission is not null or filed is not null")


@query(f"select id::bigint as id, location from (values {_LOCATIONS}) t(id, location) where location <> 'OR' or location is null")
def drop_value(spark, sf):
    return R.drop_value(_locations(spark), "location", "OR")


_GOLD = "case quality when 1 then 'yes' when 0 then 'no' end"
_PRED = "case toxic when 1 then 'yes' when 0 then 'no' end"


def _judged(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.select("doc_id", "source", F.expr(_GOLD).alias("gold"), F.expr(_PRED).alias("predicted"))


@query(f"""select doc_id, source from (select doc_id, source, {_GOLD} as gold, {_PRED} as predicted from documents left join labels using (doc_id))
           where (coalesce(gold,'') = 'yes' or coalesce(predicted,'') = 'yes') and coalesce(gold,'') <> 'no'""")
def market_commissions(spark, sf):
    return _judged(spark, sf).where(R.is_market(F.col("gold"), F.col("predicted"))).select("doc_id", "source")


@query("select doc_id, source from documents left join labels using (doc_id) where quality is null")
def unlabelled_docs(spark, sf):
    return _judged(spark, sf).where("gold is null or gold not in ('yes', 'no')").select("doc_id", "source")


@query("select doc_id from documents where contains(text, 'License')")
def contains_filter(spark, sf):
    return table(spark, sf, "documents").where(F.col("text").contains("License")).select("doc_id")


@query("select doc_id from documents where contains(lower(text), 'version 2.0')")
def phrase_search(spark, sf):
    return table(spark, sf, "documents").where(F.lower("text").contains("version 2.0")).select("doc_id")


@query("select doc_id, case when lang = 'en' and source <> 'src1' then 'english' when lang in ('fr', 'es') then 'romance' else 'other' end as part from documents")
def lang_partition(spark, sf):
    part = F.when((F.col("lang") == "en") & (F.col("source") != "src1"), "english").when(F.col("lang").isin("fr", "es"), "romance").otherwise("other")
    return table(spark, sf, "documents").select("doc_id", part.alias("part"))


@query("select l_orderkey, l_linenumber, l_discount from lineitem where l_discount between 0.05 - 0.002 and 0.05 + 0.002 and l_discount <> 0")
def rate_band(spark, sf):
    rows = table(spark, sf, "lineitem").where(F.col("l_discount").between(0.05 - 0.002, 0.05 + 0.002) & (F.col("l_discount") != 0))
    return rows.select("l_orderkey", "l_linenumber", "l_discount")


@query("select p_partkey, p_type from part where len(list_intersect(string_split(p_type, ' '), ['ECONOMY', 'PROMO'])) = 0")
def drop_cabin_rows(spark, sf):
    words = F.split("p_type", " ")
    return table(spark, sf, "part").where(~F.arrays_overlap(words, F.array(F.lit("ECONOMY"), F.lit("PROMO")))).select("p_partkey", "p_type")


@query("select c_custkey as id, c_name as name from customer union all select s_suppkey, s_name from supplier")
def union_all(spark, sf):
    one = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return one.unionByName(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("select c_nationkey as nation from customer union select s_nationkey from supplier")
def union_distinct(spark, sf):
    one = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))
    return one.union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("select l_orderkey from lineitem where l_quantity > 40 except select l_orderkey from lineitem where l_discount > 0.05")
def set_except(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.where("l_quantity > 40").select("l_orderkey").subtract(rows.where("l_discount > 0.05").select("l_orderkey"))


@query("select l_partkey from lineitem where l_quantity > 40 intersect select l_partkey from lineitem where l_discount > 0.05")
def set_intersect(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.where("l_quantity > 40").select("l_partkey").intersect(rows.where("l_discount > 0.05").select("l_partkey"))


@query("""with o as (select l_orderkey, list(distinct l_suppkey) as s, list(distinct case when l_linenumber <= 2 then l_suppkey end) filter (l_linenumber <= 2) as f from lineitem group by 1)
          select l_orderkey, (len(list_intersect(f, s)) = len(f) and len(s) > len(f)) as is_proper from o where f is not null""")
def proper_subset(spark, sf):
    sets = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("s"), F.collect_set(F.when(F.col("l_linenumber") <= 2, F.col("l_suppkey"))).alias("f"))
    return sets.where(F.size("f") > 0).select("l_orderkey", R.proper_subset(F.col("f"), F.col("s")).alias("is_proper"))


@query("select o_orderkey, o_totalprice from orders where o_orderkey >= 100 order by o_orderkey")
def resume_from(spark, sf):
    return table(spark, sf, "orders").where("o_orderkey >= 100").orderBy("o_orderkey").select("o_orderkey", "o_totalprice")


@query("select p_brand, count(*) as n from part group by 1 order by n desc, p_brand limit 10")
def topk(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(10)


@query("select least((row_number() over (order by p_partkey) - 1) // 64, (select greatest(count(*) // 64, 1) - 1 from part))::bigint as batch, p_partkey from part")
def mini_batches(spark, sf):
    parts = table(spark, sf, "part")
    numbers = R.dense_keys(parts, ["p_partkey"], "line")
    last = max(parts.count() // 64, 1) - 1
    return numbers.select(F.least(F.floor(F.col("line") / 64), F.lit(last)).cast("bigint").alias("batch"), "p_partkey")


@query("with c as (select quality, count(*) as n from labels where quality is not null group by 1) select quality, (select max(n) from c) as n from c")
def oversample_counts(spark, sf):
    labels = table(spark, sf, "labels").where("quality is not null")
    counts = {r["quality"]: r["n"] for r in labels.groupBy("quality").agg(F.count("*").alias("n")).collect()}  # one row for each class
    return R.oversample(labels, "quality", ["doc_id"], counts).groupBy("quality").agg(F.count("*").alias("n"))


def _hash_sql(key: str, seed: int) -> str:
    return f"('0x' || substr(md5({key} || '|{seed}'), 1, 13))::bigint"


@query(f"select doc_id, source from documents order by {_hash_sql('doc_id', 0)}, doc_id limit 100")
def sample_documents(spark, sf):
    return R.sample_rows(table(spark, sf, "documents").select("doc_id", "source"), ["doc_id"], 100)


@query(f"select *, case when {_hash_sql('doc_id', 42)} % 1000000 / 1000000.0::double < 0.8::double then 'train' else 'test' end as part from labels")
def train_test_split(spark, sf):
    train, test = R.hash_split(table(spark, sf, "labels"), ["doc_id"], 0.8)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(f"""select doc_id, case when {_hash_sql('doc_id', 42)} % 1000000 / 1000000.0::double < 0.5::double then 'test' when {_hash_sql('doc_id', 43)} % 1000000 / 1000000.0::double < 1.0::double / 3 then 'dev' else 'train' end as part from documents""")
def three_way_split(spark, sf):
    return R.three_way_split(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@query("select c_custkey as c_custkey, c_name as c_name from customer")
def lower_names(spark, sf):
    upper = table(spark, sf, "customer").select(F.col("c_custkey").alias("C_CustKey"), F.col("c_name").alias("C_NAME"))
    return R.lower_columns(upper)


@query("select o_orderkey, o_clerk from (select o_orderkey, case when o_orderkey % 3 = 0 then 'x' || round(o_totalprice)::bigint when o_orderkey % 3 = 1 then '' else '7' end as o_clerk from orders) where o_clerk <> '' and try_cast(o_clerk as int) is null")
def typed_rejects(spark, sf):
    clerk = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("x"), F.round("o_totalprice").cast("bigint"))).when(F.col("o_orderkey") % 3 == 1, "").otherwise("7")
    rows = table(spark, sf, "orders").select("o_orderkey", clerk.alias("o_clerk"))
    return R.typed(rows, {"o_clerk": "int"})[1]


@query("""select l_orderkey, l_partkey, l_linenumber from (select *, row_number() over (partition by l_partkey order by l_orderkey, l_linenumber) as r from lineitem) where r = 1""")
def dedupe_keep_first(spark, sf):
    return R.keep_first(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber"), ["l_partkey"], ["l_orderkey", "l_linenumber"])
