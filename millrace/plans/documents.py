"""Queries of whole fare documents and of tour codes over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import sheets as S
from millrace.operators import tourcodes as C
from millrace.plans.registry import query, table

# --- tour codes

# labelled documents as sheets: their first words are their codes, quality their type, every seventh has an extension date
_SHEETS_SQL = """with d as (select doc_id as sheet, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')[1:3] as tourcodes, coalesce(text, '') as text, case quality when 1 then 'paper' when 0 then 'filed' end as faretype,
    case when doc_id % 7 = 0 then date '2017-01-01' + doc_id::int end as extension_date from documents left join labels using (doc_id)),
  c as (select distinct tour_cd, code, case abs(length(code)) % 3 when 0 then 'Y' when 1 then 'N' end as filed from (select upper(w) as tour_cd, w as code from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as w from benchmark where item_id < 12))),
  master as (select distinct unnest(tourcodes) as code from d), """
_COUNTS_SQL = """listed as (select distinct sheet, faretype, extension_date, unnest(tourcodes) as code from d),
  words as (select distinct sheet, faretype, extension_date, unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) as word from d),
  f as (select * from listed union all select sheet, faretype, extension_date, word from words where word not in (select code from listed)),
  n as (select code, arg_min({'t': faretype}, sheet).t as faretype, count(*) as file_cnt, count(*) filter (faretype = 'paper') as paper_cnt, count(*) filter (faretype = 'filed') as filed_cnt,
        coalesce(list_sort(list({'sheet': sheet, 'extension_date': extension_date}) filter (faretype = 'filed' and extension_date is not null)), []) as dates from f group by 1),
  r as (select * from n where faretype is not null) """


def _sheets(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    words = F.slice(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0)), 1, 3)
    ascii_text = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z0-9_]+", " ")
    return docs.select(
        F.col("doc_id").alias("sheet"), words.alias("tourcodes"), ascii_text.alias("text"), F.when(F.col("quality") == 1, "paper").when(F.col("quality") == 0, "filed").alias("faretype"),
        F.when(F.col("doc_id") % 7 == 0, F.date_add(F.lit("2017-01-01").cast("date"), F.col("doc_id").cast("int"))).alias("extension_date"),
    )


def _codes(spark, sf):
    words = table(spark, sf, "benchmark").where("item_id < 12").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("code")).distinct()
    kind = F.length("code") % 3
    return words.select(F.upper("code").alias("tour_cd"), "code", F.when(kind == 0, "Y").when(kind == 1, "N").alias("filed"))


@query(_SHEETS_SQL + _COUNTS_SQL + """select c.code, coalesce(faretype, 'Not found') as faretype, coalesce(file_cnt, 0) as file_cnt, coalesce(paper_cnt, 0) as paper_cnt, coalesce(filed_cnt, 0) as filed_cnt,
   coalesce(len(dates), 0)::int as n_dates, (case when len(dates) > 0 then dates[1].extension_date end) as first_date from (select distinct code from c) c left join r using (code)""")
def tourcode_file_counts(spark, sf):
    found = C.file_counts(_codes(spark, sf), _sheets(spark, sf))
    dates = F.coalesce("extension_dates", F.array().cast("array<struct<sheet:bigint,extension_date:date>>"))
    return found.select("code", "faretype", "file_cnt", "paper_cnt", "filed_cnt", F.size(dates).alias("n_dates"), F.try_element_at(dates, F.lit(1))["extension_date"].alias("first_date"))


@query(_SHEETS_SQL + _COUNTS_SQL + """, lost as (select * from c where code not in (select code from r) and filed is null),
   k as (select code as word, unnest(list_distinct(list_append(list_transform(range(1, length(code) + 1), lambda i: code[:i - 1] || code[i + 1:]), code))) as key from (select code from lost union select code from master)),
   near as (select distinct a.word as code, b.word as candidate, damerau_levenshtein(a.word, b.word) as d from k a join k b using (key) where a.word in (select code from lost) and b.word in (select code from master) and damerau_levenshtein(a.word, b.word) <= 1),
   best as (select code, candidate from near qualify d = min(d) over (partition by code)),
   lines as (select lost.*, coalesce(candidate, lost.code) as candidate, true as corrected from lost left join best using (code) union all select c.*, code, false from c where (tour_cd, code) not in (select (tour_cd, code) from lost))
   select tour_cd, l.code, candidate, filed, case when not corrected and coalesce(filed, '') <> 'Y' and faretype = 'filed' then 'paper' else coalesce(faretype, 'Not found') end as faretype,
          coalesce(file_cnt, 0) as file_cnt, coalesce(paper_cnt, 0) as paper_cnt, coalesce(filed_cnt, 0) as filed_cnt from lines l left join r on r.code = l.candidate""")
def tourcode_export(spark, sf):
    sheets = _sheets(spark, sf)
    return C.export(_codes(spark, sf), sheets, sheets.select(F.explode("tourcodes").alias("code")).distinct())


@query("select * from (values ('HKG24FF501', true, true), ('X1', false, true), ('aFF1rest', true, true), ('FF12', false, false)) t(word, shaped, known)")
def tour_code_test(spark, sf):
    rows = spark.createDataFrame([("HKG24FF501",), ("X1",), ("aFF1rest",), ("FF12",)], "word string")
    return rows.select("word", C.is_tour_code(F.col("word")).alias("shaped"), C.is_tour_code(F.col("word"), F.array(F.lit("X1"))).alias("known"))


# --- documents

# fixed values: small sheets that name what a document's facts are made of
_DOCS = [
    (1, "iss_01Sep17_HKG24FF501.html", "HK", ["<h1>CX KA fares USD100 USD200 HKD5</h1>", "<p>Sales from 20Sep17 to 30Sep17. Travel from 01Oct17 to 31Dec17. Originating from USA. Flight CX888. code SYD24FF1 for HKG and LAX</p><p>Previous version valid upto 10Oct17</p>"]),
    (2, "cx_travel from 01Feb17 to 30Apr17.html", "CN", ["<p>RTW fares: no commission. code share</p>"]),
    (3, None, "HK", None),
]


def _docs(spark):
    return spark.createDataFrame(_DOCS, "doc_id int, filename string, country string, htmls array<string>")


@query("""select * from (values (1, 'USD', 'USA', ['CX', 'KA'], ['USA', 'HKG', 'LAX'], ['HKG24FF501', 'SYD24FF1'], ['+US'], ['+CX888'], '2017-09-20', '2017-12-31', date '2017-10-10', 20, 9999, false),
   (2, null, null, ['CX'], [], [], [], [], '2016-01-01', '2017-04-30', null, 0, 0, true), (3, null, null, [], [], [], [], [], '2016-01-01', '9999-12-31', null, 0, 9999, false))
   t(doc_id, currency, point_of_sale, carriers, locations, tourcodes, originating, flights, sales_from, travel_to, extension_date, extension, rtw_fare_comm, codeshare_mentioned)""")
def fare_documents(spark, sf):
    made = S.fare_documents(_docs(spark))
    names = ["doc_id", "currency", "point_of_sale", "carriers", "locations", "tourcodes", "originating", "flights"]
    return made.select(*names, F.col("sales_period")[0]["from"].alias("sales_from"), F.col("travel_period")[0]["to"].alias("travel_to"), "extension_date", "extension", "rtw_fare_comm", F.coalesce("codeshare_mentioned", F.lit(False)).alias("codeshare_mentioned"))


@query("select * from (values (1, 'SYD24FF1', 'HKG')) t(doc_id, code, place)")
def tourcodes_with_places(spark, sf):
    return S.fare_documents(_docs(spark)).select("doc_id", F.explode("coded_places").alias("c")).select("doc_id", "c.*")


@query("select * from (values (1, 'r2', 'HK'), (3, 'r2', 'HK')) t(doc_id, run, country)")
def document_refresh(spark, sf):
    docs = _docs(spark)
    seen = docs.select("doc_id", "filename", "country", F.when(F.col("doc_id") == 2, "r2").when(F.col("doc_id") == 1, "r1").alias("run"))
    return S.refreshed(seen, docs.select("doc_id", "htmls"), "r2").select("doc_id", "run", "country")


@query()
def page_documents(spark, sf):
    """The facts of every page of the table as a document."""
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("filename"), F.lit("HK").alias("country"), F.array("html").alias("htmls"))
    made = S.fare_documents(pages)
    return made.select(F.col("doc_id").alias("page_id"), "n_words", F.size("word_tokens_list").alias("n_tokens"), "currency", "carriers", "locations", "tourcodes", "sales_period")
