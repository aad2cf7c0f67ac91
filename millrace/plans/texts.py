"""Queries of text, date and collection functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import dates as D
from millrace.functions import spelling as SP
from millrace.functions import text as T
from millrace.plans.registry import query, sink, table


def _values(spark, rows: str, columns: str):
    return spark.sql(f"select * from values {rows} as t({columns})")


@query("select word, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1")
def word_freq(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(f"""select word, n from (select word, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as word from documents) group by 1 order by n desc, word limit 4000)
           where length(word) >= 4 and word not in ({", ".join(f"'{w}'" for w in T.STOP_WORDS)}) and not regexp_matches(word, '^[0-9]') and not regexp_matches(word, '^[a-z0-9_]+ff[0-9]+$') and not regexp_matches(word, '[0-9](jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)')""")
def topwords(spark, sf):
    return T.top_words(table(spark, sf, "documents"), "text", 4000, word="[a-z0-9_]+").where(T.is_plain_word(F.col("word")))


@query("select p_partkey, regexp_extract_all(upper(p_type), '[A-Z]+') as tokens from part")
def alpha_tokens(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.alpha_tokens(F.col("p_type")).alias("tokens"))


@query(r"select doc_id, list_filter(regexp_split_to_array(text, '[-/.,\s]+'), lambda w: w <> '') as words from documents where lang = 'en'")
def wordlist(spark, sf):
    return table(spark, sf, "documents").where("lang = 'en'").select("doc_id", T.wordlist(F.col("text")).alias("words"))


@query("select doc_id, array_to_string(string_split(text, ' '), '|') as joined from documents")
def array_join(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.split("text", " "), "|").alias("joined"))


_MONEY = "('CNY100'),('USD5.5'),('HKDX'),('EUR'),('ABC100'),('gbp20')"


@query(f"select word, case when length(word) >= 4 and upper(word[1:3]) in {T.CURRENCIES} and regexp_matches(word[4:4], '[0-9]') then [word[1:3], word[4:]] else [word] end as parts from (values {_MONEY}) t(word)")
def split_currency(spark, sf):
    return _values(spark, _MONEY, "word").select("word", T.split_currency(F.col("word")).alias("parts"))


@query("""select * from (values ('1 a b 2 c', ['1 a b', '2 c']), ('x y 3', ['x y', '3']), ('q', ['q']), ('7 8', ['7', '8'])) t(text, pieces)""")
def break_notes(spark, sf):
    rows = _values(spark, "('1 a b 2 c'),('x y 3'),('q'),('7 8')", "text")
    return rows.select("text", F.transform(T.break_at_numbers(F.split("text", " ")), lambda p: F.array_join(p, " ")).alias("pieces"))


@query("select doc_id, list_filter(string_split(text, ' '), lambda w: length(w) > 14) as long_words from documents")
def long_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.filter(F.split("text", " "), lambda w: F.length(w) > 14).alias("long_words"))


@query(r"select p_partkey, trim(regexp_replace(lower(regexp_replace(translate(p_name || '_' || p_type || '.html', '_-,;.', '     '), '\bhtml\b', '', 'g')), ' +', ' ', 'g')) as name from part")
def filename_norm(spark, sf):
    name = F.concat("p_name", F.lit("_"), "p_type", F.lit(".html"))
    return table(spark, sf, "part").select("p_partkey", T.filename_norm(name).alias("name"))


_CODES = "('IT 16FLL888FF520'),('BCODEX1'),('ITBCODE77'),('HKG2407FF538')"


@query(f"select code, regexp_replace(regexp_replace(replace(code, ' ', ''), '^IT', ''), '^BCODE', '') as clean from (values {_CODES}) t(code)")
def clean_tourcode(spark, sf):
    return _values(spark, _CODES, "code").select("code", T.clean_tourcode(F.col("code")).alias("clean"))


_GLUED = "('TOWUH'),('TOKYO'),('ORSHA'),('AND'),('TO'),('HKG'),('ORLANDO')"


@query(f"select word, case when word in {T.WHOLE_NAMES} then word else regexp_replace(word, '^(TO|OR|AND)([A-Z]{{3,}})$', '\\1 \\2') end as split from (values {_GLUED}) t(word)")
def unglue_route(spark, sf):
    return _values(spark, _GLUED, "word").select("word", T.unglue_route(F.col("word")).alias("split"))


@query("select * from (values ('usa asia', 'USA - ASIA'), ('LAX TOHKG', 'LAX TO HKG'), ('SFO A HKG', 'SFO - HKG'), ('TOKYO', 'TOKYO'), ('', '')) t(route, text)")
def route_texts(spark, sf):
    return _values(spark, "('usa asia'),('LAX TOHKG'),('SFO A HKG'),('TOKYO'),('')", "route").select("route", T.route_text(F.col("route")).alias("text"))


@query("select doc_id from documents where len(list_intersect(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), ['license', 'apache', 'server'])) > 0")
def word_search(spark, sf):
    """Any of several words, as an unquoted search."""
    return table(spark, sf, "documents").where(T.any_word(F.col("text"), ["License", "Apache", "server"])).select("doc_id")


@query("select distinct doc_id from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as word from documents) where word in ('license', 'the')")
def index_search(spark, sf):
    """A search over an inverted index that was written by word and read again."""
    path = sink(spark, "index")
    T.word_index(table(spark, sf, "documents"), "doc_id", "text").repartitionByRange("word").sortWithinPartitions("word").write.parquet(path)
    return spark.read.parquet(path).where(F.col("word").isin("license", "the")).select("doc_id").distinct()


@query("""select * from (values (0, date '2017-02-28'), (1, date '2017-10-05'), (2, date '9999-12-31'), (3, date '2018-06-09'), (4, date '2017-10-16'), (5, date '9999-12-31'), (6, null)) t(id, day)""")
def spoken_dates(spark, sf):
    rows = _values(spark, "(0, '31 Feb 2017'),(1, '05October17'),(2, '1Jan30'),(3, '9 June'),(4, '10/16/2017 only'),(5, 'until further notice'),(6, 'soon')", "id, text")
    return rows.select("id", D.spoken_date(F.col("text"), F.lit(2018)).alias("day"))


# the vocabulary is small, so the SQL compares all words of about its lengths
_VOCABULARY = """w as (select word, count(*) as freq from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1),
  m as (select word from w), v as (select word, freq from w where freq >= 50),
  near as (select m.word, v.word as candidate, freq, damerau_levenshtein(m.word, v.word) as d from m join v on abs(length(m.word) - length(v.word)) <= 1 and damerau_levenshtein(m.word, v.word) <= 1) """


def _spelling(spark, sf):
    docs = table(spark, sf, "documents")
    counts = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("freq"))
    return counts.select("word"), counts.where("freq >= 50")


@query("with " + _VOCABULARY + """, b as (select word, candidate from near qualify row_number() over (partition by word order by (word <> candidate)::int, freq desc, candidate) = 1)
   select m.word, coalesce(candidate, m.word) as corrected from m left join b on m.word = b.word""")
def spell_correct(spark, sf):
    return T.correct(*_spelling(spark, sf))


@query("with " + _VOCABULARY + """select m.word, case when count(candidate) filter (candidate = m.word) > 0 or count(candidate) = 0 then [m.word] else list_sort(list(candidate)) end as candidates
   from m left join near on m.word = near.word group by m.word""")
def tourcode_candidates(spark, sf):
    return _candidates(*_spelling(spark, sf))


@query("""with w as (select word, count(*) as freq from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1), v as (select word, freq from w where freq >= 50),
   near as (select w.word, v.word as candidate, v.freq, damerau_levenshtein(w.word, v.word) as d from w join v on abs(length(w.word) - length(v.word)) <= 4),
   b as (select word, arg_min(candidate, (d, -freq, candidate)) as corrected, min(d) as d from near where d <= 4 group by word)
   select w.word, coalesce(corrected, w.word) as corrected, d as distance from w left join b using (word)""")
def spell_correct_four(spark, sf):
    """Corrections up to four edits away, over all words of the documents."""
    return SP.correct(*_spelling(spark, sf), 4)


@query("""with w as (select word, count(*) as freq from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1), v as (select word, freq from w where freq >= 50),
   near as (select w.word, v.word as candidate, v.freq, damerau_levenshtein(w.word, v.word) as d from w join v on abs(length(w.word) - length(v.word)) <= 2),
   b as (select word, arg_min(candidate, (d, -freq, candidate)) as corrected from near where d <= 2 group by word)
   select w.word, coalesce(corrected, w.word) as corrected from w left join b using (word)""")
def spell_correct_two(spark, sf):
    """Corrections up to two edits away, over all words of the documents."""
    return SP.correct(*_spelling(spark, sf), 2).select("word", "corrected")


def _candidates(words, vocabulary):
    found = T.spelling_candidates(words, vocabulary).groupBy("word").agg(F.min("distance").alias("d"), F.array_sort(F.collect_set("candidate")).alias("all"))
    joined = words.join(found, "word", "left")
    return joined.select("word", F.when(F.col("d") == 1, F.col("all")).otherwise(F.array("word")).alias("candidates"))


@query(r"""with w as (select doc_id, word, count(*) as c from (select doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]{2,}')) as word from documents where lang = 'en') group by 1, 2),
   n as (select count(*) as n from documents where lang = 'en'), f as (select word, count(*) as df from w group by 1 having count(*) >= 2),
   v as (select doc_id, word, c * (ln((1 + n) / (1.0::double + df)) + 1) as v from w join f using (word), n)
   select doc_id, word, round(v / sqrt(sum(v * v) over (partition by doc_id)), 6) as weight from v""")
def tfidf(spark, sf):
    return T.tf_idf(table(spark, sf, "documents").where("lang = 'en'"), "doc_id", "text", 2).withColumn("weight", F.round("weight", 6))


_YMD = "(10,16,2017),(2017,10,16),(16,10,2017),(16,10,7),(10,16,7),(10,12,7),(12,10,7),(25,12,2017),(16,10,17),(10,16,17),(1,1,9),(99,99,99),(16,10,12)"


@query(f"""select a, b, c, case when a between 2010 and 9998 and b between 1 and 12 and c between 1 and 31 then make_date(a, b, c)
    when c between 2010 and 9998 and b between 1 and 12 and a between 1 and 31 then make_date(c, b, a) when c between 2010 and 9998 and a between 1 and 12 and b between 1 and 31 then make_date(c, a, b)
    when c between 16 and 9999 and b between 1 and 12 and a between 1 and 31 then make_date(c + 2000, b, a) when c between 16 and 9999 and a between 1 and 12 and b between 1 and 31 then make_date(c + 2000, a, b)
    when c between 0 and 8 and b between 1 and 12 and a between 1 and 31 then make_date(c + 2010, b, a) when c between 0 and 8 and a between 1 and 12 and b between 1 and 31 then make_date(c + 2010, a, b)
    else date '9999-01-01' end as day from (values {_YMD}) t(a, b, c)""")
def ymd_dater(spark, sf):
    return _values(spark, _YMD, "a, b, c").withColumn("day", D.ymd_date(F.col("a"), F.col("b"), F.col("c")))


@query("select o_orderkey, (case when y = 0 then 2016 when y between 10 and 99 then y + 2000 when y between 1 and 9 then y + 2010 else y end)::int as year from (select o_orderkey, (o_orderkey % 120)::int as y from orders)")
def normalise_year(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.normalise_year((F.col("o_orderkey") % 120).cast("int"), F.lit(2016)).cast("int").alias("year"))


@query("""select o_orderkey, least(make_date(2015 + (o_orderkey % 7)::int, 1 + (o_orderkey % 12)::int, 1) + ((o_orderkey % 31)::int), last_day(make_date(2015 + (o_orderkey % 7)::int, 1 + (o_orderkey % 12)::int, 1))) as day from orders""")
def clamp_month_end(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", D.clamp_day((k % 7 + 2015).cast("int"), (k % 12 + 1).cast("int"), (k % 31 + 1).cast("int")).alias("day"))


@query("select o_orderkey, strftime(o_orderdate, '%d-%b-%y') as text, make_date(2000 + (year(o_orderdate) % 100)::int, month(o_orderdate)::int, day(o_orderdate)::int) as day from orders")
def date_formats(spark, sf):
    text = F.date_format("o_orderdate", "dd-MMM-yy")
    return table(spark, sf, "orders").select("o_orderkey", text.alias("text"), D.text_date(text).alias("day"))


@query("select l_orderkey, l_linenumber, date_diff('day', o_orderdate::date, l_shipdate::date)::int as days from lineitem join orders on o_orderkey = l_orderkey")
def date_diff(spark, sf):
    joined = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return joined.select("l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").alias("days"))


_EXT = "(1,'2017-10-10','2017-09-28','2017-01-01'),(2,'2017-10-10','2017-06-01','2017-10-01'),(3,'2016-10-10','2017-10-12','2017-10-11'),(4,'2017-01-05','2018-01-03','2018-01-06')"


@query(f"""with e as (select id, x::date as x, b::date as b, f::date as f from (values {_EXT}) t(id, x, b, f)), g as (select *, case when x - b between 1 and 30 then b else f end as e from e),
    h as (select id, case when x - e < -350 and year(x) = 2016 then x + interval 1 year else x end::date as x, case when x - e < -350 and year(x) <> 2016 then e - interval 1 year else e end::date as e from g)
    select id, x as extension_date, e as effective_date, (x - e)::int as days from h""")
def extension_repair(spark, sf):
    rows = _values(spark, _EXT, "id, x, b, f").select("id", *(F.col(c).cast("date").alias(c) for c in "xbf"))
    return rows.select("id", D.extension(F.col("x"), F.col("b"), F.col("f")).alias("e")).select("id", "e.*")


@query("select o_orderkey, make_date((year(o_orderdate) - (((o_orderkey % 12) + 1) > month(o_orderdate))::int)::int, ((o_orderkey % 12) + 1)::int, 1) as day from orders")
def inherit_year(spark, sf):
    month = (F.col("o_orderkey") % 12 + 1).cast("int")
    return table(spark, sf, "orders").select("o_orderkey", D.inherit_year(month, F.lit(1), F.to_date("o_orderdate")).alias("day"))


_PERCENT = "('10%'),('7 %'),('USD 50'),('0%'),('net'),('5 pct 12%')"


@query(f"""select text, try_cast(nullif(regexp_extract(text, '(\\d+)[^%]*%\\s*$', 1), '') as int) as value, case when regexp_extract(text, '(\\d+)[^%]*%\\s*$', 1) <> '' then 'P' else 'T' end as unit from (values {_PERCENT}) t(text)""")
def parse_percent(spark, sf):
    return _values(spark, _PERCENT, "text").select("text", D.parse_percent(F.col("text")).alias("p")).select("text", "p.*")


@query("select doc_id, w[1] as first, w[-1] as last, text[1:1] as letter, list_contains(w, 'the') as has_the from (select doc_id, text, string_split(text, ' ') as w from documents)")
def array_ops(spark, sf):
    words = F.split("text", " ")
    return table(spark, sf, "documents").select("doc_id", F.element_at(words, 1).alias("first"), F.element_at(words, -1).alias("last"), F.substring("text", 1, 1).alias("letter"), F.array_contains(words, "the").alias("has_the"))


@query("""with a as (select l_orderkey, list(l_suppkey) filter (l_quantity > 45) as x, list(l_linenumber) filter (l_discount > 0.08) as y from lineitem group by 1),
    b as (select l_orderkey, unnest(case when x is null then [null] else x end) as x, y from a)
    select l_orderkey, x as supplier, unnest(case when y is null then [null] else y end) as line from b""")
def unwind_outer(spark, sf):
    from millrace.operators.relational import unwind_outer as unwind

    arrays = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.when(F.expr("l_quantity > 45D"), F.col("l_suppkey"))).alias("supplier"), F.collect_list(F.when(F.expr("l_discount > 0.08D"), F.col("l_linenumber"))).alias("line"))
    return unwind(arrays, ["supplier", "line"])


@query("select event_id, cast(props->>'k' as bigint) as k from events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("select role, rank() over (order by n desc) as place, n from (select role, count(*) as n from conversations group by 1)")
def role_ranks(spark, sf):
    counts = table(spark, sf, "conversations").groupBy("role").agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.rank().over(Window.orderBy(F.desc("n"))))  # one row for each role


@query("select doc_id, case when source in ('src1', 'src2') then 'zh-Hant' when source in ('src3', 'src4') then 'zh-cn' else 'other' end as rule from documents")
def lang_rules(spark, sf):
    rule = F.when(F.col("source").isin("src1", "src2"), "zh-Hant").when(F.col("source").isin("src3", "src4"), "zh-cn").otherwise("other")
    return table(spark, sf, "documents").select("doc_id", rule.alias("rule"))
