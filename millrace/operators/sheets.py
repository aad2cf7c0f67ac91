"""Fare sheets: from pages to commission rows and to extension records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import extract as E
from millrace.functions import shaping as S
from millrace.functions import tagging as G
from millrace.functions import text as T
from millrace.functions.dates import extension
from millrace.functions.fare_tables import fare_rows
from millrace.functions.html_tables import html_text, paragraphs_of, tables_of
from millrace.operators.tourcodes import codes_in_name

NO_COMMISSION = {"rtw_fare_comm": r"(?i)\b(rtw|round the world)\b[^.]*\bno commission\b", "ct_fare_comm": r"(?i)\b(ctp|circle trip)\b[^.]*\bno commission\b"}
UNKNOWN_COMMISSION = 9999


def selected(docs: DataFrame, phrase: str, country: str, failed: DataFrame | None = None, after: object = None) -> DataFrame:
    """Sheets of a country whose text has the phrase, apart from those that failed before; from those after ``after`` on, to go on with a batch."""
    found = docs.where((F.col("country") == country) & F.lower("html").contains(phrase.lower()))
    found = found if after is None else found.where(F.col("doc_id") > F.lit(after))
    return found if failed is None else found.join(failed.select("doc_id").distinct(), "doc_id", "left_anti")


def _first(periods: Column, side: str) -> Column:
    return F.try_element_at(periods, F.lit(1))[side]


def discontinue_date(periods: Column) -> Column:
    """The end of the first period as a date; null for an open end."""
    return F.nullif(_first(periods, "to"), F.lit("9999-12-31")).try_cast("date")


def document_facts(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, travel period, flags) of a sheet's whole text: 0 where a fare has no commission, 9999 if nothing says so."""
    texts = paragraphs.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda p: p["text"]), ". ").alias("text"))  # one document
    flags = [F.when(F.col("text").rlike(pattern), 0).otherwise(UNKNOWN_COMMISSION).alias(name) for name, pattern in NO_COMMISSION.items()]
    travel = E.choose_periods(E.periods_of(F.col("text"), "travel"), F.array().cast("array<struct<from:string,to:string>>"))
    return texts.select("doc_id", *flags, _first(travel, "from").alias("travel_from"), F.nullif(_first(travel, "to"), F.lit("9999-12-31")).alias("trv_dis_date"))


def paragraph_facts(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, table_no, origins, flights, sales period) of the text before each table."""
    before = paragraphs.where("text <> '' and before_table is not null").groupBy("doc_id", F.col("before_table").alias("table_no"))
    texts = before.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda p: p["text"]), ". ").alias("text"))
    sales = E.choose_periods(E.periods_of(F.col("text"), "sales"), F.array().cast("array<struct<from:string,to:string>>"))
    return texts.select("doc_id", "table_no", E.origins_of(F.col("text")).alias("originating"), E.flights_of(F.col("text")).alias("flights"), _first(sales, "from").alias("sales_from"), _first(sales, "to").alias("sales_to"))


def commission_rows(docs: DataFrame) -> DataFrame:
    """Commission rows of all fare tables of (doc_id, html) with what their sheets and paragraphs say."""
    spark = docs.sparkSession
    paragraphs = paragraphs_of(spark, docs, "doc_id", "html")
    rows = fare_rows(tables_of(spark, docs, "doc_id", "html"), ["doc_id", "table_no"])
    return rows.join(paragraph_facts(paragraphs), ["doc_id", "table_no"], "left").join(document_facts(paragraphs), "doc_id", "left")


def extension_records(docs: DataFrame) -> DataFrame:
    """(doc_id, extension_date, effective_date, days) of (doc_id, text, filename): until when a former version holds."""
    dated = docs.withColumn("ext", E.extension_date_of(F.col("text"))).where("ext is not null")
    start = lambda c: _first(E.periods_of(c, "sales"), "from").try_cast("date")
    unknown = F.lit("2016-01-01").cast("date")
    body, name = F.coalesce(start(F.col("text")), unknown), F.coalesce(start(F.col("filename")), unknown)
    return dated.select("doc_id", extension(F.col("ext"), body, name).alias("e")).select("doc_id", "e.*")


def carriers_of(*tokens: Column) -> Column:
    """The carriers of several tagged word lists, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[G.words_tagged(F.transform(t, lambda x: F.struct(F.upper(x["word"]).alias("word"), x["tag"].alias("tag"))), "CARRIER") for t in tokens]))))


def locations_of(*tokens: Column) -> Column:
    """The places of several tagged word lists, in order."""
    return F.flatten(F.array(*[G.words_tagged(t, "LOCATION") for t in tokens]))


def currency_of(tokens: Column) -> Column:
    """The most frequent currency code; of equally frequent ones the first."""
    codes = F.transform(G.words_tagged(tokens, "CURRENCY"), lambda w: F.upper(F.substring(w, 1, 3)))
    counted = F.transform(F.array_distinct(codes), lambda c, i: F.struct(F.size(F.filter(codes, lambda x: x == c)).alias("n"), (-i).alias("first"), c.alias("code")))
    return F.array_max(counted)["code"]


def coded_places(tokens: Column) -> Column:
    """array<struct<code,place>>: each tour code with the first place after it, up to the next code."""
    def next_code(i):
        return F.coalesce(S.position_from(tokens, lambda t: t["tag"] == "TOURCODE", i + 1), F.size(tokens))

    def place(i):
        inside = F.slice(tokens, i + 2, F.greatest(next_code(i) - i - 1, F.lit(0)))
        return F.try_element_at(G.words_tagged(inside, "LOCATION"), F.lit(1))

    marked = F.transform(tokens, lambda t, i: F.when(t["tag"] == "TOURCODE", F.struct(t["word"].alias("code"), place(i).alias("place"))))
    return F.filter(marked, lambda x: x.isNotNull())


def fare_documents(docs: DataFrame) -> DataFrame:
    """One row of facts for each of (doc_id, filename, country, htmls array).

    Its pages are joined and read once.  Tags of the file name and of the text give
    carriers, places, point of sale (the text's first place) and currency (the most
    frequent); periods come from the text, else from the file name, else are open;
    what single fares may override starts at its default.
    """
    page = F.array_join(F.coalesce("htmls", F.array().cast("array<string>")), " ")
    texts = docs.select("doc_id", "filename", "country", page.alias("html")).withColumn("text", html_text(F.col("html")))
    texts = texts.withColumn("name_words", F.split(F.translate(F.coalesce("filename", F.lit("")), "_.", "  "), r"\s+")).withColumn("word_list", T.wordlist(F.coalesce("text", F.lit(""))))
    tagged = texts.withColumn("name_tokens", G.tag_tokens(F.col("name_words"))).withColumn("tokens", G.tag_tokens(F.col("word_list")))
    name, body = F.col("name_tokens"), F.col("tokens")
    spoken = F.array_join("name_words", " ")
    ext = E.extension_date_of(F.col("text"))
    facts = tagged.select(
        "*", locations_of(name, body).alias("locations"), F.try_element_at(locations_of(body), F.lit(1)).alias("point_of_sale"), carriers_of(name, body).alias("carriers"), currency_of(body).alias("currency"),
        E.choose_periods(E.periods_of(F.col("text"), "sales"), E.periods_of(spoken, "sales")).alias("sales_period"), E.choose_periods(E.periods_of(F.col("text"), "travel"), E.periods_of(spoken, "travel")).alias("travel_period"),
        ext.alias("extension_date"), E.origins_of(F.col("text")).alias("originating"), E.flights_of(F.col("text")).alias("flights"), coded_places(body).alias("coded_places"), codes_in_name(F.col("filename")).alias("name_codes"),
    )
    start = _first(F.col("sales_period"), "from").try_cast("date")
    empty = F.array().cast("array<string>")
    return facts.select(
        "doc_id", "filename", "country", "html", "text",
        F.size("word_list").alias("n_words"), "word_list", F.array_sort(F.array_distinct("word_list")).alias("word_tokens_list"),
        F.filter("word_list", lambda w: F.length(w) > 20).alias("long_words"),
        "currency", F.lit(0).alias("commission"), "sales_period", "travel_period", "extension_date",
        F.when(F.col("extension_date").isNotNull(), start).alias("effective_date"),
        F.coalesce(F.datediff("extension_date", start), F.lit(0)).alias("extension"),
        discontinue_date(F.col("travel_period")).alias("trv_dis_date"),
        F.col("text").rlike(r"(?i)code\s?share").alias("codeshare_mentioned"), F.lit(False).alias("codeshare_permitted"),
        F.array_distinct(F.concat("name_codes", F.transform("coded_places", lambda x: x["code"]))).alias("tourcodes"), "coded_places",
        F.lit("").alias("farebasis"), F.lit(0).alias("nettfare"), F.lit(0).alias("grossfare"), F.lit("").alias("rbd"),
        F.lit("").alias("origin"), F.lit("").alias("destination"), F.lit("").alias("gateway"),
        "point_of_sale", "locations", "carriers", "originating", "flights",
        *[F.when(F.col("text").rlike(pattern), 0).otherwise(UNKNOWN_COMMISSION).alias(flag) for flag, pattern in NO_COMMISSION.items()],
        empty.alias("paragraph_data"), empty.alias("table_data"),
    )


def refreshed(docs: DataFrame, pages: DataFrame, run: str) -> DataFrame:
    """``docs`` (doc_id, filename, country, run) that this run has not seen, with facts of their ``pages`` (doc_id, htmls) and the run's mark."""
    due = docs.where(F.coalesce("run", F.lit("")) != run).drop("run")
    return fare_documents(due.join(pages, "doc_id", "left")).withColumn("run", F.lit(run))
