"""Fare tables: which column is what, and their rows as commission rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.dates import parse_percent
from millrace.functions.extract import periods_of, route_ends
from millrace.operators.windows import fill_down, fill_sparse_columns, lookback

#: Header tags in the order in which they take their columns, with what a header says.
HEADER_TAGS = (
    ("RBD", r"\b(RBD|BOOKING CLASS|CLASS OF SERVICE)\b"),
    ("FBC", r"\b(FBC|FARE BASIS)\b"),
    ("CORPORATE_DISCOUNT", r"\b(CORPORATE|COMPANY)\b.*\b(DISCOUNT|COMMISSION)"),
    ("AGENT_DISCOUNT", r"\b(AGENT\b.*\b)?(DISCOUNT|COMMISSION)S?\b"),
    ("ROUTE", r"\b(ROUTE|ROUTING|SECTOR)S?\b"),
)
CABIN_WORDS = ("FIRST", "BUSINESS", "ECONOMY", "PREMIUM", "CLASS")


def header_roles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, tag, col): the column of each tag by the texts of row 0.

    Tags take columns in their order; of the columns no earlier tag has, the last
    that fits is a tag's.  Tags without a column have no row.
    """
    header = cells.where(F.col("row") == 0).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("col", F.upper("text").alias("text")))).alias("cells"))
    taken = F.array().cast("array<int>")
    pairs = []

    def fits(pattern: str, used: Column):
        return lambda c: c["text"].rlike(pattern) & ~F.array_contains(used, c["col"])

    for tag, pattern in HEADER_TAGS:
        fitting = F.filter("cells", fits(pattern, taken))
        column = F.try_element_at(F.transform(fitting, lambda c: c["col"]), F.lit(-1))
        pairs.append(F.struct(F.lit(tag).alias("tag"), column.alias("col")))
        taken = F.when(column.isNotNull(), F.array_append(taken, column)).otherwise(taken)
    return header.select(*keys, F.explode(F.array(*pairs)).alias("p")).select(*keys, "p.tag", "p.col").where("col is not null")


def fare_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Commission rows of fare tables: one for each booking class letter of each row.

    A table needs a column of agent discounts and three of the five tags.  Blank
    cells take what is above, sparse columns their joined text; a blank route takes
    the table's most frequent one; rows that name a cabin are dropped.
    """
    roles = header_roles(cells, keys)
    tagged = roles.groupBy(*keys).agg(F.count("*").alias("tags"), F.max((F.col("tag") == "AGENT_DISCOUNT").cast("int")).alias("priced"))
    tables = tagged.where("tags >= 3 and priced = 1").select(*keys)
    full = fill_down(fill_sparse_columns(cells, [*keys, "col"], "row", "text").drop("text").withColumnRenamed("filled", "text"), [*keys, "col"], "row", "text")
    named = full.join(tables, keys, "left_semi").join(roles, [*keys, "col"])
    wide = named.where("row > 0").groupBy(*keys, "row").agg(*[F.max(F.when(F.col("tag") == tag, F.col("filled"))).alias(tag.lower()) for tag, _ in HEADER_TAGS])
    counts = wide.where("route <> ''").groupBy(*keys, "route").agg(F.count("*").alias("n"))
    common = counts.groupBy(*keys).agg(F.max_by("route", F.struct("n", "route")).alias("common_route"))
    rows = wide.join(common, keys, "left").withColumn("route", F.coalesce(F.nullif("route", F.lit("")), "common_route", F.lit("")))
    rows = rows.where(~F.arrays_overlap(F.split(F.upper("route"), r"\s+"), F.array(*map(F.lit, CABIN_WORDS))))
    letters = F.filter(F.transform(F.split(F.coalesce("rbd", F.lit("")), "/"), lambda x: F.substring(F.trim(x), 1, 1)), lambda x: x != "")
    rows = rows.withColumn("rbd", F.explode_outer(letters))
    ends = route_ends(F.col("route"))
    return rows.select(
        *keys,
        "row",
        F.coalesce("rbd", F.lit("")).alias("rbd"),
        F.coalesce("fbc", F.lit("")).alias("fbc"),
        parse_percent(F.coalesce("agent_discount", F.lit("")))["value"].alias("agent_discount"),
        parse_percent(F.coalesce("corporate_discount", F.lit("0%")))["value"].alias("corporate_discount"),
        parse_percent(F.coalesce("corporate_discount", F.lit("0%")))["unit"].alias("discount_unit"),
        "route",
        ends["from_location"].alias("from_location"),
        ends["to_location"].alias("to_location"),
    )


def codes_under_header(cells: DataFrame, keys: list[str], keyword: str, code: str, near: str = "BASE") -> DataFrame:
    """(keys, row, col, code) of codes below a header cell with the keyword, apart from rows that follow ``near``."""
    headers = cells.where((F.col("row") == 0) & F.upper("text").contains(keyword)).select(*keys, "col").distinct()
    below = cells.withColumn("blocked", lookback(F.upper("text").contains(near), [*keys, "col"], "row", 2)).where("row > 0")
    found: Column = F.regexp_extract("text", code, 0)
    return below.join(headers, [*keys, "col"], "left_semi").where(~F.col("blocked") & (found != "")).select(*keys, "row", "col", found.alias("code"))


def back_to_back(paragraphs: DataFrame, key: str) -> DataFrame:
    """(key, table_no, follows): whether nothing but blanks stands between a table and the one before it.

    ``paragraphs`` are (key, ord, table_no, text): tables have a number, texts none.
    """
    shown = paragraphs.where("table_no is not null or trim(text) <> ''")
    over = Window.partitionBy(key).orderBy("ord")
    marked = shown.withColumn("follows", F.coalesce(F.lag("table_no").over(over).isNotNull(), F.lit(False)))
    return marked.where("table_no is not null").select(key, "table_no", "follows")


def carry_headers(tables: DataFrame, key: str) -> DataFrame:
    """Tables take the last header before them in their document if they have none, or if they directly follow a table of another background.

    ``tables`` are (key, table_no, header, follows, bgcolor) with a null header for
    none; the result has the header in ``header`` and ``carried``.
    """
    order = Window.partitionBy(key).orderBy("table_no")
    other = F.col("follows") & ~F.col("bgcolor").eqNullSafe(F.lag("bgcolor").over(order))
    own = tables.withColumn("own", F.when(~other, F.col("header")))
    above = order.rowsBetween(Window.unboundedPreceding, 0)
    carried = own.withColumn("__found", F.last("own", ignorenulls=True).over(above))
    return carried.withColumn("carried", F.col("own").isNull() & F.col("__found").isNotNull()).withColumn("header", F.coalesce("__found", "header")).drop("own", "__found")


def row_periods(rows: DataFrame, route: str = "route") -> DataFrame:
    """``rows`` whose route tells periods of its own, with them in place of the sheet's ``sales_to`` and ``travel_to``."""
    end = lambda kind: F.try_element_at(periods_of(F.col(route), kind), F.lit(1))["to"]
    return rows.withColumn("sales_to", F.coalesce(end("sales"), "sales_to")).withColumn("travel_to", F.coalesce(end("travel"), "travel_to"))


def row_texts(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, text): the texts of a row's cells in their order, without repeats of a cell that spans several."""
    ordered = cells.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(F.struct("col", "text"))).alias("cells"))  # one row of one table
    texts = F.transform("cells", lambda c: c["text"])
    fresh = F.filter(F.transform(texts, lambda t, i: F.when((i == 0) | (t != F.get(texts, i - 1)), t)), lambda t: t.isNotNull() & (t != ""))
    return ordered.select(*keys, "row", F.array_join(fresh, " ").alias("text"))
