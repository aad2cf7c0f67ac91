"""Sequence operators: filling down, look-back, context, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_down(df: DataFrame, keys: list[str], row: str, text: str, first_rows: int = 2) -> DataFrame:
    """A blank cell takes the last text above it in its column.

    The first rows are never filled, and their text, even blank, is what is carried.
    """
    shown = F.when((F.col(row) < first_rows) | (F.col(text) != ""), F.col(text))
    over = Window.partitionBy(*keys).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.when(F.col(row) < first_rows, F.col(text)).otherwise(F.last(shown, True).over(over))
    return df.withColumn("filled", filled)


def fill_sparse_columns(df: DataFrame, keys: list[str], row: str, text: str) -> DataFrame:
    """Columns that are blank in more than half of their rows get all their texts joined, below the header."""
    shown = F.when((F.col(row) > 0) & (F.col(text) != ""), F.struct(row, text))
    columns = df.groupBy(*keys).agg(F.count_if(F.col(text) == "").alias("__blanks"), F.max(row).alias("__last"), F.array_sort(F.collect_list(shown)).alias("__texts"))  # one column of one table
    sparse = columns.where(F.col("__blanks") * 2 > F.col("__last") + 1).select(*keys, F.array_join(F.transform("__texts", lambda t: t[text]), " ").alias("__joined"))
    filled = F.when(F.col("__joined").isNotNull() & (F.col(row) > 0), F.col("__joined")).otherwise(F.col(text))
    return df.join(sparse, keys, "left").withColumn("filled", filled).drop("__joined")


def lookback(flag: Column, keys: list[str], order: str, words: int = 5) -> Column:
    """Whether the flag was set in this or one of the ``words - 1`` rows before."""
    return F.max(flag.cast("int")).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - words, 0)) == 1


def neighbours(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Each value with the ones before and after it, marked at the ends."""
    over = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("previous", F.lag(value, 1, "<START>").over(over)).withColumn("following", F.lead(value, 1, "<END>").over(over))


def context(words: Column, at: Column, width: int) -> Column:
    """The words around a 0-based position, clamped at both ends."""
    start = F.greatest(at - width, F.lit(0))
    return F.slice(words, start + 1, at + width + 1 - start)
