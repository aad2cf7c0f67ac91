"""Aggregates: shares, modes, votes, confusion tables, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shares(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each key and their share of all."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.join(F.broadcast(total)).select(*keys, "n", (F.col("n") / F.col("total")).alias("share"))  # one row


def mode_of(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key; of equally frequent ones the smallest."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    place = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return counts.withColumn("place", F.row_number().over(place)).where("place = 1").drop("place")


def majority(*votes: Column) -> Column:
    """1 if more than half of the 0/1 votes are 1."""
    return F.when(sum(votes[1:], votes[0]) * 2 > len(votes), 1).otherwise(0)


def confusion(df: DataFrame, actual: str, guess: str) -> DataFrame:
    """Counts of each pair of actual and guessed value."""
    return df.groupBy(actual, guess).agg(F.count("*").alias("n"))


def report(df: DataFrame, actual: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support of each class, in one pass over a small table of counts."""
    counts = confusion(df, actual, guess)
    sides = counts.select(F.col(actual).alias("label"), "n", F.lit(True).alias("is_actual"), (F.col(actual) == F.col(guess)).alias("hit"))
    sides = sides.unionByName(counts.select(F.col(guess).alias("label"), "n", F.lit(False).alias("is_actual"), F.lit(False).alias("hit")))
    sums = sides.groupBy("label").agg(
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("right"),
        F.sum(F.when(F.col("is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_actual"), F.col("n")).otherwise(0)).alias("guessed"),
    )
    share = lambda part, whole: F.when(whole == 0, 0.0).otherwise(part / whole)
    right, support, guessed = F.col("right"), F.col("support"), F.col("guessed")
    return sums.select("label", share(right, guessed).alias("precision"), share(right, support).alias("recall"), share(right * 2, support + guessed).alias("f1"), "support")
