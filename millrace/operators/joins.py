"""Joins that Spark has no operator for: periods with an as-of choice, array membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGEST = 600  # months; a longer period counts as open


def array_members(df: DataFrame, array: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose array holds one of the keys, once each; ``df`` needs unique rows."""
    exploded = df.withColumn("__member", F.explode(F.array_distinct(array)))
    return exploded.join(keys.select(F.col(key).alias("__member")).distinct(), "__member", "left_semi").drop("__member").distinct()


def period_bucket(day: Column) -> Column:
    """The month of a day as a number."""
    return F.year(day) * 12 + F.month(day)


def in_periods(events: DataFrame, periods: DataFrame, on: list[str], day: str, start: str, end: str) -> DataFrame:
    """Events with the periods of the same keys that contain their day.

    A period is repeated for each month it touches and joined on keys and month, so
    no pair outside a common month is ever compared.  A period of more than
    ``LONGEST`` months, such as one to 9999-12-31, is joined on its keys alone: it
    matches nearly all of their events in any case.  A null end or start matches
    nothing.
    """
    first, last = period_bucket(F.col(start)), period_bucket(F.col(end))
    valid = periods.where(F.col(start) <= F.col(end))
    inside = F.col(day).between(F.col(start), F.col(end))
    bounded = valid.where(last - first <= LONGEST).withColumn("__month", F.explode(F.sequence(first, last)))
    dated = events.withColumn("__month", period_bucket(F.col(day))).join(bounded, [*on, "__month"]).where(inside).drop("__month")
    return dated.unionByName(events.join(valid.where(last - first > LONGEST), on).where(inside))


def best_of(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """(keys, values) of the row of each key that is greatest in the order, in one aggregation.

    A flag that comes first in the order gives its rows preference over all others.
    """
    best = F.max(F.struct(*[o.alias(f"__{i}") for i, o in enumerate(order)], *values)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{v}").alias(v) for v in values])


def best_in_periods(events: DataFrame, periods: DataFrame, keys: list[str], on: list[str], day: str, start: str, end: str, order: list[Column], values: list[str]) -> DataFrame:
    """(keys, values) as by ``in_periods`` and then ``best_of``, for an order and values that are the period's own.

    Of periods with the same keys, start and end only the best can win, and events with
    the same keys and day have the same winner.  So periods and days are made distinct
    first; the pairs that meet depend on the different days, not on the rows.
    """
    best = F.max(F.struct(*[o.alias(f"__{i}") for i, o in enumerate(order)], *values)).alias("__best")
    ahead = periods.groupBy(*on, F.col(start).alias("__start"), F.col(end).alias("__end")).agg(best)
    asked = events.select(*on, F.col(day).alias("__day")).distinct()
    found = in_periods(asked, ahead, on, "__day", "__start", "__end").groupBy(*on, "__day").agg(F.max("__best").alias("__best"))
    met = events.withColumn("__day", F.col(day)).join(found, [*on, "__day"])
    return met.groupBy(*keys).agg(F.max("__best").alias("__best")).select(*keys, *[F.col(f"__best.{v}").alias(v) for v in values])
