"""Exact order statistics by counting, without sorting a column or a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 256


def values_at_ranks(rows: DataFrame, wanted: Sequence[tuple[object, int]], group: str = "group", value: str = "value") -> dict[tuple[object, int], float]:
    """The value with each rank (from 0) among a group's values, for (group, rank) pairs.

    Each round cuts what is left of a pair's values into ``BUCKETS`` ranges of equal
    width, counts them all in one aggregation, and goes on with the range that holds
    the rank, from its smallest to its largest value; the range ends when these are
    equal, so repeated values cost nothing.  The driver holds ``BUCKETS`` counts for
    each pair.  Values are doubles; null and NaN don't count.  A rank beyond a
    group's values, or a group without any, is left out.
    """
    spark = rows.sparkSession
    data = rows.select(F.col(group).alias("group"), F.col(value).cast("double").alias("value")).where("value is not null and not isnan(value)")
    kind = dict(data.dtypes)["group"]
    asked = spark.createDataFrame([(g,) for g in dict.fromkeys(g for g, _ in wanted)], f"group {kind}")
    limits = data.join(F.broadcast(asked), "group").groupBy("group").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    of = {r["group"]: r for r in limits}
    found: dict[tuple[object, int], float] = {}
    open_ = {(g, k): (k, of[g]["low"], of[g]["high"]) for g, k in wanted if g in of and 0 <= k < of[g]["n"]}
    while True:
        found |= {pair: low for pair, (_, low, high) in open_.items() if low == high}
        open_ = {pair: x for pair, x in open_.items() if x[1] != x[2]}
        if not open_:
            return found
        numbered = list(open_.items())
        # halves where the difference of two doubles is beyond a double
        targets = spark.createDataFrame([(i, g, low, high, 1.0 if high - low < float("inf") else 0.5) for i, ((g, _), (_, low, high)) in enumerate(numbered)], f"target int, group {kind}, low double, high double, scale double")
        inside = data.join(F.broadcast(targets), "group").where("value >= low and value <= high")  # the targets are given by the caller
        low, high = F.col("low") * F.col("scale"), F.col("high") * F.col("scale")
        part = (F.col("value") * F.col("scale") - low) / (high - low)
        bucket = F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
        counts = inside.groupBy("target", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        by_target: dict[int, list] = {}
        for r in counts.collect():
            by_target.setdefault(r["target"], []).append(r)
        for i, (pair, (rank, _, _)) in enumerate(numbered):
            for r in sorted(by_target[i], key=lambda r: r["bucket"]):
                if rank < r["n"]:
                    open_[pair] = (rank, r["low"], r["high"])
                    break
                rank -= r["n"]


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Quantiles of columns, between two values in proportion; null for a column without values."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("group"), F.col(c).cast("double").alias("value")) for c in columns])).alias("r")).select("r.*")
    sizes = {r["group"]: r["n"] for r in stacked.where("value is not null and not isnan(value)").groupBy("group").agg(F.count("*").alias("n")).collect()}
    places = {(c, s): (sizes[c] - 1) * s for c in columns if c in sizes for s in shares}
    wanted = sorted({(c, k) for (c, _), p in places.items() for k in (int(p), min(int(p) + 1, sizes[c] - 1))})
    values = values_at_ranks(stacked, wanted)

    def at(c: str, s: float) -> float | None:
        if c not in sizes:
            return None
        k = int(places[c, s])
        low, high = values[c, k], values[c, min(k + 1, sizes[c] - 1)]
        return low + (high - low) * (places[c, s] - k)

    return {c: [at(c, s) for s in shares] for c in columns}


def cutoffs(rows: DataFrame, group: str, value: str, sizes: Mapping[object, int]) -> dict[object, float]:
    """For each group the value that its ``size`` smallest values don't go beyond; groups of size 0 are left out."""
    found = values_at_ranks(rows, [(g, n - 1) for g, n in sizes.items() if n > 0], group, value)
    return {g: v for (g, _), v in found.items()}
