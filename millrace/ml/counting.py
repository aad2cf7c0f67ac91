"""Models whose fit is sums, so that a row can be taken out of it again: bayes by counts, ridge regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bayes:
    """(feature, value, label, n), (label, rows) and (feature, label, n, values): all that scoring needs."""

    counts: DataFrame
    labels: DataFrame
    features: DataFrame
    alpha: float


def fit_bayes(pairs: DataFrame, labels: DataFrame, key: str, alpha: float = 1.0) -> Bayes:
    """A naive bayes model of many-valued features from (key, feature, value) and (key, label).

    A row may have any number of pairs; repeated pairs count once, null values are
    no values, rows without a label don't count.
    """
    labels = labels.select(key, "label").where("label is not null")
    joined = pairs.where("value is not null").select(key, "feature", "value").distinct().join(labels, key)
    counts = joined.groupBy("feature", "value", "label").agg(F.count("*").alias("n"))
    per_label = counts.groupBy("feature", "label").agg(F.sum("n").alias("in_label"))
    values = counts.groupBy("feature").agg(F.count_distinct("value").alias("n_values"))
    each = values.join(F.broadcast(labels.groupBy("label").agg(F.count("*").alias("rows"))))  # a row for each label
    features = each.join(per_label, ["feature", "label"], "left").select("feature", "label", F.coalesce("in_label", F.lit(0)).alias("in_label"), "n_values")
    return Bayes(counts, labels.groupBy("label").agg(F.count("*").alias("rows")), features, alpha)


def score_bayes(model: Bayes, pairs: DataFrame, key: str, own: DataFrame | None = None) -> DataFrame:
    """(key, label, score): the log of each label's prior and of its features' chances, summed.

    A value that a label never had counts ``alpha``; a feature the model doesn't
    know counts nothing.  With ``own`` (key, label) each row that the model was
    fitted on is scored as if it hadn't been: its pairs and its label are taken out
    of the counts again, which is leaving one out without another fit.
    """
    alpha = F.lit(model.alpha)
    rows = pairs.where("value is not null").select(key, "feature", "value").distinct()
    by_label = rows.join(model.features, "feature").join(model.counts, ["feature", "value", "label"], "left")
    keys = pairs.select(key).distinct()
    everything = model.labels.agg(F.sum("rows").alias("all"))  # one row
    prior = keys.join(F.broadcast(model.labels.join(everything)))  # a row for each label
    own_label = None
    if own is not None:
        known = own.select(key, F.col("label").alias("own_label")).where("own_label is not null")
        by_label, prior = by_label.join(known, key, "left"), prior.join(known, key, "left")
        own_label = F.col("own_label")
    taken = F.lit(0) if own_label is None else F.coalesce((F.col("label") == own_label).cast("int"), F.lit(0))
    anyone = F.lit(0) if own_label is None else own_label.isNotNull().cast("int")
    chance = F.log((F.coalesce("n", F.lit(0)) - taken + alpha) / (F.col("in_label") - taken + alpha * F.col("n_values")))
    parts = by_label.select(key, "label", chance.alias("part"))
    rest = F.col("rows") - taken
    start = F.when(rest > 0, F.log(rest / (F.col("all") - anyone)))  # a label without other rows can't be told
    parts = parts.unionByName(prior.select(key, "label", F.coalesce(start, F.lit(float("-inf"))).alias("part")))
    return parts.groupBy(key, "label").agg(F.sum("part").alias("score"))


def best_label(scores: DataFrame, key: str) -> DataFrame:
    """(key, prediction, score) of the highest score; of equal ones the smallest label."""
    best = scores.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("s"), "label")).alias("b"))
    return best.select(key, F.col("b.label").alias("prediction"), (-F.col("b.s")).alias("score"))


def ranked_values(model: Bayes, one: object, other: object) -> DataFrame:
    """(feature, value, log_odds) of a value under one label against another."""

    def side(label: object, name: str) -> DataFrame:
        return model.counts.where(F.col("label") == F.lit(label)).select("feature", "value", F.col("n").alias(name))

    sizes = model.features.groupBy("feature", "n_values").agg(*[F.sum(F.when(F.col("label") == F.lit(x), F.col("in_label"))).alias(f"all_{i}") for i, x in enumerate((one, other))])
    joined = side(one, "n_0").join(side(other, "n_1"), ["feature", "value"], "full_outer").join(sizes, "feature")
    chance = lambda i: (F.coalesce(f"n_{i}", F.lit(0)) + model.alpha) / (F.col(f"all_{i}") + model.alpha * F.col("n_values"))
    return joined.select("feature", "value", (F.log(chance(0)) - F.log(chance(1))).alias("log_odds"))


def _products(columns: Sequence[Column]) -> list[Column]:
    return [F.sum(a * b) for i, a in enumerate(columns) for b in columns[i:]]


def ridge_left_out(df: DataFrame, key: str, features: Sequence[str], target: str, penalty: float = 1.0) -> DataFrame:
    """(key, actual, fitted, leverage, left_out) of ridge regression with an intercept.

    ``left_out`` is what the model says of a row if fitted without it, from its
    leverage: no second fit.  The fit is one aggregation of products; the driver
    solves one equation for each feature.  The intercept isn't penalised.  Rows with
    a null in a feature or the target don't count; an empty table gives none.
    """
    rows = df.select(key, F.col(target).cast("double").alias("actual"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features, 1)]).dropna(subset=["actual", *[f"x{i}" for i in range(1, len(features) + 1)]])
    columns = [F.lit(1.0), *[F.col(f"x{i}") for i in range(1, len(features) + 1)]]
    sums = rows.agg(*_products(columns), *[F.sum(c * F.col("actual")) for c in columns]).first()
    d = len(columns)
    if sums[0] is None:
        return rows.select(key, "actual", *[F.lit(0.0).alias(c) for c in ("fitted", "leverage", "left_out")])
    gram = np.zeros((d, d))
    gram[np.triu_indices(d)] = sums[: d * (d + 1) // 2]
    gram = np.triu(gram) + np.triu(gram, 1).T + np.diag([0.0] + [penalty] * (d - 1))
    weights = np.linalg.solve(gram, np.array(sums[d * (d + 1) // 2 :], float))
    inverse = np.linalg.inv(gram)
    fitted = sum((c * F.lit(float(w)) for c, w in zip(columns, weights, strict=True)), F.lit(0.0))
    leverage = sum((a * b * F.lit(float(inverse[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)), F.lit(0.0))
    made = rows.select(key, "actual", fitted.alias("fitted"), leverage.alias("leverage"))
    return made.withColumn("left_out", F.col("actual") - (F.col("actual") - F.col("fitted")) / (1 - F.col("leverage")))
