"""Models: those of Spark ML behind one call, and AdaBoost, majority votes and a silhouette of our own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import tf_idf
from millrace.ml.features import vectors
from millrace.ml.silhouette import silhouettes, silhouettes_of
from millrace.session import cut, stored

#: kind: how to make the classifier for a number of features
CLASSIFIERS = {
    "tree": lambda d: DecisionTreeClassifier(seed=42),
    "forest": lambda d: RandomForestClassifier(impurity="entropy", numTrees=20, weightCol="weight", seed=42),
    "boosting": lambda d: GBTClassifier(maxIter=10, seed=42),
    "bayes": lambda d: NaiveBayes(modelType="bernoulli"),
    "svc": lambda d: LinearSVC(maxIter=20),
    "network": lambda d: MultilayerPerceptronClassifier(layers=[d, 50, 2], maxIter=50, seed=42),
}


def balanced(data: DataFrame, label: str = "label") -> DataFrame:
    """With a ``weight`` that gives each class the same total."""
    counts = data.groupBy(label).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"), F.count("*").alias("__classes"))
    weights = counts.join(F.broadcast(total)).select(label, (F.col("__all") / (F.col("__n") * F.col("__classes"))).alias("weight"))
    return data.join(F.broadcast(weights), label)  # a row for each class


def fit(kind: str, data: DataFrame, size: int):
    """Fit one of :data:`CLASSIFIERS` to (features, label)."""
    return CLASSIFIERS[kind](size).fit(balanced(data) if kind == "forest" else data)


GRIDS = {"maxDepth": (3, 5), "maxIter": (5, 10), "stepSize": (0.1, 0.3), "subsamplingRate": (0.8, 1.0)}


def select_grid(data: DataFrame, depths: Sequence[int] = (3, 5), folds: int = 5):
    """The best boosting model of a grid of depths, by cross-validation."""
    return select_grids(data, {"maxDepth": depths}, folds)


def select_grids(data: DataFrame, grids: Mapping[str, Sequence] = GRIDS, folds: int = 5):
    """The boosting model whose parameters are chosen one after the other, each by cross-validation over its own grid."""
    base = GBTClassifier(maxIter=5, seed=42)
    best = None
    for name, values in grids.items():
        grid = ParamGridBuilder().addGrid(base.getParam(name), list(values)).build()
        chosen = CrossValidator(estimator=base, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds, seed=42).fit(data)
        best = chosen.bestModel
        base = base.copy({base.getParam(name): best.getOrDefault(name)})
    return best


def fourier_features(data: DataFrame, size: int, gamma: float = 0.1, dimensions: int = 200, seed: int = 42) -> DataFrame:
    """``data`` with random Fourier features in place of its own: their products come near a radial kernel.

    A linear model over them is a support vector machine with that kernel, up to the
    error of the approximation, which falls with the root of ``dimensions``.
    """
    rng = np.random.default_rng(seed)
    directions, offsets = rng.normal(0, np.sqrt(2 * gamma), (size, dimensions)), rng.uniform(0, 2 * np.pi, dimensions)

    @F.pandas_udf("array<double>")
    def of(rows: pd.Series) -> pd.Series:
        found = np.sqrt(2 / dimensions) * np.cos(np.stack(rows.to_list()).reshape(len(rows), size) @ directions + offsets) if len(rows) else np.zeros((0, dimensions))
        return pd.Series(list(found))

    return data.withColumn("features", array_to_vector(of(vector_to_array("features"))))


@dataclass
class AdaBoost:
    """Weighted trees after SAMME for two classes."""

    trees: list
    weights: list[float]

    @classmethod
    def fit(cls, data: DataFrame, rounds: int = 10, depth: int = 1) -> AdaBoost:
        """Each round refits a tree to rows whose weight grows while they are wrong."""
        import math

        rows = data.withColumn("weight", F.lit(1.0))
        trees, weights = [], []
        for _ in range(rounds):
            tree = DecisionTreeClassifier(maxDepth=depth, weightCol="weight", seed=42).fit(rows)
            wrong = (F.col("prediction") != F.col("label")).cast("double")
            judged = tree.transform(rows).select("features", "label", "weight", wrong.alias("wrong"))
            sums = judged.agg(F.sum(F.col("weight") * F.col("wrong")).alias("bad"), F.sum("weight").alias("all")).first()
            error = min(max((sums["bad"] or 0.0) / sums["all"], 1e-10), 1 - 1e-10)
            if error >= 0.5:
                break
            alpha = math.log((1 - error) / error)
            trees.append(tree)
            weights.append(alpha)
            rows = cut(judged.withColumn("weight", F.col("weight") * F.exp(F.lit(alpha) * F.col("wrong"))).drop("wrong"))
        return cls(trees, weights)

    def transform(self, data: DataFrame) -> DataFrame:
        """``data`` with ``prediction``."""
        scored = data.withColumn("__score", F.lit(0.0))
        for tree, weight in zip(self.trees, self.weights, strict=True):
            vote = (F.col("prediction") * 2 - 1) * weight
            scored = tree.transform(scored).withColumn("__score", F.col("__score") + vote).select(*data.columns, "__score")
        return scored.withColumn("prediction", (F.col("__score") > 0).cast("double")).drop("__score")


def _kernel_map(shared, gamma: float):
    """Kernel values of rows with the landmarks, times their axes."""

    @F.pandas_udf("array<double>")
    def of(rows: pd.Series) -> pd.Series:
        points, axes = shared.value
        x = np.stack(rows.to_list()).reshape(len(rows), points.shape[1]) if len(rows) else np.zeros((0, points.shape[1]))
        square = np.maximum((x * x).sum(1)[:, None] + (points * points).sum(1)[None] - 2 * x @ points.T, 0)
        return pd.Series(list(np.exp(-gamma * square) @ axes), index=rows.index)

    return of


def landmark_features(data: DataFrame, key: str, gamma: float = 0.5, landmarks: int = 96, rounds: int = 3) -> tuple[DataFrame, float]:
    """``data`` with features whose products are about those of a radial kernel, and the mean error of the kernel's diagonal.

    The kernel is exp(-gamma * squared distance).  Landmarks are rows of the data:
    in each round the rows that the features so far tell least about (the largest
    1 - |features|**2, which is each row's own error) join them, ties by the hash of
    ``key``.  ``landmarks`` bounds what is sent to the tasks.  The error is exact: it
    is the mean over all rows, and no product of two rows is off by more than the
    square root of the product of their own errors.
    """
    spark = data.sparkSession
    chosen = np.zeros((0, 0))
    made, error = data, 1.0

    def mapped(points: np.ndarray) -> np.ndarray:
        square = ((points[:, None] - points[None]) ** 2).sum(-1)
        values, axes = np.linalg.eigh(np.exp(-gamma * square))
        good = values > 1e-10 * values.max()
        return axes[:, good] / np.sqrt(values[good])

    for number in range(rounds):
        residual = F.lit(1.0) if not len(chosen) else 1.0 - F.aggregate(vector_to_array("__made"), F.lit(0.0), lambda s, x: s + x * x)
        take = landmarks * (number + 1) // rounds - len(chosen)
        top = made.withColumn("__residual", F.round(residual, 9)).orderBy(F.desc("__residual"), F.xxhash64(key), key).limit(take).select("features").collect()
        fresh = np.array([r["features"].toArray() for r in top])
        if not len(fresh):
            break
        chosen = np.unique(np.concatenate([chosen.reshape(-1, fresh.shape[1]), fresh]), axis=0)
        shared = spark.sparkContext.broadcast((chosen, mapped(chosen)))

        made = cut(data.withColumn("__made", array_to_vector(_kernel_map(shared, gamma)(vector_to_array("features")))))
        norm = F.aggregate(vector_to_array("__made"), F.lit(0.0), lambda s, x: s + x * x)
        error = made.agg(F.avg(1.0 - norm)).first()[0] or 0.0
    if not len(chosen):
        return data, 0.0
    return made.drop("features").withColumnRenamed("__made", "features"), max(float(error), 0.0)  # below 0 is rounding


def tfidf_vectors(docs: DataFrame, key: str, text: str, min_df: int, most: int = 500) -> tuple[DataFrame, list[str]]:
    """tf-idf vectors over the words of the highest document frequency, and those words."""
    with stored(tf_idf(docs, key, text, min_df)) as weights:  # read twice
        names = weights.groupBy("word").agg(F.count("*").alias("df")).orderBy(F.desc("df"), "word").limit(most)
        vocabulary = sorted(r["word"] for r in names.collect())
        return cut(vectors(weights.select(key, F.col("word").alias("name"), F.col("weight").alias("value")), key, vocabulary)), vocabulary  # clustering reads it in each round


def clusters(data: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """``data`` with its cluster in ``prediction``."""
    return KMeans(k=k, seed=seed).fit(data).transform(data)


def silhouette(clustered: DataFrame, key: str) -> float:
    """The mean of the exact euclidean silhouettes of all points; 0 without any."""
    points = clustered.select(key, vector_to_array("features").alias("features"), F.col("prediction").cast("int").alias("cluster"))
    return silhouettes(points, key).agg(F.avg("silhouette")).first()[0] or 0.0


def silhouette_sweep(data: DataFrame, key: str, sizes: Sequence[int]) -> dict[int, float]:
    """The silhouette of each number of clusters; all share the distances."""
    made, names = data.select(key, "features"), {k: f"of_{k}" for k in sizes}
    for k, name in names.items():
        made = clusters(made, k).withColumnRenamed("prediction", name)
    scored = silhouettes_of(made.withColumn("features", vector_to_array("features")), key, list(names.values()))
    means = scored.agg(*[F.avg(f"{name}_silhouette").alias(name) for name in names.values()]).first()
    return {k: means[name] or 0.0 for k, name in names.items()}


def vote(models: Sequence, data: DataFrame, key: str) -> DataFrame:
    """(key, label, prediction) by the majority of several models."""
    joined = data.select(key, "label")
    for n, model in enumerate(models):
        joined = joined.join(model.transform(data).select(key, F.col("prediction").alias(f"p{n}")), key)
    total = sum((F.col(f"p{n}") for n in range(len(models))), F.lit(0.0))
    return joined.select(key, "label", (total * 2 > len(models)).cast("double").alias("prediction"))
