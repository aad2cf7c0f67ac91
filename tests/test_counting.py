"""Ranks, models by counts and silhouettes against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.ml import counting as B
from millrace.ml.silhouette import silhouettes
from millrace.operators import ranks
from millrace.operators.relational import hash_of, oversample


def test_values_at_ranks(spark, monkeypatch):
    rng = random.Random(1)
    groups = {
        "same": [3.5] * 300,
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-30, 30) for _ in range(300)],
        "edges": [-1.7e308, 1.7e308, 0.0, 5e-324],
        "ties": [float(rng.randrange(4)) for _ in range(500)],
        "one": [7.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("same", None), ("one", float("nan")), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "group string, value double").repartition(5)
    wanted = [(g, k) for g, vs in groups.items() for k in {0, len(vs) // 3, len(vs) // 2, len(vs) - 1}] + [("none", 0), ("missing", 0), ("one", 1), ("one", -1)]
    for buckets in (4, 256):
        monkeypatch.setattr(ranks, "BUCKETS", buckets)
        got = ranks.values_at_ranks(df, wanted if buckets > 4 else [w for w in wanted if w[0] != "wide"])
        assert got == {(g, k): sorted(groups[g])[k] for g, k in wanted if g in groups and 0 <= k < len(groups[g]) and (buckets > 4 or g != "wide")}


def test_quantiles(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (10.0, None), (None, None)], "a double, b double")
    assert ranks.quantiles(df, ["a", "b"], [0.0, 0.5, 0.75, 1.0]) == {"a": [1.0, 2.0, 6.0, 10.0], "b": [None] * 4}


def test_oversample_takes_the_smallest_hashes(spark):
    rows = [("x", i) for i in range(50)] + [("y", i) for i in range(13)] + [("z", 4)] * 6 + [(None, 1)]
    df = spark.createDataFrame(rows, "label string, k long").repartition(4)
    got = oversample(df, "label", ["k"], {"x": 50, "y": 13, "z": 6})
    hashes = {r["k"]: r["h"] for r in df.select("k", hash_of(["k"], 24).alias("h")).distinct().collect()}
    want = Counter(dict.fromkeys([("x", i) for i in range(50)], 1))
    for place, i in enumerate(sorted(range(13), key=hashes.get)):
        want["y", i] = 3 + (place < 50 % 13)
    want["z", 4] = 50
    assert got.columns == ["label", "k"] and Counter(map(tuple, got.collect())) == want
    assert oversample(df.where("false"), "label", ["k"], {}).count() == 0


def bayes_rows(seed=2):
    rng = random.Random(seed)
    labels = {i: rng.choice("aab") for i in range(60)} | {90: "c", 91: None}
    pairs = [(i, f, f"{f}{min(int(rng.expovariate(0.7)), 6) + (labels.get(i) == 'b')}") for i in [*labels, 200] for f in ("p", "q") if rng.random() < 0.9]
    return labels, pairs + pairs[:5] + [(3, "p", None), (None, "p", "p1")]


def plain_bayes(labels, pairs, alpha=1.0, values=None):
    rows = {p for p in pairs if p[2] is not None}
    known = {i: v for i, v in labels.items() if v is not None}
    prior, counts, totals = Counter(known.values()), Counter(), Counter()
    for i, f, v in rows:
        if i in known:
            counts[f, v, known[i]] += 1
            totals[f, known[i]] += 1
    values = values or {f: len({v for i, g, v in rows if g == f and i in known}) for f in ("p", "q")}

    def score(i):
        own = [(f, v) for j, f, v in rows if j == i]
        return {c: math.log(n / sum(prior.values())) + sum(math.log((counts[f, v, c] + alpha) / (totals[f, c] + alpha * values[f])) for f, v in own) for c, n in prior.items()}

    return score, values


def test_bayes_and_leaving_out_as_fitting_again(spark):
    labels, pairs = bayes_rows()
    lf = spark.createDataFrame(list(labels.items()), "id long, label string")
    pf = spark.createDataFrame(pairs, "id long, feature string, value string").repartition(3)
    model = B.fit_bayes(pf, lf, "id")
    score, values = plain_bayes(labels, pairs)
    got = defaultdict(dict)
    for r in B.score_bayes(model, pf, "id").collect():
        got[r["id"]][r["label"]] = r["score"]
    assert set(got) == {p[0] for p in pairs}
    for i in got:
        want = score(i)
        assert set(got[i]) == set(want) and all(abs(got[i][c] - want[c]) < 1e-9 for c in want)

    left = defaultdict(dict)
    for r in B.score_bayes(model, pf, "id", own=lf).collect():
        left[r["id"]][r["label"]] = r["score"]
    for i in (p[0] for p in pairs if p[0] is not None):
        again, _ = plain_bayes({k: v for k, v in labels.items() if k != i}, pairs, values=values)
        want = again(i)
        for c, s in left[i].items():
            assert s == -math.inf if c not in want else abs(s - want[c]) < 1e-9
    best = {r["id"]: r["prediction"] for r in B.best_label(B.score_bayes(model, pf, "id"), "id").collect()}
    assert best == {i: min(s, key=lambda c: (-s[c], c)) for i, s in got.items()}


def test_bayes_of_nothing(spark):
    lf, pf = spark.createDataFrame([], "id long, label int"), spark.createDataFrame([(1, "p", "x")], "id long, feature string, value string")
    assert B.score_bayes(B.fit_bayes(pf, lf, "id"), pf, "id").count() == 0


def test_ridge_left_out_as_fitting_again(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 2)) * [1, 20]
    y = x @ [2.0, -0.3] + 5 + rng.normal(size=30)
    rows = [(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame([*rows, (90, None, 1.0, 1.0), (91, 1.0, 1.0, None)], "id long, a double, b double, t double")
    got = {r["id"]: r["left_out"] for r in B.ridge_left_out(df, "id", ["a", "b"], "t", 2.5).collect()}
    design = np.hstack([np.ones((30, 1)), x])
    for i in range(30):
        rest = np.delete(np.arange(30), i)
        w = np.linalg.solve(design[rest].T @ design[rest] + np.diag([0, 2.5, 2.5]), design[rest].T @ y[rest])
        assert abs(got[i] - design[i] @ w) < 1e-8
    assert len(got) == 30 and B.ridge_left_out(df.where("false"), "id", ["a"], "t").count() == 0


@pytest.mark.parametrize("block", [7, 500])
def test_silhouettes(spark, block):
    rng = np.random.default_rng(4)
    points = [(i, [float(v) for v in rng.normal(size=3) + 3 * (i % 4) * (i % 4 != 3)], i % 4) for i in range(60)]
    points += [(100, [50.0, 0.0, 0.0], 9), *[(200 + i, [1.0, 1.0, 1.0], 1) for i in range(9)], *[(300 + i, [9.0, 9.0, 9.0], 5) for i in range(4)]]
    df = spark.createDataFrame([*points, (900, None, 1), (901, [0.0] * 3, None)], "id long, features array<double>, cluster int")
    got = {r["id"]: r["silhouette"] for r in silhouettes(df, "id", block=block).collect()}
    x, c = np.array([p[1] for p in points]), np.array([p[2] for p in points])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert len(got) == len(points)
    for n, (i, _, own) in enumerate(points):
        mine = (c == own).sum() - 1
        if not mine:
            assert got[i] == 0
            continue
        a = d[n, c == own].sum() / mine
        b = min(d[n, c == k].mean() for k in set(c.tolist()) - {own})
        assert abs(got[i] - (b - a) / max(a, b)) < 1e-9
    one = silhouettes(df.where("cluster = 1"), "id")
    assert {r["silhouette"] for r in one.collect()} == {0.0} and silhouettes(df.where("false"), "id").count() == 0


def test_silhouettes_of_several_clusterings(spark):
    from millrace.ml.silhouette import silhouettes_of

    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(90, 4)), 1) + 4 * (np.arange(90) % 3)[:, None]
    clusters = np.stack([np.arange(90) % 2, np.arange(90) % 3, np.arange(90) % 3 * 7 - 5, np.full(90, 2), np.arange(90) % 30, np.arange(90)], axis=1)
    df = spark.createDataFrame([(f"k{i}", x[i].tolist(), *map(int, clusters[i])) for i in range(90)], "id string, features array<double>, a int, b int, c int, d int, e int, f int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for block in (13, None):
        got = {r["id"]: r for r in silhouettes_of(df, "id", list("abcdef"), block=block).collect()}
        assert len(got) == 90
        for m, name in enumerate("abcdef"):
            c = clusters[:, m]
            for i in range(90):
                a = d[i, c == c[i]].sum() / max((c == c[i]).sum() - 1, 1)
                b = min((d[i, c == k].mean() for k in set(c.tolist()) - {c[i]}), default=a)
                want = (b - a) / max(a, b) if (c == c[i]).sum() > 1 else 0.0
                assert got[f"k{i}"][name] == c[i] and abs(got[f"k{i}"][f"{name}_silhouette"] - want) < 1e-9


def test_silhouettes_shuffle_each_point_once(spark):
    """Points don't meet by a shuffle of all pairs of blocks: twice the blocks write no more."""
    data = spark.createDataFrame([(i, [float(i % 7 + j * i % 11) for j in range(50)], i % 3) for i in range(600)], "id long, features array<double>, cluster int")

    def written(block):
        group = f"silhouettes-{block}"
        spark.sparkContext.setJobGroup(group, group)
        silhouettes(data, "id", block=block).count()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        store = spark.sparkContext._jsc.sc().statusStore()
        stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
        return sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages)

    assert written(20) < 1.5 * written(300)


def test_landmarks_give_the_kernel_and_its_error(spark):
    from pyspark.ml.functions import array_to_vector

    from millrace.ml.models import landmark_features

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(60, 2)), rng.normal(size=(20, 2)) + 6, [[6.0, 6.0]] * 5])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, f array<double>").select("id", array_to_vector("f").alias("features"))
    kernel = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(-1))
    errors = []
    for landmarks in (6, 30, 84):
        made, error = landmark_features(df, "id", landmarks=landmarks)
        rows = sorted((r["id"], r["features"].toArray()) for r in made.collect())
        phi = np.array([f for _, f in rows])
        left = np.maximum(1 - (phi * phi).sum(1), 0)
        assert abs(error - (1 - (phi * phi).sum(1)).mean()) < 1e-12
        assert (np.abs(kernel - phi @ phi.T) <= np.sqrt(np.outer(left, left)) + 1e-6).all()
        errors.append(error)
    assert errors[0] > errors[1] > errors[2] - 1e-9 and errors[2] < 1e-6
    assert landmark_features(df.where("false"), "id")[1] == 0.0
