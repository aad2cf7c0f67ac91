"""The two classifiers against plain arithmetic: every cosine and vote, and the optimum of the whole loss."""

from __future__ import annotations

import math
import random

import numpy as np

from millrace.llm import quality, toxicity
from millrace.llm.bytewords import as_bytes


def texts_of(seed, n):
    rng = random.Random(seed)
    good = ["the river runs", "a small house", "they walked along", "in the morning", "with old friends"]
    bad = ["BUY now!!!", "click click click", "$$$ 100 % free", "xx xx xx xx", "win win WIN"]
    texts, labels = [], []
    for i in range(n):
        kind = rng.random() < 0.5
        texts.append(" ".join(rng.choice(good if kind else bad) + f" {rng.choice('abcdefgh') * rng.randrange(1, 4)}{rng.randrange(50)}" for _ in range(rng.randrange(1, 15))))
        labels.append(int(kind))
    return texts, labels


def test_quality_is_an_exact_vote_over_all_neighbours(spark):
    texts, labels = texts_of(1, 60)
    model = quality.fit(texts, labels, dimensions=12)
    asked = texts_of(2, 40)[0] + ["", None, texts[0]]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}

    def latent(text):
        counts = quality.terms(as_bytes(text))
        row = [math.sqrt(float(c)) * float(w) for c, w in zip(counts, model.weights, strict=True)]
        out = [sum(x * float(d) for x, d in zip(row, column, strict=True) if x) for column in model.directions.T]
        length = math.sqrt(sum(x * x for x in out))
        return [x / max(length, 1e-12) for x in out]

    known = [latent(t) for t in texts]
    compared = 0
    for i, text in enumerate(asked):
        own = latent(text)
        cosines = sorted(((sum(a * b for a, b in zip(own, v, strict=True)), label) for v, label in zip(known, labels, strict=True)), reverse=True)
        if cosines[quality.NEIGHBOURS - 1][0] - cosines[quality.NEIGHBOURS][0] < 1e-5:
            continue  # which of them votes is rounding
        votes = [(max(c, 1e-6) ** quality.SHARPNESS, label) for c, label in cosines[: quality.NEIGHBOURS]]
        want = sum(v for v, label in votes if label) / sum(v for v, _ in votes)
        assert abs(got[i] - want) < 2e-3
        compared += 1
    assert compared > 25 and abs(got[42] - got[42]) == 0


def test_toxicity_is_at_the_optimum_of_the_whole_loss():
    rng = random.Random(3)
    insults, groups, plain = ["fool", "scum", "vermin"], ["women", "men", "muslims", "christians"], ["walk", "eat", "sing", "work", "travel"]
    texts, labels = [], []
    for i in range(80):
        toxic = i % 2
        words = [rng.choice(plain) for _ in range(4)] + [rng.choice(insults)] * toxic
        words += [rng.choice(groups if rng.random() < 0.5 else plain)] * 2
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(toxic)
    for fairness in (0.0, toxicity.FAIRNESS):
        model = toxicity.fit(texts, labels, fairness=fairness)
        place = {int(k): i for i, k in enumerate(model.keys)}
        d = len(place) + 1

        def row(found, place=place, d=d):
            out = np.zeros(d)
            for f in found.tolist():
                if int(f) in place:
                    out[place[int(f)]] = 1
            return out

        x = np.array([row(toxicity.features(as_bytes(t))) for t in texts])
        x[:, -1] = 1
        changes = [row(gained) - row(lost) for t in texts for lost, gained in toxicity.counterfactuals(t)]
        c = np.array(changes) if changes else np.zeros((0, d))
        assert len(changes) > 20
        w = np.append(model.weights, model.bias)
        held = np.full(d, toxicity.RIDGE)
        held[-1] = 1e-6
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - labels) + held * w + fairness * c.T @ (c @ w)
        assert len(place) > 2 and np.abs(gradient).max() < 1e-4
        # the loss is convex, so no other weights do better
        loss = lambda v: np.sum(np.logaddexp(0, x @ v) - np.array(labels) * (x @ v)) + (held * v * v).sum() / 2 + fairness * ((c @ v) ** 2).sum() / 2
        noise = np.random.default_rng(0)
        assert all(loss(w + noise.normal(size=d) * s) >= loss(w) for s in (0.01, 0.1, 1.0) for _ in range(5))
