"""Segmentation and base forms against trying all."""

from __future__ import annotations

import math
import random
from collections import Counter

from millrace.ml import segmentation as S


def ways(run, longest):
    if not run:
        yield []
    for size in range(1, min(longest, len(run)) + 1):
        for rest in ways(run[size:], longest):
            yield [run[:size], *rest]


def test_best_path_is_the_best_of_all():
    rng = random.Random(1)
    for _ in range(60):
        chances = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))): -rng.random() * 9 for _ in range(12)}
        run = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 10)))
        score = lambda words: sum(chances.get(w, -20.0 if len(w) == 1 else -math.inf) for w in words)
        got = S.best_path(run, chances, 3, -20.0)
        assert "".join(got) == run and abs(score(got) - max(map(score, ways(run, 3)))) < 1e-9


def test_words_are_found_again(spark):
    rng = random.Random(2)
    words = ["kalo", "bi", "zumre", "fent", "ax"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30)) + ". Ü") for i in range(60)] + [(99, None), (98, ""), (97, "x" * 20_000)]
    texts = S.runs(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    counts = {r["word"]: r["n"] for r in S.piece_counts(texts.where("id = 0"), 2).collect()}
    run = rows[0][1].replace(" ", "").split(".")[0]
    assert counts == Counter(list(run) + ["ü"] + [run[i : i + 2] for i in range(len(run) - 1)])
    model = S.learn(texts.where("id < 97"), rounds=4)
    got = S.segment(texts, model).collect()
    assert all("".join(r["words"]) == r["run"] for r in got)
    found = Counter(w for r in got if r["id"] < 97 for w in r["words"])
    assert sum(found[w] for w in words) > 0.5 * sum(found.values())


def test_endings(spark):
    pairs = [(f"{s}ies", f"{s}y") for s in ("part", "cit", "stud")] + [(f"{s}s", s) for s in ("fare", "flight", "ticket", "rate")] + [("ran", "run"), ("ies", "y"), (None, "x"), ("x", None), ("same", "same")]
    rules = S.learn_endings(spark.createDataFrame(pairs + pairs[:3], "form string, base string"), least=2)
    assert sorted(tuple(r) for r in rules.collect()) == [("ies", "y", 4), ("s", "", 4)]
    words = ["countries", "fares", "dies", "s", "", None, "run", "fares"]
    got = {r["word"]: r["base"] for r in S.base_forms(spark.createDataFrame([(w,) for w in words], "word string"), rules).collect()}
    assert got == {"countries": "country", "fares": "fare", "dies": "die", "s": "s", "": "", "run": "run"}


def test_paths_of_many_runs_are_those_of_each(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    letters = "abcdé至𝄞"
    for dense in (True, False):
        chances = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))): rng.choice([-1.0, -2.0, -3.5, -rng.random() * 9]) for _ in range(80)}
        runs = ["".join(rng.choice(letters + "x") for _ in range(rng.randrange(0, 60))) for _ in range(300)] + [None, "", "ab" * 900]
        made = S.Lattice(chances, 5, -9.0)
        if not dense:
            made.table = None
        assert made.words(pa.array(runs, pa.string())).to_pylist() == [None if r is None else S.best_path(r, chances, 5, -9.0) for r in runs]
    assert S.Lattice({}, 5, -9.0).words(pa.array(["xy"] * 20 + ["z"], pa.string())).to_pylist() == [["x", "y"]] * 20 + [["z"]]
    assert S.Lattice({}, 5, -9.0).words(pa.array([], pa.string())).to_pylist() == []


def test_pieces_of_runs_longer_than_a_part(spark):
    run = "".join(random.Random(5).choice("abcdé") for _ in range(3 * S.PART + 1))
    got = {r["word"]: r["n"] for r in S.piece_counts(spark.createDataFrame([(run,), (run[: S.PART],), ("a",), (None,), ("",)], "run string"), 4).collect()}
    assert got == Counter(r[i : i + k] for r in (run, run[: S.PART], "a") for k in range(1, 5) for i in range(len(r) - k + 1))
