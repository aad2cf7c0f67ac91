"""The dictionary automaton against plain search."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from millrace.functions import dictionary as A


def plain(texts, words):
    return sorted((i, at, w) for i, t in enumerate(texts) if t for w in words if w for at in range(len(t)) if t.startswith(w, at))


def test_find_is_as_plain_search(monkeypatch):
    rng = random.Random(1)
    for piece in (3, 16, 1024):
        monkeypatch.setattr(A, "PIECE", piece)
        for alphabet in ("ab", "abcé漢𝄞"):
            words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))) for _ in range(25)] + ["", "a" * 7]
            texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(30)] + [None, "", "a" * 200]
            made = A.Automaton.of(words)
            row, start, word = made.find(texts)
            assert sorted((r, s, made.words[w]) for r, s, w in zip(row.tolist(), start.tolist(), word.tolist(), strict=True)) == plain(texts, set(words))
    assert [len(x) for x in A.Automaton.of([]).find(["x"])] == [0, 0, 0]


def fewest(text, phrases):
    """The best cut by trying all, as (number, minus the lengths)."""
    best = {len(text): (0, ())}
    for at in range(len(text) - 1, -1, -1):
        ways = [1] + [n for n in range(2, len(text) - at + 1) if text[at : at + n] in phrases]
        best[at] = min((best[at + n][0] + 1, (-n, *best[at + n][1])) for n in ways)
    return [-n for n in best[0][1]]


def test_convert_takes_the_fewest_parts(spark):
    rng = random.Random(2)
    phrases = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))): f"<{i}>" for i in range(14)}
    texts = ["".join(rng.choice("abcd") for _ in range(rng.randrange(30))) for _ in range(60)] + [None, ""]
    got = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", A.convert(F.col("t"), phrases).alias("c")).collect()
    for r in got:
        t = texts[r["id"]]
        want = None if t is None else ""
        at = 0
        for n in fewest(t, phrases) if t else ():
            want += phrases.get(t[at : at + n], t[at : at + n])
            at += n
        assert r["c"] == want


def test_occurrences_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(A, "WORDS", 3)
    words = ["aa", "a", "ab", "b c", "漢", "", None, "aa", "zz"]
    texts = {1: "aaab", 2: None, 3: "b c漢漢", 4: "", 5: "x" * 100_000 + "zz"}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = A.occurrences(df, "id", "text", spark.createDataFrame([(w,) for w in words], "word string"))
    counts = {}
    for i, t in texts.items():
        for _, _, w in plain([t], {w for w in words if w}) if t and len(t) < 1000 else ():
            counts[i, w] = counts.get((i, w), 0) + 1
    assert {(r["id"], r["word"]): r["n"] for r in got.collect()} == counts | {(5, "zz"): 1}
    assert A.occurrences(df, "id", "text", spark.createDataFrame([], "word string")).count() == 0
    assert np.prod(A.Automaton.of(["x"]).find([None])[0].shape) == 0


def test_batches_are_read_in_slices(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(A, "SLICE", 10)
    batch = pd.DataFrame({"text": ["abcd", None, "abcd", "abcd", "x" * 30, "", "abcd"]})
    parts = [list(p.index) for p in A.slices(batch, "text")]
    assert parts == [[0, 1, 2], [3], [4], [5, 6]] and list(A.slices(batch.iloc[:0], "text"))[0].empty
