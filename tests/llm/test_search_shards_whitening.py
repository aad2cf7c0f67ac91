"""Lexical search, sharding and whitening against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import lexical, whitening
from millrace.llm.lexical import add_slices, best, build, search, to_slices, values_at
from millrace.llm.sharding import jump, shard
from millrace.llm.whitening import whiten

DOCS = "doc_id long, text string, lang string, block long, term string, score long, key string, size long, shard int, slot long, name string, copies long"


def docs_of(spark, rows):
    """(doc_id, text) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "en", 1, "t", 1, "k", 1, 1, 1, "n", 1) for r in rows], DOCS)


# 11

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute_search(docs, items, k):
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    want = []
    for item, asked in items.items():
        scores = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n // length
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in asked.items() if t in c)
            if score:
                scores.append((-score, i is None, i or 0, i))
        want += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(want, key=repr)


def lexical_rows():
    rng = random.Random(7)
    words = [f"w{int(60 * rng.random() ** 2)}" for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(300)]
    rows += [(1000 + i, "same Words w1, w2; w3!") for i in range(90)]  # ties beyond k
    rows += [(None, "w1 w1 w5"), (5, None), (6, ""), (7, " ,;:\t"), (8, "é漢字  x É w1"), (9, "w2 " * 3000), (10, rows[3][1]), (10, rows[3][1]), (11, "w7\x85w8")]
    return rows


def test_lexical_search(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TERMS", 7)  # several groups of items
    rows = lexical_rows()
    items = [(1, "w1 W1 w2 w59"), (2, "same words"), (3, None), (4, ""), (5, "unknown"), (None, "w3 w9"), (6, "é漢字 w5"), (6, "é漢字 w5"), (7, "w1"), (7, "w2 w2"), (8, "w2 " * 50 + "w3"), (9, "w40 w41 w42 w43 w44 w45 w46 w47 w48 w49")]
    asked = {}
    for i, t in dict.fromkeys(items):
        asked[i] = asked.get(i, Counter()) + terms(t)
    df = spark.createDataFrame([(*r, 1, 2) for r in items], "item_id long, text string, rank int, score long")
    for k in (3, 20, 500):
        got = search(build(docs_of(spark, rows).repartition(5)), df, k=k).collect()
        assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=repr) == brute_search(rows, asked, k)


def test_lexical_blocks_of_any_size(spark):
    """Blocks that end after each document, and one block for all, give the same."""
    rows = lexical_rows()

    class One:
        def partitionId(self):
            return 3

    import pyarrow as pa

    batch = pa.record_batch({"id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    asked = [terms("w1 w2 w2 w59 same"), terms("w7 words é")]
    numbers = {t.encode(): i for i, t in enumerate(dict.fromkeys(t for a in asked for t in a))}
    results = []
    for most in (1, 40, 1 << 14):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lexical, "DOCUMENTS", most)
            patch.setattr(lexical.TaskContext, "get", One)
            index = [r for b in lexical._index(iter([batch])) for r in b.to_pylist()]
        headers = [r for r in index if r["term"] is None]
        assert len({r["block"] for r in headers}) == len(headers)
        n, length = sum(len(r["ids"]) for r in headers), sum(sum(r["lengths"]) for r in headers)
        group = lexical.Group([[(numbers[t.encode()], c) for t, c in a.items()] for a in asked], [5000 + i for i in range(len(numbers))], n, length)
        found = lexical._Best(len(asked), 25)
        for header in headers:
            own = {numbers[r["term"].encode()]: (np.array(r["places"]), np.array(r["counts"])) for r in index if r["block"] == header["block"] and r["term"] is not None and r["term"].encode() in numbers}
            ids = np.array([lexical._NO_ID if i is None else i for i in header["ids"]])
            lexical._rank(ids, np.array(header["lengths"]), own, group, found)
        results.append(found.batch().to_pylist())
    assert results[0] == results[1] == results[2] and len(results[0]) == 50


def test_lexical_empty(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(build(docs_of(spark, [])), items).count() == 0
    assert search(build(docs_of(spark, [(1, None)])), items).count() == 0
    got = search(build(docs_of(spark, [(1, "a")])), items.where("false"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_a_very_long_text_is_counted(spark):
    text = "word " * 2_000_000 + "Tail"
    found = lexical.count_terms(np.frombuffer(text.encode(), np.uint8))
    assert found == {b"word": 2_000_000, b"tail": 1}
    run = lexical.count_terms(np.frombuffer(b"a" * 5_000_000, np.uint8))
    assert list(run.values()) == [1]


def test_bit_slices():
    rng = np.random.default_rng(1)
    for size in (1, 64, 65, 1000):
        numbers = []
        for _ in range(rng.integers(1, 9)):
            values = np.zeros(size, np.int64)
            places = np.sort(rng.choice(size, rng.integers(1, size + 1), replace=False))
            values[places] = rng.integers(0, 1 << int(rng.integers(1, 40)), len(places))
            numbers.append((places, values))
        total = sum(v for _, v in numbers)
        digits = max(1, sum(int(v.max()) for _, v in numbers).bit_length())
        slices = add_slices([to_slices(p, v[p], size) for p, v in numbers], digits)
        assert (values_at(slices, np.arange(size)) == total).all()
        for k in (1, 3, 20, size):
            sure, tied = best(slices, k)
            order = np.sort(total)[::-1]
            positive = int((total > 0).sum())
            assert len(sure) + len(tied) >= min(k, positive) and len(sure) <= k
            if positive > k:
                assert set(sure) == set(np.flatnonzero(total > order[k - 1])) or len(sure) == k and total[sure].min() >= order[k - 1]
                assert len(sure) == k or set(tied) == set(np.flatnonzero(total == order[k - 1]))
            else:
                assert set(sure) | set(tied) == set(np.flatnonzero(total))


# 12


def jump_of(key, n):
    """The published walk, with Python's integers."""
    at, to = -1, 0
    while to < n:
        at = to
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def key_of(doc_id):
    return int(hashlib.md5(b"" if doc_id is None else str(doc_id).encode()).hexdigest()[:16], 16)


def test_jump(spark):
    digit = lambda first: F.conv(F.substring("k", first, 8), 16, 10).cast("long")
    keys = spark.range(300).select(F.md5(F.col("id").cast("string").cast("binary")).alias("k"))
    counts = (1, 2, 9, 1000)
    for row in keys.select("k", jump(digit(1), digit(9), counts, least=5).alias("found")).collect():
        assert row["found"] == [jump_of(int(row["k"][:16], 16), n) for n in counts]


def test_shard(spark):
    rows = [(i, f"text {i % 40}") for i in range(500)] + [(None, "no id"), (None, None), (7, "other"), (8, None), (9, ""), (10, "é漢" * 5000)] + [(11, "twin")] * 25
    got = shard(docs_of(spark, rows).repartition(3)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", jump_of(key_of(i), 8), jump_of(key_of(i), 9)) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got) == want
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    again = shard(docs_of(spark, rows[::-1]).repartition(6)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_shard_deals_copies_out_in_pieces(spark, monkeypatch):
    from millrace.llm import sharding

    monkeypatch.setattr(sharding, "PIECE", 7)
    got = shard(docs_of(spark, [(1, "copy")] * 100 + [(2, "x")]), shards=1).collect()
    assert sorted(r["slot"] for r in got) == list(range(101))
    assert {r["shard"] for r in got} == {0} and {r["grown_shard"] for r in got} <= {0, 1}


def test_shard_empty(spark):
    got = shard(docs_of(spark, []))
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and got.count() == 0
    with pytest.raises(ValueError):
        shard(docs_of(spark, []), shards=0)


# 13

VECTORS = "vec_id long, embedding array<float>, vector array<long>, id long, n long, line int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, [1], 1, 1, 1) for r in rows], VECTORS)


def exact_whitening(rows, scale=64, offset=1_000_000):
    """n, deviations and covariance with fractions; eigenvectors of its rounded entries."""
    width = max(len(v) for _, v in rows)
    grid = [[math.floor(scale * float(np.float32(c))) + offset for c in v] + [offset] * (width - len(v)) for _, v in rows]
    fit = sorted(set(map(tuple, grid)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = [[n * x - s for x, s in zip(v, sums, strict=True)] for v in fit]
    cov = np.array([[float(Fraction(sum(c[i] * c[j] for c in centred), n**3)) for j in range(width)] for i in range(width)])
    return grid, n, sums, cov


def test_whitening(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 6)) * [5, 3, 2, 1, 1, 0.5]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(500 + i, rows[0][1]) for i in range(60)] + [(None, rows[1][1]), (700, rows[2][1][:3]), (700, rows[2][1][:3])]
    odd = [(800, None), (801, [1.0, None]), (802, [float("nan")] * 6), (803, [float("inf")] * 6)]
    got = whiten(vectors_of(spark, rows + odd).repartition(5), components=4).collect()
    grid, n, sums, cov = exact_whitening(rows)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:4]
    assert len(got) == 4 * len(rows)
    want = {}
    for (i, _), g in zip(rows, grid, strict=True):
        projected = np.array([float(Fraction(n * x - s, n)) for x, s in zip(g, sums, strict=True)]) @ vectors[:, order] / np.sqrt(values[order])
        want.setdefault(i, []).append((sum((n * x - s) ** 2 for x, s in zip(g, sums, strict=True)), projected))
    signs = {}
    for r in got:
        deviation, projected = next((d, p) for d, p in want[r["vec_id"]] if d == r["deviation"])
        c = r["component"] - 1
        signs.setdefault(c, np.sign(r["whitened"] * projected[c]))
        assert abs(r["whitened"] - signs[c] * projected[c]) < 1e-11
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["explained"] - values[order][c] / values.sum()) < 1e-12
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-12


def test_covariance_is_right_beyond_doubles(spark):
    """Values far from zero with a tiny spread, where sums of squares in doubles lose all digits."""
    rng = np.random.default_rng(3)
    grid = rng.integers(0, 3, (400, 3)) + (1 << 44)
    fit = spark.createDataFrame([([int(x) for x in v],) for v in grid], "vector array<long>").repartition(7)
    n, sums = len(grid), [int(x) for x in grid.sum(axis=0)]
    mean = np.array([s / n for s in sums])
    low = np.array([float(Fraction(s, n) - Fraction(m)) for s, m in zip(sums, mean, strict=True)])
    model = whitening.Model(n, tuple(sums), (mean, low), np.zeros((3, 0)), np.zeros(0))
    high, rest = whitening.covariance(fit, 3, n, model.centred)
    for i in range(3):
        for j in range(3):
            exact = Fraction(sum((n * int(a) - sums[i]) * (n * int(b) - sums[j]) for a, b in zip(grid[:, i], grid[:, j], strict=True)), n**3)
            assert abs(Fraction(high[i, j]) + Fraction(rest[i, j]) - exact) < Fraction(1, 10**24)


def test_double_double():
    rng = np.random.default_rng(4)
    a, b = (rng.normal(size=500) * 10.0 ** rng.integers(-8, 8, 500) for _ in range(2))
    high, low = whitening.two_sum(a, b)
    assert all(Fraction(h) + Fraction(e) == Fraction(x) + Fraction(y) for h, e, x, y in zip(high, low, a, b, strict=True))
    high, low = whitening.two_product(a, b, whitening.split(a), whitening.split(b))
    assert all(Fraction(h) + Fraction(e) == Fraction(x) * Fraction(y) for h, e, x, y in zip(high, low, a, b, strict=True))
    total = whitening.add_rows(high[:, None], low[:, None])
    exact = sum(Fraction(x) * Fraction(y) for x, y in zip(a, b, strict=True))
    assert abs(Fraction(total[0][0]) + Fraction(total[1][0]) - exact) < Fraction(1, 10**14)


def test_whitening_without_directions(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])] * 3, [(1, [0.5])]):
        got = whiten(vectors_of(spark, rows))
        assert got.columns == columns and got.count() == 0
    got = whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()  # one direction only
    assert sorted((r["vec_id"], r["component"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got) == [(1, 1, 16384, 1.0, 1.0), (2, 1, 16384, 1.0, 1.0)]


def test_deviation_beyond_64_bits_is_an_error():
    model = whitening.Model(1 << 20, ((1 << 20) * (1 << 20),), (np.zeros(1), np.zeros(1)), np.zeros((1, 0)), np.zeros(0))
    assert model.deviation(np.array([[1 << 20], [(1 << 20) + 1]])).tolist() == [0, 1 << 40]
    with pytest.raises(OverflowError):
        model.deviation(np.array([[1 << 40]]))
