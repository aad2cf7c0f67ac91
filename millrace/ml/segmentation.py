"""Words of texts without blanks, and base forms of words; both learnt from counts.

Segmentation is a unigram lattice: every piece of up to some letters is a word with
a chance, and a text's words are its likeliest path.  The chances are counts of the
pieces in the paths of the last round, counted anew by Spark in each round.  Base
forms come from endings that are learnt from pairs of words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

LONGEST = 5  # letters of a word
PART = 64  # letters that are cut off a long run at once
WORDS = 20_000  # words of a model: what is sent to the tasks


def runs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, run): the letters of each text in lower case, without blanks, cut at all other marks."""
    bare = F.regexp_replace(F.lower(text), r"\s+", "")
    return docs.select(key, F.explode(F.regexp_extract_all(bare, F.lit(r"\p{L}+"), F.lit(0))).alias("run"))


def piece_counts(texts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(word, n): how often each piece of up to ``longest`` letters is in the runs."""
    # each letter's next ones are counted first, then their beginnings: a row for each letter, not for each piece;
    # long runs are cut, as finding a letter takes time by its place
    part = lambda j: F.struct(F.substr("run", j * PART + 1, F.lit(PART + longest - 1)).alias("text"), F.least(F.lit(PART), F.length("run") - j * PART).alias("starts"))
    parts = texts.where(F.length("run") > 0).select(F.explode(F.transform(F.sequence(F.lit(0), F.expr(f"cast((length(run) - 1) div {PART} as int)")), part)).alias("p"))
    ahead = F.transform(F.sequence(F.lit(1), F.col("p.starts")), lambda i: F.substr(F.col("p.text"), i, F.lit(longest)))
    windows = parts.select(F.explode(ahead).alias("window")).groupBy("window").agg(F.count("*").alias("n"))
    pieces = windows.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("window")), lambda i: F.left("window", i))).alias("word"))
    return pieces.groupBy("word").agg(F.sum("n").alias("n"))


def best_path(run: str, chances: dict[str, float], longest: int, unknown: float) -> list[str]:
    """The likeliest words of a run; a letter that is no word has the chance ``unknown``; of equal paths the last word is the longer."""
    score, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        best, start = -math.inf, end - 1
        for size in range(min(longest, end), 0, -1):
            chance = chances.get(run[end - size : end], unknown if size == 1 else None)
            if chance is not None and score[end - size] + chance > best:
                best, start = score[end - size] + chance, end - size
        score.append(best)
        back.append(start)
    words, end = [], len(run)
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


class Lattice:
    """The likeliest paths of many runs at once: ``best_path`` with a step for each letter over all runs that are as long."""

    def __init__(self, chances: dict[str, float], longest: int, unknown: float):
        self.chances, self.longest, self.unknown = chances, longest, unknown
        self.letters = np.array(sorted({ord(c) for w in chances for c in w}), np.uint32)
        number = {chr(c): i for i, c in enumerate(self.letters.tolist(), 1)}
        nodes: dict[str, int] = {"": 1}  # beginnings of words; 0 is none
        for w in chances:
            for size in range(1, len(w) + 1):
                nodes.setdefault(w[:size], len(nodes) + 1)
        self.width = len(number) + 1
        steps = sorted((nodes[w[:-1]] * self.width + number[w[-1]], n) for w, n in nodes.items() if w)
        self.keys, self.targets = np.array([k for k, _ in steps] or [-1], np.int64), np.array([n for _, n in steps] or [0], np.int32)
        self.table = None
        if (len(nodes) + 1) * self.width <= 1 << 24:
            self.table = np.zeros((len(nodes) + 1) * self.width, np.int32)
            self.table[self.keys[self.keys >= 0]] = self.targets[self.keys >= 0]
        self.chance = np.full(len(nodes) + 1, -np.inf)
        for w, n in nodes.items():
            self.chance[n] = chances.get(w, -np.inf) if w else -np.inf

    def _next(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) * self.width + letter
        if self.table is not None:
            return np.where(letter > 0, self.table[key], 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((letter > 0) & (self.keys[at] == key), self.targets[at], 0)

    def ends(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Whether a word ends after each letter of the runs in a row, and the letters' code points."""
        points = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.letters, points)
        known = self.letters[np.minimum(at, len(self.letters) - 1)] == points if len(self.letters) else np.zeros(len(points), bool)
        letter = np.where(known, at + 1, 0)
        padded = np.concatenate([letter, np.zeros(self.longest, letter.dtype)])
        node, by_size = np.ones(len(points), np.int32), []
        for size in range(1, self.longest + 1):
            node = self._next(node, padded[size - 1 : size - 1 + len(points)])
            by_size.append(self.chance[node])
        by_size[0] = np.where(np.isneginf(by_size[0]), self.unknown, by_size[0])
        sizes = np.array(list(map(len, runs)), np.int64)
        first = np.cumsum(sizes) - sizes
        cuts = np.zeros(len(points), bool)
        order = np.argsort(-sizes, kind="stable")
        alone = 16 if len(runs) > 16 and sizes[order[16]] < sizes[order[0]] else 0 if len(runs) > 16 else len(runs)
        for r in order[:alone].tolist():  # the longest ones, whose last letters would be steps over few runs
            lengths = [len(w) for w in best_path(runs[r], self.chances, self.longest, self.unknown)]
            cuts[first[r] + np.cumsum(lengths, dtype=np.int64) - 1] = True
        order = order[alone:]
        base, long = first[order], sizes[order]
        score, back = np.zeros((self.longest + 1, len(order))), np.zeros(len(points), np.int8)
        shorter = np.searchsorted(-long, -np.arange(1, (long[0] if len(long) else 0) + 1), side="right")  # how many runs reach each letter
        for end, many in enumerate(shorter.tolist(), 1):
            best, chosen = np.full(many, -np.inf), np.ones(many, np.int8)
            for size in range(min(self.longest, end), 0, -1):
                value = score[(end - size) % (self.longest + 1), :many] + by_size[size - 1][base[:many] + end - size]
                better = value > best
                best, chosen = np.where(better, value, best), np.where(better, np.int8(size), chosen)
            score[end % (self.longest + 1), :many] = best
            back[base[:many] + end - 1] = chosen
        while len(base):
            open_ = long > 0
            base, long = base[open_], long[open_]
            cuts[base + long - 1] = True
            long = long - back[base + long - 1]
        return cuts, points

    def words(self, runs: pa.Array) -> pa.ListArray:
        """The words of each run; null stays null."""
        texts = ["" if r is None else r for r in runs.to_pylist()]
        cuts, points = self.ends(texts)
        after = np.cumsum(1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000))
        starts = np.concatenate([[0], after[cuts]]).astype(np.int32)
        values = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.tobytes()), pa.py_buffer("".join(texts).encode()))
        counts = np.concatenate([[0], np.cumsum(cuts)])[np.concatenate([[0], np.cumsum(list(map(len, texts)), dtype=np.int64)])]
        return pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), values, mask=runs.is_null())


def segment(texts: DataFrame, counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``texts`` with ``words``, the likeliest ones by the model's counts.

    The model is the ``WORDS`` most frequent pieces at most, so its size is bounded;
    it is sent to all tasks.  Runs of any length are worked on whole.
    """
    spark = texts.sparkSession
    model = {r["word"]: r["n"] for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()}
    total = float(sum(model.values()) + 1)
    shared = spark.sparkContext.broadcast(({w: math.log(n / total) for w, n in model.items()}, math.log(0.1 / total)))

    @F.arrow_udf("array<string>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chances, unknown = shared.value
        made = Lattice(chances, longest, unknown)
        for runs in batches:
            yield made.words(runs)

    return texts.withColumn("words", of("run"))


def learn(texts: DataFrame, rounds: int = 2, longest: int = LONGEST, least: int = 2) -> DataFrame:
    """(word, n): the words of the runs' likeliest paths after some rounds; words that are there less than ``least`` times go."""
    counts = cut(piece_counts(texts, longest).where(F.col("n") >= least))
    for _ in range(rounds):
        words = segment(texts, counts, longest).select(F.explode("words").alias("word"))
        counts = cut(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least))
    return counts


# --- base forms


def _shared(one: Column, two: Column) -> Column:
    """How many letters two words have in common at their beginning."""
    return F.array_max(F.filter(F.sequence(F.lit(0), F.least(F.length(one), F.length(two))), lambda i: F.left(one, i) == F.left(two, i)))


def learn_endings(pairs: DataFrame, least: int = 5) -> DataFrame:
    """(ending, put, n): what an ending of a form becomes in its base form, from (form, base) pairs.

    Of several for one ending the most frequent counts, then the shorter text; only
    those that ``least`` pairs show.  A pair counts once, and nulls don't.
    """
    known = pairs.where("form is not null and base is not null and form <> base").select("form", "base").distinct().withColumn("__same", _shared(F.col("form"), F.col("base")))
    rules = known.select(F.substr("form", F.col("__same") + 1).alias("ending"), F.substr("base", F.col("__same") + 1).alias("put"))
    counts = rules.where("ending <> ''").groupBy("ending", "put").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    best = counts.groupBy("ending").agg(F.min(F.struct((-F.col("n")).alias("m"), F.length("put").alias("l"), "put")).alias("b"))
    return best.select("ending", F.col("b.put").alias("put"), (-F.col("b.m")).alias("n"))


def base_forms(words: DataFrame, endings: DataFrame, shortest: int = 3) -> DataFrame:
    """(word, base): words with their longest known ending replaced, if ``shortest`` letters stay before it; else as they are."""
    asked = words.select("word").where("word is not null").distinct()
    cuts = F.when(F.length("word") > shortest, F.sequence(F.lit(shortest), F.length("word") - 1)).otherwise(F.array().cast("array<int>"))
    each = asked.withColumn("at", F.explode(cuts)).withColumn("ending", F.substr("word", F.col("at") + 1))
    found = each.join(endings, "ending").groupBy("word").agg(F.min(F.struct("at", "put")).alias("b"))
    return asked.join(found, "word", "left").select("word", F.coalesce(F.concat(F.expr("left(word, b.at)"), F.col("b.put")), F.col("word")).alias("base"))
