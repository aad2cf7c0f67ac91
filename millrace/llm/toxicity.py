"""Toxicity by a counterfactual-regularised classifier.

A linear model over the words of a text and over the beginnings of longer words.
It is fitted on a bounded, hash-chosen sample of labelled texts.  Every sentence
of the sample that mentions a group (an identity term) is written again with each
other term of its kind, and the fit penalises the squared change of the score, so
the mention of a group as such carries no weight.  Scoring reads whole texts and
needs the model alone, whose size is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import Prefixes, as_bytes, blocks, byte_views, mix, word_spans
from millrace.llm.scratch import bound_batches, free_name, keep, tidy

SAMPLE = 6_000  # labelled texts that are fitted on, at most
FEATURES = 2_000  # features the model keeps, at most
LEAST_TEXTS, LEAST_LIFT = 3, 1.0  # texts of label 1 that have a kept feature, and how much likelier (as a logarithm) they are to have it
RIDGE, FAIRNESS = 0.2, 10.0
PARTS = 32  # partitions of the sample
PREFIXES = (4, 5, 6, 7, 8, 9)  # bytes of a longer word's beginning

#: Groups of terms of one kind that can stand for each other.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "natives"),
    ("african", "european", "american", "mexican", "chinese", "indian", "arab"),
    ("disabled", "blind", "deaf"), ("old", "young", "elderly"),
    ("frauen", "männer"), ("schwarze", "weiße"), ("muslime", "christen", "juden"),
    ("femmes", "hommes"), ("noirs", "blancs"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("negros", "blancos"), ("musulmanes", "cristianos", "judíos"),
)
_SENTENCE = regex.compile(r"[^.!?\n]+[.!?\n]?")
_OTHERS = {term: [x for x in kind if x != term] for kind in IDENTITY_TERMS for term in kind}
_TERM = regex.compile(r"\b(?:" + "|".join(sorted(_OTHERS, key=len, reverse=True)) + r")\b")


def _inside(raw: np.ndarray) -> np.ndarray:
    return ((raw >= 97) & (raw <= 122)) | ((raw >= 65) & (raw <= 90)) | (raw >= 128)


def features(text: np.ndarray) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct words and of its longer words' beginnings.

    ``text`` are UTF-8 bytes.  Words are runs of ASCII letters and non-ASCII
    characters, in lower case.
    """
    found = [_block_features(block) for block in blocks(text, _inside)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _block_features(block: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(block.tobytes().decode("utf-8", "replace").lower().encode("utf-8", "replace"), np.uint8)
    starts, ends = word_spans(_inside(raw))
    if not len(starts):
        return np.zeros(0, np.uint64)
    hashes = Prefixes(raw)
    words, first = np.unique(hashes.spans(starts, ends), return_index=True)
    starts, ends = starts[first], ends[first]
    found = [words]
    for length in PREFIXES:
        longer = ends - starts > length
        found.append(mix(hashes.spans(starts[longer], starts[longer] + length) + np.uint64(length)))
    return np.concatenate(found)


def counterfactuals(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each swap of a term in a sentence of the text: the features lost and gained."""
    found = []
    low = text.lower()
    if not _TERM.search(low):
        return found
    for sentence in _SENTENCE.findall(low):
        for term in set(_TERM.findall(sentence)):
            mine = features(as_bytes(sentence))
            for other in _OTHERS[term]:
                swapped = features(as_bytes(regex.sub(rf"\b{term}\b", other, sentence)))
                found.append((np.setdiff1d(mine, swapped), np.setdiff1d(swapped, mine)))
    return found


@dataclass
class Model:
    """Weights by feature; ``keys`` are sorted."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    seen: np.ndarray = field(init=False)

    def __post_init__(self):
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def logit(self, found: np.ndarray) -> float:
        found = found[self.seen[(found >> np.uint64(44)).astype(np.int64)]]
        at = np.minimum(np.searchsorted(self.keys, found), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == found if len(self.keys) else np.zeros(len(found), bool)
        return self.bias + float(self.weights[at[hit]].sum())


def _places(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Where the features that are among the sorted ``keys`` stand there."""
    at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
    return at[keys[at] == found].astype(np.int32) if len(keys) else np.zeros(0, np.int32)


def _changes(keys: np.ndarray, text: str) -> list[np.ndarray]:
    """For each swap in a text that matters: the places it takes (as -1 - place) and those it gives."""
    found = []
    for lost, gained in counterfactuals(text):
        change = np.concatenate([-1 - _places(keys, lost), _places(keys, gained)])
        if len(change):
            found.append(change.astype(np.int32))
    return found


def _worth(with_1: np.ndarray, with_0: np.ndarray, n_1: float, n_0: float) -> np.ndarray:
    """How much a feature tells of label 1; minus infinity for one that isn't kept."""
    lift = np.log((with_1 + 0.5) / (n_1 + 1)) - np.log((with_0 + 0.5) / (n_0 + 1))
    return np.where((with_1 >= LEAST_TEXTS) & (lift > LEAST_LIFT), lift * np.sqrt(with_1), -np.inf)


def _constant(truth: np.ndarray) -> Model:
    share = float((truth.sum() + 0.5) / (len(truth) + 1))
    return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))


def _solve(keys: np.ndarray, lines: list[np.ndarray], truth: np.ndarray, changes: list[np.ndarray], fairness: float, ridge: float, rounds: int = 60) -> Model:
    """Newton steps on logistic loss + ridge + fairness x squared counterfactual changes.

    ``lines`` are the features of each text, ``changes`` those of each swap; both
    stay sparse, and each step is found by conjugate gradients.
    """
    n = len(keys) + 1  # the last is the bias
    row = np.repeat(np.arange(len(lines)), [len(x) + 1 for x in lines])
    col = np.concatenate([np.append(x, n - 1) for x in lines])
    where = np.repeat(np.arange(len(changes)), [len(x) for x in changes])
    signed = np.concatenate([*changes, np.zeros(0, np.int32)]).astype(np.int64)
    place, sign = np.where(signed < 0, -1 - signed, signed), np.where(signed < 0, -1.0, 1.0)
    held = np.full(n, ridge)
    held[-1] = 1e-6

    def logits(v: np.ndarray) -> np.ndarray:
        return np.bincount(row, v[col], len(lines))

    def back(u: np.ndarray) -> np.ndarray:
        return np.bincount(col, u[row], n)

    def penalty(v: np.ndarray) -> np.ndarray:
        moved = np.bincount(where, sign * v[place], max(len(changes), 1))
        return held * v + fairness * np.bincount(place, sign * moved[where], n)

    w = np.zeros(n)
    w[-1] = _constant(truth).bias
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(logits(w), -30, 30)))
        curve = p * (1 - p)
        rest = -(back(p - truth) + penalty(w))
        scale = 1 / (back(curve) + held)
        step, aim = np.zeros(n), scale * rest
        size = first = rest @ aim
        for _ in range(4 * n):
            if size <= 1e-14 * first or size <= 1e-20:
                break
            bent = back(curve * logits(aim)) + penalty(aim)
            move = size / (aim @ bent)
            step += move * aim
            rest = rest - move * bent
            turned = scale * rest
            size, before = rest @ turned, size
            aim = turned + size / before * aim
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return Model(keys, w[:-1], float(w[-1]))


def fit(texts: list[str | None], labels: list[int], most: int = FEATURES, fairness: float = FAIRNESS, ridge: float = RIDGE) -> Model:
    """Fit to labelled texts that are at hand.

    Kept are the ``most`` features that tell most of label 1.  Without texts of both
    labels the score is the smoothed share of label 1.
    """
    truth = np.array(labels, np.float64)
    if len(truth) == 0 or truth.min() == truth.max():
        return _constant(truth)
    sets = [features(as_bytes(t)) for t in texts]
    keys, at = np.unique(np.concatenate(sets), return_inverse=True)
    with_1 = np.bincount(at, np.repeat(truth, [len(s) for s in sets]), len(keys))
    worth = _worth(with_1, np.bincount(at, minlength=len(keys)) - with_1, truth.sum(), (1 - truth).sum())
    order = np.argsort(-worth, kind="stable")[:most]
    keys = np.sort(keys[order[worth[order] > -np.inf]])
    if not len(keys):
        return _constant(truth)
    return _solve(keys, [_places(keys, s) for s in sets], truth, [c for t in texts for c in _changes(keys, t or "")], fairness, ridge)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each feature of a partition how many of its texts have it, by label."""
    sets, labels = [], []
    for batch in batches:
        sets += [features(t) if t is not None else np.zeros(0, np.uint64) for t in byte_views(batch.column("text"))]
        labels += batch.column("label").to_pylist()
    keys, at = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True)
    with_1 = np.bincount(at, np.repeat(np.array(labels, np.float64), [len(s) for s in sets]), len(keys)).astype(np.int64)
    yield pa.record_batch({"feature": keys.view(np.int64), "with_1": with_1, "with_0": np.bincount(at, minlength=len(keys)) - with_1})


def learn(sample: DataFrame, most: int = FEATURES, fairness: float = FAIRNESS, ridge: float = RIDGE) -> Model:
    """:func:`fit` to a labelled sample (id, text, label) whose features are found on the executors.

    The driver gets no texts: only the kept features with their counts, and for
    each text and swap which of the kept features it has.
    """
    bound_batches(sample.sparkSession)
    sample = keep(sample.repartition(PARTS, "id"))
    n, n_1 = sample.agg(F.count("*"), F.sum("label")).first()
    n_1 = n_1 or 0
    if n_1 in (0, n):
        return _constant(np.repeat([1.0, 0.0], [n_1, n - n_1]))
    counts = sample.mapInArrow(tidy(_count_features), "feature long, with_1 long, with_0 long").groupBy("feature").agg(F.sum("with_1").alias("with_1"), F.sum("with_0").alias("with_0"))
    lift = F.log((F.col("with_1") + 0.5) / (n_1 + 1)) - F.log((F.col("with_0") + 0.5) / (n - n_1 + 1))
    worth = counts.where(F.col("with_1") >= LEAST_TEXTS).where(lift > LEAST_LIFT).select("feature", (lift * F.sqrt("with_1")).alias("worth"))
    best = worth.orderBy(F.desc("worth"), "feature").limit(most).toArrow().column("feature").to_numpy()
    if not len(best):
        return _constant(np.repeat([1.0, 0.0], [n_1, n - n_1]))
    keys = np.sort(best.astype(np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(byte_views(batch.column("text")))
            lines = [_places(keys, features(t)) if t is not None else np.zeros(0, np.int32) for t in texts]
            swaps = [_changes(keys, bytes(t).decode("utf-8", "replace")) if t is not None else [] for t in texts]
            yield pa.record_batch({"id": batch.column("id"), "label": batch.column("label"), "line": pa.array(lines, pa.list_(pa.int32())), "swaps": pa.array(swaps, pa.list_(pa.list_(pa.int32())))})

    rows = sample.mapInArrow(tidy(run), "id long, label int, line array<int>, swaps array<array<int>>").toArrow().sort_by("id")
    lines = [np.array(x, np.int32) for x in rows.column("line").to_pylist()]
    swaps = [np.array(c, np.int32) for x in rows.column("swaps").to_pylist() for c in x]
    return _solve(keys, lines, rows.column("label").to_numpy().astype(np.float64), swaps, fairness, ridge)


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, allowed: Column, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most ``most`` labelled texts of the allowed rows, by the smallest hashes of their identifiers.

    Of texts that repeat an identifier the smallest counts.  ``allowed`` is a
    condition on the column ``label_id``.
    """
    chosen = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    chosen = chosen.where(F.col("label_id").isNotNull() & F.col("label").isin(0, 1) & allowed).dropDuplicates(["label_id"])
    chosen = chosen.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
    texts = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).cast("string").alias("text"))
    joined = texts.join(F.broadcast(chosen), "label_id")  # at most ``most`` keys
    return joined.groupBy(F.col("label_id").cast("long").alias("id")).agg(F.min("text").alias("text"), F.min("label").alias("label"))


def sample_labelled(*args, **more) -> tuple[list[str | None], list[int]]:
    """The texts and labels of :func:`labelled`, on the driver."""
    rows = labelled(*args, **more).toArrow().sort_by("id")
    return rows.column("text").to_pylist(), rows.column("label").to_pylist()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs``' id_col and ``keep`` columns with ``score``, the probability of label 1 of the whole text.

    A null text scores as an empty one; repeated rows score alike; rows without an
    identifier stay, and an empty table gives an empty result.  A text of any
    length is read whole, in blocks.  ``keep`` may hold any columns but ``score``.
    """
    bound_batches(docs.sparkSession)
    names = (id_col, *keep)
    hidden = free_name("text", names)
    rows = docs.select(*names, F.col(text_col).cast("string").alias(hidden))
    shared = docs.sparkSession.sparkContext.broadcast((model.keys, model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            logits = np.array([own.logit(features(t)) if t is not None else own.bias for t in byte_views(batch.column(hidden))])
            yield pa.record_batch({**{c: batch.column(c) for c in names}, "score": 1 / (1 + np.exp(-logits))})

    from pyspark.sql.types import DoubleType

    schema = docs.select(*names).schema.add("score", DoubleType())
    return rows.mapInArrow(tidy(run), schema)
