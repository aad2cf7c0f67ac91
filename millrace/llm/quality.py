"""Quality by nearest-neighbour voting over latent-semantic vectors.

A document's terms are pairs of neighbouring character classes and the repeats of
its words and lines, so the vectors tell how a text is written in any language.
Weighted terms of a bounded, hash-chosen sample of labelled texts give the latent
directions (a singular value decomposition); the sample's vectors are broadcast.
Every document meets all of them in blocks of exact cosine products, and the
labels of its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.bytewords import BLOCK, as_bytes, byte_views, word_hashes
from millrace.llm.scratch import bound_batches, free_name, tidy

SAMPLE = 4_000  # labelled vectors that are broadcast, at most: 4,000 x 48 x 4 bytes
DIMENSIONS = 48
NEIGHBOURS = 10
SHARPNESS = 16.0  # a neighbour's vote is its cosine to this power
REPEAT_BLOCK = 256  # words within which repeats are counted

_OWN_CLASS = b" \n.,|#$%*&!?@/\\_-=<>\"'()[]{}:;~^+"
_CLASS_OF = np.zeros(256, np.int64)
for _i, _byte in enumerate(_OWN_CLASS):
    _CLASS_OF[_byte] = _i + 5
_CLASS_OF[97:123], _CLASS_OF[65:91], _CLASS_OF[48:58], _CLASS_OF[128:] = 1, 2, 3, 4
CLASSES = len(_OWN_CLASS) + 5
TERMS = CLASSES * CLASSES + 4


def _repeats(words: np.ndarray) -> float:
    """The share of words that occurred before in their block of ``REPEAT_BLOCK``, over the whole text.

    Blocks keep the share from growing with the length of the text; a last, shorter
    one counts by its words.
    """
    block = np.arange(len(words)) // REPEAT_BLOCK
    order = np.lexsort((words, block))
    words, block = words[order], block[order]
    return float(np.count_nonzero((words[1:] == words[:-1]) & (block[1:] == block[:-1]))) / len(words)


def terms(text: np.ndarray) -> np.ndarray:
    """How often each term occurs for each character (the last four: for each word or line)."""
    found = np.zeros(TERMS, np.float32)
    if not len(text):
        found[-1] = 1  # so that an empty text has a direction
        return found
    pairs = np.zeros(CLASSES * CLASSES, np.int64)
    for low in range(0, len(text), BLOCK):
        classes = _CLASS_OF[text[low : low + BLOCK + 1]]
        pairs += np.bincount(classes[:-1] * CLASSES + classes[1:], minlength=CLASSES * CLASSES)
    found[:-4] = pairs / max(len(text) - 1, 1)
    words = word_hashes(text)
    if len(words):
        found[-4] = np.mean(words[1:] == words[:-1]) if len(words) > 1 else 0
        found[-3] = _repeats(words)
    lines = [line for line in text.tobytes().split(b"\n") if line]
    if len(lines) > 1:
        found[-2] = 1 - len(set(lines)) / len(lines)
    found[-1] = 1 / (1 + len(text) / 50)
    return found


@dataclass
class Neighbours:
    """The latent directions and the labelled vectors."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        latent = (np.sqrt(counts) * self.weights) @ self.directions
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def vote(self, counts: np.ndarray, k: int = NEIGHBOURS, block: int = 256) -> np.ndarray:
        scores = np.full(len(counts), 0.5)
        if not len(self.vectors):
            return scores
        k = min(k, len(self.vectors))
        for low in range(0, len(counts), block):
            cosines = self.embed(counts[low : low + block]) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6) ** SHARPNESS
            scores[low : low + block] = (votes * self.labels[near]).sum(axis=1) / votes.sum(axis=1)
        return scores


def _sparse_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms that are not zero, as 16-bit places and 32-bit values."""
    nothing = np.zeros(0, np.uint8)
    for batch in batches:
        found = [terms(nothing if t is None else t) for t in byte_views(batch.column("text"))]
        places = [np.flatnonzero(x).astype(np.int16) for x in found]
        values = [x[at].tobytes() for x, at in zip(found, places, strict=True)]
        yield pa.record_batch({"id": batch.column("id"), "label": batch.column("label"), "places": pa.array([x.tobytes() for x in places], pa.binary()), "values": pa.array(values, pa.binary())})


def learn(sample: DataFrame) -> Neighbours:
    """:func:`fit` to a labelled sample (id, text, label) whose terms are counted on the executors.

    The driver gets no texts, only the terms that occur: some kilobytes for each row.
    """
    bound_batches(sample.sparkSession)
    rows = sample.mapInArrow(tidy(_sparse_terms), "id long, label int, places binary, values binary").toArrow().sort_by("id")
    counts = np.zeros((rows.num_rows, TERMS), np.float32)
    for line, (places, values) in enumerate(zip(rows.column("places").to_pylist(), rows.column("values").to_pylist(), strict=True)):
        counts[line, np.frombuffer(places, np.int16)] = np.frombuffer(values, np.float32)
    return _fit(counts, rows.column("label").to_pylist(), DIMENSIONS)


def fit(texts: list[str | None], labels: list[int], dimensions: int = DIMENSIONS) -> Neighbours:
    """Learn the directions from labelled texts; without any, every score is 0.5."""
    return _fit(np.array([terms(as_bytes(t)) for t in texts], np.float32).reshape(-1, TERMS), labels, dimensions)


def _fit(counts: np.ndarray, labels: list[int], dimensions: int) -> Neighbours:
    spread = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
    weights = spread.astype(np.float32)
    weights[-4:-1] *= 2
    _, _, directions = np.linalg.svd(np.sqrt(counts) * weights, full_matrices=False)
    model = Neighbours(weights, directions[:dimensions].T.copy(), np.zeros((0, dimensions), np.float32), np.array(labels, np.float32))
    model.vectors = model.embed(counts)
    return model


def score(docs: DataFrame, model: Neighbours, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs``' id_col and ``keep`` columns with ``score``, how likely label 1 is for the whole text.

    A null text scores as an empty one; repeated rows score alike; rows without an
    identifier stay, and an empty table gives an empty result.  A text of any
    length is read whole, in blocks.  ``keep`` may hold any columns but ``score``.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import DoubleType

    bound_batches(docs.sparkSession)
    names = (id_col, *keep)
    hidden = free_name("text", names)
    rows = docs.select(*names, F.col(text_col).cast("string").alias(hidden))
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.directions, model.vectors, model.labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Neighbours(*shared.value)
        nothing = np.zeros(0, np.uint8)
        for batch in batches:
            counts = np.array([terms(nothing if t is None else t) for t in byte_views(batch.column(hidden))], np.float32).reshape(-1, TERMS)
            yield pa.record_batch({**{c: batch.column(c) for c in names}, "score": own.vote(counts).astype(np.float64)})

    return rows.mapInArrow(tidy(run), docs.select(*names).schema.add("score", DoubleType()))
