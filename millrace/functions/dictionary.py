"""All occurrences of a dictionary's words in texts, by an Aho-Corasick automaton in arrays.

Edges are a sorted array of (state, character) with a target each; a state's failure
link is the longest end of what was read that begins another word.  Texts are cut
into pieces of one length that overlap by the longest word, and the automaton reads
all pieces of a batch at once, a character of each in a step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 1024  # characters of a text that are read between overlaps
SLICE = 1 << 21  # characters that are read at once
WORDS = 50_000  # words of one automaton; more take another pass over the texts
_CHARACTERS = 1 << 21


@dataclass(frozen=True)
class Automaton:
    words: tuple[str, ...]
    edges: np.ndarray  # state * 2**21 + character, sorted
    targets: np.ndarray
    fail: np.ndarray
    word: np.ndarray  # the word that ends in a state, -1 for none
    shorter: np.ndarray  # the next state along failure links where a word ends, 0 for none
    longest: int

    @classmethod
    def of(cls, words: Iterable[str]) -> Automaton:
        """An automaton of distinct words; empty ones are left out."""
        kept = tuple(dict.fromkeys(w for w in words if w))
        children: list[dict[int, int]] = [{}]
        word = [-1]
        for number, text in enumerate(kept):
            at = 0
            for c in map(ord, text):
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    word.append(-1)
                at = children[at][c]
            word[at] = number
        fail, shorter, layer = [0] * len(children), [0] * len(children), list(children[0].values())
        while layer:
            following = []
            for state in layer:
                for c, to in children[state].items():
                    back = fail[state]
                    while back and c not in children[back]:
                        back = fail[back]
                    fail[to] = children[back].get(c, 0)
                    following.append(to)
                shorter[state] = fail[state] if word[fail[state]] >= 0 else shorter[fail[state]]
            layer = following
        pairs = sorted((state * _CHARACTERS + c, to) for state, own in enumerate(children) for c, to in own.items())
        edges, targets = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
        return cls(kept, edges, targets, np.array(fail), np.array(word), np.array(shorter), max(map(len, kept), default=0))

    def _next(self, state: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The state after a character, along failure links where there is no edge."""
        state = state.copy()
        open_ = np.arange(len(state))
        while len(open_):
            keys = state[open_] * _CHARACTERS + characters[open_].astype(np.int64)
            at = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
            hit = self.edges[at] == keys
            state[open_[hit]] = self.targets[at[hit]]
            missed = open_[~hit]
            open_ = missed[state[missed] > 0]
            state[missed] = self.fail[state[missed]]
        return state

    def find(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, word) of all occurrences, overlapping ones as well; null has none."""
        nothing = (np.zeros(0, np.int64),) * 3
        sizes = np.array([len(t or "") for t in texts], np.int64)
        if not len(self.edges) or not sizes.sum():
            return nothing
        flat = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(sizes) - sizes
        pieces = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(texts)), pieces)
        low = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
        before = np.minimum(low, self.longest - 1)  # read first, so that words across the border are seen; they count in the later piece
        size = before + np.minimum(PIECE, sizes[text] - low)
        order = np.argsort(-size, kind="stable")  # the pieces still open are always the first ones
        text, low, before, size = text[order], low[order], before[order], size[order]
        begin = starts[text] + low - before
        state = np.zeros(len(text), np.int64)
        ends: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for step in range(int(size[0])):
            open_ = int(np.searchsorted(-size, -step))
            state = self._next(state[:open_], flat[begin[:open_] + step])
            hit = np.flatnonzero(((self.word[state] >= 0) | (self.shorter[state] > 0)) & (before[:open_] <= step))
            if len(hit):
                ends.append((text[hit], low[hit] - before[hit] + step + 1, state[hit]))
        if not ends:
            return nothing
        row, end, state = (np.concatenate(x) for x in zip(*ends, strict=True))
        found = []
        while len(row):
            word = self.word[state]
            own = word >= 0
            found.append((row[own], end[own], word[own]))
            state = self.shorter[state]
            more = state > 0
            row, end, state = row[more], end[more], state[more]
        row, end, word = (np.concatenate(x) for x in zip(*found, strict=True))
        return row, end - np.array([len(w) for w in self.words])[word], word


def fewest_parts(size: int, matches: Mapping[int, Sequence[int]]) -> list[int]:
    """The lengths of the parts of a text, as few as can be; ``matches`` has the lengths of known words by their start.

    A part is a known word or one character; of equally few the first part is the longer.
    """
    parts, lengths = [0] * (size + 1), [1] * size
    for at in range(size - 1, -1, -1):
        parts[at] = parts[at + 1] + 1
        for length in sorted(matches.get(at, ())):
            if length > 1 and parts[at + length] + 1 <= parts[at]:
                parts[at], lengths[at] = parts[at + length] + 1, length
    out, at = [], 0
    while at < size:
        out.append(lengths[at])
        at += lengths[at]
    return out


def convert_texts(texts: Sequence[str | None], automaton: Automaton, phrases: Mapping[str, str]) -> list[str | None]:
    """Texts with the automaton's words by their counterparts, cut into as few parts as can be; the rest as it is."""
    rows, starts, words = automaton.find(texts)
    order = np.argsort(rows, kind="stable")
    rows, starts, words = rows[order], starts[order], words[order]
    out: list[str | None] = []
    for i, t in enumerate(texts):
        if t is None:
            out.append(None)
            continue
        matches: dict[int, list[int]] = {}
        for k in range(*np.searchsorted(rows, [i, i + 1])):
            matches.setdefault(int(starts[k]), []).append(len(automaton.words[words[k]]))
        made, at = [], 0
        for length in fewest_parts(len(t), matches):
            piece = t[at : at + length]
            made.append(phrases.get(piece, piece))
            at += length
        out.append("".join(made))
    return out


def convert(text: Column, phrases: Mapping[str, str]) -> Column:
    """:func:`convert_texts` as a column, by a dictionary of phrases, such as traditional to simplified Chinese."""
    automaton, known = Automaton.of(phrases), dict(phrases)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(convert_texts([t if isinstance(t, str) else None for t in texts], automaton, known), index=texts.index, dtype=object)

    return of(text)


def slices(batch: pd.DataFrame, text: str) -> Iterator[pd.DataFrame]:
    """A batch in parts of up to ``SLICE`` characters, or of one longer text."""
    sizes = [len(t) if isinstance(t, str) else 0 for t in batch[text]]
    low = held = 0
    for at, size in enumerate(sizes):
        if at > low and held + size > SLICE:
            yield batch.iloc[low:at]
            low, held = at, 0
        held += size
    yield batch.iloc[low:]


def occurrences(docs: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """(key, word, n): how often each known word is in each text, as a piece of it, overlapping ones counted.

    ``words`` (word) may have any number of rows: each ``WORDS`` of them are an
    automaton, sent to all tasks once, and a pass over the texts.  Repeated, null
    and empty words are left out; texts of any length are read whole.
    """
    spark = docs.sparkSession
    schema = f"`{key}` {dict(docs.dtypes)[key]}, word string, n long"
    result = spark.createDataFrame([], schema)
    names = (r["word"] for r in words.where("word is not null and word <> ''").select("word").distinct().orderBy("word").toLocalIterator())
    while some := [w for _, w in zip(range(WORDS), names, strict=False)]:
        shared = spark.sparkContext.broadcast(Automaton.of(some))

        def count(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            automaton = shared.value
            for batch in batches:
                for part in slices(batch, text):
                    rows, _, found = automaton.find([t if isinstance(t, str) else None for t in part[text]])
                    pairs, n = np.unique(rows * len(automaton.words) + found, return_counts=True)
                    if not len(pairs):
                        continue
                    lines = pairs // len(automaton.words)
                    yield pd.DataFrame({key: part[key].iloc[lines].to_numpy(), "word": [automaton.words[w] for w in pairs % len(automaton.words)], "n": n})

        result = result.unionByName(docs.select(key, text).where(F.col(key).isNotNull()).mapInPandas(count, schema))
    return result
