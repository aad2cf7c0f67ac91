"""Words, hashes and shingles of UTF-8 texts, vectorised over their bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK = 1 << 20  # bytes of a text that are worked on at once

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_tables: dict[str, np.ndarray] = {"power": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables["power"]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("power", np.uint64(_BASE)), ("inverse", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["power"], _tables["inverse"]


def byte_views(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The bytes of each text of a string column without copying; None for null."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield None if valid is not None and not valid[i] else whole[ends[i] : ends[i + 1]]


def as_bytes(text: str | None) -> np.ndarray:
    """The bytes of one text, none for null."""
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def word_spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.flatnonzero(np.diff(is_word.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edges[0::2], edges[1::2]


def not_space(text: np.ndarray) -> np.ndarray:
    """Which bytes are outside [\\x20\\x09-\\x0D]."""
    return ~((text == 32) | ((text >= 9) & (text <= 13)))


class Prefixes:
    """Hashes of any spans of one block of text, each in constant time; for features, as equal hashes can be constructed."""

    def __init__(self, text: np.ndarray):
        power, self._inverse = _powers(len(text) + 1)
        self._sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[: len(text)], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def blocks(text: np.ndarray, inside: Callable[[np.ndarray], np.ndarray], size: int = BLOCK) -> Iterator[np.ndarray]:
    """The text in order in blocks of about ``size`` bytes, none of which ends within a run of bytes that are ``inside``."""
    start, n = 0, len(text)
    while start < n:
        end = min(start + size, n)
        while end < n:
            found = np.flatnonzero(~inside(text[end : end + 4096]))
            if len(found):
                end += int(found[0])
                break
            end = min(end + 4096, n)
        yield text[start:end]
        start = end


def word_hash_blocks(text: np.ndarray, lower: bool = False) -> Iterator[np.ndarray]:
    """A 64-bit hash of every white-space separated word, in order, block by block.

    Only a block's words are ever held as objects.  ``lower`` takes A-Z as a-z.
    """
    for block in blocks(text, not_space):
        raw = block.tobytes()
        words = (raw.lower() if lower else raw).split()  # of bytes: ASCII letters and [\x20\x09-\x0D] only
        yield np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_hashes(text: np.ndarray, lower: bool = False) -> np.ndarray:
    """All hashes of :func:`word_hash_blocks`."""
    return np.concatenate([*word_hash_blocks(text, lower), np.zeros(0, np.uint64)])


def _windows(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = mix(total + words[i : n + i])
    return total


def shingles(parts: Iterable[np.ndarray], k: int) -> np.ndarray:
    """The distinct k-word shingles of the words that come in parts, sorted.

    A shorter text is one shingle, none is empty.
    """
    found, tail = [], np.zeros(0, np.uint64)
    for part in parts:
        words = np.concatenate([tail, part])
        if len(words) >= k:
            found.append(np.unique(_windows(words, k)))
            words = words[len(words) - k + 1 :]
        tail = words
    if not found:
        return _windows(tail, len(tail)) if len(tail) else tail
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))
