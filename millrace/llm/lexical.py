"""Ranked lexical search in a bit-sliced impact index.

1. :func:`build` reads each text once and writes the index: blocks of documents,
   and for each block and term the places of the documents that hold it with its
   counts.  All documents and all terms are in it; no posting is shuffled.
2. A group of items asks for its terms.  Their document frequencies are sums over
   blocks, and the number of documents and terms sums over block headers.
3. The postings of the asked terms meet by block.  There the impacts of a term
   become bit slices: one bitmap of the block's documents for each binary digit.
   An item's score is the sum of its terms' slices: carry-save steps (sum and
   carry by bitwise operations on whole slices) until two numbers are left, then
   one addition from the lowest slice up with a rippling carry.
4. From the most significant slice down, the candidates are narrowed until the k
   highest are found.  A task carries each item's k best over all of its blocks.

Items are taken in groups of a fixed number of terms, so what is broadcast is
bounded.  Blocks are bounded by documents and postings, so a task holds one block's
postings of the asked terms, and no term, however frequent, is gathered in one place.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bytewords import blocks, byte_views
from millrace.llm.scratch import bound_batches, cut, store, tidy

K = 20
DOCUMENTS, POSTINGS = 1 << 14, 1 << 20  # a block is full at so many documents or postings
TERMS = 100_000  # (item, term) pairs broadcast at once, or one item's
_INDEX = "block long, term string, places array<int>, counts array<int>, ids array<long>, lengths array<long>"
_FOUND = "item int, doc_id long, score long"
_NO_ID = (1 << 63) - 1  # sorts a document without identifier last

# A-Z in lower case, other letters, digits and all bytes of longer characters as they are, the rest a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INSIDE = np.array([b != 32 for b in _FOLD])


def count_terms(text: np.ndarray) -> Counter[bytes]:
    """How often each term is in a text, given as bytes; only one block's terms are held as objects with repeats."""
    found: Counter[bytes] = Counter()
    for block in blocks(text, lambda some: _INSIDE[some]):
        found.update(block.tobytes().translate(_FOLD).split())
    return found


class _Block:
    """The postings of one block while it fills."""

    def __init__(self, number: int):
        self.number = number
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__  # a new term gets the next number
        self.ids, self.lengths, self.terms, self.counts, self.postings = [], [], [], [], 0

    def add(self, doc_id: int | None, found: Counter[bytes]) -> None:
        self.terms.append(np.fromiter(map(self.vocabulary.__getitem__, found), np.int32, len(found)))
        self.counts.append(np.fromiter(found.values(), np.int32, len(found)))
        self.ids.append(doc_id)
        self.lengths.append(int(self.counts[-1].sum(dtype=np.int64)))
        self.postings += len(found)

    def full(self) -> bool:
        return len(self.ids) >= DOCUMENTS or self.postings >= POSTINGS

    def rows(self, size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        """A header with identifiers and lengths, then a row for each term."""
        names, places = list(self.vocabulary), np.repeat(np.arange(len(self.ids), dtype=np.int32), [len(t) for t in self.terms])
        terms, counts = np.concatenate(self.terms), np.concatenate(self.counts)
        order = np.argsort(terms, kind="stable")
        places, counts = places[order], counts[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(names)))])
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        header = {"block": [self.number], "term": pa.array([None], pa.string()), "places": pa.array([None], ints), "counts": pa.array([None], ints), "ids": pa.array([self.ids], longs), "lengths": pa.array([self.lengths], longs)}
        yield pa.record_batch(header)
        low = 0
        while low < len(names):
            high = min(len(names), low + 1000, max(low + 1, int(np.searchsorted(ends, ends[low] + size))))
            part, n = slice(ends[low], ends[high]), high - low
            own = pa.array((ends[low : high + 1] - ends[low]).astype(np.int32))
            yield pa.record_batch(
                {
                    "block": np.full(n, self.number),
                    "term": pa.array(names[low:high], pa.binary()).cast(pa.string()),
                    "places": pa.ListArray.from_arrays(own, pa.array(places[part])),
                    "counts": pa.ListArray.from_arrays(own, pa.array(counts[part])),
                    "ids": pa.nulls(n, longs),
                    "lengths": pa.nulls(n, longs),
                }
            )
            low = high


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = itertools.count(TaskContext.get().partitionId() << 32)
    block = _Block(next(numbers))
    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), byte_views(batch.column("text")), strict=True):
            if text is None or not (found := count_terms(text)):
                continue
            block.add(doc_id, found)
            if block.full():
                yield from block.rows()
                block = _Block(next(numbers))
    if block.ids:
        yield from block.rows()


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all terms of all documents, written to the shared folder.

    Rows: (block, term, places, counts) for each term of a block, and one without
    a term for each block, with its documents' identifiers and lengths.  Texts
    without terms, null ones among them, can't be found and have no place.
    """
    bound_batches(docs.sparkSession, rows=500, size="16m")
    return store(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(_index), _INDEX), "lexical")


# bit slices: row b of an array holds, as a bitmap over the block's documents, digit b of their numbers


def _turn(words: np.ndarray) -> np.ndarray:
    """Transposes the 64 x 64 bits of each column: digit b of word j becomes digit j of word b."""
    by, mask = 32, (1 << 32) - 1
    while by:
        pairs = words.reshape(-1, 2, by, words.shape[1])
        upper, lower = pairs[:, 0], pairs[:, 1]
        swapped = (upper >> np.uint64(by) ^ lower) & np.uint64(mask)
        upper ^= swapped << np.uint64(by)
        lower ^= swapped
        by >>= 1
        mask ^= mask << by & (1 << 64) - 1
    return words


def to_slices(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Numbers at some places of a block, in rising order, as bit slices of 64-bit words."""
    digits = max(1, int(values.max(initial=0)).bit_length())
    words = places // 64
    first = np.ones(len(words), bool)
    first[1:] = words[1:] != words[:-1]
    dense = np.zeros((64, int(first.sum())), "<u8")
    dense[places % 64, np.cumsum(first) - 1] = values
    slices = np.zeros((digits, -(-size // 64)), "<u8")
    slices[:, words[first]] = _turn(dense)[:digits]
    return slices


def _raised(slices: np.ndarray, by: int, digits: int) -> np.ndarray:
    """The numbers times 2**by, in so many digits."""
    out = np.zeros((digits, slices.shape[1]), "<u8")
    n = min(len(slices), digits - by)
    out[by : by + n] = slices[:n]
    return out


def add_slices(numbers: list[np.ndarray], digits: int) -> np.ndarray:
    """The sums, place by place, of several bit-sliced numbers; they have to fit in ``digits``."""
    total = _raised(numbers[0], 0, digits)
    if len(numbers) == 1:
        return total
    carry = _raised(numbers[1], 0, digits)
    for number in numbers[2:]:  # carry-save: three numbers become two
        n = len(number)
        low_total, low_carry = total[:n], carry[:n]
        odd = low_total ^ low_carry
        more = np.zeros_like(total)
        top = min(n, digits - 1)
        more[1 : top + 1] = (low_total & low_carry | number & odd)[:top]
        if n < digits:
            more[n + 1 :] = (total[n:] & carry[n:])[: digits - n - 1]
            total[n:] ^= carry[n:]
        total[:n] = odd ^ number
        carry = more
    ripple = np.zeros(total.shape[1], "<u8")
    for b in range(digits):
        odd = total[b] ^ carry[b]
        ripple, total[b] = total[b] & carry[b] | odd & ripple, odd ^ ripple
    return total


def best(slices: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that are among the k highest for certain, and those that tie for what is left; zeros are in neither."""
    sure = np.zeros(slices.shape[1], "<u8")
    open_ = np.bitwise_or.reduce(slices, axis=0)
    if int(np.bitwise_count(open_).sum()) > k:
        for digit in slices[::-1]:
            higher = sure | open_ & digit
            n = int(np.bitwise_count(higher).sum())
            if n > k:
                open_ = open_ & digit
            else:
                sure, open_ = higher, open_ & ~digit
                if n == k:
                    open_ = np.zeros_like(open_)
                    break
    return tuple(np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little")) for x in (sure, open_))


def values_at(slices: np.ndarray, places: np.ndarray) -> np.ndarray:
    digits = slices[:, places // 64] >> (places % 64).astype("<u8") & np.uint64(1)
    return (digits.astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0)


@dataclass(frozen=True)
class Group:
    """Some items, as (term number, count) lists, and what their terms weigh."""

    items: list[list[tuple[int, int]]]
    weights: list[int]
    n: int
    length: int


def impacts(weight: int, counts: np.ndarray, lengths: np.ndarray, group: Group) -> np.ndarray:
    """A term's share in the scores of documents that hold it so many times and have so many terms."""
    wide = object if 25 * group.n * int(lengths.max(initial=0)) >= 1 << 63 else np.int64
    m = (75 + (25 * lengths.astype(wide) * group.n) // group.length).astype(np.int64)
    tf = counts.astype(np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class _Best:
    """The k best (highest score, then smallest identifier) documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.held = k, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * items

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = (np.concatenate(x) for x in zip(self.held[item], (ids, scores), strict=True))
        order = np.lexsort((ids, -scores))[: self.k]
        self.held[item] = ids[order], scores[order]

    def batch(self) -> pa.RecordBatch:
        items = np.repeat(np.arange(len(self.held), dtype=np.int32), [len(ids) for ids, _ in self.held])
        ids, scores = (np.concatenate([h[i] for h in self.held] or [np.zeros(0, np.int64)]) for i in (0, 1))
        return pa.record_batch({"item": items, "doc_id": pa.array(ids, mask=ids == _NO_ID), "score": scores})


def _rank(ids: np.ndarray, lengths: np.ndarray, postings: dict[int, tuple[np.ndarray, np.ndarray]], group: Group, found: _Best) -> None:
    """Adds one block's results."""
    made, highest = {}, {}
    for term, (places, counts) in postings.items():
        values = impacts(group.weights[term], counts, lengths[places], group)
        highest[term] = int(values.max(initial=0))
        if highest[term]:
            made[term] = to_slices(places, values, len(ids))
    for item, terms in enumerate(group.items):
        own = [(t, n) for t, n in terms if t in made]
        if not own:
            continue
        digits = sum(n * highest[t] for t, n in own).bit_length()
        if digits > 63:
            raise OverflowError("a score does not fit in 64 bits")
        numbers = [made[t] if not by else _raised(made[t], by, min(digits, len(made[t]) + by)) for t, n in own for by in range(n.bit_length()) if n >> by & 1]
        scores = add_slices(numbers, digits)
        sure, tied = best(scores, found.k)
        tied = tied[np.argsort(ids[tied], kind="stable")[: found.k - len(sure)]]
        places = np.concatenate([sure, tied])
        found.add(item, ids[places], values_at(scores, places))


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        found, block, ids, lengths, postings = _Best(len(group.items), k), None, None, None, {}
        for batch in batches:
            for at, (number, term) in enumerate(zip(batch.column("block").to_pylist(), batch.column("number").to_pylist(), strict=True)):
                if number != block:
                    if postings:
                        _rank(ids, lengths, postings, group, found)
                    block, postings = number, {}
                if term is None:  # the header comes first
                    ids = batch.column("ids")[at].values.fill_null(_NO_ID).to_numpy()
                    lengths = batch.column("lengths")[at].values.to_numpy()
                else:
                    postings[term] = tuple(batch.column(c)[at].values.to_numpy().copy() for c in ("places", "counts"))
        if postings:
            _rank(ids, lengths, postings, group, found)
        yield found.batch()

    return run


def _groups(items: DataFrame) -> Iterator[list[tuple[int | None, Counter[bytes]]]]:
    """(identifier, terms) of the items, in groups of a bounded number of terms; one group is held at a time."""

    def numbered() -> Iterable[tuple[int | None, Counter[bytes]]]:
        rows = items.orderBy(F.col("id").asc_nulls_last()).toLocalIterator()
        for key, same in itertools.groupby(rows, lambda r: r["id"]):
            yield key, sum((count_terms(np.frombuffer((r["text"] or "").encode(), np.uint8)) for r in same), Counter())

    group, size = [], 0
    for key, terms in numbered():
        if group and size + len(terms) > TERMS:
            yield group
            group, size = [], 0
        if terms:
            group.append((key, terms))
            size += len(terms)
    if group:
        yield group


def search(index: DataFrame, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The k highest-scoring documents of each item: id_col, rank (from 1), doc_id, score.

    Only scores above 0 count; equal scores go by the smaller identifier, documents
    without one last.  Rows that share a document identifier are documents of their
    own.  Rows of ``items`` that are repeated count once; rows that share an
    identifier (null is one) but not their text are one item with the terms of all.
    Items without terms, null texts among them, and an empty index have no result.
    Texts may be of any length; a score beyond 64 bits is an error.
    """
    spark = index.sparkSession
    bound_batches(spark, rows=500, size="16m")
    n, length = index.where("term is null").select(F.explode("lengths").alias("n")).agg(F.count("n"), F.sum("n")).first()
    asked = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).distinct()
    results = spark.createDataFrame([], f"{id_col} long, rank int, doc_id long, score long")
    for group in _groups(asked) if n else ():
        found = _answer(index, group, n, length, k)
        keys = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(group)], f"item int, {id_col} long")
        results = results.unionByName(found.join(F.broadcast(keys), "item").select(id_col, "rank", "doc_id", "score"))
    return results


def _answer(index: DataFrame, group: list[tuple[int | None, Counter[bytes]]], n: int, length: int, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of one group's items, written to the shared folder."""
    spark = index.sparkSession
    numbers = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in group for t in terms))}
    words = F.broadcast(spark.createDataFrame(pa.table({"term": pa.array(list(numbers), pa.binary()).cast(pa.string()), "number": np.arange(len(numbers), dtype=np.int32)})))
    df = index.join(words, "term").groupBy("number").agg(F.sum(F.size("places")).cast("double").alias("df"))
    weigh = F.floor(1000 * F.ln(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = [0] * len(numbers)
    for row in df.select("number", weigh.alias("weight")).collect():  # a group's terms at most
        weights[row["number"]] = row["weight"]
    items = [[(numbers[t], count) for t, count in terms.items() if weights[numbers[t]]] for _, terms in group]
    shared = spark.sparkContext.broadcast(Group(items, weights, n, length))
    rows = index.join(words, "term", "left").where("number is not null or term is null").drop("term")
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("number").asc_nulls_first())
    found = dealt.select("block", "number", "places", "counts", "ids", "lengths").mapInArrow(tidy(_search(shared, k)), _FOUND)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return cut(found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k))
