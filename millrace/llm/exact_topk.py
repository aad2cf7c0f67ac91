"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are dealt to ``lists`` score lists; a pair's score is the
sum of its partial scores, one from each list.

1. Each partition reports, for each query and list, the entries with the highest
   partial scores, with their sums.  The k-th best of a query's sums is a score
   that k vectors reach, so it is a safe cutoff.
2. The cutoffs are broadcast.  An entry that reaches the cutoff has a partial
   score of at least cutoff / lists in some list; each list gives just the entries
   that do, and passes by those whose length can't reach it.
3. For those entries, and no others, the partial scores that their lists did not
   give are resolved, one pair at a time; what reaches the cutoff is ranked.

Products are exact: in floating point where all sums are below 2**53, else in
64-bit integers, else in Python's.

Copies of one vector are one entry that carries its k + 1 smallest identifiers.
Queries are taken in blocks of a fixed size, so what is broadcast doesn't grow
with the data; every block meets all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.scratch import bound_batches, cut, keep, tidy

BLOCK = 4096  # queries broadcast at once: 4096 x dimensions x 8 bytes
SALTS = 32
_ENTRY = "query long, id long, score long"


def quantised(vector):
    """floor(256 * x) of each component; null for a vector that takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(wide, lambda x: F.floor(x * 256).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def _matrix(column: pa.Array, width: int = 1) -> np.ndarray:
    """Rows of a list column as 64-bit integers, filled up with zeros to one width."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(int(lengths.max(initial=0)), width)), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))


def _pair(queries: np.ndarray, entries: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Both with one width, and as a type in which sums of products, ``lists`` times over, are exact."""
    wide = max(queries.shape[1], entries.shape[1])
    bound = _largest(queries) * _largest(entries) * wide * lists
    kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
    return tuple(np.pad(x, ((0, 0), (0, wide - x.shape[1]))).astype(kind) for x in (queries, entries))


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths, a little too large rather than too small."""
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)


def _expand(query_ids: np.ndarray, lines: np.ndarray, entries: np.ndarray, scores: np.ndarray, ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of each copy behind the entries, without the query itself."""
    starts = ids.offsets.to_numpy()
    counts = np.diff(starts)[entries]
    flat = ids.values.to_numpy()
    at = np.repeat(starts[entries] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    query, found, score = np.repeat(query_ids[lines], counts), flat[at], np.repeat(scores, counts)
    other = query != found
    return query[other], found[other], score[other]


def _long(score: np.ndarray) -> np.ndarray:
    if score.dtype == object and len(score) and max(map(abs, score)) >= 1 << 63:
        raise OverflowError("a score does not fit in 64 bits")
    return score.astype(np.int64)


class _Best:
    """The k best (score, then smallest id) entries of each query in one partition."""

    def __init__(self, k: int):
        self.k, self.parts = k, []

    def add(self, query: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((query, found, _long(score)))
        if sum(len(p[0]) for p in self.parts) > 500_000:
            self.parts = [self.cut()]

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        query, found, score = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((found, -score, query))
        query, found, score = query[order], found[order], score[order]
        fresh = np.ones(len(query), bool)  # an entry may come from several lists
        fresh[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1]) | (score[1:] != score[:-1])
        query, found, score = query[fresh], found[fresh], score[fresh]
        first = np.searchsorted(query, query)
        top = np.arange(len(query)) - first < self.k
        return query[top], found[top], score[top]

    def batch(self) -> pa.RecordBatch:
        query, found, score = self.cut()
        return pa.record_batch({"query": query, "id": found, "score": score})


def _first(queries: np.ndarray, entries: np.ndarray, lists: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase one: (query, entry, score) of the k + 1 best entries of each list and query."""
    parts = [queries[:, i::lists] @ entries[:, i::lists].T for i in range(lists)]
    deep = min(k + 1, len(entries))
    tops = [np.argpartition(-p, deep - 1, axis=1)[:, :deep] for p in parts]
    lines = np.repeat(np.arange(len(queries)), deep * lists)
    found = np.concatenate(tops, axis=1).ravel()
    return lines, found, sum(p[lines, found] for p in parts)


def _sufficient(queries: np.ndarray, entries: np.ndarray, cutoffs: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phase two: (query, entry, known score, lists that know it as bits) of the entries that are sufficient in some list."""
    n, codes, known, bits = len(entries), [], [], []
    for i in range(lists):
        own, theirs = queries[:, i::lists], entries[:, i::lists]
        # only entries long enough for the query that asks the least
        far = _norms(own)
        asked = cutoffs.astype(np.float64) / lists
        least = min(np.min(asked[far > 0] / far[far > 0], initial=np.inf), -np.inf if (asked[far == 0] <= 0).any() else np.inf)
        near = np.flatnonzero(_norms(theirs) >= least)
        parts = own @ theirs[near].T
        lines, at = np.nonzero(parts * lists >= cutoffs[:, None])
        codes.append(lines * n + near[at])
        known.append(parts[lines, at])
        bits.append(np.full(len(lines), 1 << i))
    codes, where = np.unique(np.concatenate(codes), return_inverse=True)
    score, seen = np.zeros(len(codes), queries.dtype), np.zeros(len(codes), np.int64)
    np.add.at(score, where, np.concatenate(known))
    np.add.at(seen, where, np.concatenate(bits))
    return codes // max(n, 1), codes % max(n, 1), score, seen


def _resolve(queries: np.ndarray, entries: np.ndarray, lines: np.ndarray, at: np.ndarray, score: np.ndarray, seen: np.ndarray, lists: int, most: int = 100_000) -> np.ndarray:
    """Phase three: the scores with the partial scores that are missing."""
    score = score.copy()
    for i in range(lists):
        missing = np.flatnonzero(seen >> i & 1 == 0)
        for low in range(0, len(missing), most):
            some = missing[low : low + most]
            score[some] += (queries[lines[some], i::lists] * entries[at[some], i::lists]).sum(axis=1)
    return score


def _phase(shared, k: int, lists: int, slices: int = 256):
    """Phase one without cutoffs, phases two and three with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, cutoffs = shared.value
        best = _Best(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            asked, entries = _pair(queries, _matrix(batch.column("vector")), lists)
            for low in range(0, len(query_ids), slices):
                some = asked[low : low + slices]
                if cutoffs is None:
                    lines, at, scores = _first(some, entries, lists, k)
                else:
                    own = cutoffs[low : low + slices]
                    lines, at, scores, seen = _sufficient(some, entries, own, lists)
                    scores = _resolve(some, entries, lines, at, scores, seen, lists)
                    enough = scores >= own[lines]
                    lines, at, scores = lines[enough], at[enough], scores[enough]
                best.add(*_expand(query_ids[low : low + slices], lines, at, scores, batch.column("ids")))
        yield best.batch()

    return run


def _ranked(entries: DataFrame) -> DataFrame:
    return entries.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = 2, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """The k rows of ``vectors`` with the highest scores for each row of ``queries``.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller
    identifier; a query's own identifier is never its result.  A score is the
    inner product of the :func:`quantised` vectors; the shorter of two vectors
    counts as filled up with zeros.  Vectors that are null or hold a null or
    non-finite component, and rows without an identifier, take no part.  Rows that
    repeat identifier and vector count once.  Fewer than k candidates give them
    all; no query or no candidate gives an empty result.  Vectors may be of any
    length; a score that does not fit in 64 bits is an error.
    """
    spark = vectors.sparkSession
    bound_batches(spark, rows=2000)

    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("vector")).where("id is not null and vector is not null")

    salted = usable(vectors).withColumn("print", F.xxhash64("vector")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    by_copy = Window.partitionBy("vector", "print", "salt").orderBy("id")
    few = salted.dropDuplicates(["id", "vector", "print", "salt"]).withColumn("place", F.row_number().over(by_copy)).where(F.col("place") <= k + 1)
    entries = few.groupBy("vector", "print").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))
    entries = keep(entries.select("vector", "ids"))
    asked = keep(usable(queries).dropDuplicates(["id"]))

    results, after = None, None
    while True:
        more = asked if after is None else asked.where(F.col("id") > after)
        head = more.orderBy("id").limit(block).toArrow().combine_chunks()
        if head.num_rows:
            found = _answer(spark, entries, head, k, lists)
            results = found if results is None else results.unionByName(found)
            after = head.column("id")[-1].as_py()
        if head.num_rows < block:
            break
    if results is None:
        results = spark.createDataFrame([], "query long, rank int, id long, score long")
    return results.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _answer(spark, entries: DataFrame, head: pa.Table, k: int, lists: int) -> DataFrame:
    """The results for one block of queries, written to the shared folder."""
    head = head.to_batches()[0]
    ids, matrix = head.column("id").to_numpy(), _matrix(head.column("vector"))
    shared = spark.sparkContext.broadcast((ids, matrix, None))
    gathered = entries.mapInArrow(tidy(_phase(shared, k, lists)), _ENTRY)
    kth = {r["query"]: r["score"] for r in _ranked(gathered).where(F.col("rank") == k).select("query", "score").collect()}
    cutoffs = np.array([kth.get(q, -(1 << 62)) for q in ids.tolist()], np.int64)
    shared = spark.sparkContext.broadcast((ids, matrix, cutoffs))
    enough = entries.mapInArrow(tidy(_phase(shared, k, lists)), _ENTRY)
    return cut(_ranked(enough).where(F.col("rank") <= k))
