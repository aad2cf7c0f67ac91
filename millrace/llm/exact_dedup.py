"""Exact deduplication by content sort.

Sampled splitters range-partition the normalised texts by their bytes, an external
sort in byte order puts equal texts next to each other, and every row is compared
in full with its predecessor.

A splitter holds the beginning of a text, and then its digest and its identifier,
which come into play only among texts that begin alike: so splitters stay small,
and they cut through a group of thousands of copies as readily as between two
groups.  Only the groups at the ends of a partition's range can go on in another
one; their full texts are compared afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import bound_batches, keep, tidy

SPLITTER_CHARS = 64  # of the beginning of a text in a splitter

_RUNS = "id long, keep_id long, group_size long, first boolean, sha string, run long, edge_text string"


def normalised(text):
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class _Runs:
    """The runs of equal neighbours in one partition that is sorted by text and identifier.

    A run's rows are given out once it has ended and its size is known; until then
    only their identifiers are held.
    """

    def __init__(self, base: int):
        self.base, self.run, self.text, self.sha = base, -1, None, None
        self.ids: list[pa.Array] = []
        self.low = self.high = None  # (beginning, digest, run, text)

    def begin(self, text: str, head: str, sha: str) -> None:
        self.run += 1
        self.text, self.sha = text, sha
        if self.low is None or (head, sha) < self.low[:2]:
            self.low = (head, sha, self.run, text)
        if self.high is None or (head, sha) > self.high[:2]:
            self.high = (head, sha, self.run, text)

    def end(self) -> pa.RecordBatch | None:
        """The rows of the run that is open."""
        ids, self.ids = [x for x in self.ids if len(x)], []
        return _rows(pa.concat_arrays(ids), np.array([0]), pa.array([self.sha]), np.array([self.base + self.run])) if ids else None

    def edges(self) -> Iterator[pa.RecordBatch]:
        nothing = {c: pa.nulls(1, pa.int64()) for c in ("id", "keep_id", "group_size")}
        for _, _, run, text in {x[2]: x for x in (self.low, self.high) if x}.values():
            yield pa.record_batch({**nothing, "first": pa.array([False]), "sha": pa.nulls(1, pa.string()), "run": pa.array([self.base + run]), "edge_text": pa.array([text], pa.string())})


def _rows(ids: pa.Array, starts: np.ndarray, shas: pa.Array, runs: np.ndarray) -> pa.RecordBatch:
    """The rows of whole runs that begin at ``starts``; a run's first row has its smallest identifier."""
    sizes = np.diff(np.append(starts, len(ids)))
    first = np.zeros(len(ids), bool)
    first[starts] = True
    spread = pa.array(np.repeat(np.arange(len(starts)), sizes))
    return pa.record_batch({
        "id": ids, "keep_id": ids.take(pa.array(starts)).take(spread), "group_size": np.repeat(sizes, sizes), "first": first,
        "sha": shas.take(spread), "run": np.repeat(runs, sizes), "edge_text": pa.nulls(len(ids), pa.string()),
    })


def _number_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one sorted partition with their run of equal texts, its smallest identifier and its size.

    Besides, two rows that are marked by an ``edge_text`` tell the texts with the
    least and the greatest (beginning, digest): only they can have copies in other
    partitions.
    """
    from pyspark import TaskContext

    runs = _Runs(TaskContext.get().partitionId() << 40)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text, ids = batch.column("norm"), batch.column("id")
        fresh = np.ones(n, bool)
        fresh[0] = runs.text is None or text[0].as_py() != runs.text
        fresh[1:] = pc.not_equal(text.slice(1), text.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(fresh)
        if not len(starts):  # the open run goes on
            runs.ids.append(ids)
            continue
        runs.ids.append(ids.slice(0, int(starts[0])))
        if (done := runs.end()) is not None:
            yield done
        shas = batch.column("sha").take(pa.array(starts))
        before = runs.run + 1
        for at, head, sha in zip(starts.tolist(), batch.column("head").take(pa.array(starts)).to_pylist(), shas.to_pylist(), strict=True):
            runs.begin(text[at].as_py(), head, sha)
        inside = starts[:-1]
        if len(inside):
            low, high = int(inside[0]), int(starts[-1])
            yield _rows(ids.slice(low, high - low), inside - low, shas.slice(0, len(inside)), runs.base + before + np.arange(len(inside)))
        runs.ids.append(ids.slice(int(starts[-1])))
    if (done := runs.end()) is not None:
        yield done
    yield from runs.edges()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after :func:`normalised`; null counts
    as empty, so null and empty texts are one group.  The row with the smallest
    identifier stays (a null identifier sorts last); of rows that repeat text and
    identifier exactly one stays.  A text of any length is one row of the sort.
    Other columns of ``docs`` are not read.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bound_batches(spark, size="4m")  # neighbours are compared batch by batch; large batches would only take memory
    norm = docs.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("norm"))
    keyed = norm.withColumn("head", F.substring("norm", 1, SPLITTER_CHARS)).withColumn("sha", F.sha2("norm", 256))
    last = F.col("id").asc_nulls_last()
    ordered = keyed.repartitionByRange("head", "sha", last).sortWithinPartitions("norm", last)
    rows = keep(ordered.mapInArrow(tidy(_number_runs), _RUNS))

    edges = rows.where(F.col("edge_text").isNotNull()).select("run", "edge_text")
    joined = edges.join(edges.groupBy("edge_text").agg(F.min("run").alias("head")), "edge_text").select("run", "head")
    members = rows.where(F.col("edge_text").isNull())
    # at most two runs of each partition
    spread = members.where("first").join(F.broadcast(joined), "run").select("run", "head", "keep_id", "group_size")
    totals = spread.groupBy("head").agg(F.min("keep_id").alias("all_low"), F.sum("group_size").alias("all_n"))
    spread = spread.select("run", "head").join(totals, "head")
    whole = members.join(F.broadcast(spread), "run", "left")
    return whole.select(
        F.col("id").alias(id_col),
        F.when(F.col("head").isNull(), F.col("keep_id")).otherwise(F.col("all_low")).alias("keep_id"),
        F.coalesce("all_n", "group_size").alias("group_size"),
        (F.col("first") & (F.coalesce("head", "run") == F.col("run"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
