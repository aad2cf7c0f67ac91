"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

Every text is sketched once: the distinct k-word shingles of the whole text get
correlated permutation ranks (element ``x`` draws one rank in [0, 1), then one in
[1, 2) at another place, and so on), so a signature has less variance than
independent minima have, and a level is only drawn while some place is empty.

Texts with the same shingle set collapse to one representative before banding.
Representatives that share a band are compared on their full shingle sets:
first each with the bucket leader it shares most bands with, then every pair of
one bucket that is still in different groups and that an upper bound of its
similarity allows.  A pair of one group needs no comparison, as it can't change
the result.  No bucket is capped, and no task ever holds one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import byte_views, mix, shingles, word_hash_blocks
from millrace.llm.scratch import bound_batches, cut, keep, tidy

WORDS = 16  # 64-bit words of a node's bitmap
BUCKET = 2_000  # open members of a bucket that one task holds; larger buckets are dealt to several
MOST_BROADCAST = 100_000  # large buckets, of 12 bytes each; more are joined by shuffling
BANDS, ROWS = 32, 5  # a pair at similarity 0.8 is missed with probability (1 - 0.8**5)**32 = 3e-6


def superminhash(elements: np.ndarray, m: int, chunk: int = 1 << 16) -> np.ndarray:
    """The SuperMinHash signature of a set of distinct 64-bit hashes.

    All elements draw level after level together.  A level's values are above
    those of all earlier levels, so the drawing ends as soon as every place is
    filled; for sets much larger than ``m`` that is after the first level, which
    goes through the elements in chunks.
    """
    signature = np.full(m, np.uint64(0xFFFFFFFFFFFFFFFF))

    def draws(level: int, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        draw = mix(some + np.uint64((level + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        return (level + (draw >> np.uint64(32)) % np.uint64(m - level)).astype(np.int64), np.uint64(level << 32) | (draw & np.uint64(0xFFFFFFFF))

    for low in range(0, len(elements), chunk):
        np.minimum.at(signature, *draws(0, elements[low : low + chunk]))
    if int(signature.max()) < 1 << 32 or not len(elements):
        return signature
    lines, first = np.arange(len(elements)), draws(0, elements)[0]
    order = np.tile(np.arange(m, dtype=np.int16), (len(elements), 1))  # the permutations after the first level's swap
    order[:, 0], order[lines, first] = first, 0
    for level in range(1, m):
        place, value = draws(level, elements)
        held = order[lines, place]
        order[lines, place] = order[:, level]
        np.minimum.at(signature, held.astype(np.int64), value)
        if int(signature.max()) < (level + 1) << 32:
            break
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of the signature."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    grid = signature.reshape(bands, rows)
    for i in range(rows):
        keys = mix(keys + grid[:, i])
    return keys.view(np.int64)


def text_shingles(text: np.ndarray | None, k: int) -> np.ndarray:
    return shingles(word_hash_blocks(text, lower=True), k) if text is not None else np.zeros(0, np.uint64)


def _fingerprint(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements, digest_size=16).digest()


def _sketch(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, keys = [], [], []
            for text in byte_views(batch.column("text")):
                found = text_shingles(text, k)
                sizes.append(len(found))
                prints.append(_fingerprint(found) if len(found) else None)
                keys.append(band_keys(superminhash(found, bands * rows), bands, rows) if len(found) else None)
            yield pa.record_batch({"id": batch.column("id"), "n": pa.array(sizes, pa.int64()), "fp": pa.array(prints, pa.binary()), "bands": pa.array(keys, pa.list_(pa.int64()))})

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_shingles(text, k).tobytes() for text in byte_views(batch.column("text"))]
            yield pa.record_batch({"node": batch.column("node"), "elements": pa.array(found, pa.binary())})

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist(), strict=True):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * common >= percent * (len(one) + len(two) - common))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))

    return run


def _members_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each element of each set."""
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column("elements").to_pylist()]
        sizes = [len(x) for x in sets]
        flat = np.concatenate([*sets, np.zeros(0, np.int64)])
        yield pa.record_batch({"node": np.repeat(batch.column("node").to_numpy(), sizes), "label": np.repeat(batch.column("label").to_numpy(), sizes), "element": flat})


def _open_pairs(rows: DataFrame, elements: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of one bucket and different labels that may be similar enough.

    A pair is made in the first band it shares, and only if an upper bound of its
    intersection allows the link.  An element that no node of another label has
    can't be common; of the others each node keeps a bitmap of 1,024 cells, and a
    cell that one node has and the other hasn't hides one element at least that
    isn't common.  The bound never falls short, so no link is lost.

    A bucket of many open members is cut into parts of about ``BUCKET``: each member
    is the first of a pair in one part and meets all parts as the second, so a task
    holds one part and passes the other members by.
    """
    nodes = rows.select("node", "label").distinct()
    parts = cut(elements.join(nodes, "node").mapInArrow(tidy(_members_of_sets), "node long, label long, element long"))
    shared = parts.groupBy("element").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    cell = F.pmod(F.col("element"), F.lit(64 * WORDS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(element, {64 * WORDS}) % 64 as int))")
    maps = [F.bit_or(F.when(F.floor(cell / 64) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(WORDS)]
    bounds = parts.join(shared.select("element"), "element").groupBy("node").agg(F.count("*").alias("common"), *maps)
    bounds = bounds.join(sets.select("node", "bands"), "node")
    large = keep(rows.groupBy("band").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("parts")).where("parts > 1"))
    small_side = F.broadcast(large) if large.count() <= MOST_BROADCAST else large
    wide = cut(rows.join(small_side, "band", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).join(bounds, "node"))
    names = ["node", "n", "label", "common", "bands", *(f"w{w}" for w in range(WORDS))]
    own = F.pmod(F.xxhash64("node", "band"), F.col("parts")).cast("int")
    one = wide.select("band", "place", own.alias("part"), *(F.col(c).alias(f"a_{c}") for c in names))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    two = wide.select(F.col("band").alias("b_band"), every.alias("b_part"), *(F.col(c).alias(f"b_{c}") for c in names))

    def missing(x: str, y: str) -> str:
        return " + ".join(f"bit_count({x}_w{w} & ~{y}_w{w})" for w in range(WORDS))

    most = f"least(a_common - ({missing('a', 'b')}), b_common - ({missing('b', 'a')}))"
    allowed = F.expr(
        f"band = b_band and part = b_part and a_node > b_node and a_label <> b_label and a_n * 100 >= b_n * {percent} and b_n * 100 >= a_n * {percent}"
        f" and {most} * {100 + percent} >= {percent} * (a_n + b_n)"
        " and not exists(zip_with(slice(a_bands, 1, place), slice(b_bands, 1, place), (x, y) -> x = y), same -> same)"
    )
    return one.join(two, allowed).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _local_union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as a forest: each node with its root, the smallest of its tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    links = [(x, r) for x in parent if (r := root(x)) != x]
    yield pa.record_batch({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([r for _, r in links], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected links (a, b): its component's smallest node.

    Each partition unites what it holds; minima then pass along the links, with
    labels of labels taken in each round, until no label changes.
    """
    forest = cut(links.select("a", "b").mapInArrow(tidy(_local_union_find), "a long, b long"))
    both = cut(forest.unionByName(forest.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    before = None
    while True:
        near = both.join(labels, both["b"] == labels["node"]).select(both["a"].alias("node"), "label")
        lower = keep(labels.unionByName(near).groupBy("node").agg(F.min("label").alias("label")))
        other = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = cut(lower.join(other, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
        lower.unpersist()
        state = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")), F.count("*")).first()
        if state == before:
            return labels
        before = state


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id, kept.

    A document's set is its distinct ``k``-word shingles (A-Z in lower case, words
    ``[^\\x20\\x09-\\x0D]+``); with fewer words it is the whole sequence, and a
    text that is null, empty or blank has none and is linked with nothing.
    Documents are linked if ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest identifier that can be reached.  Rows with a
    null identifier are their own component, with a null ``component_id``, and are
    kept; a row repeated with one identifier is kept in each of its copies if its
    identifier is, and different texts whose smallest identifier is the same count
    as one node.  Texts of any length are shingled whole, in blocks.  Other columns
    are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = cut(texts.mapInArrow(tidy(_sketch(k, bands, rows)), "id long, n long, fp binary, bands array<long>"))
    real = sketch.where(F.col("fp").isNotNull() & F.col("id").isNotNull())
    sets = cut(real.groupBy("fp").agg(F.min("id").alias("node"), F.min("n").alias("n"), F.min_by("bands", "id").alias("bands")))
    banded = sets.select("node", "n", F.posexplode("bands").alias("place", "band"))
    leaders = banded.groupBy("band").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("many")).where("many > 1")
    leaders = leaders.select("band", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n"))
    members = cut(banded.join(leaders, "band"))
    wanted = members.select("node").distinct()
    needed = texts.join(wanted, texts["id"] == wanted["node"]).select("node", "text")
    elements = cut(needed.mapInArrow(tidy(_sets(k)), "node long, elements binary"))

    def fits(one: str, two: str):
        return (F.col(one) * 100 >= F.col(two) * percent) & (F.col(two) * 100 >= F.col(one) * percent)

    def label_of(df: DataFrame, node: str, name: str, labels: DataFrame) -> DataFrame:
        found = labels.select(F.col("node").alias(node), F.col("label").alias(name))
        return df.join(found, node, "left").withColumn(name, F.coalesce(name, node))

    def unite(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Compare the pairs (a, b) on their full sets and merge the labels of those that are linked."""
        with_a = pairs.join(elements.select(F.col("node").alias("a"), F.col("elements").alias("a_set")), "a")
        with_b = with_a.join(elements.select(F.col("node").alias("b"), F.col("elements").alias("b_set")), "b")
        links = with_b.select("a", "b", "a_set", "b_set").mapInArrow(tidy(_similar(percent)), "a long, b long")
        links = label_of(label_of(links, "a", "la", labels), "b", "lb", labels)
        merged = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a <> b"))
        moved = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
        old = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        new = merged.join(labels.select("node"), "node", "left_anti")
        return cut(old.unionByName(new))

    stars = members.where((F.col("node") != F.col("lead")) & fits("n", "lead_n"))
    stars = stars.groupBy(F.col("node").alias("a"), F.col("lead").alias("b")).agg(F.count("*").alias("shared"))
    best = cut(stars.groupBy("a").agg(F.max(F.struct("shared", (-F.col("b")).alias("b"))).alias("best")).select("a", (-F.col("best.b")).alias("b")))
    labels = unite(best, spark.createDataFrame([], "node long, label long"))
    labelled = cut(label_of(members.select("band", "place", "node", "n"), "node", "label", labels))
    split = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    open_rows = cut(labelled.join(split, "band", "left_semi"))
    last = _open_pairs(open_rows, elements, sets, percent).join(best, ["a", "b"], "left_anti")
    last = cut(last)
    if not last.isEmpty():
        labels = unite(last, labels)

    found = label_of(sets.select("fp", "node"), "node", "component", labels).select("fp", "component")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return sketch.select("id", "n", "fp").join(found, "fp", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )
