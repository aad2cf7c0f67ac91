"""Sharding by jump consistent hashing.

Only built-in DataFrame functions.  A document's key is the first 64 bits of the
md5 of its identifier.  The key seeds a linear congruential generator whose draws
say to which shard the key jumps next as shards are appended; the last jump below
the number of shards is its place.  No ring and no table is held, and one more
shard draws just the keys whose next jump lands on it.

Places within a shard (slots) follow a second digest, so they need no sort of a
whole shard: the digest's leading bits name one of 4,096 ranges, counts of ranges
are summed up, and rows are numbered within their range alone.  Rows that can't be
told apart are one counted row until the end, when they are dealt out in pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.scratch import cut

RANGE_BITS = 12
PIECE = 10_000  # equal rows that are dealt out at once
# fixed values: the generator of the published algorithm, key * MULTIPLIER + 1 modulo 2**64
MULTIPLIER = 2862933555777941757
_LOW = (1 << 32) - 1


def _hex(digest: Column, first: int, n: int) -> Column:
    return F.conv(F.substring(digest, first, n), 16, 10).cast("long")


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next state, as two halves of 32 bits; no product leaves 63 bits."""
    upper, lower = MULTIPLIER >> 32, MULTIPLIER & _LOW
    left, right = lower >> 16, lower & 0xFFFF
    crossed = low * left
    down = low * right + F.shiftleft(crossed.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    up = F.shiftright(down, 32) + F.shiftright(crossed, 16) + (low * upper).bitwiseAND(F.lit(_LOW)) + high * right + F.shiftleft((high * left).bitwiseAND(F.lit(0xFFFF)), 16)
    return up.bitwiseAND(F.lit(_LOW)), down.bitwiseAND(F.lit(_LOW))


def jump(high: Column, low: Column, counts: Sequence[int], least: int = 24) -> Column:
    """The shard of a key (two halves of 32 bits) for each number of shards, as an array.

    A key jumps about ln(n) times below n; those that jump more than ``least``
    times go through a walk of n steps, which none outlasts, as each jump goes up.
    """
    most = max(counts)
    start = F.struct(high.alias("high"), low.alias("low"), F.lit(0.0).alias("at"), F.array(*[F.lit(0) for _ in counts]).alias("shards"))

    def step(state: Column, _: Column) -> Column:
        up, down = _next(state["high"], state["low"])
        jumped = F.floor((F.floor(state["at"]) + 1) * (F.lit(float(1 << 31)) / (F.shiftright(up, 1) + 1))).cast("double")
        shards = F.array(*[F.when(jumped < n, jumped.cast("int")).otherwise(state["shards"][i]) for i, n in enumerate(counts)])
        return F.when(state["at"] < most, F.struct(up.alias("high"), down.alias("low"), jumped.alias("at"), shards.alias("shards"))).otherwise(state)

    def walk(steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)

    if most <= least:
        return walk(most)["shards"]
    some = walk(least)
    return F.when(some["at"] >= most, some["shards"]).otherwise(walk(most)["shards"])


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1 and ``text_crc32`` its unsigned
    checksum; a null text has no bytes (size 1, checksum 0).  The identifier and
    the number of shards alone decide on the shard, so repeated identifiers share
    one; null counts as an identifier of its own (an empty string).
    ``grown_shard`` is the shard with one more of them: the same or the new one.
    ``slot`` counts each shard's documents from 0 without gaps; the order hangs on
    identifier, size and checksum, so reruns agree, and repeated rows have slots
    next to each other.  Texts of any length are read once, by the checksum.  An
    empty table gives an empty result.  Other columns are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    key = F.md5(name.cast("binary"))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        key.alias("key"),
        name.alias("name"),
    )
    copies = rows.groupBy("id", "name", "key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    order = F.md5(F.concat_ws(" ", "name", F.col("size").cast("string"), F.col("text_crc32").cast("string")).cast("binary"))
    placed = copies.withColumn("shards", jump(_hex(F.col("key"), 1, 8), _hex(F.col("key"), 9, 8), (shards, shards + 1)))
    placed = placed.withColumn("order", F.substring(order, 1, 15)).withColumn("range", F.shiftright(_hex(F.col("order"), 1, 15), 60 - RANGE_BITS).cast("int"))
    placed = cut(placed.select("id", "size", "text_crc32", "copies", F.col("shards")[0].alias("shard"), F.col("shards")[1].alias("grown_shard"), "order", "range"))
    ranges = placed.groupBy("shard", "range").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "range").orderBy("order", "id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, ["shard", "range"])
    numbered = numbered.withColumn("first", F.col("start") + F.col("before")).withColumn("end", F.col("first") + F.col("copies") - 1)
    pieces = numbered.withColumn("piece", F.explode(F.sequence("first", "end", F.lit(PIECE).cast("long")))).hint("rebalance")
    slots = pieces.withColumn("slot", F.explode(F.sequence("piece", F.least(F.col("end"), F.col("piece") + (PIECE - 1)))))
    return slots.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
