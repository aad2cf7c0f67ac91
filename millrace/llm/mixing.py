"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Only built-in DataFrame functions.  Every document gets a random key that hangs on
its identifier, its text and the seed alone, so rows without an identifier or with
a common one are spread as well.  The key's leading bits name one of 64 x 64
ranges, so within a source the ranges are in key order without any sampling and
hold about equally many rows however large the source is.  Prefix sums of word
counts are taken over the 64 upper ranges, over the 64 lower ranges of each, and
over the rows of each lower range; no task ever sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.scratch import cut, keep

KEY_BITS, RANGE_BITS = 60, 6


def words(text):
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(no_source, source, source_size, target) of each source.

    Targets are proportional to the weights; one that would be above ``most`` times
    its source's size stops there and the excess goes to the others by weight.  The
    fixpoint of that is found directly: sources fill up in the order of their
    size per weight, so prefix sums in that order tell which of them are full.
    This table has one row for each source.
    """
    place = Window.orderBy("no_source", "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("fill", F.col("cap") / F.col("weight"))
    filling = Window.orderBy("fill", "no_source", "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = ranked.withColumn("level", left / weight)
    level = level.withColumn("open_level", F.when(F.col("fill") > F.col("level"), F.col("level")))
    # the first source that isn't full sets the level of all later ones
    reached = F.min(F.when(F.col("open_level").isNotNull(), F.struct("fill", "open_level"))).over(everything)["open_level"]
    target = F.least(F.col("cap"), F.coalesce(reached, F.lit(float("inf"))) * F.col("weight"))
    return level.select("no_source", "source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id_col, size, source_size, target, taken.

    Sources are in the order of their code points, null last, and take the weights
    in turn.  All targets together are ``share`` of all words.  A source is taken
    as often as its target holds it whole, and its remaining budget is cut from
    the random order to the word, so the document at the cut may be taken in part.
    ``taken`` counts repeats and is never above ``most`` times the size (rounded
    up to whole epochs).  A null source is a source of its own, apart from the
    empty name; a null text has no words; rows that share an identifier
    have places of their own.  A table without words takes nothing, and an empty
    table gives an empty result.  Texts of any length are counted whole.  Other
    columns are not read.
    """
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f" {seed} "), F.coalesce(F.col(text_col), F.lit(""))).cast("binary"))
    order = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")
    base = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        words(F.col(text_col)).alias("size"),
        order.alias("key"),
    ).withColumn("range", F.shiftright(F.col("key"), KEY_BITS - 2 * RANGE_BITS).cast("int"))
    base = keep(base)
    by_range = base.groupBy("no_source", "source", "range").agg(F.sum("size").alias("range_size"))
    by_range = cut(by_range.withColumn("upper", F.shiftright("range", RANGE_BITS)))
    uppers = cut(by_range.groupBy("no_source", "source", "upper").agg(F.sum("range_size").alias("upper_size")))
    plan = _targets(uppers.groupBy("no_source", "source").agg(F.sum("upper_size").alias("source_size")), weights, share, most)

    def earlier(keys: list[str], order: str, column: str):
        return F.coalesce(F.sum(column).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    uppers = uppers.withColumn("upper_start", earlier(["no_source", "source"], "upper", "upper_size"))
    uppers = cut(uppers.join(cut(plan), ["no_source", "source"]).drop("upper_size"))
    ranges = by_range.withColumn("start", earlier(["no_source", "source", "upper"], "range", "range_size"))
    ranges = ranges.join(uppers, ["no_source", "source", "upper"]).withColumn("start", F.col("start") + F.col("upper_start"))
    ranges = cut(ranges.select("no_source", "source", "range", "start", "source_size", "target"))

    rows = Window.partitionBy("no_source", "source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = base.withColumn("inside", F.coalesce(F.sum("size").over(rows), F.lit(0))).join(ranges, ["no_source", "source", "range"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    rest_taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("start") - F.col("inside")))
    return placed.select(F.col("id").alias(id_col), "size", "source_size", "target", (epochs * F.col("size") + rest_taken).alias("taken"))
