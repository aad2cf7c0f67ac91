"""Row-wise steps: selectors, clean-up, coercion, replacement by maps, set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranks import cutoffs
from millrace.session import cut

# fixed values: the days that stand for an open end and an open start
UNKNOWN_END = "9999-12-31"
UNKNOWN_START = "2016-01-01"


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case."""
    return df.toDF(*(c.lower() for c in df.columns))


def sentinel(column: Column, found: object, put: object) -> Column:
    """``put`` where the column equals ``found``."""
    return F.when(column == F.lit(found), F.lit(put)).otherwise(column)


def map_values(df: DataFrame, column: str, values: Mapping[str, str | None]) -> DataFrame:
    """Replace exact values; a value that maps to None becomes null."""
    if not values:
        return df
    lookup = F.create_map(*[x for pair in values.items() for x in map(F.lit, pair)])
    known = F.col(column).isin(*values)
    return df.withColumn(column, F.when(known, lookup[F.col(column)]).otherwise(F.col(column)))


def unwind_values(df: DataFrame, column: str, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row for each element that a value stands for; other values keep their row."""
    lookup = F.create_map(*[x for k, v in lists.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    many = F.when(F.col(column).isin(*lists), lookup[F.col(column)]).otherwise(F.array(F.col(column)))
    return df.withColumn(column, F.explode(many))


def unwind_outer(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The cross product of several array columns of each row; null and empty arrays keep the row."""
    return reduce(lambda d, c: d.withColumn(c, F.explode_outer(c)), columns, df)


def typed(df: DataFrame, types: Mapping[str, str], empty_is_null: bool = True) -> tuple[DataFrame, DataFrame]:
    """Coerce string columns; returns (accepted, rejected).

    A row is rejected if a value that is there can't be coerced.
    """

    def source(c: str) -> Column:
        return F.nullif(F.col(c), F.lit("")) if empty_is_null else F.col(c)

    def cast(c: str, kind: str) -> Column:
        return F.try_to_timestamp(source(c), F.lit("yyyy-MM-dd")).cast("date") if kind == "date" else source(c).try_cast(kind)

    bad = reduce(lambda x, y: x | y, [source(c).isNotNull() & cast(c, k).isNull() for c, k in types.items()], F.lit(False))
    accepted = df.where(~bad).withColumns({c: cast(c, k) for c, k in types.items()})
    return accepted, df.where(bad)


def drop_value(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column is not the value; null stays."""
    return df.where((F.col(column) != F.lit(value)) | F.col(column).isNull())


def is_market(gold: Column, predicted: Column) -> Column:
    """Labelled or predicted yes and not labelled no; a missing label is empty."""
    label = F.coalesce(gold, F.lit(""))
    return ((label == "yes") | (F.coalesce(predicted, F.lit("")) == "yes")) & (label != "no")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a declared order."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def dense_keys(df: DataFrame, keys: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """(keys, name): a number from 0 in the order of the keys, without sorting in one task.

    The distinct keys are range-partitioned; each partition's start is the count of
    those before, of which there is one for each partition.  The numbered keys are
    a checkpoint, as both steps must see the same partitions.
    """
    ordered = df.select(*keys).distinct().repartitionByRange(*([parts] if parts else []), *keys).sortWithinPartitions(*keys)
    numbered = cut(ordered.withColumn("__id", F.monotonically_increasing_id()))
    part, line = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row for each partition
    return numbered.withColumn("part", part).join(F.broadcast(offsets), "part").select(*keys, (F.col("start") + line).alias(name))


def proper_subset(one: Column, two: Column) -> Column:
    """Whether the set ``one`` is contained in ``two`` and smaller."""
    one, two = F.array_distinct(one), F.array_distinct(two)
    return (F.size(F.array_except(one, two)) == 0) & (F.size(two) > F.size(one))


def hash_of(keys: Sequence[str], seed: int) -> Column:
    """A whole number below 2**52 that hangs on the keys and the seed alone; other engines can work it out as well."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")


def unit_of(keys: Sequence[str], seed: int) -> Column:
    """:func:`hash_of` as a number from 0 to below 1, in steps of a millionth."""
    return F.pmod(hash_of(keys, seed), F.lit(1_000_000)) / 1_000_000


def hash_split(df: DataFrame, keys: Sequence[str], share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A split that hangs on the keys and the seed alone, so reruns and replicas agree."""
    unit = unit_of(keys, seed)
    return df.where(unit < share), df.where(unit >= share)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by the smallest hashes of their keys, all if there are no more."""
    return df.orderBy(hash_of(keys, seed), *keys).limit(n)


def oversample(df: DataFrame, label: str, keys: Sequence[str], counts: Mapping[object, int], seed: int = 24) -> DataFrame:
    """Repeat the rows of rarer labels until all labels have as many rows as the largest.

    ``counts`` has the rows of each label.  Whole repeats come first; the rest goes
    to the rows with the smallest hashes.  The hash at which a label's rest ends is
    found by counts of ranges, so no label is ever sorted; only rows that share that
    very hash are ranked, by their keys.
    """
    most = max(counts.values(), default=0)
    if not most:
        return df
    sizes = {k: most % n for k, n in counts.items() if n}
    hashed = df.withColumn("__hash", hash_of(keys, seed).cast("double"))  # below 2**52, so exact
    last = cutoffs(hashed, label, "__hash", sizes)
    cutoff = F.create_map(*[x for k in counts for x in (F.lit(k), F.lit(last.get(k, -1.0)))])
    hashed = hashed.withColumn("__last", F.coalesce(cutoff[F.col(label)], F.lit(-1.0)))
    below = {r[label]: r["n"] for r in hashed.groupBy(label).agg(F.count_if(F.col("__hash") < F.col("__last")).alias("n")).collect()}
    rest = F.create_map(*[x for k in counts for x in (F.lit(k), F.lit(sizes.get(k, 0) - below.get(k, 0)))])
    tied = hashed.where(F.col("__hash") == F.col("__last")).withColumn("__rank", F.row_number().over(Window.partitionBy(label).orderBy(*keys)))
    tied = tied.withColumn("__more", (F.col("__rank") <= rest[F.col(label)]).cast("int")).drop("__rank")
    others = hashed.where(F.col("__hash") != F.col("__last")).withColumn("__more", (F.col("__hash") < F.col("__last")).cast("int"))
    times = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(most // n if n else 0))])
    copied = others.unionByName(tied).withColumn("__copy", F.explode(F.sequence(F.lit(1), times[F.col(label)] + F.col("__more"))))
    return copied.select(*df.columns)


def three_way_split(df: DataFrame, keys: Sequence[str], shares: Sequence[float] = (0.5, 1 / 3), seed: int = 42) -> DataFrame:
    """``df`` with ``part``: test, then of the rest dev by their shares, the others train."""
    return df.withColumn("part", F.when(unit_of(keys, seed) < shares[0], "test").when(unit_of(keys, seed + 1) < shares[1], "dev").otherwise("train"))
