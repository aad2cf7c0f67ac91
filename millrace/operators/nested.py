"""Changes to nested records, lists and maps, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_field(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Set ``a`` or ``a.b``; of a null struct the one field is set, the others are null."""
    head, _, rest = path.partition(".")
    if not rest:
        return df.withColumn(head, value)
    known = {f.name: f.dataType for f in df.schema[head].dataType.fields} if head in df.columns else {}
    fields = [value.alias(rest) if name == rest else F.col(f"{head}.{name}").alias(name) for name in known]
    return df.withColumn(head, F.struct(*fields, *([] if rest in known else [value.alias(rest)])))


def unset_field(df: DataFrame, path: str) -> DataFrame:
    """Remove ``a`` or ``a.b``."""
    head, _, rest = path.partition(".")
    return df.withColumn(head, F.col(head).dropFields(rest)) if rest else df.drop(head)


def add_to_set(values: Column, *added: Column) -> Column:
    """The list as a set with more values; a null list is an empty one."""
    return F.array_distinct(F.concat(F.coalesce(values, F.array().cast("array<string>")), F.array(*added)))


def with_keys(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """A struct of text with all the keys, each its present value or null."""
    known = {f.name for f in df.schema[column].dataType.fields} if column in df.columns else set()
    fields = [(F.col(f"{column}.{k}") if k in known else F.lit(None)).cast("string").alias(k) for k in keys]
    return df.withColumn(column, F.struct(*fields))


def merge_maps(*maps: Column) -> Column:
    """All entries; of equal keys the last map's."""
    merged = maps[0]
    for more in maps[1:]:
        merged = F.map_concat(_without(merged, more), more)
    return merged


def _without(one: Column, two: Column) -> Column:
    return F.map_filter(one, lambda k, _: ~F.array_contains(F.map_keys(two), k))


def all_keys(*maps: Column) -> Column:
    """The distinct keys of several maps, sorted."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[F.coalesce(F.map_keys(m), empty) for m in maps]))))


def inverted(pairs: Column) -> Column:
    """Values to keys; the values have to be unique."""
    return F.map_from_arrays(F.map_values(pairs), F.map_keys(pairs))


def recode_labels(label: Column, codes: Mapping[str, str]) -> Column:
    """Old labels by new ones, such as paper to no; others stay."""
    out = label
    for old, new in codes.items():
        out = F.when(label == old, F.lit(new)).otherwise(out)
    return out
