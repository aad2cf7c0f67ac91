"""Features of rules and documents: tags, phrases, bags of words, context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.preprocess import rule_words_of
from millrace.operators.relational import proper_subset
from millrace.operators.windows import context


def adhoc_by_tags(tags: Column) -> Column:
    """True if a true tag's name speaks of ad hoc, else null."""
    true_tags = F.map_keys(F.map_filter(tags, lambda _, v: v))
    return F.when(F.exists(true_tags, lambda k: F.upper(k).contains("ADHOC")), F.lit(True))


def phrase_flags(text: Column, phrases: Mapping[str, str]) -> list[Column]:
    """A flag column for each named phrase, found in any case."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    return [lower.contains(phrase.lower()).alias(name) for name, phrase in sorted(phrases.items())]


def category_features(rules: DataFrame, category: str, text: Column, base: Column, phrases: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``rules`` with ``features``: those all have, and a flag for each phrase of the rule's own category."""
    lower, own = F.lower(F.coalesce(text, F.lit(""))), F.create_map().cast("map<string,string>")
    for name, named in sorted(phrases.items()):
        flags = F.create_map(*[x for key, phrase in sorted(named.items()) for x in (F.lit(key), lower.contains(phrase.lower()).cast("string"))])
        own = F.when(F.col(category) == name, flags).otherwise(own)
    return rules.withColumn("features", F.map_concat(base, own))


def registry(spark, features: Sequence[tuple[str, str]], fields: Sequence[str]) -> DataFrame:
    """(feature, kind, field): every feature with every field it is tried for."""
    named = spark.createDataFrame(list(features), "feature string, kind string")
    return named.select("*", F.explode(F.array(*map(F.lit, fields))).alias("field"))


def bags(rules: DataFrame, key: str, text: str) -> DataFrame:
    """(key, words) of each rule; a text that many rules share is read once."""
    texts = rules.select(text).distinct().withColumn("words", F.array_sort(F.array_distinct(rule_words_of(F.col(text)))))
    return rules.select(key, text).join(texts, text).select(key, "words")


def context_flag(words: Column, pivot: str, search: Sequence[str], without: Sequence[str] = (), width: int = 3, strict_reference: bool = False) -> Column:
    """Whether some context of the pivot word holds all searched words and more, and none of ``without``.

    ``strict_reference`` keeps an old behaviour that asks for ``without`` to be there.
    """
    wanted = F.array(*map(F.lit, search))
    barred = F.array(*map(F.lit, without)) if without else F.array().cast("array<string>")
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == pivot)

    def fits(i: Column) -> Column:
        around = context(words, i, width)
        has = proper_subset(wanted, around)
        if not without:
            return has
        return has & (proper_subset(barred, around) if strict_reference else ~F.arrays_overlap(barred, around))

    return F.coalesce(F.when(F.size(words) > 0, F.exists(places, fits)), F.lit(False))
