"""Reshaping of tagged sentences, as expressions over array<struct<word,tag>>, and of spans over them.

Positions are from 0; a position that is not there is null, and a sentence without
what a step looks for stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: singular and plural forms of verbs with their tags
SINGULAR_PLURAL = ((("is", "VBZ"), ("are", "VBP")), (("was", "VBD"), ("were", "VBD")))


def _pair(word: str | Column, tag: str | Column) -> Column:
    put = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(put(word).alias("word"), put(tag).alias("tag"))


def position(tokens: Column, fits: Callable[[Column], Column], nth: int = 0) -> Column:
    """Where the first pair stands that fits, or the ``nth`` after it; -1 is the last."""
    places = F.filter(F.transform(tokens, lambda t, i: F.when(fits(t), i)), lambda i: i.isNotNull())
    return F.try_element_at(places, F.lit(nth + 1 if nth >= 0 else nth))


def position_from(tokens: Column, fits: Callable[[Column], Column], start: Column, back: bool = False) -> Column:
    """The fitting place nearest to ``start``, it included, towards the end or back to the beginning."""
    places = F.filter(F.transform(tokens, lambda t, i: F.when(fits(t) & ((i <= start) if back else (i >= start)), i)), lambda i: i.isNotNull())
    return F.array_max(places) if back else F.array_min(places)


def _part(tokens: Column, start: Column, stop: Column) -> Column:
    """The tokens from ``start`` to before ``stop``."""
    return F.slice(tokens, start + 1, F.greatest(stop - start, F.lit(0)))


def without_tags(tokens: Column, endings: Sequence[str] = ("DT", "CC")) -> Column:
    """Without pairs whose tag ends in one of the endings."""
    pattern = "(" + "|".join(endings) + ")$"
    return F.filter(tokens, lambda t: ~t["tag"].rlike(pattern))


def agree_verb(tokens: Column) -> Column:
    """The first verb in the number of the nearest noun, one after it before one in front of it."""
    verb = position(tokens, lambda t: t["tag"].startswith("VB"))
    noun = lambda t: t["tag"].startswith("NN")
    near = F.coalesce(position_from(tokens, noun, verb + 1), position_from(tokens, noun, verb - 1, back=True))
    plural = F.get(tokens, near)["tag"].endswith("S")

    def formed(t: Column) -> Column:
        out = t
        for one, many in SINGULAR_PLURAL:
            out = F.when(plural & (t == _pair(*one)), _pair(*many)).when(~plural & (t == _pair(*many)), _pair(*one)).otherwise(out)
        return out

    return F.when(near.isNull(), tokens).otherwise(F.transform(tokens, lambda t, i: F.when(i == verb, formed(t)).otherwise(t)))


def predicate_first(tokens: Column) -> Column:
    """What follows the first finite verb in front of what comes before it, without the verb."""
    verb = position(tokens, lambda t: t["tag"].startswith("VB") & (F.length(t["tag"]) > 2) & (t["tag"] != "VBG"))
    moved = F.concat(_part(tokens, verb + 1, F.size(tokens)), _part(tokens, F.lit(0), verb))
    return F.when(verb.isNull(), tokens).otherwise(moved)


def cardinal_first(tokens: Column, noun: str = "NN") -> Column:
    """``Dec 10`` as ``10 Dec``: the first number goes before a noun (or month) right in front of it."""
    at = position(tokens, lambda t: t["tag"] == "CD")
    swap = (at > 0) & F.get(tokens, at - 1)["tag"].startswith(noun)
    swapped = F.transform(tokens, lambda t, i: F.when(i == at, F.get(tokens, at - 1)).when(i == at - 1, F.get(tokens, at)).otherwise(t))
    return F.when(F.coalesce(swap, F.lit(False)), swapped).otherwise(tokens)


def complement_first(tokens: Column) -> Column:
    """``book of recipes`` as ``recipes book``: what follows the first preposition before the noun in front of it."""
    link = position(tokens, lambda t: (t["tag"] == "IN") & (t["word"] != "like"))
    noun = F.coalesce(position_from(tokens, lambda t: t["tag"].startswith("NN"), link, back=True), F.lit(0))
    moved = F.concat(_part(tokens, F.lit(0), noun), _part(tokens, link + 1, F.size(tokens)), _part(tokens, noun, link))
    return F.when(link.isNull(), tokens).otherwise(moved)


def attributive_singular(tokens: Column) -> Column:
    """The first plural noun as a singular if a noun follows it."""
    at = position(tokens, lambda t: t["tag"] == "NNS")
    singular = lambda t: _pair(F.regexp_replace(t["word"], "s+$", ""), F.regexp_replace(t["tag"], "S+$", ""))
    follows = F.get(tokens, at + 1)["tag"].startswith("NN")
    return F.when(F.coalesce(follows, F.lit(False)), F.transform(tokens, lambda t, i: F.when(i == at, singular(t)).otherwise(t))).otherwise(tokens)


def headline(tokens: Column) -> Column:
    """All steps that make a noun phrase of a sentence, one after the other."""
    for step in (without_tags, predicate_first, complement_first, attributive_singular):
        tokens = step(tokens)
    return tokens


def sentence(words: Column) -> Column:
    """Words as a sentence, with no blank before a mark."""
    return F.regexp_replace(F.array_join(words, " "), r"\s([,.;?])", "$1")


def outer(spans: Column) -> Column:
    """The spans that no other holds."""
    return F.filter(spans, lambda s: s["depth"] == 0)


def inner(spans: Column) -> Column:
    """The spans that hold no other."""
    return F.filter(spans, lambda s: ~F.exists(spans, lambda x: (x["depth"] == s["depth"] + 1) & (x["start"] >= s["start"]) & (x["stop"] <= s["stop"])))


def relabel(spans: Column, labels: Mapping[str, str]) -> Column:
    """Spans with other labels where the mapping has one."""
    new = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.transform(spans, lambda s: F.struct(F.coalesce(new[s["label"]], s["label"]).alias("label"), s["start"].alias("start"), s["stop"].alias("stop"), s["depth"].alias("depth")))


def tags_with_neighbours(tokens: Column) -> Column:
    """array<struct<word,tag,previous,following,position,iob>>: B where a run of one tag begins, I within it, O for NN and the like without a chunk."""
    at = lambda i: F.get(tokens, i)
    return F.transform(tokens, lambda t, i: F.struct(
        t["word"].alias("word"), t["tag"].alias("tag"),
        F.coalesce(at(i - 1)["tag"], F.lit("<START>")).alias("previous"), F.coalesce(at(i + 1)["tag"], F.lit("<END>")).alias("following"), i.alias("position"),
        F.when(~t["tag"].isin("LOCATION", "CARRIER", "DAY", "TOURCODE"), "O").when(F.coalesce(at(i - 1)["tag"] == t["tag"], F.lit(False)), F.concat(F.lit("I-"), t["tag"])).otherwise(F.concat(F.lit("B-"), t["tag"])).alias("iob"),
    ))
