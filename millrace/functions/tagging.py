"""Tagging and chunking of word lists.

Tags come from a chain: tour codes, closed lists, places and carriers, spelling
patterns, and last the endings of a word.  Chunks come from rules over tags in a
small notation: ``<TAG>``, ``<A|B>``, ``<.*>`` and the usual ``? * +`` after them.
Rules apply in order; a rule's match becomes one node with the rule's label, so
later rules can use it.  The result is a flat list of spans with their depth.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the words that carry a tag of their own
_LISTS = {
    "TO": "to until till upto – - — 至",
    "FROM": "from",
    "AND": "& and",
    "OR": "or",
    "SALES": "sales selling ticketing ticket tkt issue issued iss",
    "TRAVEL": "travel trvl travl dep departure",
    "EFFECTIVE": "effective eff wef after",
    "VALIDITY": "valid validity",
    "PREVIOUS": "previous",
    "VERSION": "version vers",
    "EXTENDED": "extended",
    "HONORED": "honored honoured honour",
    "UFN": "ufn onwards further",
    "ORIGINATING": "originating origin",
    "EXCLUDING": "excluding excludes exclude except excl",
    "CODESHARE": "codeshare code-share codeshares",
    "AGENT": "agent agents agency",
    "SLASH": "/",
    "COMMA": ",",
    "OTHER": "other",
    "THAN": "than",
    "ROUTE": "route routes",
    "CABIN": "cabin first business economy premium",
    "CLASS": "class",
    "FARE": "fare fares",
    "CORPORATE": "corporate company",
    "DISCOUNT": "discount discounts commission commissions",
    "IN": "in on at by for of with",
    "DT": "the a an this that",
    "MD": "will shall may can must",
    "MM": "jan feb mar apr may jun jul aug sep oct nov dec january february march april june july august september october november december",
    "CARRIER": "cx ka aa",
    "LOCATION": "usa mexico mex canada asia china japan india hkg sin sha pvg bos lax dfw ord jfk ewr",
}
_WORDS = {w: tag for tag, words in reversed(_LISTS.items()) for w in words.split()}
_SHAPES = [
    (re.compile(r"[A-Za-z0-9_]+FF\d+"), "TOURCODE"),
    (re.compile(r"\d{1,2}(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\d{2,4}", re.I), "DAY"),
    (re.compile(r"\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{2,4}"), "DAY"),
    (re.compile(r"-?\d+(\.\d+)?"), "CD"),
    (re.compile(r"\d+(\.\d+)?%"), "PERCENT"),
    (re.compile(r"(CNY|USD|HKD|EUR|GBP|JPY)\d*"), "CURRENCY"),
]
_ENDINGS = (("able", "JJ"), ("ness", "NN"), ("ly", "RB"), ("ing", "VBG"), ("ed", "VBD"), ("s", "NNS"))

#: (label, rule), in the order in which they apply.
GRAMMAR = (
    ("DATE", "<CD><MM><CD>"),
    ("DATE", "<MM><CD><COMMA>?<CD>"),
    ("DATE", "<DAY>"),
    ("DATE", "<CD><MM>"),
    ("AMOUNT", "<CURRENCY><CD>?"),
    ("LOCATIONS", "<LOCATION>(?:<AND|OR|SLASH|COMMA>+<LOCATION>)+"),
    ("RANGE", "<DATE><TO>?<DATE>"),
    ("TODATE", "<TO><DATE>"),
    ("FROMDATE", "<FROM|EFFECTIVE><DATE>"),
    ("FROMDATE", "<DATE><UFN>"),
    ("EXTENSION_DATE", "<PREVIOUS><VERSION><.*>*<TODATE>"),
    ("SALESPERIOD", "<SALES>+<VALIDITY>?<IN>?<RANGE|TODATE|FROMDATE>"),
    ("TRAVELPERIOD", "<TRAVEL>+<VALIDITY>?<IN>?<RANGE|TODATE|FROMDATE>"),
    ("VALIDITYPERIOD", "<VALIDITY><IN>?<RANGE|TODATE|FROMDATE>"),
    ("ORIGINS_EXCLUDED", "<ORIGINATING><OTHER><THAN><LOCATION|LOCATIONS>"),
    ("ORIGINS", "<ORIGINATING><FROM|IN>?<LOCATION|LOCATIONS>"),
    ("ORIGINS", "<LOCATION|LOCATIONS><ORIGINATING>"),
    ("TOURCODELOCATION", "<TOURCODE><IN|FROM>*<LOCATION|LOCATIONS>"),
    ("TO_LOCATION", "<TO><LOCATION|LOCATIONS>"),
    ("FROM_LOCATION", "<FROM><LOCATION|LOCATIONS>"),
    ("ROUTEPAIR", "<LOCATION|LOCATIONS|FROM_LOCATION><TO_LOCATION>"),
    ("CORPORATE_DISCOUNT", "<CORPORATE><DISCOUNT>"),
    ("AGENT_DISCOUNT", "<AGENT>?<DISCOUNT>"),
    ("RATE", "<PERCENT><CORPORATE_DISCOUNT|AGENT_DISCOUNT>"),
    ("FLIGHT", "<CARRIER><CD>"),
    ("FLIGHTS", "<FLIGHT>(?:<SLASH|COMMA|AND>+<CD|FLIGHT>)+"),
    ("FLIGHTS_EXCLUDED", "<EXCLUDING><FLIGHT|FLIGHTS>"),
    ("CARRIERS", "<CARRIER>(?:<SLASH|COMMA|AND>+<CARRIER>)+"),
    ("CABINS", "<CABIN>(?:<SLASH|COMMA|AND|OR>+<CABIN>)+"),
    ("FARES", "<CABIN|CABINS>?<CLASS>?<FARE>"),
)


def tag_word(word: str, tables: Mapping[str, str] | None = None) -> str:
    """The tag of one word; ``tables`` has the tags of further words in lower case, such as known codes, carriers and places."""
    for shape, tag in _SHAPES[:3]:
        if shape.fullmatch(word):
            return tag
    if (tag := _WORDS.get(word.lower())) is not None:
        return tag
    if tables and (tag := tables.get(word.lower())) is not None:
        return tag
    for shape, tag in _SHAPES[3:]:
        if shape.fullmatch(word):
            return tag
    return next((tag for ending, tag in _ENDINGS if len(word) > len(ending) + 1 and word.lower().endswith(ending)), "NN")


@lru_cache(maxsize=None)
def _compiled(rule: str) -> re.Pattern:
    def one(match: re.Match) -> str:
        names = match[1]
        return "(?:<[^<>]+>)" if names == ".*" else "(?:<(?:" + names + ")>)"

    return re.compile(re.sub(r"<([^<>]+)>", one, rule).replace("*", "*?") if ".*" in rule else re.sub(r"<([^<>]+)>", one, rule))


def chunk(tags: list[str], grammar: tuple[tuple[str, str], ...] = GRAMMAR) -> list[tuple[str, int, int, int]]:
    """(label, start, end, depth) of all chunks over the tags; depth 0 is outermost."""
    nodes: list[tuple[str, int, int, list]] = [(tag, i, i + 1, []) for i, tag in enumerate(tags)]
    for label, rule in grammar:
        line = "".join(f"<{n[0]}>" for n in nodes)
        if not (matches := [m for m in _compiled(rule).finditer(line) if m.end() > m.start()]):
            continue
        starts, at = {}, 0
        for i, node in enumerate(nodes):
            starts[at] = i
            at += len(node[0]) + 2
        starts[at] = len(nodes)
        for m in reversed(matches):
            inside = nodes[starts[m.start()] : starts[m.end()]]
            nodes[starts[m.start()] : starts[m.end()]] = [(label, inside[0][1], inside[-1][2], inside)]
    found: list[tuple[str, int, int, int]] = []

    def walk(node, depth: int) -> None:
        if node[3]:
            found.append((node[0], node[1], node[2], depth))
            for child in node[3]:
                walk(child, depth + 1)

    for node in nodes:
        walk(node, 0)
    return found


WORDS = 1 << 18  # of word lists that are tagged at a time
_BLANKS = re.compile(r"\s+", re.ASCII)


@lru_cache(maxsize=1 << 16)
def _tag_of(word: str) -> str:
    return tag_word(word)


def tags_of(text: Column) -> Column:
    """array<string>: the tags of all words between blanks; the words stay in Python, as whole texts have many."""

    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [_tag_of(w) for w in _BLANKS.split(t)])

    return of(text)


def word_tags(words: Column, tables: Mapping[str, str] | None = None) -> Column:
    """array<string>: the tags of a word list; some lists at a time, whose different words are tagged once, and only they are Python objects."""

    @F.arrow_udf("array<string>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            made, ends = [], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(lists) or not made:
                below = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, below + WORDS, "right")))
                made.append(_tagged(lists.slice(at, to - at), tables))
                at = to
            yield pa.concat_arrays(made)

    return of(words)


def _tagged(lists: pa.Array, tables: Mapping[str, str] | None) -> pa.Array:
    flat = lists.flatten().dictionary_encode("encode")
    tags = pa.array([None if w is None else tag_word(w, tables) if tables else _tag_of(w) for w in flat.dictionary.to_pylist()], pa.string())
    offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), tags.take(flat.indices), mask=lists.is_null())


def tables_of(**named: Iterable[str]) -> dict[str, str]:
    """Words by tag as tags by word: ``tables_of(CARRIER=["cx"], LOCATION=["hkg"])``; the first tag of a word counts."""
    found: dict[str, str] = {}
    for tag, words in named.items():
        for word in words:
            found.setdefault(word.lower(), tag)
    return found


def tag_tokens(words: Column, tables: Mapping[str, str] | None = None) -> Column:
    """array<struct<word,tag>> of a word list."""
    return F.arrays_zip(words.alias("word"), word_tags(words, tables).alias("tag"))


def spans_of(words: Column, tables: Mapping[str, str] | None = None) -> Column:
    """array<struct<label,start,stop,depth>> of the chunks in a word list."""

    @F.pandas_udf("array<struct<label:string,start:int,stop:int,depth:int>>")
    def of(lists: pd.Series) -> pd.Series:
        rows = lists.map(lambda ws: None if ws is None else chunk([tag_word(w, tables) for w in ws]))
        return rows.map(lambda r: None if r is None else [dict(zip(("label", "start", "stop", "depth"), x, strict=True)) for x in r])

    return of(words)


def words_under(words: Column, spans: Column, ending: str) -> Column:
    """The words of each span whose label ends with ``ending``."""
    wanted = F.filter(spans, lambda s: s["label"].endswith(ending))
    return F.transform(wanted, lambda s: F.array_join(F.slice(words, s["start"] + 1, s["stop"] - s["start"]), " "))


# --- places


def merge_places(words: list[str], places: frozenset[str], longest: int = 4) -> list[tuple[str, int, int]]:
    """(text, start, end) of the longest known places in order; places next to each other, or parted by a comma, are one."""
    found: list[tuple[str, int, int]] = []
    at = 0
    while at < len(words):
        for length in range(min(longest, len(words) - at), 0, -1):
            name = " ".join(words[at : at + length])
            if name.upper() in places:
                if found and (found[-1][2] == at or (found[-1][2] == at - 1 and words[at - 1] == ",")):
                    found[-1] = (" ".join(words[found[-1][1] : at + length]), found[-1][1], at + length)
                else:
                    found.append((name, at, at + length))
                at += length
                break
        else:
            at += 1
    return found


def places_of(words: Column, places: frozenset[str]) -> Column:
    """array<struct<text,start,stop>> of :func:`merge_places` in word lists."""
    known = frozenset(places)

    @F.pandas_udf("array<struct<text:string,start:int,stop:int>>")
    def of(lists: pd.Series) -> pd.Series:
        return lists.map(lambda ws: None if ws is None else [dict(zip(("text", "start", "stop"), x, strict=True)) for x in merge_places(list(ws), known)])

    return of(words)


def words_tagged(tokens: Column, *tags: str) -> Column:
    """The words with one of the tags, in order."""
    return F.transform(F.filter(tokens, lambda t: t["tag"].isin(*tags)), lambda t: t["word"])
