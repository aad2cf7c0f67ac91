"""Language of texts, script by script, and Chinese conversion."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.dictionary import Automaton, convert_texts

# fixed values: frequent function words by language
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are as with be by this not or from",
    "fr": "le la les de des du et en un une que qui pour dans sur pas est au avec par",
    "de": "der die das und ist in den von zu mit sich des auf für nicht ein eine dem als auch",
    "es": "el la los las de que y en un una por con para no se su al del lo es",
}
_SETS = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}


def detect(text: str | None) -> str:
    """en, fr, de, es, zh, or empty for a text without words; ties in alphabetical order."""
    words = (text or "").lower().split()
    if not words:
        return ""
    letters = [c for c in text if c.isalpha()]
    if letters and sum("一" <= c <= "鿿" for c in letters) * 5 > len(letters):
        return "zh"
    counts = {lang: sum(w.strip(".,;:!?") in known for w in words) for lang, known in _SETS.items()}
    best = max(sorted(counts), key=counts.__getitem__)
    return best if counts[best] else ""


def detect_language(text: Column) -> Column:
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(detect)

    return of(text)


def detect_all(text: str | None, least: float = 0.1) -> list[str]:
    """All languages of a text, sorted: those whose function words are a share of its words, zh by its characters."""
    words = (text or "").lower().split()
    letters = [c for c in text or "" if c.isalpha()]
    shares = {lang: sum(w.strip(".,;:!?") in known for w in words) / max(len(words), 1) for lang, known in _SETS.items()}
    shares["zh"] = sum("一" <= c <= "鿿" for c in letters) / max(len(letters), 1)
    return sorted(lang for lang, share in shares.items() if share > least)


def languages(text: Column) -> Column:
    """array<string>: the languages of each text; no language for a text without words."""

    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(detect_all)

    return of(text)


def nfkd(text: Column) -> Column:
    """The text in compatibility decomposition."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))

    return of(text)


def convert_phrases(text: str, phrases: Mapping[str, str]) -> str:
    """One text with known phrases by their counterparts, in as few parts as can be."""
    return convert_texts([text], Automaton.of(phrases), phrases)[0] or ""


def bigrams(text: Column) -> Column:
    """Overlapping pairs of CJK characters, for texts without blanks."""
    runs = F.regexp_extract_all(text, F.lit("[一-鿿]+"), F.lit(0))
    pairs = lambda r: F.when(F.length(r) < 2, F.array(r)).otherwise(F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substr(r, i, F.lit(2))))
    return F.flatten(F.transform(runs, pairs))
