"""Word lists of rules and documents: clean-up, spelling of months, stop words, stems."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import CJK_MARKS, CURRENCIES, STOP_WORDS

# fixed values: stop words that stay or are added, short forms, months, and what each mark becomes
KEPT_FOR_RULES = frozenset(("no", "not", "before", "after"))
KEPT_FOR_CHUNKS = frozenset(("no", "not", "other", "to", "and", "or", "can"))
ADDED_FOR_CHUNKS = frozenset(("apply", "applicable", "applies", "payable", "applied", "html"))
SHORT_FORMS = {"ISSD": "SALES", "TRVL": "TRAVEL", "EFF": "EFFECTIVE", "OWL": "ONE WORLD ALLIANCE"}
MONTHS = "JANUARY FEBRUARY MARCH APRIL MAY JUNE JULY AUGUST SEPTEMBER OCTOBER NOVEMBER DECEMBER".split()
_MARKS = str.maketrans(dict.fromkeys("()!@#$\"“”`") | dict.fromkeys(":,'", " ") | {"/": " / ", "-": " - "})
_CODE = re.compile(r"\w+FF\d+")
_GLUED = re.compile(r"(?<=\d)(?=[A-Za-z])|(?<=[A-Za-z])(?=\d)")


def rule_words(text: str | None, kept: frozenset[str] = KEPT_FOR_RULES) -> list[str]:
    """The words of a rule: marks gone, upper-case stop words gone, currencies split from their amounts."""
    words: list[str] = []
    for word in (text or "").translate(_MARKS).replace("&", " & ").split():
        word = word.rstrip(".")
        if word.isupper() and word.lower() in STOP_WORDS and word.lower() not in kept:
            continue
        if len(word) >= 4 and word[:3].upper() in CURRENCIES and word[3].isdigit():
            words += [word[:3], word[3:]]
        elif word:
            words.append(word)
    return words


def chunk_words(text: str | None) -> list[str]:
    """The words for chunking: digits and letters apart but in tour codes, typos of COMMISSION and short forms in full."""
    words: list[str] = []
    for word in rule_words(text, KEPT_FOR_CHUNKS):
        if word.lower() in ADDED_FOR_CHUNKS:
            continue
        if re.match(r"COMM?ISS?IONS?\w*$", word, re.I):
            word = "COMMISSION"
        if (full := SHORT_FORMS.get(word.upper())) is not None:
            words += full.split()
        elif _CODE.fullmatch(word):
            words.append(word)
        else:
            words += _GLUED.split(word)
    return words


def near(one: str, two: str) -> bool:
    """Whether two words are equal but for one letter too many, missing or changed, or two neighbours swapped."""
    short = min(len(one), len(two))
    head = next((i for i in range(short) if one[i] != two[i]), short)
    tail = next((i for i in range(short - head) if one[-1 - i] != two[-1 - i]), short - head)
    a, b = one[head : len(one) - tail], two[head : len(two) - tail]
    return max(len(a), len(b)) <= 1 or (len(a) == 2 and a == b[::-1])


@lru_cache(1 << 16)
def month_of(word: str) -> str | None:
    """The month an upper-case word names: in full, by its first three letters, or with one typo if its name is long."""
    for month in MONTHS:
        if word in (month, month[:3]):
            return month
    return next((m for m in MONTHS if len(m) > 4 and near(word, m)), None)


def correct_months(words: list[str] | None) -> list[str]:
    """Misspelt months put right, in the case they were written in; other words stay."""
    out = []
    for word in words or []:
        month = month_of(word.upper()) if word.isalpha() else None
        if month is None or len(word) == 3:
            out.append(word)
        else:
            out.append(month if word.isupper() else month.title() if word.istitle() else month.lower())
    return out


def stems(text: str | None) -> list[str]:
    """Lower-case words without digits, marks, stop words and single letters, cut to a simple stem."""
    out = []
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        if len(word) < 2 or word in STOP_WORDS:
            continue
        for ending, put in (("ies", "y"), ("sses", "ss"), ("ing", ""), ("ed", ""), ("s", "")):
            if word.endswith(ending) and len(word) - len(ending) + len(put) >= 3 and not word.endswith("ss" if ending == "s" else "\0"):
                word = word[: -len(ending)] + put
                break
        out.append(word)
    return out


def _column(function, text: Column) -> Column:
    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(function)

    return of(text)


def rule_words_of(text: Column) -> Column:
    return _column(rule_words, text)


def chunk_words_of(text: Column) -> Column:
    return _column(chunk_words, text)


def stems_of(text: Column) -> Column:
    return _column(stems, text)


def correct_months_of(words: Column) -> Column:
    return _column(lambda ws: correct_months(None if ws is None else list(ws)), words)


def sentences(text: Column) -> Column:
    """A text cut after full stops, question and exclamation marks that a blank follows, and at line ends."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?。！？])\s+|\n+"), F.trim), lambda x: x != "")


def wordlist_of(text: Column) -> Column:
    """struct(words, tokens): the words of :func:`rule_words_of`, split again at separators, in order and as a sorted set."""
    pieces = F.flatten(F.transform(rule_words_of(text), lambda w: F.split(w, rf"[-/.,\s{CJK_MARKS}]+")))
    words = F.filter(F.transform(pieces, F.trim), lambda w: w != "")
    return F.struct(words.alias("words"), F.array_sort(F.array_distinct(words)).alias("tokens"))


def flat(texts: Column) -> Column:
    """Words of texts that may hold several each."""
    return F.filter(F.flatten(F.transform(texts, lambda t: F.split(F.trim(t), r"\s+"))), lambda w: w != "")


def header_clean(text: Column) -> Column:
    """A header's words in upper case without marks, typos of months and of COMMISSION put right."""
    words = F.filter(F.split(F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\w%/&]+", " ")), r"\s+"), lambda w: w != "")
    fixed = F.transform(words, lambda w: F.when(w.rlike(r"^COMM?ISS?IONS?$"), "COMMISSION").otherwise(w))
    return F.array_join(correct_months_of(fixed), " ")
