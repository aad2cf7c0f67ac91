"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: marks that part words in CJK texts, currencies, stop words
CJK_MARKS = "，。；：！？、（）《》【】“”‘’"
CURRENCIES = ("CNY", "USD", "HKD", "EUR", "GBP", "JPY", "AUD", "CAD", "SGD", "TWD")
STOP_WORDS = tuple(
    "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing down during each few "
    "for from further had has have having he her here hers him his how i if in into is it its just me more most my no nor not now of off on once only or other our out "
    "over own same she should so some such than that the their them then there these they this those through to too under until up very was we were what when where "
    "which while who whom why will with you your monday tuesday wednesday thursday friday saturday sunday".split()
)


def alpha_tokens(text: Column) -> Column:
    """Runs of A-Z of the text in upper case."""
    return F.regexp_extract_all(F.upper(text), F.lit("[A-Z]+"), F.lit(0))


def wordlist(text: Column) -> Column:
    """Words in order: split at blanks and -/., and CJK marks, blanks dropped."""
    return F.filter(F.split(text, rf"[-/.,\s{CJK_MARKS}]+"), lambda w: w != "")


def split_currency(word: Column) -> Column:
    """``CNY100`` as [CNY, 100]; other words alone."""
    head = F.upper(F.substring(word, 1, 3))
    known = (F.length(word) >= 4) & head.isin(*CURRENCIES) & F.substring(word, 4, 1).rlike("[0-9]")
    return F.when(known, F.array(F.substring(word, 1, 3), F.regexp_replace(word, "^.{3}", ""))).otherwise(F.array(word))


def break_at_numbers(words: Column) -> Column:
    """The word list in pieces that each start at a number; the last one is kept as well."""
    start = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast("array<string>").alias("piece"))

    def step(state, word):
        cut = word.rlike("^[0-9]+$") & (F.size(state["piece"]) > 0)
        done = F.when(cut, F.concat(state["done"], F.array(state["piece"]))).otherwise(state["done"])
        piece = F.when(cut, F.array(word)).otherwise(F.concat(state["piece"], F.array(word)))
        return F.struct(done.alias("done"), piece.alias("piece"))

    return F.aggregate(words, start, step, lambda s: F.when(F.size(s["piece"]) > 0, F.concat(s["done"], F.array(s["piece"]))).otherwise(s["done"]))


def filename_norm(name: Column) -> Column:
    """A file name as lower-case words: separators become blanks, a trailing html goes."""
    spaced = F.regexp_replace(F.translate(name, "_-,;.", "     "), r"\bhtml\b", "")
    return F.trim(F.regexp_replace(F.lower(spaced), " +", " "))


def clean_cell(text: Column) -> Column:
    """Cell text without quotes, no-break spaces and line ends."""
    return F.trim(F.regexp_replace(F.translate(text, "\" \r\n\t", "     "), " +", " "))


def clean_tourcode(code: Column) -> Column:
    """A code without blanks and the prefixes IT and BCODE."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(code, " ", ""), "^IT", ""), "^BCODE", "")


#: Names that begin like a connector and are none.
WHOLE_NAMES = ("TOKYO", "TORONTO", "TOLEDO", "ORLANDO", "ANDORRA")


def unglue_route(word: Column, whole: Sequence[str] = WHOLE_NAMES) -> Column:
    """``TOWUH`` as ``TO WUH``: a connector glued to three or more letters, but for names that begin like one."""
    return F.when(word.isin(*whole), word).otherwise(F.regexp_replace(word, r"^(TO|OR|AND)([A-Z]{3,})$", "$1 $2"))


def route_text(route: Column) -> Column:
    """A route as its parts are read: connectors unglued, ``X ASIA`` as ``X - ASIA``, a lone A between two names as a dash."""
    words = F.filter(F.split(F.upper(F.trim(route)), r"\s+"), lambda w: w != "")
    spaced = F.array_join(F.transform(words, lambda w: unglue_route(w)), " ")
    parted = F.regexp_replace(spaced, r"^(\S+) A (\S+)$", "$1 - $2")
    return F.regexp_replace(parted, r"^(\w+) (ASIA|AISA)$", "$1 - ASIA")


def any_word(text: Column, words: Sequence[str]) -> Column:
    """Whether the text has one of the words as a whole word, in any case."""
    pattern = "|".join(w.lower() for w in words)
    return F.coalesce(F.lower(text).rlike(rf"(^|[^\w])({pattern})($|[^\w])"), F.lit(False))


def word_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, key): an inverted index with a row for each word of each document, to be written sorted or bucketed by word."""
    return docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_]+"), F.lit(0)))).alias("word"), key)


def within_one_edit(one: str, two: str) -> Column:
    """Whether two columns differ by at most one insertion, deletion, change or swap of neighbours."""
    swap = f"exists(sequence(1, greatest(length({one}) - 1, 1)), i -> concat(left({one}, i - 1), substr({one}, i + 1, 1), substr({one}, i, 1), substr({one}, i + 2)) = {two})"
    return F.expr(f"levenshtein({one}, {two}, 1) between 0 and 1 or (length({one}) = length({two}) and {swap})")


def edit_distance(one: str, two: str) -> int:
    """The least number of insertions, deletions, changes and swaps of neighbours between two words."""
    seen: dict[str, int] = {}
    most = len(one) + len(two)
    rows = [[most] * (len(two) + 2), [most, *range(len(two) + 1)]]
    for i, x in enumerate(one, 1):
        line, match = [most, i], 0
        for j, y in enumerate(two, 1):
            last = seen.get(y, 0)  # the last row with this letter
            swap = rows[last][match] + (i - last - 1) + 1 + (j - match - 1)
            line.append(min(rows[i][j] + (x != y), line[j] + 1, rows[i][j + 1] + 1, swap))
            if x == y:
                match = j
        rows.append(line)
        seen[x] = i
    return rows[-1][-1]


def _variants(df: DataFrame, column: str, edits: int) -> DataFrame:
    """Each word with all it becomes by deleting up to ``edits`` of its letters, as ``__key``."""
    one = lambda w: F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.left(w, i - 1), F.substr(w, i + 1)))).otherwise(F.array().cast("array<string>"))
    keys = F.array(F.col(column))
    for _ in range(edits):
        keys = F.array_distinct(F.concat(keys, F.flatten(F.transform(keys, one))))
    return df.withColumn("__key", F.explode(keys))


def spelling_candidates(words: DataFrame, vocabulary: DataFrame, edits: int = 1) -> DataFrame:
    """(word, candidate, freq, distance) for known words at a distance of 0 to ``edits``.

    Words are compared only if they share a variant with at most ``edits`` letters
    deleted: within that distance two words always do, so the join is on equal keys
    and no pair without a chance is made.  The variants of a word of n letters grow
    as n to the power of ``edits``, which is meant for one to four.
    """
    left = _variants(words.select("word").distinct(), "word", edits)
    right = _variants(vocabulary.select(F.col("word").alias("candidate"), "freq"), "candidate", edits)
    pairs = left.join(right, "__key").drop("__key").distinct()
    if edits == 1:
        close = pairs.where(within_one_edit("word", "candidate"))
        return close.withColumn("distance", (F.col("word") != F.col("candidate")).cast("int"))

    @F.pandas_udf("int")
    def distance(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series([edit_distance(a, b) for a, b in zip(one, two, strict=True)], dtype="int32")

    return pairs.withColumn("distance", distance("word", "candidate")).where(F.col("distance") <= edits)


def correct(words: DataFrame, vocabulary: DataFrame, edits: int = 1) -> DataFrame:
    """(word, corrected): itself if known, else the most frequent word the fewest edits away, else itself."""
    order = Window.partitionBy("word").orderBy("distance", F.desc("freq"), "candidate")
    best = spelling_candidates(words, vocabulary, edits).withColumn("r", F.row_number().over(order)).where("r = 1").select("word", "candidate")
    return words.select("word").distinct().join(best, "word", "left").select("word", F.coalesce("candidate", "word").alias("corrected"))


def is_plain_word(word: Column) -> Column:
    """Whether a lower-case word is not a date, a tour code or anything that begins with a number."""
    dated = word.rlike("[0-9](jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)")
    return ~(word.rlike("^[0-9]") | word.rlike("^[a-z0-9_]+ff[0-9]+$") | dated)


def top_words(texts: DataFrame, text: str, n: int, shortest: int = 4, stop: Sequence[str] = STOP_WORDS, word: str = "[a-z]+") -> DataFrame:
    """(word, n) of the most frequent words; ties in order of the word; short and stop words go afterwards."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(word), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(n).where((F.length("word") >= shortest) & ~F.col("word").isin(*stop))


def tf_idf(docs: DataFrame, key: str, text: str, min_df: int = 1) -> DataFrame:
    """(key, word, weight): counts times ln((1+n)/(1+df))+1, each document scaled to length 1."""
    words = docs.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))).alias("word"))
    counts = words.groupBy(key, "word").agg(F.count("*").alias("c"))
    # counted by a condition on c, so both uses of the counts have the same columns and share a shuffle
    frequency = counts.groupBy("word").agg(F.count_if(F.col("c") > 0).alias("df")).where(F.col("df") >= min_df)
    total = docs.select(key).distinct().agg(F.count("*").alias("n"))
    weighted = counts.join(frequency, "word").join(F.broadcast(total)).withColumn("v", F.col("c") * (F.log((1 + F.col("n")) / (1.0 + F.col("df"))) + 1))
    length = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy(key)))
    return weighted.select(key, "word", (F.col("v") / length).alias("weight"))


def is_number(text: Column) -> Column:
    """Whether the text is a number, Unicode digits included."""
    return text.try_cast("double").isNotNull() | text.rlike(r"^\p{N}+$")


def case_of(text: Column) -> Column:
    """upper, title, lower or mixed; null without letters."""
    letters = text.rlike(r"\p{L}")
    return F.when(~letters, F.lit(None)).when(F.upper(text) == text, "upper").when(F.lower(text) == text, "lower").when(text.rlike(r"^[^\p{L}]*\p{Lu}\P{Lu}*$"), "title").otherwise("mixed")


def code_candidates(words: DataFrame, vocabulary: DataFrame, mark: str = "FF") -> DataFrame:
    """(word, candidate) of known codes that differ by one edit after the mark and are equal before it."""
    pairs = spelling_candidates(words, vocabulary)
    return pairs.where(F.substring_index("word", mark, 1) == F.substring_index("candidate", mark, 1)).select("word", "candidate")


def bookmark_number(text: Column) -> Column:
    """The number of a table's bookmark ``<table n>``."""
    return F.regexp_extract(text, r"<table\s+(\d+)>", 1).try_cast("int")
