"""A tagger learnt from tagged tokens: context tables with backoff, then transformation rules.

Tokens are rows (doc, place, word, tag): ``place`` numbers a document's tokens.  Three
tables are counted by Spark: the most frequent tag of a word's ending, of a word,
and of a word after a tag.  Tagging looks them up by joins, the more special one
first.  Then rules of the form "change tag x to y where the neighbours are so" are
learnt greedily: in each round every possible rule is scored at once by what it
would mend and what it would break, and the best is applied to all tokens.

Rules are learnt on a row for each document, with its words, tags and guesses as
lists: a token's neighbours stand in its list, so rounds shuffle counts, not tokens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut, stored

ENDING = 3  # letters
SLICE = 1 << 18  # tokens worked on at once, or one list
NONE = "<none>"  # beyond the ends of a document

#: What a rule may look at: a name and which neighbours, as (column, distance).
TEMPLATES: dict[str, tuple[tuple[str, int], ...]] = {
    "before": (("guess", -1),),
    "after": (("guess", 1),),
    "two before": (("guess", -2),),
    "two after": (("guess", 2),),
    "both sides": (("guess", -1), ("guess", 1)),
    "word before": (("word", -1),),
    "word after": (("word", 1),),
    "word itself": (("word", 0),),
    "word and before": (("word", 0), ("guess", -1)),
}


@dataclass(frozen=True)
class Rule:
    """``old`` becomes ``new`` where the template's neighbours read ``context``."""

    template: str
    context: str
    old: str
    new: str
    score: int


@dataclass(frozen=True)
class Tables:
    """(ending, tag), (word, tag), (before, word, tag), and the tag of everything else."""

    endings: DataFrame
    words: DataFrame
    pairs: DataFrame
    default: str | None


def _commonest(counts: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(keys, tag) from counts (keys, tag, n): each key's most frequent tag, of equally frequent ones the smallest; only keys that are there ``least`` times."""
    counts = counts.groupBy(*keys, "tag").agg(F.sum("n").alias("n"))
    best = counts.groupBy(*keys).agg(F.sum("n").alias("all"), F.min(F.struct((-F.col("n")).alias("n"), "tag"))["tag"].alias("tag"))
    return best.where(F.col("all") >= least).select(*keys, "tag")


def _ending() -> Column:
    return F.when(F.length("word") > ENDING, F.substr("word", F.length("word") - (ENDING - 1))).otherwise(F.col("word"))


def _neighbour(column: str, distance: int) -> Column:
    order = Window.partitionBy("doc").orderBy("place")
    if distance == 0:
        return F.col(column)
    return F.coalesce(F.lag(column, -distance).over(order) if distance < 0 else F.lead(column, distance).over(order), F.lit(NONE))


def learn_tables(tokens: DataFrame, least: int = 2) -> Tables:
    """The context tables of tagged tokens; a context counts if it is there ``least`` times.

    Tokens are read once: all tables come from one count by (before, word, tag).
    Where tokens have ``before``, the tag of the token before, it is not looked up.
    """
    tokens = tokens.where("tag is not null and word is not null")
    after = tokens if "before" in tokens.columns else tokens.withColumn("before", _neighbour("tag", -1))
    pairs = cut(after.groupBy("before", "word", "tag").agg(F.count("*").alias("n")))
    words = cut(pairs.groupBy("word", "tag").agg(F.sum("n").alias("n")))
    default = words.groupBy("tag").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "tag").limit(1).collect()
    return Tables(
        cut(_commonest(words.withColumn("ending", _ending()), ["ending"], least)),
        cut(_commonest(words, ["word"], least)),
        cut(_commonest(pairs, ["before", "word"], least)),
        default[0]["tag"] if default else None,
    )


def tag(tokens: DataFrame, tables: Tables) -> DataFrame:
    """``tokens`` with ``guess``: by word or ending first, then by the word after the first guess of the token before.

    A word that no table knows, or a null one, gets the default.
    """
    first = tokens.withColumn("ending", _ending()).join(tables.words.withColumnRenamed("tag", "by_word"), "word", "left")
    first = first.join(tables.endings.withColumnRenamed("tag", "by_ending"), "ending", "left")
    first = first.withColumn("guess", F.coalesce("by_word", "by_ending", F.lit(tables.default))).drop("by_word", "by_ending", "ending")
    context = first.withColumn("before", _neighbour("guess", -1))
    second = context.join(tables.pairs.withColumnRenamed("tag", "by_pair"), ["before", "word"], "left")
    return second.withColumn("guess", F.coalesce("by_pair", "guess")).drop("by_pair", "before")


def tag_lists(words: Column, tables: Tables) -> Column:
    """array<string>: the guesses of :func:`tag` for lists of words.

    The tables are sent to all tasks, so this is for words of a closed set, such as parts of speech.
    """
    by_word = {r["word"]: r["tag"] for r in tables.words.collect()}
    by_ending = {r["ending"]: r["tag"] for r in tables.endings.collect()}
    by_pair = {(r["before"], r["word"]): r["tag"] for r in tables.pairs.collect()}
    default = tables.default

    def guess(word: str | None) -> str | None:
        return default if word is None else by_word.get(word, by_ending.get(word[-ENDING:], default))

    @F.arrow_udf("array<string>")
    def of(words: pa.Array) -> pa.Array:
        made = []
        for (part,) in _parts(words):
            some = _Tokens(part)
            flat = some.numbers(part)
            first = np.array([some.number(guess(w)) for w in list(some.names)], np.int64)[flat]
            pairs, at = _dense(some.neighbours(first, -1) * len(some.names) + flat, len(some.names) ** 2)
            names = list(some.names)
            second = [by_pair.get((names[p // len(names)], names[p % len(names)])) for p in pairs.tolist()]
            second = np.array([-1 if t is None else some.number(t) for t in second], np.int64)[at]
            made.append(some.lists(np.where(second < 0, first, second)))
        return pa.concat_arrays(made)

    return of(words)


class _Tokens:
    """The tokens of some lists, one after the other; words and tags are numbers of names, 0 is null and 1 beyond a list's ends."""

    def __init__(self, lists: pa.ListArray) -> None:
        self.names: dict[str | None, int] = {None: 0, NONE: 1}
        self.null = lists.is_null()
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        self.ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.low, self.high = np.repeat(self.ends[:-1], sizes), np.repeat(self.ends[1:], sizes)

    def number(self, name: str | None) -> int:
        return self.names.setdefault(name, len(self.names))

    def numbers(self, lists: pa.ListArray) -> np.ndarray:
        flat = lists.flatten().dictionary_encode("encode")
        return np.array([self.number(n) for n in flat.dictionary.to_pylist()], np.int64)[flat.indices.to_numpy(zero_copy_only=False)]

    def lists(self, flat: np.ndarray) -> pa.ListArray:
        names = pa.array(list(self.names), pa.string())
        return pa.ListArray.from_arrays(pa.array(self.ends.astype(np.int32)), names.take(pa.array(flat)), mask=self.null)

    def neighbours(self, flat: np.ndarray, distance: int) -> np.ndarray:
        if distance == 0:
            return flat
        at = np.arange(distance, len(flat) + distance)
        found = np.where((at >= self.low) & (at < self.high), np.take(flat, at, mode="clip"), 1) if len(flat) else flat.copy()
        found[found == 0] = 1
        return found

    def reads(self, columns: dict[str, np.ndarray], parts: Sequence[tuple[str, int]]) -> tuple[list[str], np.ndarray]:
        """What a template reads: the texts, and the number of each token's text."""
        size, names = len(self.names), list(self.names)
        keys, at = [()], np.zeros(len(self.low), np.int64)
        for column, distance in parts:
            found, at = _dense(at * size + self.neighbours(columns[column], distance), len(keys) * size)
            keys = [(*keys[k // size], names[k % size]) for k in found.tolist()]
        return [" ".join(n for n in k if n is not None) for k in keys], at

    def mend(self, columns: dict[str, np.ndarray], rules: Sequence[Rule], templates: dict[str, tuple[tuple[str, int], ...]]) -> None:
        for rule in rules:
            old, new = self.number(rule.old), self.number(rule.new)
            texts, at = self.reads(columns, templates[rule.template])
            fits = np.array([t == rule.context for t in texts], bool)[at] & (columns["guess"] == old)
            columns["guess"] = np.where(fits, new, columns["guess"])


def _dense(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different codes below ``size``, and each one's place among them."""
    if size > max(4 * len(codes), 1 << 16):
        return np.unique(codes, return_inverse=True)
    there = np.zeros(size, bool)
    there[codes] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[codes]


def _parts(*lists: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """Columns of lists in parts of up to ``SLICE`` tokens or one row; one empty part if there is no row."""
    ends = np.cumsum(lists[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, rows = 0, len(lists[0])
    while True:
        after = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
        yield tuple(x.slice(at, after - at) for x in lists)
        if after >= rows:
            return
        at = after


def _counts(lists: DataFrame, rules: list[Rule], templates: dict[str, tuple[tuple[str, int], ...]]) -> DataFrame:
    """(template, context, guess, tag, n): what the templates read at the tokens after the rules, counted for some lists at a time and then for all."""
    rules = list(rules)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, tags, guesses in _parts(*batch.columns):
                some = _Tokens(words)
                columns, tag = {"word": some.numbers(words), "guess": some.numbers(guesses)}, some.numbers(tags)
                some.mend(columns, rules, templates)
                size, names = len(some.names), pa.array(list(some.names), pa.string())
                judged = (tag != 0) & (columns["guess"] != 0)
                both, kind = _dense(columns["guess"] * size + tag, size * size)
                for template, parts in templates.items():
                    texts, at = some.reads(columns, parts)
                    found, row = _dense((at * len(both) + kind)[judged], len(texts) * len(both))
                    pair = both[found % max(len(both), 1)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([template] * len(found), pa.string()),
                            pa.array(texts, pa.string()).take(pa.array(found // max(len(both), 1))),
                            names.take(pa.array(pair // size)),
                            names.take(pa.array(pair % size)),
                            pa.array(np.bincount(row, minlength=len(found)).astype(np.int64)),
                        ],
                        ["template", "context", "guess", "tag", "n"],
                    )

    made = lists.select("words", "tags", "guesses").mapInArrow(of, "template string, context string, guess string, tag string, n long")
    return made.groupBy("template", "context", "guess", "tag").agg(F.sum("n").alias("n"))


def _as_lists(tokens: DataFrame) -> DataFrame:
    """(words, tags, guesses) of each document of tokens (doc, place, word, tag, guess)."""
    of = tokens.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("place", "word", "tag", "guess"))).alias("t"))
    return of.select(F.col("t.word").alias("words"), F.col("t.tag").alias("tags"), F.col("t.guess").alias("guesses"))


def learn_rules(tagged: DataFrame, most: int = 10, least: int = 5, templates: dict[str, tuple[tuple[str, int], ...]] | None = None) -> list[Rule]:
    """Up to ``most`` rules, each the best after those before it, that mend at least ``least`` tokens more than they break.

    ``tagged`` has doc, place, word, tag, guess, or lists of them: words, tags, guesses.
    A rule's score is the number of tokens it would mend, less those that were right and
    read the same; both are counts by (template, context, guess), so one aggregation
    scores all rules.  Ties go by the rule's text.  The lists are written once; each
    round applies the rules so far as it reads them.
    """
    templates = templates or TEMPLATES
    rules: list[Rule] = []
    with stored(tagged.select("words", "tags", "guesses") if "guesses" in tagged.columns else _as_lists(tagged)) as lists:
        while len(rules) < most:
            whole = _counts(lists, rules, templates).groupBy("template", "context", "guess").agg(
                F.coalesce(F.sum(F.when(F.col("tag") == F.col("guess"), F.col("n"))), F.lit(0)).alias("right"),
                F.max(F.when(F.col("tag") != F.col("guess"), F.struct("n", "tag"))).alias("wrong"),
            )
            scored = whole.where("wrong is not null").withColumn("score", F.col("wrong.n") - F.col("right")).where(F.col("score") >= least)
            best = scored.orderBy(F.desc("score"), "template", "context", "guess", "wrong.tag").limit(1).collect()
            if not best:
                break
            rules.append(Rule(best[0]["template"], best[0]["context"], best[0]["guess"], best[0]["wrong"]["tag"], best[0]["score"]))
    return rules


def mended(words: Column, guesses: Column, rules: list[Rule], templates: dict[str, tuple[tuple[str, int], ...]] | None = None) -> Column:
    """array<string>: lists of guesses changed by the rules as by :func:`apply_rules`."""
    chosen, templates = list(rules), templates or TEMPLATES

    @F.arrow_udf("array<string>")
    def of(words: pa.Array, guesses: pa.Array) -> pa.Array:
        made = []
        for part, given in _parts(words, guesses):
            some = _Tokens(part)
            columns = {"word": some.numbers(part), "guess": some.numbers(given)}
            some.mend(columns, chosen, templates)
            made.append(some.lists(columns["guess"]))
        return pa.concat_arrays(made)

    return of(words, guesses)


def apply_rules(tagged: DataFrame, rules: list[Rule], templates: dict[str, tuple[tuple[str, int], ...]] | None = None) -> DataFrame:
    """``tagged`` with its guesses changed by the rules, one after the other; a rule reads what the last one left."""
    templates = templates or TEMPLATES
    for rule in rules:
        reads = F.concat_ws(" ", *[_neighbour(c, d) for c, d in templates[rule.template]])
        tagged = tagged.withColumn("__reads", reads)
        fits = (F.col("guess") == rule.old) & (F.col("__reads") == rule.context)
        tagged = tagged.withColumn("guess", F.when(fits, F.lit(rule.new)).otherwise(F.col("guess"))).drop("__reads")
    return tagged


def iob(tokens: DataFrame, spans: DataFrame, label: str) -> DataFrame:
    """``tokens`` (doc, place, ...) with ``tag``: B- for the first token of a span, I- for its others, O for the rest; ``spans`` are (doc, start, stop)."""
    inside = spans.select("doc", "start", F.explode(F.sequence("start", F.col("stop") - 1)).alias("place"))
    marks = inside.select("doc", "place", F.when(F.col("place") == F.col("start"), f"B-{label}").otherwise(f"I-{label}").alias("tag"))
    return tokens.join(marks, ["doc", "place"], "left").withColumn("tag", F.coalesce("tag", F.lit("O")))
