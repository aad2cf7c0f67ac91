"""A cascade of chunk rules over tags, compiled to finite automata.

A grammar is a list of stages, each a label with rules that are data.  In a rule,
``<A|B>`` is a tag, ``<.*>`` any tag, ``? * +`` and groups ``( | )`` work as usual,
``{...}`` is what becomes a chunk and ``}...{`` what is taken out of a chunk (a
chink).  What stands before and after is context: it has to be there, but stays
outside.  A rule's matches are the leftmost, then the longest, and don't overlap;
a stage's rules apply one after the other to what is not yet in a chunk of that
stage (chinks to what is).  After a stage each chunk is one node that has the
stage's label for its tag, so later stages build on it.

Patterns become deterministic automata over tag numbers.  Some rows of an Arrow
batch (up to ``SLICE`` tags, or one list) are one array of tag numbers with a stop
between rows, and an automaton runs from all places at once, a step for each tag.
Places still alive after ``STEPS`` steps go on only if no match before covers them,
so a rule that matches a whole list takes each tag once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Grammar = Sequence[tuple[str, Sequence[str]]]
STOP = 0  # between rows, and for what a rule must not see; 1 is any tag that no rule names
SPANS = "array<struct<label:string,start:int,stop:int,stage:int>>"
SLICE = 1 << 18  # tags worked on at once
STEPS = 32


class _Pattern:
    """A pattern as a nondeterministic automaton by Thompson's construction."""

    def __init__(self, text: str, codes: dict[str, int]):
        self.steps: list[list[tuple[frozenset[int] | None, int]]] = []  # (tags or None for a free move, target)
        self.codes, self.items, self.at = codes, re.findall(r"<[^<>]+>|[()|?*+]", text), 0
        if "".join(self.items) != re.sub(r"\s", "", text):
            raise ValueError(f"not a pattern: {text}")
        self.first, self.last = self._either()
        if self.at != len(self.items):
            raise ValueError(f"not a pattern: {text}")

    def _state(self) -> int:
        self.steps.append([])
        return len(self.steps) - 1

    def _free(self, a: int, b: int) -> None:
        self.steps[a].append((None, b))

    def _peek(self) -> str:
        return self.items[self.at] if self.at < len(self.items) else ""

    def _either(self) -> tuple[int, int]:
        first, last = self._state(), self._state()
        while True:
            a, b = self._row()
            self._free(first, a)
            self._free(b, last)
            if self._peek() != "|":
                return first, last
            self.at += 1

    def _row(self) -> tuple[int, int]:
        first = last = self._state()
        while self._peek() not in ("", "|", ")"):
            a, b = self._one()
            while self._peek() in ("?", "*", "+"):
                mark = self._peek()
                self.at += 1
                start, end = self._state(), self._state()
                self._free(start, a)
                self._free(b, end)
                if mark != "+":
                    self._free(start, end)
                if mark != "?":
                    self._free(end, start)
                a, b = start, end
            self._free(last, a)
            last = b
        return first, last

    def _one(self) -> tuple[int, int]:
        item = self._peek()
        self.at += 1
        if item == "(":
            inside = self._either()
            if self._peek() != ")":
                raise ValueError("a group is not closed")
            self.at += 1
            return inside
        names = item[1:-1].split("|")
        tags = frozenset(range(1, len(self.codes) + 2)) if names == [".*"] else frozenset(self.codes[n] for n in names)
        first, last = self._state(), self._state()
        self.steps[first].append((tags, last))
        return first, last


@dataclass(frozen=True)
class Automaton:
    """Deterministic: ``moves[state, tag]`` is the next state, 0 is dead, 1 the start."""

    moves: np.ndarray
    final: np.ndarray

    @classmethod
    def of(cls, pattern: str, codes: dict[str, int], backwards: bool = False) -> Automaton:
        made = _Pattern(pattern, codes)
        steps, first, last = made.steps, made.first, made.last
        if backwards:
            turned: list[list] = [[] for _ in steps]
            for a, edges in enumerate(steps):
                for tags, b in edges:
                    turned[b].append((tags, a))
            steps, first, last = turned, last, first

        def closure(states: set[int]) -> frozenset[int]:
            open_ = list(states)
            while open_:
                for tags, b in steps[open_.pop()]:
                    if tags is None and b not in states:
                        states.add(b)
                        open_.append(b)
            return frozenset(states)

        numbers, waiting, rows = {frozenset(): 0, (start := closure({first})): 1}, [start], {0: [0] * (len(codes) + 2)}
        while waiting:
            own = waiting.pop()
            row = [0] * (len(codes) + 2)
            for tag in range(1, len(codes) + 2):
                to = closure({b for a in own for tags, b in steps[a] if tags and tag in tags})
                if to not in numbers:
                    numbers[to] = len(numbers)
                    waiting.append(to)
                row[tag] = numbers[to]
            rows[numbers[own]] = row
        return cls(np.array([rows[i] for i in range(len(rows))], np.int32), np.array([last in s for s in sorted(numbers, key=numbers.get)]))

    def ends(self, tags: np.ndarray, starts: np.ndarray, step: int = 1, allowed: np.ndarray | None = None, steps: int | None = None) -> np.ndarray | tuple:
        """For each start the end of the longest match (the place after it, or before it backwards), -1 for none.

        ``allowed`` says at which places a match may end.  With ``steps`` the run stops
        after so many, and those still alive are returned too: (ends, starts' numbers, states).
        """
        found = np.where(self.final[1] & (True if allowed is None else allowed[starts]), starts, -1)
        alive, state, at = np.arange(len(starts)), np.ones(len(starts), np.int32), starts.copy()
        while len(alive) and steps != 0:
            steps = None if steps is None else steps - 1
            here = at if step > 0 else at - 1
            inside = (here >= 0) & (here < len(tags))
            alive, state, at, here = alive[inside], state[inside], at[inside], here[inside]
            state = self.moves[state, tags[here]]
            live = state > 0
            alive, state, at = alive[live], state[live], at[live] + step
            done = self.final[state]
            if allowed is not None:
                done = done & allowed[at]
            found[alive[done]] = at[done]
        return found if steps is None else (found, alive, state)

    def going_on(self, tags: list[int], at: int, state: int, end: int, allowed: list[bool] | None) -> int:
        """The end of the longest match of one start that is in ``state`` at a place; ``end`` is its longest so far."""
        moves, final = self.lists
        while at < len(tags) and (state := moves[state][tags[at]]):
            at += 1
            if final[state] and (allowed is None or allowed[at]):
                end = at
        return end

    @cached_property
    def lists(self) -> tuple[list[list[int]], list[bool]]:
        return self.moves.tolist(), self.final.tolist()

    def fits(self, tags: np.ndarray, places: np.ndarray, step: int = 1) -> np.ndarray:
        """Whether some match begins (backwards: ends) at each place."""
        return self.ends(tags, places, step) >= 0


@dataclass(frozen=True)
class Rule:
    body: Automaton
    before: Automaton | None
    after: Automaton | None
    chink: bool

    @classmethod
    def of(cls, text: str, codes: dict[str, int]) -> Rule:
        shape = re.fullmatch(r"\s*([^{}]*)([{}])([^{}]+)([{}])([^{}]*)", text)
        if not shape or shape[2] == shape[4]:
            raise ValueError(f"not a rule: {text}")
        before, mark, body, _, after = (shape[i].strip() for i in range(1, 6))
        return cls(Automaton.of(body, codes), Automaton.of(before, codes, backwards=True) if before else None, Automaton.of(after, codes) if after else None, mark == "}")

    def places(self, tags: np.ndarray, hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places inside matches among those that are not hidden, and each one's match's start; contexts see all."""
        seen = np.where(hidden, STOP, tags)
        starts = np.flatnonzero(self.body.moves[1, seen] > 0)
        if self.before is not None:
            starts = starts[self.before.fits(tags, starts, -1)]
        allowed = None
        if self.after is not None and len(starts):
            allowed = self.after.fits(tags, np.arange(len(tags) + 1))
        ends, alive, state = self.body.ends(seen, starts, 1, allowed, STEPS)
        states = np.zeros(len(starts), np.int32)
        states[alive] = state
        good = (ends > starts) | (states > 0)
        first, sizes, last, seen_list, allowed_list = [], [], 0, None, None
        for start, end, state in zip(starts[good].tolist(), ends[good].tolist(), states[good].tolist(), strict=True):
            if start >= last:
                if state:
                    if seen_list is None:
                        seen_list, allowed_list = seen.tolist(), None if allowed is None else allowed.tolist()
                    end = self.body.going_on(seen_list, start + STEPS, state, end, allowed_list)
                    if end <= start:
                        continue
                first.append(start)
                sizes.append(end - start)
                last = end
        heads, sizes = np.array(first, np.int64), np.array(sizes, np.int64)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(heads, sizes) + inside, np.repeat(heads, sizes)


class Cascade:
    """A compiled grammar."""

    def __init__(self, grammar: Grammar):
        named = {n for label, rules in grammar for n in (label, *(x for r in rules for names in re.findall(r"<([^<>]+)>", r) if names != ".*" for x in names.split("|")))}
        self.codes = {n: i for i, n in enumerate(sorted(named), 2)}
        # 'any' covers 1 and all named tags
        self.stages = [(label, [Rule.of(r, {n: i for n, i in self.codes.items()}) for r in rules]) for label, rules in grammar]

    def spans(self, lists: Sequence[Sequence[str] | None]) -> list[list[tuple[str, int, int, int]] | None]:
        """(label, start, stop, stage) of all chunks of each list of tags, by stage and place; null stays null."""
        found: list[list | None] = [None if tags is None else [] for tags in lists]
        flat = [self.codes.get(t, 1) for tags in lists for t in tags or ()]
        for number, row, start, stop in self.chunks(np.array(flat, np.int32), np.array([len(tags or ()) for tags in lists], np.int64)):
            for r, a, b in zip(row.tolist(), start.tolist(), stop.tolist(), strict=True):
                found[r].append((self.stages[number][0], a, b, number))
        return found

    def chunks(self, flat: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(stage, rows, starts, stops) of the chunks that each stage makes in lists of tag numbers that follow each other."""
        if not len(sizes):
            return
        row = np.repeat(np.arange(len(sizes)), sizes + 1)
        first = np.cumsum(sizes + 1) - sizes - 1
        start = np.arange(len(row)) - first[row]
        tags = np.full(len(row), STOP, np.int32)
        tags[start < sizes[row]] = flat
        stop = start + 1
        for number, (label, rules) in enumerate(self.stages):
            chunk = np.zeros(len(tags), np.int64)  # 0 outside, else a number that neighbouring chunks don't share
            for rule in rules:
                places, heads = rule.places(tags, chunk == 0 if rule.chink else chunk > 0)
                chunk[places] = 0 if rule.chink else heads + 1
                if rule.chink:  # what is left on both sides of a chink are chunks of their own
                    first = np.flatnonzero((chunk > 0) & (chunk != np.concatenate([[0], chunk[:-1]])))
                    chunk = np.where(chunk > 0, np.concatenate([[0], first + 1])[np.searchsorted(first, np.arange(len(chunk)), side="right")], 0)
            if not chunk.any():
                continue
            first = (chunk == 0) | (chunk != np.concatenate([[0], chunk[:-1]]))
            heads = np.flatnonzero(first)
            tails = np.append(heads[1:], len(tags)) - 1
            made = chunk[heads] > 0
            tags = np.where(made, self.codes[label], tags[heads]).astype(np.int32)
            row, start, stop = row[heads], start[heads], stop[tails]
            yield number, row[made], start[made], stop[made]

    def numbers(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all tags of some lists, and the lists' sizes."""
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        words = lists.flatten().dictionary_encode("encode")
        codes = np.array([self.codes.get(t, 1) for t in words.dictionary.to_pylist()], np.int32)
        flat = codes[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int32)
        return flat, sizes

    def column(self, lists: pa.ListArray) -> pa.ListArray:
        """The chunks of lists of tags as an Arrow array of ``SPANS``."""
        flat, sizes = self.numbers(lists)
        found = list(self.chunks(flat, sizes))
        row, start, stop = (np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in (1, 2, 3))
        stage = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int32)
        order = np.argsort(row, kind="stable")
        labels = pa.DictionaryArray.from_arrays(pa.array(stage[order]), pa.array([label for label, _ in self.stages], pa.string())).cast(pa.string())
        values = pa.StructArray.from_arrays([labels, *(pa.array(x[order].astype(np.int32)) for x in (start, stop, stage))], ["label", "start", "stop", "stage"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=lists.is_null())


def slices(lists: pa.ListArray, most: int) -> Iterator[pa.ListArray]:
    """An array of lists in parts of up to ``most`` values or one list."""
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(lists):
        after = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield lists.slice(at, after - at)
        at = after


def cascade(tags: Column, grammar: Grammar) -> Column:
    """array<struct<label,start,stop,stage>>: the chunks of lists of tags, by stage and place; a null list has none.

    Lists of any length; a list is worked on whole, with some tens of bytes for each tag.
    """
    rules = tuple((label, tuple(r)) for label, r in grammar)

    @F.arrow_udf(SPANS)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = Cascade(rules)
        for lists in batches:
            if not len(lists):
                yield made.column(lists)
            for part in slices(lists, SLICE):
                yield made.column(part)

    return of(tags)


def marks(tags: Column, grammar: Grammar, label: str) -> Column:
    """array<string>: B- for the first tag of each chunk with the label, I- for its others, O for the rest; of nested ones the last stage's count."""
    rules = tuple((name, tuple(r)) for name, r in grammar)
    rules = rules[: 1 + max((i for i, r in enumerate(rules) if r[0] == label), default=0)]  # stages after the label's last can't change its chunks

    @F.arrow_udf("array<string>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made, names = Cascade(rules), pa.array(["O", f"B-{label}", f"I-{label}"], pa.string())
        for lists in batches:
            for part in slices(lists, SLICE) if len(lists) else (lists,):
                flat, sizes = made.numbers(part)
                first, kind = np.cumsum(sizes) - sizes, np.zeros(len(flat) + 1, np.int8)
                for stage, row, start, stop in made.chunks(flat, sizes):
                    if made.stages[stage][0] == label:
                        long = stop - start
                        at = np.repeat(first[row] + start, long)
                        kind[at + np.arange(len(at)) - np.repeat(np.cumsum(long) - long, long)] = 2
                        kind[first[row] + start] = 1
                offsets = np.append(first, len(flat)).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(kind[:-1])), mask=part.is_null())

    return of(tags)


#: Phrases of plain English, in six stages: noun phrases; after a preposition; goals; left parts of pairs; clauses by chinks; chains of clauses.
PHRASES: Grammar = (
    ("NP", ("{<DT>?<JJ|VBG|VBD>*<NN|NNS>+}",)),
    ("PP", ("{<IN><NP>}",)),
    ("GOAL", ("<TO>{<NP>}",)),
    ("LEFT", ("{<NP|PP|GOAL>}<AND|OR>",)),
    ("CLAUSE", ("{<.*>+}", "}<AND|OR|COMMA|MARK>+{")),
    ("CHAIN", ("{<CLAUSE>(<AND|OR><CLAUSE>)+}",)),
)

#: Dates, periods, places, flights and fares of commercial notices.
NOTICES: Grammar = (
    ("DATE", ("{<CD><MM|MD><CD>}", "{<MM><CD><COMMA>?<CD>}", "{<CD><SLASH><CD><SLASH><CD>}", "{<DAY>}", "<EFFECTIVE|FROM|TO>{<CD><MM>|<MM><CD>}", "{<CD><MM>|<MM><CD>}<TO|UFN>")),
    ("PLACES", ("{<LOCATION>(<AND|OR|SLASH|COMMA><LOCATION>)*}",)),
    ("FLIGHT", ("{<CARRIER><CD>(<SLASH|COMMA|AND><CD>)*}",)),
    ("OPENING", ("{<DATE>}<TO><DATE|UFN>", "<FROM|EFFECTIVE>{<DATE>}", "{<DATE>}<UFN>")),
    ("CLOSING", ("<OPENING><TO>{<DATE|UFN>}", "<TO>{<DATE>}", "<OPENING>{<UFN>}")),
    ("SALESPERIOD", ("{<SALES>+<VALIDITY>?<IN>?<FROM|EFFECTIVE>?<OPENING>(<TO>?<CLOSING>)?}", "{<SALES>+<VALIDITY>?<TO><CLOSING>}")),
    ("TRAVELPERIOD", ("{<TRAVEL>+<VALIDITY>?<IN>?<FROM|EFFECTIVE>?<OPENING>(<TO>?<CLOSING>)?}", "{<TRAVEL>+<VALIDITY>?<TO><CLOSING>}")),
    ("EXTENSION", ("<PREVIOUS><VERSION><.*>*{<TO><CLOSING>}",)),
    ("ORIGINS", ("<ORIGINATING><FROM|IN>?{<PLACES>}", "{<PLACES>}<ORIGINATING>")),
    ("ROUTE", ("{<FROM>?<PLACES|ORIGINS><TO><PLACES>}",)),
    ("EXCLUDED", ("<EXCLUDING>{<FLIGHT|PLACES|ROUTE>}", "<OTHER><THAN>{<PLACES|FLIGHT>}")),
    ("FARES", ("{<CABIN>(<AND|OR|SLASH|COMMA><CABIN>)*<CLASS>?<FARE>?}", "{<FARE>}")),
    ("RATE", ("{<PERCENT><CORPORATE|AGENT>?<DISCOUNT>}", "<DISCOUNT><IN>?{<PERCENT>}")),
    ("NOTICE", ("{<.*>+}", "}<MARK>+{")),
)
