"""The chunk cascade against a plain matcher with Python's regular expressions."""

from __future__ import annotations

import random
import re

import pytest

from millrace.functions import cascade as C
from millrace.functions.tagging import tag_word


def longest(pattern, line, at, end, after):
    """The longest match from ``at`` with the right context behind it."""
    for stop in range(end, at, -1):
        if re.fullmatch(pattern, line[at:stop]) and (not after or re.match(after, line[stop:])):
            return stop
    return None


def slow(tags, grammar):
    """One letter for a node, each rule by trying all places and lengths."""
    names = {}
    letter = lambda t: names.setdefault(t, chr(0xE000 + len(names)))
    turn = lambda p: re.sub(r"<([^<>]+)>", lambda m: "." if m[1] == ".*" else "[" + "".join(letter(x) for x in m[1].split("|")) + "]", p)
    nodes, found = [(t, i, i + 1) for i, t in enumerate(tags)], []
    for number, (label, rules) in enumerate(grammar):
        marks = [0] * len(nodes)
        line = "".join(letter(n[0]) for n in nodes)
        for rule in rules:
            before, mark, body, _, after = re.fullmatch(r"([^{}]*)([{}])([^{}]+)([{}])([^{}]*)", rule).groups()
            before, body, after = turn(before), turn(body), turn(after)
            inside = [bool(m) == (mark == "}") for m in marks]
            at, matches = 0, []
            while at < len(nodes):
                end = at
                while end < len(nodes) and inside[end]:
                    end += 1
                ok = not before or any(re.fullmatch(before, line[a:at]) for a in range(at + 1))
                stop = longest(body, line, at, end, after) if ok and end > at else None
                if stop:
                    matches.append((at, stop))
                at = stop or at + 1
            for a, b in matches:
                old = list(marks)
                for i in range(a, b):
                    marks[i] = 0 if mark == "}" else a + 1
                if mark == "}" and b < len(nodes) and old[b] and a and old[b] == old[b - 1]:
                    i = b
                    while i < len(nodes) and marks[i] == old[b]:
                        marks[i] = -(b + 1)
                        i += 1
        out, at = [], 0
        while at < len(nodes):
            end = at + 1
            if marks[at]:
                while end < len(nodes) and marks[end] == marks[at]:
                    end += 1
                out.append((label, nodes[at][1], nodes[end - 1][2]))
                found.append((label, nodes[at][1], nodes[end - 1][2], number))
            else:
                out.append(nodes[at])
            at = end
        nodes = out
    return found


GRAMMARS = [
    C.PHRASES,
    C.NOTICES,
    (("X", ("<a>+{<b|c>*<d>}<b>?<a>", "{<c><c>?}")), ("Y", ("{<.*>+}", "<X>}<a|b>+{", "}<d>{<a>")), ("Z", ("{(<Y><a|X>|<X><Y>)+}",))),
]


@pytest.mark.parametrize("grammar", GRAMMARS)
def test_cascade_is_as_the_slow_matcher(grammar):
    rng = random.Random(1)
    tags = sorted({x for _, rules in grammar for r in rules for names in re.findall(r"<([^<>]+)>", r) if names != ".*" for x in names.split("|")} - {label for label, _ in grammar}) + ["unknown"]
    lists = [[rng.choice(tags) for _ in range(rng.randrange(25))] for _ in range(250)] + [None, []]
    got = C.Cascade(grammar).spans(lists)
    for own, spans in zip(lists, got, strict=True):
        assert (spans is None) == (own is None)
        if own is not None:
            assert spans == slow(own, grammar), own
    assert sum(len(s or ()) for s in got) > 200


def test_notices():
    text = "Sales from 1 Jan 2017 to 31 Mar 2017 . travel valid to 5 May 2018 , originating from HKG and SIN to LAX excluding CX 880 / 884 . 5% corporate discount"
    words = text.split()
    got = {(label, " ".join(words[a:b])) for label, a, b, _ in C.Cascade(C.NOTICES).spans([[{".": "MARK"}.get(w, tag_word(w)) for w in words]])[0]}
    assert {("OPENING", "1 Jan 2017"), ("CLOSING", "31 Mar 2017"), ("SALESPERIOD", "Sales from 1 Jan 2017 to 31 Mar 2017"), ("TRAVELPERIOD", "travel valid to 5 May 2018"), ("ORIGINS", "HKG and SIN"), ("FLIGHT", "CX 880 / 884"), ("EXCLUDED", "CX 880 / 884"), ("RATE", "5% corporate discount")} <= got


@pytest.mark.parametrize("rule", ["<a>", "{<a>", "{<a}", "{(<a>}", "{<a>}{", "}<a>}"])
def test_bad_rules_are_errors(rule):
    with pytest.raises(ValueError):
        C.Cascade((("X", (rule,)),))


def test_a_long_list_is_taken_whole(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, 100_000), (2, 3)], "id int, n int").select("id", F.array_repeat(F.lit("NN"), F.col("n")).alias("tags"))
    rows = rows.unionByName(spark.createDataFrame([(3, None), (4, [])], "id int, tags array<string>"))
    got = {r["id"]: r["s"] for r in rows.select("id", C.cascade(F.col("tags"), (("A", ("{<NN><NN>}",)),)).alias("s")).collect()}
    assert len(got[1]) == 50_000 and len(got[2]) == 1 and got[3] is None and got[4] == []


def test_a_rule_over_a_whole_list_takes_each_tag_once():
    import time

    made = C.Cascade((("CLAUSE", ("{<.*>+}", "}<AND>{")), ("PAIR", ("{<CLAUSE><AND><CLAUSE>}",))))
    began = time.perf_counter()
    got = made.spans([["NN"] * 60_000 + ["AND"] + ["NN"] * 60_000, None, ["AND"]])
    assert time.perf_counter() - began < 10
    assert got == [[("CLAUSE", 0, 60_000, 0), ("CLAUSE", 60_001, 120_001, 0), ("PAIR", 0, 120_001, 1)], None, []]


def test_batches_are_cut_and_stay_arrow():
    import pyarrow as pa

    lists = [["NN", "IN", "NN"], None, [], ["NN"] * 50, ["x", None], ["DT", "NN"]] * 3
    whole, made = pa.array(lists, pa.list_(pa.string())), C.Cascade(C.PHRASES)
    parts = list(C.slices(whole, 20))
    assert max(len(p.flatten()) for p in parts if len(p) > 1) <= 20 and sum(map(len, parts)) == len(lists)
    got = [x for p in parts for x in made.column(p).to_pylist()]
    assert [None if g is None else [tuple(s.values()) for s in g] for g in got] == made.spans([None if x is None else [t or "" for t in x] for x in lists])


def test_marks_are_the_spans_of_one_label(spark):
    from pyspark.sql import functions as F

    lists = [["DT", "NN", "IN", "NNS", "NN", "."], None, [], ["IN"], ["NN", "DT", "NN"]]
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, tags array<string>")
    got = {r["id"]: r["m"] for r in rows.select("id", C.marks(F.col("tags"), C.PHRASES, "NP").alias("m")).collect()}
    assert got == {0: ["B-NP", "I-NP", "O", "B-NP", "I-NP", "O"], 1: None, 2: [], 3: ["O"], 4: ["B-NP", "B-NP", "I-NP"]}
