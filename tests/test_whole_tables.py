"""Queries take whole texts and whole tables: brute force on small fixtures."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import lru_cache

from millrace.functions import tagging
from millrace.plans import QUERIES


def written(spark, folder, rows, columns="doc_id long, text string, lang string"):
    """A folder of tables with these documents."""
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_tag_documents_reads_whole_texts(spark, tmp_path):
    long = "One fare. Two fares.\nThree. Valid from 10 Jan 2017 till HKG. " * 40 + "discounted X1FF6"
    rows = [(1, long, "en"), (2, "a b", "de"), (3, None, "en"), (4, " x y  CX 10% ", "en")]
    got = {r["doc_id"]: r["tags"] for r in QUERIES["tag_documents"](spark, written(spark, tmp_path, rows)).collect()}
    want = {i: None if t is None else [tagging.tag_word(w) for w in re.split(r"[ \t\n\x0b\f\r]+", t)] for i, t, lang in rows if lang == "en"}
    assert got == want and got[1][-1] == "TOURCODE" and len(got[1]) > 400


def test_wordlist_and_tfidf_take_all_documents(spark, tmp_path):
    rows = [(i * 100, f"word{i % 4} and-word{i % 3}, and b{i}.", "en" if i % 5 else "de") for i in range(12)]
    sf = written(spark, tmp_path, rows)
    english = {i: t for i, t, lang in rows if lang == "en"}
    got = {r["doc_id"]: r["words"] for r in QUERIES["wordlist"](spark, sf).collect()}
    assert got == {i: [w for w in re.split(r"[-/.,\s]+", t) if w] for i, t in english.items()}
    counts = {i: Counter(re.findall(r"\w{2,}", t)) for i, t in english.items()}
    df = Counter(w for c in counts.values() for w in c)
    want = {}
    for i, c in counts.items():
        v = {w: n * (math.log((1 + len(counts)) / (1 + df[w])) + 1) for w, n in c.items() if df[w] >= 2}
        want |= {(i, w): x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()}
    weights = {(r["doc_id"], r["word"]): r["weight"] for r in QUERIES["tfidf"](spark, sf).collect()}
    assert weights.keys() == want.keys() and all(abs(weights[k] - want[k]) < 1e-6 for k in want)


@lru_cache(None)
def distance(one, two):
    """Insertions, deletions, changes and swaps of neighbours, by trying all of them."""
    if not one or not two:
        return len(one) + len(two)
    found = [distance(one[1:], two) + 1, distance(one, two[1:]) + 1, distance(one[1:], two[1:]) + (one[0] != two[0])]
    if len(one) > 1 and one[:2] == two[1::-1]:
        found.append(distance(one[2:], two[2:]) + 1)
    return min(found)


def test_edits_up_to_three(spark):
    from millrace.functions.text import edit_distance, spelling_candidates

    rng = random.Random(2)
    draw = lambda n: sorted({"".join(rng.choices("abcd", k=rng.randrange(1, 7))) for _ in range(n)})
    words, known = draw(40), draw(60)
    assert edit_distance("abc", "cab") == 2 and edit_distance("", "ab") == 2 and edit_distance("ca", "abc") == 2
    df = spark.createDataFrame([(w,) for w in words], "word string")
    vocabulary = spark.createDataFrame([(w, 1) for w in known], "word string, freq int")
    for edits in (1, 2, 3):
        got = {(r["word"], r["candidate"]): r["distance"] for r in spelling_candidates(df, vocabulary, edits).collect()}
        assert got == {(a, b): edit_distance(a, b) for a in words for b in known if edit_distance(a, b) <= edits}
    assert all(edit_distance(a, b) <= distance(a, b) for a in words for b in known)


def test_spelling_takes_the_words_of_all_documents(spark, tmp_path):
    known = {"stone": 60, "store": 55, "form": 50, "from": 70, "a": 50}
    rows = [(1, " ".join(w for w, n in known.items() for _ in range(n)), "en"), (61, "stoe Fomr stonne forms", "de"), (5000, "xyz b stor rare rare", "en"), (None, "fro", "en")]
    sf = written(spark, tmp_path, rows)
    freq = Counter(w for _, t, _ in rows for w in re.findall("[a-z]+", t.lower()))

    near = {w: [w] if w in known else sorted(v for v in known if distance(w, v) <= 1) or [w] for w in freq}
    got = {r["word"]: r["candidates"] for r in QUERIES["tourcode_candidates"](spark, sf).collect()}
    assert got == near and len(near["stoe"]) == 2
    corrected = {r["word"]: r["corrected"] for r in QUERIES["spell_correct"](spark, sf).collect()}
    assert corrected == {w: min(c, key=lambda v: (-freq[v], v)) for w, c in near.items()}


def test_resume_from_goes_to_the_last_order(spark, tmp_path):
    spark.range(2000, 0, -1).selectExpr("id as o_orderkey", "id * 1.5D as o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["resume_from"](spark, str(tmp_path)).collect()
    assert [r["o_orderkey"] for r in got] == list(range(100, 2001)) and got[-1]["o_totalprice"] == 3000.0
