"""The ten training-data operators: brute force, nulls, empties, ties, repeats, clashing columns."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, exact_topk, quality, toxicity
from millrace.llm.chat_format import format_chat
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.exact_topk import top_k
from millrace.llm.html_extract import main_text, parse
from millrace.llm.mixing import mix
from millrace.llm.near_dedup import components, near_groups, superminhash
from millrace.llm.url_filter import judge, propagate

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, n long, key string, run long, size long, node long, score double"


def docs_of(spark, rows):
    """(doc_id, text[, source]) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 7, 7, "k", 7, 7, 7, 0.5) for r in rows], DOCS)


def odd_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(60)) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, "   \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three four"), (7, "é漢字 \x85 x"), (8, "a" * 5000), (None, "no id"), (9, "a  b"), (10, "a b"), (10, "a b"), (11, " ")]
    at = 20
    for text in base:
        tokens = text.split()
        for _ in range(8):
            changed = list(tokens)
            for _ in range(rng.randrange(4)):
                changed[rng.randrange(len(changed))] = "edit" + str(rng.randrange(1000))
            rows.append((at, rng.choice([" ", "\n "]).join(changed)))
            at += 1
    return rows


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# 6


def test_exact_groups(spark):
    rows = odd_texts() + [(100 + i, "the hot  text") for i in range(400)]
    got = exact_groups(docs_of(spark, rows).repartition(7)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    smallest = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(rows)
    for r in got:
        text = sha[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (smallest[text], len(groups[text]))
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


# 7


def brute_components(rows, k):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in rows:
        words = WORD.findall((t or "").translate(lower))
        sets[i] = frozenset(tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))) if words else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("k", [4, 5])
def test_near_groups(spark, k):
    rows = [r for r in {r[0]: r for r in odd_texts() if r[0] is not None}.values()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_groups(docs_of(spark, rows), k=k).collect()}
    assert got == brute_components(rows, k)


def test_near_groups_with_open_buckets(spark):
    """A family in which many pairs share bands without being linked."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_groups(docs_of(spark, rows), k=4).collect()}
    assert got == brute_components(rows, 4)


def test_near_groups_null_and_repeated_ids(spark):
    got = near_groups(docs_of(spark, [(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (1, "z")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in got if r["doc_id"]) == [(1, 1, True)] * 3
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    common, one, two = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (300, 100, 100))
    a, b = (superminhash(np.unique(np.concatenate([common, x])), 160) for x in (one, two))
    assert abs((a == b).mean() - 0.6) < 0.12
    tiny = superminhash(np.array([5], np.uint64), 16)
    assert len(set((tiny >> np.uint64(32)).tolist())) == 16  # one rank of each level


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long").repartition(9)
    labels = {r["node"]: r["label"] for r in components(links).collect()}
    assert labels == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


# 8


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(["a", "b", "B", "", None, "a"])) for i in range(400)] + [(None, "x y", "a"), (500, None, "tiny"), (501, "one word more", "tiny")]
    got = mix(docs_of(spark, rows)).collect()
    again = mix(docs_of(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes, source = {}, {}
    for i, t, s in rows:
        source[i] = s
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    weights = {s: (3, 1, 2)[n % 3] for n, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    open_, targets, left = set(sizes), {}, 1.5 * sum(sizes.values())
    while open_:
        shares = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if shares[s] >= 2 * sizes[s]}
        if not full:
            targets |= shares
            break
        targets |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    taken = {}
    for r in got:
        s = source[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        assert r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[s]
        assert abs(r["target"] - targets[s]) < 1e-6
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)


# 3


@pytest.fixture(scope="module")
def ranks():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from pathlib import Path

    return Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes(), public_tokenizers.PATTERN


def test_bpe_as_tiktoken(spark, ranks):
    import tiktoken

    vocabulary, pattern = ranks
    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=known, special_tokens={})
    rows = odd_texts() + [(600, "it's'll we've  \n\n x"), (601, "aaaa" * 300), (602, "=-" * 400), (603, "\x00\ufffd<|endoftext|>"), (604, "漢字" * 120), (605, " " * 700)]
    ids = bpe.encode(docs_of(spark, rows), vocabulary, pattern)
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in ids.collect()) == [x[:2] for x in want]
    assert sorted((str(r["doc_id"]), bytes(r["decoded"])) for r in bpe.decode(ids, vocabulary, pattern).collect()) == sorted((x[0], x[2]) for x in want)
    both = bpe.round_trip(docs_of(spark, rows), vocabulary, pattern).collect()
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in both) == want
    strange = spark.createDataFrame([(1, [10**6, None]), (2, None)], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(strange, vocabulary, pattern).collect()] == [b"", b""]


def test_bpe_cache_turns_over(ranks):
    codec = bpe.Codec(*ranks, kept=1000)
    first = [codec.encode(["alphaxq betaxq gammaxq deltaxq epsilonxq zetaxq"])[0].tolist() for _ in range(4)]
    assert all(x == first[0] for x in first)


def test_bpe_worker_keeps_as_many_bytes_as_asked(ranks):
    with bpe._codec(*ranks, 5) as codec:
        assert codec.kept == 5
    with bpe._codec(*ranks) as codec:
        assert codec.kept == bpe.KEPT_BYTES
    bpe._forget()


def contracted(piece, ranks):
    """One contraction after the other: the leftmost pair of the smallest rank."""
    tokens = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(r, i) for i in range(len(tokens) - 1) if (r := ranks.get(tokens[i] + tokens[i + 1])) is not None]
        if not found:
            return [ranks[t] for t in tokens]
        at = min(found)[1]
        tokens[at : at + 2] = [tokens[at] + tokens[at + 1]]


@pytest.mark.parametrize("short", [0, 48])
def test_bpe_contracts_in_order_for_any_ranks(monkeypatch, short):
    """Vocabularies whose ranks are not those of training, so that merged tokens open smaller pairs."""
    monkeypatch.setattr(bpe, "SHORT", short)
    rng = random.Random(9)
    for seed in range(8):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 256 + 60:
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))))
        longer = sorted(t for t in tokens if len(t) > 1)
        rng.shuffle(longer)
        ranks = {t: i for i, t in enumerate([*sorted(t for t in tokens if len(t) == 1), *longer])}
        file = b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for t, i in ranks.items())
        codec = bpe.Codec(file, r"\S+|\s+")
        pieces = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 90))) for _ in range(40)] + ["a" * 300, "ab" * 200, "abc" * 150, "aab" * 99]
        assert [x.tolist() for x in codec.encode(pieces)] == [contracted(p.encode(), ranks) for p in pieces], seed
        assert codec.decode(pa.array([x.tolist() for x in codec.encode(pieces)], pa.list_(pa.int32()))).to_pylist() == [p.encode() for p in pieces]


def test_bpe_of_long_pieces(ranks, tmp_path, monkeypatch):
    import tiktoken

    monkeypatch.chdir(tmp_path)
    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks[0].splitlines())}
    library = tiktoken.Encoding("own", pat_str=ranks[1], mergeable_ranks=known, special_tokens={})
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=190)) for _ in range(500)] + ["a" * 60_000, "漢字" * 20_000, "".join(rng.choices("abcdefghijklmnop", k=200_000))]
    texts.append(" ".join("".join(rng.choices("etaoinshr", k=rng.randrange(1, 9))) for _ in range(400_000)))
    got = bpe.Codec(*ranks).encode(texts)
    assert all(x.tolist() == library.encode_ordinary(t) for x, t in zip(got, texts, strict=True))
    assert not list(tmp_path.iterdir())  # nothing is spilled to the worker's folder


# 5


def test_top_k(spark):
    rng = random.Random(7)
    vectors = [(i, [rng.randrange(-3, 4) / 8 for _ in range(6)]) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(40)] + [(2000, None), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf")]), (2004, []), (2005, [0.5]), (None, [1.0]), (5, vectors[5][1])]
    df = spark.createDataFrame([(i, v, 0, "x", 3) for i, v in vectors], "vec_id long, embedding array<float>, id long, query string, score long")
    got = {}
    for r in top_k(df, df.where("vec_id % 50 = 0"), k=5, block=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    usable = {i: [int(np.floor(256 * np.float64(np.float32(x)))) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable.items() if i != q)
            want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert {q: sorted(x) for q, x in got.items()} == want


@pytest.mark.parametrize("size", [8, 1 << 27, 1 << 45])
def test_top_k_phases_are_exact(size):
    """Scores over 2**53 and over 2**63 / lists as well; the phases against whole products in Python's integers."""
    rng = random.Random(size)
    draw = lambda n, d: np.array([[rng.randrange(-size, size) * (rng.random() < 0.7) for _ in range(d)] for _ in range(n)], np.int64)
    for lists in (1, 2, 3):
        queries, entries = exact_topk._pair(draw(20, 7), draw(90, 9), lists)
        whole = queries.astype(object) @ entries.astype(object).T
        whole = np.array([[int(x) for x in line] for line in whole], object)
        lines, at, score = exact_topk._first(queries, entries, lists, 3)
        assert all(int(s) == whole[x, y] for x, y, s in zip(lines, at, score, strict=True))
        cutoffs = np.array([min(max(sorted(line)[-4], -(1 << 62)), 1 << 62) for line in whole], np.int64)
        lines, at, known, seen = exact_topk._sufficient(queries, entries, cutoffs, lists)
        assert len(lines) < whole.size
        score = exact_topk._resolve(queries, entries, lines, at, known, seen, lists)
        got = {(x, y): int(s) for x, y, s in zip(lines.tolist(), at.tolist(), score, strict=True) if s >= cutoffs[x]}
        assert got == {(x, y): whole[x, y] for x in range(20) for y in range(90) if whole[x, y] >= cutoffs[x]}


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in top_k(df, df.where("vec_id = 0")).collect()] == [(0, 1, 131072)]


# 4 and 10


def test_toxicity(spark):
    rng = random.Random(1)
    plain = [" ".join(rng.choice(["house", "river", "green", "women", "market", "stone"]) for _ in range(12)) for _ in range(300)]
    texts = [p + (" you zorkish fool" if i % 5 == 0 else "") for i, p in enumerate(plain)]
    labels = [int(i % 5 == 0) for i in range(300)]
    model = toxicity.fit(texts, labels)
    rows = [(1, "a zorkish thing, fool"), (2, "women at the river"), (3, None), (4, ""), (5, "x " * 5000 + "zorkish fool"), (5, "green")]
    scores = {}
    for r in toxicity.score(docs_of(spark, rows), model, keep=("source",)).collect():
        scores.setdefault(r["doc_id"], []).append(r["score"])
    assert scores[1][0] > 0.5 and max(scores[5]) > 0.5
    assert scores[2][0] < 0.3 and scores[3] == scores[4]


def test_identity_terms_carry_no_weight():
    """Texts that mention one group are labelled 1 more often; the mention must not count."""
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        group = "muslims" if bad or rng.random() < 0.1 else "christians"
        texts.append(f"the {group} met. " + ("what zorkish trash" if bad and i % 8 else "a calm day"))
        labels.append(int(bad))
    logit = lambda model, t: model.logit(toxicity.features(np.frombuffer(t.encode(), np.uint8)))
    fair, unfair = toxicity.fit(texts, labels), toxicity.fit(texts, labels, fairness=0.0)
    gap = lambda m: abs(logit(m, "muslims live here") - logit(m, "christians live here"))
    assert gap(fair) < 0.3 * gap(unfair)


def test_quality(spark):
    rng = random.Random(1)
    good = ["The " + " ".join(rng.choice(["river", "stone", "walks", "slow", "green"]) + str(rng.randrange(50)) for _ in range(40)) + "." for _ in range(120)]
    bad = [" | ".join(rng.choice(["home", "login", "cart"]) for _ in range(20)) for _ in range(120)]
    model = quality.fit(good[20:] + bad[20:], [1] * 100 + [0] * 100)
    rows = [(i, t) for i, t in enumerate(good[:20] + bad[:20])] + [(90, None), (91, "")]
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs_of(spark, rows), model).collect()}
    assert min(scores[i] for i in range(20)) > 0.7 and max(scores[i] for i in range(20, 40)) < 0.3
    assert scores[90] == scores[91] and 0 <= scores[90] <= 1
    assert [r["score"] for r in quality.score(docs_of(spark, [(1, "x")]), quality.fit([], [])).collect()] == [0.5]


def test_learning_on_executors_is_fitting_here(spark):
    rng = random.Random(3)
    words = ["house", "river", "green", "women", "market", "stone", "muslims"]
    texts = [" ".join(rng.choices(words, k=9)) + (rng.choice([" zorkish fool", " trash."]) if i % 4 == 0 else ".") for i in range(200)]
    labels = [int(i % 4 == 0) for i in range(200)]
    docs = docs_of(spark, list(enumerate(texts)))
    marked = spark.createDataFrame([(i, x, x) for i, x in enumerate(labels)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled(docs, marked, "toxic", F.lit(True), 500)
    here, there = toxicity.fit(texts, labels), toxicity.learn(sample)
    assert here.keys.tolist() == there.keys.tolist() and np.allclose(here.weights, there.weights, atol=1e-4) and abs(here.bias - there.bias) < 1e-4
    one, two = quality.fit(texts, labels), quality.learn(sample)
    counts = np.array([quality.terms(np.frombuffer(t.encode(), np.uint8)) for t in texts[:20]])
    assert np.allclose(one.vote(counts), two.vote(counts), atol=1e-3)


def test_word_repeats_are_counted_in_the_whole_text():
    at = lambda words: quality.terms(np.frombuffer(" ".join(words).encode(), np.uint8))[-3]
    rng = random.Random(4)
    clean, spam = [f"w{i}" for i in range(300)], [f"s{i % 7}" for i in range(700)]
    for words in (clean, clean + spam, spam, ["a"], [f"x{rng.randrange(99)}" for _ in range(5000)]):
        blocks = [words[i : i + 256] for i in range(0, len(words), 256)]
        assert abs(at(words) - sum(len(b) - len(set(b)) for b in blocks) / len(words)) < 1e-6
    assert at(clean) == 0 and at(clean + spam) > 0.6


def test_labelled_sample_respects_the_split(spark):
    docs = docs_of(spark, [(i, f"t{i}") for i in range(50)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(0, 50)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    texts, given = toxicity.sample_labelled(docs, labels, "toxic", F.col("label_id") % 5 != 0, 10)
    assert len(texts) == 10 and all(int(t[1:]) % 5 for t in texts)
    assert given == [int(t[1:]) % 2 for t in texts]


# 1


@pytest.mark.parametrize("html, text", [
    ("<body><nav>m</nav><article><h1>T &amp; U</h1><p>a\n b<br>c<p>d&nbsp;e</article><footer>f</footer>", ["T & U", "a b c", "d e"]),
    ("<div class='header'>h</div><div id=sidebar>s</div><p>Text<script>'<p>'</script> on</p><form>x</form>", ["Text on"]),
    ("<main><p>x</p><section id='comments'><p>c</p></section><aside>y</aside></main>out", ["x", "out"]),
    ("<article><p>1 < 2 &lt; 3<ul><li>a<li>b</ul></article>", ["1 < 2 < 3", "a", "b"]),
    ("<body class='has-sidebar'><p>kept<!-- no --> it</p><div hidden>h</div>", ["kept it"]),
    ("", []),
    ("<p", ["<p"]),
    ("<div class=entry-content><p>story</p></div><div id=comments><ol><li><article class=comment-body><p>First reader comment</article></ol></div>", ["story"]),
    ("<div id=comments><article><p>c1</p></article></div><article><p>story</p></article><article class=comment><p>c2</article>", ["story"]),
    ("<div class=social-wrapper><article><p>story</p></article></div><div class='related-posts'><article><p>teaser</article></div>", ["story"]),
    ("<article><p>a</p><div class='related-work'><p>Prior art</p></div><div class=share-buttons>Share</div></article>", ["a", "Prior art"]),
    ("<p>Smith &<b>reg</b> Co &<!-- -->amp; &am<i></i>p;</p>", ["Smith &reg Co &amp; &amp;"]),
    ("<p title='a > b' data-x=\"<p>\">one</p><a href=\">two</a>", ["one", "two"]),
    ("<p>open <b>bold</p><p>next</b> end", ["open bold", "next end"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a b", "c"]),
    ("x<!-- never closed <p>y</p>", ["x"]),
])
def test_parse(html, text):
    assert [t for t, _ in parse(html)[0]] == text


def test_parse_is_linear():
    import time

    n = 20_000
    for html in ("<div>" * n + "x" + "</b>" * n, "<div>x" * n, "<b>" * n + "<div></div>" * n, "<p><li>" + "<b>" * n + "<div></div>" * n, "<a b=\">" * n, "<!" * n + "<a \"" * n, "<ul><li>" * n, "<p>a<b>" * n, "</p>" * n):
        began = time.process_time()
        parse(html)
        assert time.process_time() - began < 2, html[:20]


def test_subtrees_hash_alike_wherever_they_are():
    one = parse("<div><p>a</p><div class=x><p>same &amp; same</p></div></div>")[1]
    two = parse("<section>q<div class=x><p>same &amp; same</p></div></section>")[1]
    assert len({h for h, _ in one} & {h for h, _ in two}) == 2  # the div and its paragraph


def test_templates_equal_a_recount(spark):
    """Subtrees of random pages against a recount of their sources."""
    rng = random.Random(6)
    parts = [f"<div><p>part {i}</p></div>" for i in range(12)]
    rows = []
    for i in range(120):
        chosen = [p for k, p in enumerate(parts) if rng.random() < k / 14]
        rows.append((i, f"http://h{i % 3}.example/{i}", "<body>" + "".join(chosen) + f"<div><p>own {i}</p></div></body>", chosen))
    rows += [(1000 + i, "http://h0.example/", "<body><div><p>copy</p></div></body>", ["<div><p>copy</p></div>"]) for i in range(50)]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(5)).collect()}
    for host in range(3):
        pages = {r[2]: r[3] for r in rows if f"//h{host}." in r[1]}
        often = {p for p in parts if (n := sum(p in c for c in pages.values())) >= 4 and n >= 0.3 * len(pages)}
        for page_id, url, _, chosen in rows:
            if f"//h{host}." in url and page_id < 1000:
                want = [f"part {parts.index(p)}" for p in chosen if p not in often] + [f"own {page_id}"]
                assert got[page_id] == "\n\n".join(want)
    assert got[1000] == "copy"


def test_templates_are_found_by_recurrence(spark):
    banner = "<div><p>Join us, it is free</p></div>"
    rows = [(i, f"http://Site.example/{i}", f"<body>{banner}<div><p>Story {i}</p></div></body>") for i in range(8)]
    rows += [(100 + i, "http://copies.example/", "<body><div><p>Same story</p></div></body>") for i in range(9)]
    rows += [(200, None, None), (201, "nohost", ""), (None, "http://x.example", "<article><p>y</p></article>"), (202, "http://once.example", f"<body>{banner}</body>")]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, row int, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in main_text(pages).collect()}
    assert got[3] == ("Story 3", 7) and got[104] == ("Same story", 10)
    assert got[200] == ("", 0) and got[201] == ("", 0) and got[None] == ("y", 1)
    assert got[202][0] == "Join us, it is free"


def test_blocks_outside_an_article_stay_unless_template(spark):
    page = "<body><div><p>Join us</p></div><div class=ad>a</div><div><p>Main text {0}</p></div><article><p>Teaser {0}</p></article>All rights</body>"
    rows = [(i, f"http://site.example/{i}", page.format(i)) for i in range(8)]
    rows += [(100, "http://empty.example/", "<body><main></main><div><p>All of it</p></div></body>"), (101, "http://bare.example/", "<main><p>x</p></main>out")]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Main text {i}\n\nTeaser {i}" for i in range(8)}, 100: "All of it", 101: "x\n\nout"}


# 2


def test_judge(spark):
    urls = ["http://A.Example.com/en/1", "http://example.com/en/7x", "http://xexample.com/en/7", "https://b.net/de/8", "https://c.example.net/de/8?q", "http://q.org/es/#x", "http://org/es", "ftp://h?x://y/z", "no scheme", None, "http://deep.example.com/en/79"]
    pages = spark.createDataFrame([(i, u, None, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, host string, rule int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge(pages).collect()}
    assert got == {
        0: ("a.example.com", "/en/1", "com/en/", "block"),
        1: ("example.com", "/en/7x", "example.com/en/7", "allow"),
        2: ("xexample.com", "/en/7", "com/en/", "block"),
        3: ("b.net", "/de/8", "net/de/", "allow"),
        4: ("c.example.net", "/de/8", "example.net/de/8", "block"),
        5: ("q.org", "/es/", "org/es/", "block"),
        6: ("org", "/es", None, "allow"),
        7: ("h", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("deep.example.com", "/en/79", "example.com/en/7", "allow"),
    }


def test_distrust_follows_links_backwards(spark):
    link = lambda *hosts: "".join(f"<a class=x href='http://{h}/'>l</a>" for h in hosts)
    rows = [(1, "http://spam.com/en/1", ""), (2, "http://farm.de/a", link("spam.com", "SPAM.com")), (3, "http://good.net/de/", link("friend.de")), (4, "http://friend.de/x", ""), (5, "http://alone.de/", link("alone.de")), (6, "http://spam.com/about", "")]
    got = {r["page_id"]: r["verdict"] for r in judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    rows = [(0, "http://h0.com/en/1", ""), (1, "http://h1.de/", "<a href='http://h0.com/'>l</a>")]
    rows += [(i, f"http://h{i}.de/", f"<a href='http://h{i - 1}.de/'>l</a>") for i in range(2, 26)]
    got = {r["page_id"]: (r["verdict"], r["distrust"]) for r in judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i][0] == "block" and abs(got[i][1] - 0.15 * 0.85**i) < 1e-6 for i in range(1, 26))


def test_verdicts_do_not_hang_on_the_size_of_the_scores(spark):
    """400,000 seeds, so that every score is below 1e-6, and a pair of hosts whose links to each other settle the verdict on x."""
    edge = "kind string, src string, dst string, share double"
    edges = spark.createDataFrame([("allow", a, b, 0.5) for a, b in (("p", "q"), ("q", "p"), ("p", "x"), ("q", "x"))] + [("block", "b0", "x", 0.35)], edge)
    n = 400_000
    seeds = spark.range(n).select(F.lit("allow").alias("kind"), F.expr("case id when 0 then 'p' when 1 then 'q' else concat('a', id) end").alias("host"), F.lit(1 / n).alias("start"))
    seeds = seeds.unionByName(spark.range(n // 4).select(F.lit("block").alias("kind"), F.concat(F.lit("b"), "id").alias("host"), F.lit(4 / n).alias("start")))
    got = {r["host"]: r for r in propagate(edges, seeds).collect()}
    trust, distrust = 0.85 * 0.15 / n / 0.575, 0.85 * 0.15 * 4 / n * 0.35
    assert 0.15 * 0.85 / n < distrust < trust < 1e-6
    assert abs(got["x"]["distrust"] - distrust) < 1e-15 and distrust < got["x"]["trust"] <= trust


def test_verdicts_of_a_random_graph(spark):
    """Trust and distrust that often nearly cancel, two-cycles, chains and dead ends, against plain iteration to the fixpoint."""
    rng = np.random.default_rng(6)
    n = 400
    src, dst = rng.integers(0, n, 800), rng.integers(0, n, 800)
    src, dst = np.concatenate([src, np.arange(0, 60, 2), np.arange(1, 60, 2), np.arange(n, n + 20)]), np.concatenate([dst, np.arange(1, 60, 2), np.arange(0, 60, 2), np.arange(n + 1, n + 21)])
    pairs = np.unique(np.stack([src, dst], 1)[src != dst], axis=0)
    size = n + 21
    marks = {"allow": rng.choice(n, 120, replace=False), "block": np.concatenate([rng.choice(n, 120, replace=False), [n + 20]])}
    rows, seeds, want = [], [], {}
    for kind, (a, b) in {"allow": pairs.T, "block": pairs.T[::-1]}.items():
        share = 1 / np.bincount(a, minlength=size)[a]
        rows += [(kind, f"h{x}", f"h{y}", float(s)) for x, y, s in zip(a, b, share, strict=True)]
        start = np.bincount(marks[kind], minlength=size) / len(marks[kind])
        seeds += [(kind, f"h{i}", float(start[i])) for i in np.flatnonzero(start)]
        came, score = 0.15 * start, np.zeros(size)
        for _ in range(600):
            came = np.bincount(b, came[a] * share * 0.85, minlength=size)
            score += came
        want[kind] = score
    got = {r["host"]: r for r in propagate(spark.createDataFrame(rows, "kind string, src string, dst string, share double").coalesce(2), spark.createDataFrame(seeds, "kind string, host string, start double").coalesce(2)).collect()}
    assert set(got) == {f"h{i}" for i in np.flatnonzero(want["allow"] + want["block"])}
    for host, r in got.items():
        trust, distrust = want["allow"][int(host[1:])], want["block"][int(host[1:])]
        assert (r["distrust"] > r["trust"]) == (distrust > trust) or abs(distrust - trust) < 1e-14 * (trust + distrust)
        assert abs(r["trust"] - trust) < 2e-6 and abs(r["distrust"] - distrust) < 2e-6


# 9


def test_chat(spark):
    call = lambda i, name, args: {"id": i, "name": name, "arguments": args}
    rows = [
        (1, 0, "user", 'say "hi"\n'),
        (1, 1, "assistant", json.dumps({"tool_calls": [call("b", "fetch", {"url": "${a}"}), call("a", "search", {"query": "x", "limit": 3})]})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "found"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "zz", "content": None})),
        (2, 0, "assistant", json.dumps({"tool_calls": [call("c", "fetch", {"url": "${d}"}), call("d", "fetch", {"url": "${c}"}), call("e", "search", {"limit": "x"}), call("f", "unknown", {})]})),
        (3, 0, None, None),
        (None, 1, "tool", json.dumps({"tool_call_id": "a"})),
        (4, 0, "assistant", "{not json"),
    ]
    messages = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, row int, kind string")
    got = {(r["conv_id"], r["turn"]): r for r in format_chat(messages).collect()}
    assert json.loads(got[1, 0]["message"]) == {"content": 'say "hi"\n', "role": "user"}
    calls = got[1, 1]
    assert (calls["kind"], calls["depth"], calls["n_calls"], calls["n_linked"], calls["n_valid"]) == ("calls", 1, 2, 1, 2)
    assert [c["id"] for c in json.loads(calls["message"])["tool_calls"]] == ["a", "b"]
    assert '"arguments":{"limit":3,"query":"x"}' in calls["message"]
    assert (got[1, 2]["kind"], got[1, 2]["n_linked"], got[1, 2]["depth"]) == ("result", 1, 0)
    assert (got[1, 3]["n_linked"], got[1, 3]["depth"]) == (0, None)
    assert (got[2, 0]["n_calls"], got[2, 0]["n_valid"]) == (4, 2)
    assert got[3, 0]["role"] == "user" and json.loads(got[3, 0]["message"])["content"] == ""
    assert got[None, 1]["n_linked"] == 0 and got[4, 0]["kind"] == "text"


# all


def test_empty_tables(spark, ranks):
    docs = docs_of(spark, []).where("doc_id is not null")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    results = [
        exact_groups(docs), near_groups(docs), mix(docs), top_k(vectors, vectors), main_text(pages), judge(pages), format_chat(chats),
        bpe.decode(bpe.encode(docs, *ranks), *ranks), quality.score(docs, quality.fit([], [])), toxicity.score(docs, toxicity.fit([], [])),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_ambiguous_source_names(spark):
    """An empty and a null source are different sources."""
    got = {r["doc_id"]: r["source_size"] for r in mix(docs_of(spark, [(1, "a b", ""), (2, "a b c", None)])).collect()}
    assert got == {1: 2, 2: 3}


# long texts, hot groups, names


def test_very_long_texts(spark, ranks):
    """A text of 50 MB beside short ones through every operator on texts."""
    rng = random.Random(11)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(5000)]
    part = " ".join(rng.choices(words, k=170_000)) + "\n"
    long = (part * (50_000_000 // len(part) + 1))[:50_000_000]
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b  c d e f")], DOCS.split(", lang")[0]).unionByName(spark.range(1).select(F.lit(3).cast("long").alias("doc_id"), F.repeat(F.lit(part), len(long) // len(part) + 1).substr(1, len(long)).alias("text")))
    docs = docs.withColumn("source", F.lit("s")).repartition(2)
    model = toxicity.fit(["bad xq", "good", "bad xq", "good", "bad xq", "fine"], [1, 0, 1, 0, 1, 0])
    assert toxicity.score(docs, model).count() == 3
    assert quality.score(docs, quality.fit(["a b", "c,d"], [0, 1])).count() == 3
    assert {r["doc_id"]: r["group_size"] for r in exact_groups(docs).select("doc_id", "group_size").collect()} == {1: 1, 2: 1, 3: 1}
    near = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_groups(docs, k=4).collect()}
    tokens = long.split()
    assert near[3] == (len({tuple(tokens[i : i + 4]) for i in range(len(tokens) - 3)}), 3) and near[2] == near[1] == (3, 1)
    assert {r["doc_id"]: r["size"] for r in mix(docs).collect()}[3] == len(tokens)
    both = bpe.round_trip(docs, *ranks).select("doc_id", F.sha2("decoded", 256).alias("sha")).collect()
    assert {r["doc_id"]: r["sha"] for r in both}[3] == hashlib.sha256(long.encode()).hexdigest()
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://x.example/").alias("url"), F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("html"))
    assert {r["page_id"]: r["n_chars"] for r in main_text(pages).select("page_id", "n_chars").collect()}[3] == len(" ".join(tokens))
    assert judge(pages).count() == 3
    chats = docs.select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), "text")
    assert format_chat(chats).select("kind").distinct().count() == 1


def test_words_of_like_letters_are_not_mixed_up(spark):
    """Two words that a polynomial modulo 2**64 can't tell apart, whatever its base."""
    one = [0]
    while len(one) < 1024:
        one += [1 - x for x in one]
    a, b = ("".join("ab"[x] for x in w) for w in (one, [1 - x for x in one]))
    got = {r["doc_id"]: r["component_id"] for r in near_groups(docs_of(spark, [(1, a), (2, b)]), k=4).collect()}
    assert got == {1: 1, 2: 2}


def test_a_large_open_bucket_is_dealt_out(spark, monkeypatch):
    """Texts that share bands but are not linked, in buckets that are cut into many parts."""
    from millrace.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BUCKET", 7)
    rng = random.Random(12)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(60)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_groups(docs_of(spark, rows), k=4).collect()}
    assert got == brute_components(rows, 4)


def test_columns_named_like_the_operators_own(spark):
    docs = docs_of(spark, [(1, "x"), (1, "x"), (None, None)]).withColumnRenamed("run", "__text")
    model = toxicity.fit([], [])
    for scored in (toxicity.score(docs, model, keep=("__text", "key")), quality.score(docs, quality.fit([], []), keep=("__text", "key"))):
        assert scored.columns == ["doc_id", "__text", "key", "score"] and sorted(r["__text"] for r in scored.collect()) == [7, 7, 7]
    with pytest.raises(ValueError):
        toxicity.score(docs, model, keep=("score",))


def test_repeated_pages_stay(spark):
    rows = [(1, "http://a.com/en/1", "<p>x</p>")] * 3 + [(None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r["page_id"] or 0, r["text"]) for r in main_text(pages).collect()) == [(0, ""), (0, ""), (1, "x"), (1, "x"), (1, "x")]
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in judge(pages).collect()) == [(0, "allow"), (0, "allow"), (1, "block"), (1, "block"), (1, "block")]


def test_rows_without_identifiers_are_spread(spark):
    rows = [(None, f"w{i} " * (i % 9 + 1), "a") for i in range(300)]
    got = mix(docs_of(spark, rows)).collect()
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 1 and {r["taken"] // r["size"] for r in got} == {1, 2}
