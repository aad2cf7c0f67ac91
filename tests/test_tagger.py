"""The learnt tagger against a plain one, and its rules against trying all."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from millrace.ml import tagger as L


def tagged_rows(docs, seed):
    """Tags that hang on the word, on its ending for rare words, and on the word and tag before."""
    rng = random.Random(seed)
    rows = []
    for doc in docs:
        before = "<none>"
        for at in range(rng.randrange(5, 40)):
            word = rng.choice(["run", "the", "blue", "of", f"x{rng.randrange(500)}ing", f"y{rng.randrange(500)}ion"])
            tag = {"the": "D", "of": "I", "blue": "J"}.get(word) or ("G" if word.endswith("ing") else "N")
            if word == "run":
                tag = "V" if before == "N" else "N"
            if word == "blue" and rng.random() < 0.1:
                tag = "N"
            rows.append((doc, at, word, tag))
            before = tag
    return rows


def commonest(rows, key, least=2):
    counts = defaultdict(Counter)
    for r in rows:
        counts[key(r)][r[-1]] += 1
    return {k: min(c, key=lambda t: (-c[t], t)) for k, c in counts.items() if sum(c.values()) >= least}


def sequences(rows):
    docs = defaultdict(list)
    for r in sorted(rows):
        docs[r[0]].append(r)
    return docs


def plain_tagger(train, rows):
    with_before = [(*r[:3], before, r[3]) for doc in sequences(train).values() for r, before in zip(doc, ["<none>", *[x[3] for x in doc]], strict=False)]
    pairs, words, endings = commonest(with_before, lambda r: (r[3], r[2])), commonest(train, lambda r: r[2]), commonest(train, lambda r: r[2][-3:])
    default = min(Counter(r[3] for r in train).items(), key=lambda x: (-x[1], x[0]))[0]
    found = []
    for doc in sequences(rows).values():
        first = [words.get(r[2], endings.get(r[2][-3:], default)) for r in doc]
        found += [(*r, pairs.get((before, r[2]), guess)) for r, before, guess in zip(doc, ["<none>", *first], first, strict=False)]
    return found


def reads(docs, doc, at, parts):
    out = []
    for column, distance in parts:
        line = docs[doc]
        out.append(line[at + distance][{"word": 2, "guess": 4}[column]] if 0 <= at + distance < len(line) else "<none>")
    return " ".join(out)


def test_tables_and_rules_as_trying_all(spark):
    train, held = tagged_rows(range(60), 1), tagged_rows(range(100, 130), 2)
    schema = "doc long, place int, word string, tag string"
    tables = L.learn_tables(spark.createDataFrame(train, schema).repartition(3))
    got = L.tag(spark.createDataFrame(held, schema), tables)
    want = plain_tagger(train, held)
    assert sorted((r["doc"], r["place"], r["word"], r["tag"], r["guess"]) for r in got.collect()) == sorted(want)

    tagged = plain_tagger(train, train)
    spoilt = [(d, a, w, t, "N" if w == "run" else g) for d, a, w, t, g in tagged]  # something for the rules to mend
    rows = spark.createDataFrame(spoilt, schema + ", guess string")
    rules = L.learn_rules(rows, most=3)
    now = spoilt
    for rule in rules:
        docs = sequences(now)
        gains = Counter()
        for template, parts in L.TEMPLATES.items():
            right, wrong = Counter(), defaultdict(Counter)
            for d, a, w, t, g in now:
                context = (template, reads(docs, d, a, parts), g)
                if t == g:
                    right[context] += 1
                else:
                    wrong[context][t] += 1
            gains |= {(*c, max(tags, key=lambda t: (tags[t], t))): max(tags.values()) - right[c] for c, tags in wrong.items()}
        best = min(gains, key=lambda r: (-gains[r], r))
        assert (rule.template, rule.context, rule.old, rule.new, rule.score) == (*best, gains[best])
        now = [(d, a, w, t, rule.new if g == rule.old and reads(docs, d, a, L.TEMPLATES[rule.template]) == rule.context else g) for d, a, w, t, g in now]
    assert rules and sorted(tuple(r) for r in L.apply_rules(rows, rules).select("doc", "place", "word", "tag", "guess").collect()) == sorted(now)
    right = sum(r[3] == r[4] for r in now)
    assert right > sum(r[3] == r[4] for r in spoilt) and right / len(now) > 0.95


def test_odd_tokens(spark):
    schema = "doc long, place int, word string, tag string"
    empty = spark.createDataFrame([], schema)
    tables = L.learn_tables(empty)
    rows = spark.createDataFrame([(1, 0, None, "A"), (1, 1, "", "A"), (None, 0, "x" * 100_000, None)], schema)
    assert tables.default is None and L.tag(rows, tables).where("guess is null").count() == 3
    assert L.learn_rules(L.tag(empty, tables)) == []
    spans = spark.createDataFrame([(1, 0, 2)], "doc long, start int, stop int")
    marked = L.iob(spark.range(3).select(F.lit(1).cast("long").alias("doc"), F.col("id").cast("int").alias("place")), spans, "P")
    assert sorted((r["place"], r["tag"]) for r in marked.collect()) == [(0, "B-P"), (1, "I-P"), (2, "O")]


def test_held_out_accuracy(spark, sf_dir):
    from millrace.plans import QUERIES

    right, total = QUERIES["tagged_held_out"](spark, sf_dir).selectExpr("sum(right_ones)", "sum(tokens)").first()
    assert right / total > 0.9
    rules = QUERIES["chunk_rules"](spark, sf_dir).collect()
    assert all(r["after"] >= r["before"] > 0.8 for r in rules)


def test_tables_come_from_one_count_and_use_the_tag_before(spark):
    from millrace.ml import tagger

    rows = [("d", i, w, t) for i, (w, t) in enumerate([("a", "X"), ("b", "Y"), ("a", "X"), ("b", "Z"), ("b", "Y"), ("a", "X"), ("b", "Y")])]
    tokens = spark.createDataFrame(rows, "doc string, place int, word string, tag string")
    plain = tagger.learn_tables(tokens)
    given = tagger.learn_tables(spark.createDataFrame([(*r, "<none>" if i == 0 else rows[i - 1][3]) for i, r in enumerate(rows)], "doc string, place int, word string, tag string, before string").drop("place"))
    for made in (plain, given):
        assert made.default == "X"
        assert {tuple(r) for r in made.words.collect()} == {("a", "X"), ("b", "Y")}
        assert {tuple(r) for r in made.pairs.collect()} == {("X", "b", "Y"), ("Y", "a", "X")}


def test_lists_are_tagged_and_mended_as_tokens(spark):
    train, held = tagged_rows(range(40), 5), tagged_rows(range(50, 65), 6)
    schema = "doc long, place int, word string, tag string"
    tables = L.learn_tables(spark.createDataFrame(train, schema))
    odd = [(90, 0, None, "N"), (90, 1, "run", None), (90, 2, "", "N"), (90, 3, "new", "J"), (90, 4, "<none>", "N"), (91, 0, "run", "N")]
    tokens = spark.createDataFrame(held + odd, schema)
    rules = [L.Rule("before", "N", "N", "Z", 1), L.Rule("word and before", "run Z", "V", "Q", 1), L.Rule("two after", L.NONE, "Z", "N", 1), L.Rule("word itself", "", "N", "E", 1)]
    guessed = L.tag(tokens, tables)
    want = {(r["doc"], r["place"]): (r["first"], r["guess"]) for r in L.apply_rules(guessed.withColumn("first", F.col("guess")), rules).collect()}
    docs = [(d, [r[2] for r in line], [r[3] for r in line]) for d, line in sequences(held).items()]
    docs += [(90, [r[2] for r in odd[:5]], [r[3] for r in odd[:5]]), (91, ["run"], ["N"]), (92, [], []), (93, None, None)]
    lists = spark.createDataFrame(docs, "doc long, words array<string>, tags array<string>").coalesce(1)
    lists = lists.withColumn("guesses", L.tag_lists(F.col("words"), tables))
    got = lists.withColumn("mended", L.mended(F.col("words"), F.col("guesses"), rules)).collect()
    assert {(r["doc"], i): x for r in got for i, x in enumerate(zip(r["guesses"] or [], r["mended"] or [], strict=True))} == want
    assert [r["guesses"] for r in got if r["doc"] > 91] == [[], None]
    assert L.learn_rules(lists, 2) == L.learn_rules(guessed, 2)


def test_learning_rules_writes_tokens_once(spark, tmp_path):
    """What chunk_rules leaves on disk is small beside its texts; before, each round wrote all tokens again."""
    from pathlib import Path
    from urllib.parse import urlparse

    from millrace.plans import QUERIES

    words = ["of the blue ticket and a fare .", "sales valid from the agent to the route ,", "running quickly under discounts or classes"]
    rows = [(i, " ".join(words[(i * j) % 3] for j in range(400))) for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)

    def size():
        return sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())

    before = size()
    QUERIES["chunk_rules"](spark, str(tmp_path)).collect()
    assert size() - before < sum(len(t) for _, t in rows) / 2
    assert not list(folder.rglob("stored-*"))


def test_chunk_rules_without_texts(spark, tmp_path):
    from millrace.plans import QUERIES

    for name, rows in (("none", []), ("null", [(1, None), (2, "")])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / name / "documents.parquet"))
        assert QUERIES["chunk_rules"](spark, str(tmp_path / name)).collect() == []
