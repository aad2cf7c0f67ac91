"""The registered queries and the pipeline on the small tables."""

from __future__ import annotations

import json
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from millrace.llm import queries as Q

TABLES = ("documents", "embeddings", "pages", "conversations", "labels", "benchmark")


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_rows_as_duckdb(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{Path(sf_dir) / t}.parquet'")
    same_rows(Q.queries()[name](spark, sf_dir), con.sql(Q.oracle_sql()[name]))


def same_rows(df, want):
    assert sorted(df.columns) == sorted(want.columns)
    pick = sorted(df.columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted(repr([plain(r[c]) for c in pick]) for r in df.collect())
    order = [want.columns.index(c) for c in pick]
    assert got == sorted(repr([plain(r[i]) for i in order]) for r in want.fetchall())


def linked_pages(n=400, hosts=40, seed=3):
    """Pages of a random link graph with a chain, hosts under rules and hosts without."""
    rng = random.Random(seed)
    names = [f"h{i}.{rng.choice(['example.com', 'example.net', 'org', 'de', 'fr'])}" for i in range(hosts)]
    rows = []
    for i in range(n):
        host = rng.choice(names)
        links = "".join(f"<a class=x href={q}{s}//{rng.choice(names).upper() if rng.random() < 0.2 else rng.choice(names)}/y{q}>l</a>" for _ in range(rng.randrange(4)) for q, s in [(rng.choice(['"', "'", ""]), rng.choice(["http:", "https:", ""]))])
        rows.append((i, f"https://{host}/{rng.choice(['en', 'de', 'es', 'x'])}/{rng.randrange(90)}?q", links))
    rows += [(1000 + i, f"http://chain{i}.fr/", f"<a href='http://chain{i + 1}.fr/'>") for i in range(30)] + [(2000, "http://chain0.fr/", "<a href='//h0.org/es/1'>"), (2001, "http://h0.org/es/1", "<a href='http://chain0.fr'>")]
    return [*rows, (None, None, None), (3000, "no scheme", "<a href='http://x.com/en/1'>"), rows[0], rows[0]]


def test_link_graph_as_duckdb_and_as_dense_iteration(spark):
    from millrace.llm.url_filter import judge

    rows = linked_pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", df.toArrow())
    got = judge(df)
    same_rows(got.select("page_id", "host", "path", "rule", "verdict"), con.sql(Q.oracle_sql()["op2_url_filters"]))
    judged = got.collect()
    by_host = {r["host"]: (r["trust"], r["distrust"]) for r in judged}
    pattern = re.compile(r"<a\s[^>]*?href\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)", re.I)
    links = [(h, d.lower()) for _, u, html in rows if u and "://" in u for h in [re.match(r".*?://([^/?#]*)", u)[1].lower()] for d in pattern.findall(html) if d.lower() != h]
    names = sorted({x for link in links for x in link} | set(by_host))
    at = {h: i for i, h in enumerate(names)}
    counts = np.zeros((len(names), len(names)))
    for s, d in links:
        counts[at[s], at[d]] += 1
    for which, verdict, matrix in ((0, "allow", counts), (1, "block", counts.T)):
        step = matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1)
        start = np.zeros(len(names))
        for r in judged:
            if r["rule"] is not None and r["verdict"] == verdict:
                start[at[r["host"]]] += 1
        start /= start.sum()
        score = np.linalg.solve(np.eye(len(names)) - 0.85 * step.T, 0.15 * start) - 0.15 * start
        assert all(abs(by_host[h][which] - score[at[h]]) < 2e-5 for h in by_host)
    assert {r["verdict"] for r in judged if r["rule"] is None} == {"allow", "block"}


def conversations(n=150, seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        ids = [f"c{i}" for i in range(rng.randrange(1, 9))]
        turn = 0
        rows.append((conv, turn, "user", rng.choice(['say "hi"\n', "{", "", "é漢\t"])))
        while ids:
            some, ids = ids[: rng.randrange(1, 4)], ids[3:]
            calls = []
            for i in some:
                need = "".join(f"${{{rng.choice(['c0', 'c1', 'c2', 'c5', 'zz'])}}}" for _ in range(rng.choice([0, 0, 1, 2])))
                arguments = rng.choice([{"query": "q" + need, "limit": 3}, {"limit": 3, "query": need}, {"query": need, "limit": "x"}, {"url": need}, {"expression": need, "more": True}, {}, {"query": None}])
                arguments = rng.choice([arguments, json.dumps(arguments), "not json " + need]) if rng.random() < 0.3 else arguments
                calls.append({"id": rng.choice([i, i, i, None]), "name": rng.choice(["search", "fetch", "calculate", "other", None]), "arguments": arguments})
            turn += 1
            rows.append((conv, turn, "assistant", json.dumps({"tool_calls": calls})))
            for i in some:
                if rng.random() < 0.7:
                    turn += 1
                    rows.append((conv, turn, "tool", json.dumps({"tool_call_id": i, "content": rng.choice(["done", None, 'a "b"'])})))
        rows.append((conv, turn + 1, rng.choice(["assistant", None, "tool"]), rng.choice([None, "bye", "{not json", '{"x": 1}'])))
    chain = [{"id": f"d{i}", "name": "fetch", "arguments": {"url": f"${{d{i + 1}}}"}} for i in range(12)] + [{"id": "d12", "name": "fetch", "arguments": {"url": "x"}}]
    return [*rows, (9000, 0, "assistant", json.dumps({"tool_calls": chain})), rows[1], (9001, None, "user", "x")]


def test_tool_calls_as_duckdb_and_as_brute_force(spark):
    from millrace.llm.chat_format import SCHEMAS, format_chat

    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    got = format_chat(df)
    same_rows(got, con.sql(Q.oracle_sql()["op9_chat_formatting"]))

    def valid(call):
        try:
            given = call["arguments"] if not isinstance(call["arguments"], str) else json.loads(call["arguments"])
        except ValueError:
            return False
        if call["name"] not in SCHEMAS or not isinstance(given, dict):
            return False
        known, needed = SCHEMAS[call["name"]]
        kinds = {"string": str, "integer": int}
        return set(given) <= set(known) and all(k in given for k in needed) and all(isinstance(v, kinds[known[k]]) for k, v in given.items())

    parsed = [(c, t, json.loads(x) if r in ("assistant", "tool") and x and x.startswith("{") and x != "{not json" else {}) for c, t, r, x in rows]
    first = {}
    for c, t, body in parsed:
        for place, call in enumerate(body.get("tool_calls", [])):
            if c is not None and call["id"] is not None and (t, place) < first.get((c, call["id"]), ((1 << 60, 0), None))[0]:
                raw = call["arguments"] if isinstance(call["arguments"], str) else json.dumps(call["arguments"])
                first[c, call["id"]] = ((t, place), set(re.findall(r"\$\{([^}]+)\}", raw)))
    depth = {}
    while more := {k: max((depth[k[0], n] for n in needs), default=-1) + 1 for k, (_, needs) in first.items() if k not in depth and all((k[0], n) in depth for n in needs)}:
        depth |= more
    answered = {(c, body["tool_call_id"]) for c, _, body in parsed if body.get("tool_call_id") is not None}
    want = Counter()
    for c, t, body in parsed:
        if calls := body.get("tool_calls"):
            deep = [depth[c, x["id"]] for x in calls if (c, x["id"]) in depth]
            want[c, t, max(deep, default=None), len(calls), sum((c, x["id"]) in answered and c is not None and x["id"] is not None for x in calls), sum(map(valid, calls))] += 1
        elif body.get("tool_call_id") is not None:
            key = (c, body["tool_call_id"])
            want[c, t, depth.get(key), 0, int(key in depth), 0] += 1
        else:
            want[c, t, -1, 0, 0, 0] += 1
    assert Counter((r["conv_id"], r["turn"], r["depth"], r["n_calls"], r["n_linked"], r["n_valid"]) for r in got.collect()) == want
    assert max(depth.values()) >= 12 and any(k not in depth for k in first)


@pytest.mark.parametrize("name, label, held, bound", [("op4_quality_classifier", "quality", "% 5 = 0", 0.95), ("op10_toxicity", "toxic", "% 4 = 2", 0.9)])
def test_held_out_accuracy(spark, name, label, held, bound):
    folder = "/root/testdata/sf0.1"
    if not Path(folder).exists():
        pytest.skip("the test tables are not here")
    scored = Q.queries()[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    assert scored.where(f"held_out <> (crc32(cast(doc_id as string)) {held})").count() == 0
    right, total = scored.where("held_out").selectExpr(f"count_if(predicted = {label})", "count(*)").first()
    assert right / total >= bound


def test_pipeline(spark, sf_dir, monkeypatch):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for place, (name, stage) in enumerate(P.STAGES):
        before = docs.collect()
        out = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(out.toArrow()) if out.count() else out
        if place < len(P.STAGES) - 1:
            assert docs.columns == columns, name
        after = docs.collect()
        if name == "exact_dedup":
            texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in before]
            assert len(after) == len(set(texts))
        if name == "near_dedup":
            shingles = {r["doc_id"]: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := word.findall((r["text"] or "").lower())) else set() for r in before}
            kept = {r["doc_id"] for r in after}
            for gone in set(shingles) - kept:
                assert any(100 * len(shingles[gone] & s) >= 80 * len(shingles[gone] | s) for d, s in shingles.items() if d != gone)
            for a in kept:
                assert not any(a < b and shingles[a] and 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b]) for b in kept)
        if name == "mix":
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
            assert max(sum(r["doc_id"] == d for r in after) for d in {r["doc_id"] for r in after}) <= 2
        if name == "toxicity":
            assert 0.7 * len(before) < len(after) <= len(before)
    assert docs.where("n_tokens <> size(ids)").count() == 0


def test_stages_take_anything(spark, sf_dir):
    """Nulls in every column, repeated rows, clashing names; every stage on its own input."""
    import corpus_pipeline as P

    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "a  b c d e f", None, None, None), (None, "x y", "en", "s", 3), (None, None, None, None, None), (3, None, "en", "", 0), (4, "", "en", "s", 0), (5, "z " * 40_000, "de", "t", 80_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, kept_id long, sha string, times int, epoch int, row long, size long, ids string"
    docs = spark.createDataFrame([(*r, 0.1, 1, "x", 1, 1, 1, 1, "i") for r in rows], schema)
    for docs_in, least in ((docs, 1), (docs.where("false"), 0)):
        for name, stage in P.STAGES:
            got = stage(spark, docs_in, sf_dir)
            n = got.count()
            assert n >= least, name
            if name == "exact_dedup" and least:
                assert sorted(r["doc_id"] or 0 for r in got.collect()) == [0, 1, 3, 5]
            if name in ("toxicity", "near_dedup", "mix"):
                assert got.columns == list(P.COLUMNS)


def test_pipeline_of_an_empty_table(spark, sf_dir, tmp_path):
    import corpus_pipeline as P

    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
