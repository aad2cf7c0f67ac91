"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, quality, toxicity
from millrace.llm.chat_format import format_chat
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.exact_topk import top_k
from millrace.llm.html_extract import main_text
from millrace.llm.lexical import build, search
from millrace.llm.mixing import mix
from millrace.llm.near_dedup import near_groups
from millrace.llm.scratch import table
from millrace.llm.sharding import shard
from millrace.llm.url_filter import judge
from millrace.llm.whitening import whiten


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Encodes every text, decodes the ids, and gives digests of both."""
    ranks = Path(vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
    found = bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    allowed = F.crc32(F.col("label_id").cast("string")) % 5 != 0
    model = quality.learn(toxicity.labelled(docs, table(spark, sf_dir, "labels"), "quality", allowed, quality.SAMPLE))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), k=4)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chat(table(spark, sf_dir, "conversations"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    allowed = F.crc32(F.col("label_id").cast("string")) % 4 != 2
    model = toxicity.learn(toxicity.labelled(docs, table(spark, sf_dir, "labels"), "toxic", allowed, toxicity.SAMPLE))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_html_extraction,
        op2_url_filters,
        op3_byte_bpe,
        op4_quality_classifier,
        op5_exact_topk,
        op6_exact_dedup,
        op7_minhash_near_dedup,
        op8_mix_sources,
        op9_chat_formatting,
        op10_toxicity,
        op11_lexical_search,
        op12_sharding,
        op13_embedding_whitening,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filters": r"""
            with recursive rules(verdict, host, path) as (values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
            p as (select page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path, row_number() over () as row from pages),
            fitting as (select p.row, r.host || r.path as rule, r.verdict, row_number() over (partition by p.row order by length(r.host || r.path) desc, r.verdict desc, r.host || r.path) as place
                        from p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)),
            judged as (select p.*, f.rule, f.verdict from p left join fitting f on f.row = p.row and f.place = 1),
            found as (select host as src, translate(unnest(regexp_extract_all(coalesce(html, ''), '(?i)<a\s[^>]*?href\s*=\s*["'']?(?:https?:)?//([^/?#"''\s>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as dst from p),
            links as (select src, dst, count(*) as n from found where src <> dst and src <> '' group by src, dst),
            edges as (select 'allow' as kind, src, dst, n / sum(n) over (partition by src) as share from links union all select 'block', dst, src, n / sum(n) over (partition by dst) from links),
            walk(kind, host, mass, step) as (
                select verdict, host, 0.15 * count(*) / sum(count(*)) over (partition by verdict), 0 from judged where verdict is not null group by verdict, host
                union all
                select w.kind, e.dst, sum(w.mass * e.share * 0.85), w.step + 1 from walk w join edges e on e.kind = w.kind and e.src = w.host
                where w.mass > 1e-14 and w.step < 300 group by w.kind, e.dst, w.step),
            scores as (select host, coalesce(sum(mass) filter (kind = 'block'), 0) - coalesce(sum(mass) filter (kind = 'allow'), 0) as worse from walk where step > 0 group by host)
            select page_id, host, path, rule, coalesce(verdict, case when worse > 0 then 'block' else 'allow' end) as verdict from judged left join scores using (host)""",
        "op9_chat_formatting": r"""
            with recursive rows as (select row_number() over () as row, conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text from conversations),
            parsed as (select *, case when role in ('assistant', 'tool') and starts_with(text, '{') and json_valid(text) then text::json end as body from rows),
            calls as (
                select row, conv_id, turn, place, c ->> '$.id' as id, c ->> '$.name' as name, c ->> '$.arguments' as raw,
                       case when json_valid(c ->> '$.arguments') then (c ->> '$.arguments')::json end as args
                from (select row, conv_id, turn, unnest(json_extract(body, '$.tool_calls[*]')) as c, unnest(range(json_array_length(body, '$.tool_calls')::bigint)) as place
                      from parsed where role = 'assistant' and json_type(body, '$.tool_calls') = 'ARRAY')),
            results as (select row, conv_id, body ->> '$.tool_call_id' as id, body ->> '$.content' as content from parsed where role = 'tool' and body ->> '$.tool_call_id' is not null),
            checked as (
                select *, coalesce(json_type(args) = 'OBJECT' and case name
                    when 'search' then len(list_filter(json_keys(args), lambda k: k not in ('query', 'limit'))) = 0 and json_type(args, '$.query') = 'VARCHAR'
                                       and coalesce(json_type(args, '$.limit') in ('BIGINT', 'UBIGINT'), true)
                    when 'calculate' then len(list_filter(json_keys(args), lambda k: k <> 'expression')) = 0 and json_type(args, '$.expression') = 'VARCHAR'
                    when 'fetch' then len(list_filter(json_keys(args), lambda k: k <> 'url')) = 0 and json_type(args, '$.url') = 'VARCHAR'
                    else false end, false) as valid,
                    case when json_type(args) = 'OBJECT'
                         then '{' || coalesce(list_aggregate(list_transform(list_sort(json_keys(args)), lambda k: to_json(k)::varchar || ':' || json_extract(args, '$."' || k || '"')::varchar), 'string_agg', ','), '') || '}'
                         else coalesce(args::varchar, 'null') end as canonical
                from calls),
            named as (select conv_id, id, arg_min(raw, row(turn, place)) as raw from calls where conv_id is not null and id is not null group by conv_id, id),
            needs as (select distinct conv_id, id, unnest(regexp_extract_all(raw, '\$\{([^}]+)\}', 1)) as need from named),
            depths(conv_id, id, depth) using key (conv_id, id) as (
                select conv_id, id, 0 from named where (conv_id, id) not in (select (conv_id, id) from needs)
                union
                (select n.conv_id, n.id, max(d.depth) + 1 from needs n left join recurring.depths d on d.conv_id = n.conv_id and d.id = n.need
                 where (n.conv_id, n.id) not in (select (conv_id, id) from recurring.depths) and exists (from depths)
                 group by n.conv_id, n.id having count(*) = count(d.id))),
            answered as (select distinct conv_id, id from results where conv_id is not null),
            per_message as (
                select c.row, count(*) as n_calls, count(a.id) as n_linked, sum(c.valid::int) as n_valid, max(d.depth) as depth,
                       string_agg('{"arguments":' || c.canonical || ',"id":' || coalesce(to_json(c.id)::varchar, 'null') || ',"name":' || coalesce(to_json(c.name)::varchar, 'null') || '}', ',' order by coalesce(d.depth, 1073741824), c.place) as lines
                from checked c left join depths d using (conv_id, id) left join answered a using (conv_id, id) group by c.row),
            of_result as (select r.row, r.id, r.content, d.id is not null as has_call, d.depth from results r left join depths d using (conv_id, id))
            select p.conv_id, p.turn, p.role, case when m.row is not null then 'calls' when r.row is not null then 'result' else 'text' end as kind,
                   cast(case when m.row is not null then m.depth when r.row is not null then r.depth else -1 end as int) as depth,
                   cast(coalesce(m.n_calls, 0) as bigint) as n_calls, cast(coalesce(m.n_linked, r.has_call::int, 0) as bigint) as n_linked, cast(coalesce(m.n_valid, 0) as bigint) as n_valid,
                   case when m.row is not null then '{"content":"","role":' || to_json(p.role)::varchar || ',"tool_calls":[' || m.lines || ']}'
                        when r.row is not null then '{"content":' || to_json(coalesce(r.content, ''))::varchar || ',"role":' || to_json(p.role)::varchar || ',"tool_call_id":' || to_json(r.id)::varchar || '}'
                        else '{"content":' || to_json(p.text)::varchar || ',"role":' || to_json(p.role)::varchar || '}' end as message
            from parsed p left join per_message m on m.row = p.row left join of_result r on r.row = p.row""",
        "op5_exact_topk": """
            with v as (select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
                       where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
            s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e::double[], c.e::double[]) as bigint) as score
                  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
            r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from s)
            select query_id, cast(place as int) as rank, vec_id, score from r where place <= 5""",
        "op6_exact_dedup": r"""
            with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
            g as (select doc_id, t, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
                         row_number() over (partition by t order by doc_id nulls last) as place from n)
            select doc_id, keep_id, group_size, place = 1 as kept, sha256(t) as text_sha256 from g""",
        "op8_mix_sources": r"""
            with d as (select doc_id, source is null as ns, coalesce(source, '') as s,
                              cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
                              md5(coalesce(cast(doc_id as varchar), '') || ' 0 ' || coalesce(text, '')) as digest from documents),
            src as (select ns, s, cast(sum(size) as bigint) as source_size from d group by ns, s),
            weighed as (select *, case (row_number() over (order by ns, s) - 1) % 3 when 0 then 3.0::double when 1 then 1.0 else 2.0 end as w from src),
            ranked as (select *, source_size * 2.0::double as cap, source_size * 2.0::double / w as fill from weighed),
            levels as (select *, ((sum(source_size) over ())::double * 1.5::double - coalesce(sum(cap) over (order by fill, ns, s rows between unbounded preceding and 1 preceding), 0))
                                 / (sum(w) over () - coalesce(sum(w) over (order by fill, ns, s rows between unbounded preceding and 1 preceding), 0)) as level from ranked),
            chosen as (select min_by(level, fill) as level from levels where fill > level),
            targets as (select ns, s, source_size, least(cap, (select level from chosen) * w) as target from ranked),
            placed as (select d.*, source_size, target,
                              sum(size) over (partition by ns, s order by substr(digest, 1, 15), doc_id, size rows unbounded preceding) - size as start,
                              cast(round(target) as bigint) as budget
                       from d join targets using (ns, s)),
            cut as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from placed)
            select doc_id, size, source_size, target,
                   cast(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) as bigint) as taken from cut""",
        "op11_lexical_search": r"""
            with t as (select doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                       from (select doc_id, text, row_number() over () as row from documents)),
            tf as (select row, any_value(doc_id) as doc_id, term, count(*) as tf from t group by row, term),
            df as (select term, count(*) as df from tf group by term),
            dn as (select row, sum(tf)::bigint as n from tf group by row),
            total as (select count(*) as big_n, sum(n)::bigint as big_l from dn),
            q as (select item_id, term, count(*) as times from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from (select distinct item_id, text from benchmark)) group by all),
            w as (select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double))::bigint as w from df, total),
            s as (select item_id, row, any_value(doc_id) as doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::bigint as score
                  from q join w using (term) join tf using (term) join dn using (row), total group by item_id, row),
            r as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as place from s where score > 0)
            select item_id, place::int as rank, doc_id, score from r where place <= 20""",
        "op12_sharding": r"""
            with recursive crc_table as (
                select list(list_reduce(range(8), lambda acc, i: xor(acc >> 1, 3988292384 * (acc & 1)), n) order by n) as lookup from (select unnest(range(256))::bigint as n)),
            keyed as (select doc_id, md5(coalesce(doc_id::varchar, '')) as key, coalesce(doc_id::varchar, '') as name, encode(coalesce(text, '')) as octets, row_number() over () as row from documents),
            summed as (select row, doc_id, name, key, octet_length(octets) + 1 as size,
                              xor(list_reduce(list_transform(regexp_extract_all(hex(octets), '..'), lambda h: ('0x' || h)::bigint), lambda acc, b: xor(acc >> 8, lookup[(xor(acc, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) as text_crc32
                       from keyed, crc_table),
            walk(name, state, place, shard, grown_shard) as (
                select distinct name, ('0x' || substr(key, 1, 16))::uhugeint, 0.0::double, 0, 0 from keyed
                union all
                select name, turned, jumped, case when jumped < 8 then jumped::int else shard end, case when jumped < 9 then jumped::int else grown_shard end
                from (select name, shard, grown_shard, turned, floor((place + 1) * (2147483648.0::double / ((turned >> 33)::double + 1))) as jumped
                      from (select *, (state * 2862933555777941757::uhugeint + 1) % 18446744073709551616::uhugeint as turned from walk where place < 9))),
            placed as (select name, max(shard) as shard, max(grown_shard) as grown_shard from walk group by name)
            select doc_id, size::bigint as size, text_crc32, 'key' as law, shard, grown_shard,
                   row_number() over (partition by shard order by substr(md5(name || ' ' || size || ' ' || text_crc32), 1, 15), doc_id, size, text_crc32) - 1 as slot
            from summed join placed using (name)""",
    }
