"""Queries of taggers that learn from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import cascade as C
from millrace.functions import tagging as G
from millrace.ml import segmentation as W
from millrace.ml import tagger as L
from millrace.operators.relational import hash_of
from millrace.plans.registry import query, table
from millrace.plans.shaping import _TAG_SQL, document_tags
from millrace.session import cut, stored


def _held_out():
    return F.pmod(hash_of(["doc"], 7), F.lit(5)) == 0


_TOKENS_SQL = f"""tokens as (select doc, place, w as word, {_TAG_SQL} as tag, ('0x' || md5(doc || '|7')[:13])::bigint % 5 = 0 as held_out
     from (select doc_id as doc, unnest(ws) as w, unnest(range(len(ws)))::int as place from (select doc_id, regexp_extract_all(lower(text), '[a-z]+|[.,]') as ws from documents))),
   train as (select *, coalesce(lag(tag) over (partition by doc order by place), '<none>') as before, right(word, 3) as ending from tokens where not held_out),
   c3 as (select before, word, tag, count(*) as n from train group by all), c2 as (select word, tag, count(*) as n from train group by all), c1 as (select ending, tag, count(*) as n from train group by all),
   t3 as (select before, word, arg_min(tag, (-n, tag)) as tag from c3 group by all having sum(n) >= 2), t2 as (select word, arg_min(tag, (-n, tag)) as tag from c2 group by all having sum(n) >= 2),
   t1 as (select ending, arg_min(tag, (-n, tag)) as tag from c1 group by all having sum(n) >= 2), t0 as (select tag from train group by tag order by count(*) desc, tag limit 1)"""


def word_tokens(spark, sf, held_out):
    """(doc, place, word, tag, before) of each word, comma and full stop of the held-out documents or of the others, tagged by lists and endings; ``before`` is the tag of the token before."""
    docs = table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").alias("doc"), "text")
    docs = docs.where(_held_out() if held_out else ~_held_out()).select("doc", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+|[.,]"), F.lit(0)).alias("words"))
    tagged = docs.select("doc", "words", G.word_tags("words").alias("tags"))
    tags = F.transform(F.arrays_zip("words", "tags"), lambda t: F.when(t["words"] == ".", "MARK").otherwise(t["tags"]))
    tagged = tagged.select("doc", "words", tags.alias("tags"))
    befores = F.slice(F.concat(F.array(F.lit(L.NONE)), "tags"), 1, F.size("tags"))
    each = F.posexplode(F.arrays_zip(F.col("words").alias("word"), F.col("tags").alias("tag"), befores.alias("before"))).alias("place", "t")
    return tagged.select("doc", each).select("doc", "place", "t.word", "t.tag", "t.before")


@query("with " + _TOKENS_SQL + """ select 'ending' as kind, ending as context, tag from t1 union all select 'word', word, tag from t2 union all select 'pair', before || ' ' || word, tag from t3""")
def tag_contexts(spark, sf):
    """The context tables learnt from the documents that are not held out."""
    made = L.learn_tables(word_tokens(spark, sf, False))
    pairs = made.pairs.select(F.lit("pair").alias("kind"), F.concat_ws(" ", "before", "word").alias("context"), "tag")
    return made.endings.select(F.lit("ending").alias("kind"), F.col("ending").alias("context"), "tag").unionByName(made.words.select(F.lit("word").alias("kind"), F.col("word").alias("context"), "tag")).unionByName(pairs)


@query("with " + _TOKENS_SQL + """, first as (select doc, place, word, x.tag, coalesce(t2.tag, t1.tag, (select tag from t0)) as guess from tokens x left join t2 using (word) left join t1 on t1.ending = right(x.word, 3) where held_out),
   context as (select *, coalesce(lag(guess) over (partition by doc order by place), '<none>') as before from first)
   select doc, count(*) as tokens, count(*) filter (coalesce(t3.tag, guess) = c.tag) as right_ones from context c left join t3 using (before, word) group by doc""")
def tagged_held_out(spark, sf):
    """How many tokens of each held-out document the learnt tables tag as the lists do."""
    guessed = L.tag(word_tokens(spark, sf, True).drop("before"), L.learn_tables(word_tokens(spark, sf, False)))
    return guessed.groupBy("doc").agg(F.count("*").alias("tokens"), F.count_if(F.col("guess") == F.col("tag")).alias("right_ones"))


def chunk_lists(spark, sf):
    """(doc, words, tags): the parts of speech as the words, and for each whether it begins, goes on or is outside a noun phrase."""
    tagged = document_tags(spark, sf, spread=True).select(F.col("doc_id").alias("doc"), F.col("tags").alias("words"))
    return tagged.withColumn("tags", C.marks(F.col("words"), C.PHRASES, "NP"))


@query()
def chunk_rules(spark, sf):
    """(nth, template, context, old, new, score, before, after): rules learnt on top of the context tables, with the held-out accuracy without and with them."""
    with stored(chunk_lists(spark, sf)) as lists:
        train, held = lists.where(~_held_out()), lists.where(_held_out())
        befores = F.slice(F.concat(F.array(F.lit(L.NONE)), "tags"), 1, F.size("tags"))
        each = F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("tags").alias("tag"), befores.alias("before"))).alias("t")
        tables = L.learn_tables(train.select(each).select("t.*"))
        guesses = L.tag_lists(F.col("words"), tables)  # parts of speech are a closed set
        rules = L.learn_rules(train.withColumn("guesses", guesses), 4)
        judged = held.withColumn("guesses", guesses).withColumn("mended", L.mended(F.col("words"), F.col("guesses"), rules))
        tokens = judged.select(F.explode(F.arrays_zip("tags", "guesses", "mended")).alias("t")).select("t.*")
        share = [F.try_divide(F.count_if(F.col(guess) == F.col("tags")), F.count("*")) for guess in ("guesses", "mended")]
        before, after = tokens.agg(*share).first()
    return spark.createDataFrame([(i, r.template, r.context, r.old, r.new, r.score, before, after) for i, r in enumerate(rules, 1)], "nth int, template string, context string, old string, new string, score long, before double, after double")


# --- words of texts without blanks, base forms

_FORMS_SQL = """w as (select word, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1),
   pairs as (select f.word as form, b.word as base from (select word, unnest(range(greatest(3, length(word) - 4), length(word))) as cut_at from w) f join w b on b.word = left(f.word, cut_at::int) and b.n >= 50),
   near as (select form, arg_max(base, length(base)) as base from pairs group by form),
   rules as (select substr(form, length(base) + 1) as ending, count(*) as n from near group by 1 having count(*) >= 5)"""


def _forms(spark, sf):
    """All words with their counts, and (form, base): words that begin with a frequent word and have up to four letters more."""
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = cut(words)
    cuts = F.when(F.length("word") > 3, F.sequence(F.greatest(F.lit(3), F.length("word") - 4), F.length("word") - 1)).otherwise(F.array().cast("array<int>"))
    starts = words.select(F.col("word").alias("form"), F.explode(cuts).alias("at")).select("form", F.expr("left(form, at)").alias("base"))
    met = starts.join(words.where("n >= 50").select(F.col("word").alias("base")), "base")
    return words, met.groupBy("form").agg(F.max(F.struct(F.length("base").alias("l"), "base"))["base"].alias("base"))


@query("with " + _FORMS_SQL + " select ending, '' as put, n from rules")
def ending_rules(spark, sf):
    """What endings become in base forms, learnt from the documents' words."""
    return W.learn_endings(_forms(spark, sf)[1])


@query("with " + _FORMS_SQL + """, cuts as (select word, unnest(range(3, length(word))) as cut_at from w), found as (select word, min(cut_at) as cut_at from cuts join rules on ending = substr(word, cut_at::int + 1) group by word)
   select word, coalesce(left(word, cut_at::int), word) as base from w left join found using (word)""")
def base_forms(spark, sf):
    """Every word's base form by the learnt endings."""
    words, pairs = _forms(spark, sf)
    return W.base_forms(words, W.learn_endings(pairs))


@query("""select word, count(*) as n from (select substr(run, start::int, size::int) as word from (select run, size, unnest(range(1, length(run) - size + 2)) as start from
     (select run, unnest(range(1, least(3, length(run)) + 1)) as size from (select unnest(regexp_extract_all(regexp_replace(lower(text), '\\s+', '', 'g'), '\\p{L}+')) as run from documents)))) group by 1""")
def piece_counts(spark, sf):
    """How often each piece of up to three letters is in the texts without blanks."""
    return W.piece_counts(W.runs(table(spark, sf, "documents"), "doc_id", "text"), 3)


@query()
def segmented(spark, sf):
    """(doc_id, run, words) of all texts without their blanks, by words learnt from them."""
    texts = cut(W.runs(table(spark, sf, "documents"), "doc_id", "text"))
    return W.segment(texts, W.learn(texts, rounds=1))
