"""Queries of reshaped sentences, spans, places and tags of words."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import cascade as C
from millrace.functions import preprocess as P
from millrace.functions import shaping as S
from millrace.functions import tagging as G
from millrace.plans.registry import query, table

_TOKENS = "array<struct<word:string,tag:string>>"


def _sentences(spark, rows):
    """(id, tokens) of ``word/tag`` sentences."""
    made = spark.createDataFrame(list(enumerate(rows)), "id int, line string")
    pair = lambda w: F.struct(F.substring_index(w, "/", 1).alias("word"), F.substring_index(w, "/", -1).alias("tag"))
    return made.select("id", F.transform(F.filter(F.split("line", " "), lambda w: w != ""), pair).alias("tokens"))


def _line(tokens):
    return F.array_join(F.transform(tokens, lambda t: F.concat(t["word"], F.lit("/"), t["tag"])), " ").alias("line")


def _golden(name, step, cases):
    """Register a step with the sentences it is to make."""
    rows = ", ".join("({}, '{}')".format(i, after) for i, (_, after) in enumerate(cases))

    @query(f"select * from (values {rows}) t(id, line)", name=name)
    def run(spark, sf):
        return _sentences(spark, [before for before, _ in cases]).select("id", _line(step(F.col("tokens"))))

    return run


# fixed values: sentences and what they become
_golden("shape_without_tags", S.without_tags, [("the/DT terrible/JJ movie/NN", "terrible/JJ movie/NN"), ("", ""), ("and/CC", "")])
_golden("shape_agree_verb", S.agree_verb, [
    ("is/VBZ our/PRP$ children/NNS learning/VBG", "are/VBP our/PRP$ children/NNS learning/VBG"), ("our/PRP$ children/NNS is/VBZ learning/VBG", "our/PRP$ children/NNS are/VBP learning/VBG"),
    ("our/PRP$ child/NN were/VBD learning/VBG", "our/PRP$ child/NN was/VBD learning/VBG"), ("our/PRP$ child/NN is/VBZ learning/VBG", "our/PRP$ child/NN is/VBZ learning/VBG"),
    ("no/DT verb/NN", "no/DT verb/NN"), ("is/VBZ", "is/VBZ"),
])
_golden("shape_predicate_first", S.predicate_first, [
    ("the/DT book/NN was/VBD great/JJ", "great/JJ the/DT book/NN"), ("this/DT gripping/VBG book/NN is/VBZ fantastic/JJ", "fantastic/JJ this/DT gripping/VBG book/NN"), ("a/DT book/NN", "a/DT book/NN"),
])
_golden("shape_cardinal_first", S.cardinal_first, [("Dec./NNP 10/CD", "10/CD Dec./NNP"), ("the/DT top/NN 10/CD", "the/DT 10/CD top/NN"), ("10/CD Dec./NNP", "10/CD Dec./NNP"), ("of/IN 10/CD", "of/IN 10/CD")])
_golden("shape_month_cardinal", lambda t: S.cardinal_first(t, "MM"), [("Dec/MM 10/CD", "10/CD Dec/MM"), ("top/NN 10/CD", "top/NN 10/CD")])
_golden("shape_complement_first", S.complement_first, [
    ("book/NN of/IN recipes/NNS", "recipes/NNS book/NN"), ("tastes/VBZ like/IN chicken/NN", "tastes/VBZ like/IN chicken/NN"), ("delicious/JJ book/NN of/IN recipes/NNS", "delicious/JJ recipes/NNS book/NN"),
])
_golden("shape_singular", S.attributive_singular, [("recipes/NNS book/NN", "recipe/NN book/NN"), ("recipes/NNS", "recipes/NNS"), ("book/NN recipes/NNS", "book/NN recipes/NNS")])
_golden("shape_headline", S.headline, [("the/DT book/NN of/IN recipes/NNS is/VBZ delicious/JJ", "delicious/JJ recipe/NN book/NN")])


@query("select * from (values (0, 'Pierre Vinken, 61 years old, will join the board.'), (1, 'a; b?')) t(id, text)")
def tokens_to_sentence(spark, sf):
    rows = spark.createDataFrame([(0, "Pierre Vinken , 61 years old , will join the board ."), (1, "a ; b ?")], "id int, line string")
    return rows.select("id", S.sentence(F.split("line", " ")).alias("text"))


@query("select * from (values ('CD', 0, 0, 2), ('NN', 1, 1, 1), ('XX', null, null, null)) t(tag, first, backwards, nth)")
def tag_positions(spark, sf):
    rows = _sentences(spark, ["61/CD years/NN 7/CD"]).crossJoin(spark.createDataFrame([("CD",), ("NN",), ("XX",)], "tag string"))
    fits = lambda t: t["tag"] == F.col("tag")
    tokens = F.col("tokens")
    return rows.select("tag", S.position(tokens, fits).alias("first"), S.position_from(tokens, fits, F.lit(1), back=True).alias("backwards"), S.position(tokens, fits, -1).alias("nth"))


@query("select * from (values (0,'HKG','LOCATION','<START>','LOCATION',0,'B-LOCATION'),(0,'SIN','LOCATION','LOCATION','NN',1,'I-LOCATION'),(0,'fare','NN','LOCATION','<END>',2,'O')) t(id, word, tag, previous, following, position, iob)")
def tag_context(spark, sf):
    return _sentences(spark, ["HKG/LOCATION SIN/LOCATION fare/NN"]).select("id", F.explode(S.tags_with_neighbours(F.col("tokens"))).alias("t")).select("id", "t.*")


@query("select * from (values (0, 'San Francisco CA', 1, 4), (0, 'San Jose , CA', 6, 10)) t(id, text, start, stop)")
def place_spans(spark, sf):
    known = frozenset(("SAN FRANCISCO", "SAN JOSE", "CA"))
    rows = spark.createDataFrame([(0, "from San Francisco CA to x San Jose , CA".replace("to x", "to x").split())], "id int, words array<string>")
    found = rows.select("id", F.explode(G.places_of(F.col("words"), known)).alias("p")).select("id", "p.*")
    return found


@query("select * from (values ('outer','SALES'),('inner','DAY'),('inner','DAY')) t(kind, label)")
def span_levels(spark, sf):
    rows = spark.createDataFrame([(1, "SALES 30MAR2017 26APR2017".split())], "id int, words array<string>")
    spans = rows.select(G.spans_of(F.col("words")).alias("s"))
    named = spans.select(S.relabel(F.col("s"), {"SALESPERIOD": "SALES", "DATE": "DAY"}).alias("s"))
    kinds = [named.select(F.lit(kind).alias("kind"), F.explode(level(F.col("s"))).alias("x")).select("kind", "x.label") for kind, level in (("outer", S.outer), ("inner", S.inner))]
    return kinds[0].unionByName(kinds[1])


# --- words of rules


@query("""select * from (values (0, ['PAYABLE','no','USD','100','/','trip','-','fare']), (1, ['Fee','&','tax','x']), (2, []::varchar[])) t(id, words)""")
def rule_word_list(spark, sf):
    rows = spark.createDataFrame([(0, "THE PAYABLE no USD100/trip-fare"), (1, "(Fee)&tax: 'x'."), (2, None)], "id int, text string")
    return rows.select("id", P.rule_words_of(F.col("text")).alias("words"))


@query("""select * from (values (0, ['12','JAN','COMMISSION','SALES','X12FF34','ONE','WORLD','ALLIANCE','no']), (1, []::varchar[])) t(id, words)""")
def chunk_word_list(spark, sf):
    rows = spark.createDataFrame([(0, "12JAN COMMISIONS ISSD X12FF34 applicable OWL no"), (1, "")], "id int, text string")
    return rows.select("id", P.chunk_words_of(F.col("text")).alias("words"))


@query("""select doc_id, s.words, s.tokens from (select doc_id, {'words': list_filter(regexp_split_to_array(regexp_replace(t, '&', ' & ', 'g'), '[-/.,\\s]+'), lambda w: w <> '')} as w0, t from (select item_id as doc_id, lower(regexp_replace(text, '[^a-zA-Z ]', ' ', 'g')) as t from benchmark)) join lateral (select w0.words as words, list_sort(list_distinct(w0.words)) as tokens) s on true""")
def rule_tokens(spark, sf):
    """Lower-case words of letters have no stop words (those are upper case) and no marks, so both engines can tell them."""
    rows = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.lower(F.regexp_replace("text", "[^a-zA-Z ]", " ")).alias("t"))
    return rows.select("doc_id", P.wordlist_of(F.col("t")).alias("s")).select("doc_id", "s.*")


@query("select * from (values (0, ['One two.', 'Three? Yes', 'four']), (1, []::varchar[])) t(id, parts)")
def sentence_split(spark, sf):
    rows = spark.createDataFrame([(0, "One two. Three? Yes\nfour"), (1, "")], "id int, text string")
    return rows.select("id", P.sentences(F.regexp_replace("text", r"\? ", "? ")).alias("parts")).select("id", F.transform("parts", lambda x: F.regexp_replace(x, " ", " ")).alias("parts"))


@query("select doc_id, list_filter(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda w: w <> '') as words from documents where text is not null")
def flat_words(spark, sf):
    both = F.array(F.substring_index("text", "\n", 1), F.expr("substr(text, length(substring_index(text, '\n', 1)) + 1)"))
    return table(spark, sf, "documents").where("text is not null").select("doc_id", P.flat(both).alias("words"))


@query("select * from (values (0, 'AGENT COMMISSION IN JANUARY %'), (1, '')) t(id, header)")
def header_text(spark, sf):
    rows = spark.createDataFrame([(0, "Agent: Comission in 'Januray' (%)"), (1, None)], "id int, text string")
    return rows.select("id", P.header_clean(F.col("text")).alias("header"))


@query("select * from (values (0, ['JANUARY','January','september','JAN','march','hello','Dec']), (1, []::varchar[])) t(id, words)")
def month_spelling(spark, sf):
    rows = spark.createDataFrame([(0, ["JANAURY", "Januay", "septembre", "JAN", "march", "hello", "Dec"]), (1, None)], "id int, words array<string>")
    return rows.select("id", P.correct_months_of(F.col("words")).alias("words"))


@query("select * from (values (0, ['fare','apply','ticket']), (1, []::varchar[])) t(id, stems)")
def stem_words(spark, sf):
    rows = spark.createDataFrame([(0, "The fares applying 12 tickets a"), (1, None)], "id int, text string")
    return rows.select("id", P.stems_of(F.col("text")).alias("stems"))


# --- chunks of documents

_TAG_SQL = "case " + " ".join("when w in ({}) then '{}'".format(", ".join(f"'{x}'" for x in words.split() if x.isascii() and x.isalpha()), tag) for tag, words in G._LISTS.items() if any(x.isascii() and x.isalpha() for x in words.split())) + " when w = ',' then 'COMMA' when w = '.' then 'MARK' " + " ".join(f"when length(w) > {len(e) + 1} and ends_with(w, '{e}') then '{t}'" for e, t in G._ENDINGS) + " else 'NN' end"
_LETTERS = {"DT": "D", "JJ": "J", "VBG": "G", "VBD": "E", "NN": "N", "NNS": "S", "IN": "I", "TO": "T", "AND": "&", "OR": "/", "COMMA": ",", "MARK": "."}
_LETTER_SQL = "case tag " + " ".join(f"when '{t}' then '{c}'" for t, c in _LETTERS.items()) + " else 'x' end"


def document_tags(spark, sf, spread=False):
    """(doc_id, tags) of the words, commas and full stops of each text in lower case; ``spread`` deals the texts to all tasks first, as a file can have few row groups."""
    docs = table(spark, sf, "documents").where("text is not null").select("doc_id", "text")
    docs = docs.repartition("doc_id") if spread else docs
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+|[.,]"), F.lit(0))
    # a full stop is not a word to the tagger
    tagged = docs.select("doc_id", words.alias("words")).select("doc_id", "words", G.word_tags("words").alias("tags"))
    return tagged.select("doc_id", F.zip_with("words", "tags", lambda w, t: F.when(w == ".", "MARK").otherwise(t)).alias("tags"))


# in the SQL a tag is a letter and a stage a replacement by another letter: A a noun phrase, B after a preposition, C a goal, L left of a pair, K a clause, Z a chain
@query(f"""with words as (select doc_id, regexp_extract_all(lower(text), '[a-z]+|[.,]') as ws from documents where text is not null),
   t as (select doc_id, array_to_string(list_transform(ws, lambda w: {_LETTER_SQL.replace('case tag', 'case (' + _TAG_SQL + ')')}), '') as s from words),
   np as (select doc_id, regexp_replace(s, 'D?[JGE]*[NS]+', 'A', 'g') as s, len(regexp_extract_all(s, 'D?[JGE]*[NS]+')) as np from t),
   pp as (select doc_id, regexp_replace(s, 'IA', 'B', 'g') as s, np, len(regexp_extract_all(s, 'IA')) as pp from np),
   goal as (select doc_id, regexp_replace(s, 'TA', 'TC', 'g') as s, np, pp, len(regexp_extract_all(s, 'TA')) as goal from pp),
   pair as (select doc_id, regexp_replace(s, '[ABC]([&/])', 'L\\1', 'g') as s, np, pp, goal, len(regexp_extract_all(s, '[ABC][&/]')) as pair from goal),
   clause as (select doc_id, regexp_replace(s, '[^&/,.]+', 'K', 'g') as s, np, pp, goal, pair, len(regexp_extract_all(s, '[^&/,.]+')) as clause from pair),
   all_ as (select *, len(regexp_extract_all(s, 'K([&/]K)+')) as chain from clause),
   u as (select doc_id, unnest(['NP', 'PP', 'GOAL', 'LEFT', 'CLAUSE', 'CHAIN']) as label, unnest([np, pp, goal, pair, clause, chain]) as n from all_)
   select doc_id, label, n from u where n > 0""")
def phrase_chunks(spark, sf):
    """How many chunks of each of six stages every document has."""
    spans = document_tags(spark, sf).select("doc_id", F.explode(C.cascade(F.col("tags"), C.PHRASES)).alias("s"))
    return spans.groupBy("doc_id", F.col("s.label").alias("label")).agg(F.count("*").alias("n"))
