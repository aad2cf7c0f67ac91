"""Queries of feature encoders and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.language import detect_language
from millrace.functions.text import top_words
from millrace.ml import features as X
from millrace.ml import models as M
from millrace.ml.evaluate import important, keep_features, leave_out, most_errors, two_level_clusters, wrong_rows, written_back
from millrace.operators.aggregates import mode_of
from millrace.operators.relational import hash_split
from millrace.plans.registry import query, sink, table
from millrace.session import cut
from millrace.sources.readers import read_csv
from millrace.sources.writers import write_csv

_CODES_SQL = "with o as (select l_orderkey, list(cast(l_partkey as varchar) order by l_linenumber, cast(l_partkey as varchar)) as codes from lineitem group by 1) "


def _codes(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").cast("string").alias("c")))).alias("x"))
    return rows.select("l_orderkey", F.transform("x", lambda s: s["c"]).alias("codes"))


@query(_CODES_SQL + """select l_orderkey, codes[-1][-1:] as last_digit, case when len(list_filter(codes, lambda c: ends_with(c, '6'))) > 0 then true end as adhoc,
   case when len(list_filter(codes, lambda c: ends_with(c, '6'))) / len(codes)::double > 0.49 then 'ADHOC' else 'FILED' end as majority from o""")
def tc_features(spark, sf):
    return _codes(spark, sf).select("l_orderkey", X.code_features(F.col("codes")).alias("f")).select("l_orderkey", "f.last_digit", "f.adhoc", "f.majority")


@query(_CODES_SQL + "select l_orderkey, len(list_filter(codes, lambda c: not regexp_matches(c, '^[0-9]'))) = 0 as first_is_digit from o")
def tc_firstdigit(spark, sf):
    return _codes(spark, sf).select("l_orderkey", X.code_features(F.col("codes"))["first_is_digit"].alias("first_is_digit"))


@query("select o_orderkey, bool_or(contains(o_orderpriority, 'URGENT')) as has_bcode from orders group by 1")
def tc_bcode(spark, sf):
    codes = F.array(F.regexp_replace("o_orderpriority", "URGENT", "BCODE"))
    return table(spark, sf, "orders").select("o_orderkey", X.code_features(codes)["has_bcode"].alias("has_bcode"))


@query("""with f as (select distinct l_orderkey from lineitem where l_partkey in (select p_partkey from part where p_size < 5))
   select o_orderkey, f.l_orderkey is not null as filed, case when f.l_orderkey is not null then 'filed' when o_orderkey % 10 = 6 then 'paper' end as faretype from orders left join f on o_orderkey = l_orderkey""")
def cat35_flags(spark, sf):
    small = table(spark, sf, "part").where("p_size < 5").select(F.col("p_partkey").alias("l_partkey"))
    filed = table(spark, sf, "lineitem").join(small, "l_partkey", "left_semi").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    joined = table(spark, sf, "orders").select("o_orderkey").join(filed, "o_orderkey", "left")
    kind = F.when(F.col("hit"), "filed").when(F.col("o_orderkey") % 10 == 6, "paper")
    return joined.select("o_orderkey", F.coalesce("hit", F.lit(False)).alias("filed"), kind.alias("faretype"))


@query("""with t as (select word from (select word, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1 order by n desc, word limit 100) where length(word) >= 6)
   select distinct doc_id, word from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) where word in (select word from t)""")
def topword_features(spark, sf):
    docs = table(spark, sf, "documents")
    vocabulary = top_words(docs, "text", 100, 6, ())
    return X.word_flags(docs.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("words")), "doc_id", "words", vocabulary)


@query("select doc_id, case when contains(text, 'Apache') and source in ('src1', 'src2') then 'yes' when contains(text, 'Apache') then 'no' end as cta from documents")
def cta_flag(spark, sf):
    has = F.col("text").contains("Apache")
    return table(spark, sf, "documents").select("doc_id", F.when(has & F.col("source").isin("src1", "src2"), "yes").when(has, "no").alias("cta"))


def _feature_maps(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    pairs = F.create_map(F.lit("lang"), "lang", F.lit("long"), (F.col("n_chars") > 1000).cast("string"), F.lit("n"), F.col("n_chars").cast("string"))
    return docs.select("doc_id", "toxic", "quality", pairs.alias("features"))


@query("""select doc_id, unnest(['lang=' || lang, 'long', 'n']) as name, unnest([1.0::double, (n_chars > 1000)::int::double, n_chars::double]) as value from documents join labels using (doc_id)""")
def assemble_features(spark, sf):
    return X.as_pairs(_feature_maps(spark, sf), "doc_id")


_WORDS = "w as (select distinct doc_id, word from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents where doc_id in (select doc_id from labels))), "


@query(f"""with {_WORDS} l as (select doc_id, quality from labels), n as (select count(*)::double as n from l), c as (select quality, count(*) as nl from l group by 1),
   b as (select word, count(*) as nw from w group by 1 having count(*) >= 20), j as (select word, quality, count(*) as n11 from w join l using (doc_id) group by 1, 2),
   g as (select word, quality, nl, nw, coalesce(n11, 0) as n11 from (b cross join c) left join j using (word, quality))
   select word, round(sum(case when n11 > 0 then n11 / n * ln(n11 * n / (nw * nl)) else 0 end + case when nl - n11 > 0 then (nl - n11) / n * ln((nl - n11) * n / ((n - nw) * nl)) else 0 end), 6) as mi from g, n group by 1""")
def mutual_information(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id", F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("words"))
    return X.mutual_information(docs, labels, "doc_id", "words", "quality", 20).withColumn("mi", F.round("mi", 6))


@query(f"with {_WORDS} n as (select count(*)::double as n from labels) select word, round(count(*) / n * (1 - count(*) / n), 6) as variance from w, n group by word, n having count(*) / n * (1 - count(*) / n) > 0.09")
def variance_select(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id")
    total = labels.count()
    words = table(spark, sf, "documents").join(labels, "doc_id", "left_semi").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    share = F.count("*") / F.lit(float(total))
    return words.groupBy("word").agg((share * (1 - share)).alias("variance")).where("variance > 0.09D").withColumn("variance", F.round("variance", 6))


_MAJORITY_SQL = """with m as (select source, quality as guess from (select source, quality, row_number() over (partition by source order by count(*) desc, quality) as r
   from documents join labels using (doc_id) where quality is not null group by source, quality) where r = 1) """


def _majority(spark, sf):
    """A small model: each source's most frequent label, learnt from the labelled documents."""
    seen = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").where("quality is not null"), "doc_id")
    return mode_of(seen, ["source"], "quality").select("source", F.col("quality").alias("guess"))


@query(_MAJORITY_SQL + "select doc_id, case when guess = 1 then 'yes' else 'no' end as prediction from documents left join m using (source) where doc_id not in (select doc_id from labels)")
def prediction_writeback(spark, sf):
    unlabelled = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")
    guesses = unlabelled.join(_majority(spark, sf), "source", "left").select("doc_id", "guess")
    return written_back(unlabelled, guesses, "doc_id", "guess").select("doc_id", "prediction")


@query(_MAJORITY_SQL + "select doc_id::varchar as doc_id, source, case when guess = 1 then 'yes' else 'no' end as prediction from documents left join m using (source) where lang = 'en'")
def export_predictions(spark, sf):
    """Predictions of all English documents, written as CSV and read again."""
    docs = table(spark, sf, "documents").where("lang = 'en'").select("doc_id", "source")
    guesses = docs.join(_majority(spark, sf), "source", "left").select("doc_id", "guess")
    path = sink(spark, "predictions")
    write_csv(written_back(docs, guesses, "doc_id", "guess").select("doc_id", "source", "prediction"), path)
    return read_csv(spark, path)


@query(_MAJORITY_SQL + """, p as (select quality as actual, guess, source as run, lang as category from documents join labels using (doc_id) join m using (source) where quality is not null)
   select run, category, actual, guess, count(*) as n from p group by all""")
def confusion_by_run(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels").where("quality is not null"), "doc_id").join(_majority(spark, sf), "source")
    return rows.groupBy(F.col("source").alias("run"), F.col("lang").alias("category"), F.col("quality").alias("actual"), "guess").agg(F.count("*").alias("n"))


@query(_MAJORITY_SQL + """, p as (select quality as actual, guess, lang as category from documents join labels using (doc_id) join m using (source) where quality is not null),
   e as (select category, actual, guess, count(*) as n from p where actual <> guess group by all)
   select category, actual, guess, n from (select *, row_number() over (order by n desc, category, actual, guess) as r from e) where r <= 5""")
def top_errors(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels").where("quality is not null"), "doc_id").join(_majority(spark, sf), "source")
    return most_errors(rows.select(F.col("lang").alias("category"), F.col("quality").alias("actual"), "guess"), ["category"], 5)


@query()
def lang_detect(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", detect_language(F.col("text")).alias("detected"))


def _training(spark, sf):
    data = _feature_maps(spark, sf)
    pairs = X.as_pairs(data, "doc_id").where("name <> 'n'")
    vocabulary = X.vocabulary_of(pairs)
    made = X.vectors(pairs, "doc_id", vocabulary).join(data.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    return made, len(vocabulary)


def _predict(kind: str):
    def run(spark, sf):
        data, size = _training(spark, sf)
        return M.fit(kind, data, size).transform(data).select("doc_id", "label", "prediction")

    return run


for _kind in M.CLASSIFIERS:
    query(name=f"model_{_kind}")(_predict(_kind))


@query()
def model_svc_radial(spark, sf):
    """A support vector machine with a radial kernel, by random features."""
    data, size = _training(spark, sf)
    made = M.fourier_features(data, size)
    return M.fit("svc", made, 200).transform(made).select("doc_id", "label", "prediction")


@query()
def model_svc_landmarks(spark, sf):
    """A support vector machine with a radial kernel by landmarks, with the kernel's mean error."""
    data, _ = _training(spark, sf)
    made, error = M.landmark_features(data, "doc_id")
    width = made.select("features").first()["features"].size
    return M.fit("svc", made, width).transform(made).select("doc_id", "label", "prediction", F.lit(error).alias("kernel_error"))


@query()
def model_clusters(spark, sf):
    docs = table(spark, sf, "documents")
    data, _ = M.tfidf_vectors(docs, "doc_id", "text", 5, 200)
    return M.clusters(data, 4).select("doc_id", "prediction")


@query()
def cluster_features(spark, sf):
    """The cluster of each document as a feature named by its source, such as ``US_3``."""
    docs = table(spark, sf, "documents")
    data, _ = M.tfidf_vectors(docs, "doc_id", "text", 5, 200)
    named = M.clusters(data, 4).select("doc_id", "prediction").join(docs.select("doc_id", "source"), "doc_id")
    return named.select("doc_id", F.concat_ws("_", "source", "prediction").alias("feature"))


@query()
def holdout_runs(spark, sf):
    """(kind, features, accuracy) of models fitted on four fifths and judged on the rest, with all features and with the important ones."""
    data, size = _training(spark, sf)
    train, test = hash_split(cut(data), ["doc_id"], 0.8)  # every fit reads them many times
    forest = M.fit("forest", train, size)
    names = [str(i) for i in range(size)]
    kept = [n for n, _ in important(forest, names)] or names
    found = []
    for label, columns in (("all", names), ("important", kept)):
        one, _ = keep_features(train, names, columns)
        two, _ = keep_features(test, names, columns)
        for kind in ("forest", "adaboost"):
            model = M.AdaBoost.fit(one, 3) if kind == "adaboost" else M.fit(kind, one, len(columns))
            judged = model.transform(two).agg((F.count_if(F.col("label") == F.col("prediction")) / F.count("*")).alias("accuracy"))
            found.append(judged.select(F.lit(kind).alias("kind"), F.lit(label).alias("features"), "accuracy"))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


@query()
def silhouettes(spark, sf):
    """(k, silhouette) of several numbers of clusters of the documents, exact over all of them."""
    data, _ = M.tfidf_vectors(table(spark, sf, "documents"), "doc_id", "text", 5, 200)
    found = M.silhouette_sweep(data, "doc_id", (2, 3))
    return spark.createDataFrame(sorted(found.items()), "k int, silhouette double")


@query()
def two_levels(spark, sf):
    """Documents in clusters, those of the first in parts."""
    return two_level_clusters(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", 3, 2)


@query()
def left_out(spark, sf):
    """Labelled documents, each predicted by a tree that has not seen its fold, that were predicted wrongly."""
    data, size = _training(spark, sf)
    return wrong_rows(leave_out(data, "doc_id", lambda rows: M.fit("tree", rows, size), 3), "doc_id")
