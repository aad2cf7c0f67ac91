"""A corpus pipeline: toxicity, exact and near deduplication, mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import uuid
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, toxicity
from millrace.llm.exact_dedup import exact_groups, normalised
from millrace.llm.mixing import mix
from millrace.llm.near_dedup import near_groups
from millrace.llm.scratch import keep, release, remove, shared_dir, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_AT = 0.3
BLOCK_CHARS = 400_000  # of texts that are held as pieces at once, less than the tokeniser's own for the same reason
KEPT_BYTES = 32 << 20  # of pieces; less than the tokeniser's own, as earlier stages have left executors with a full heap


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC_AT``; the model is fitted on the labelled ones.

    A null text scores as an empty one; rows without an identifier are scored like
    any others, repeated rows alike; no document gives an empty table.
    """
    release(spark)
    allowed = F.crc32(F.col("label_id").cast("string")) % 4 != 2
    model = toxicity.learn(toxicity.labelled(docs, table(spark, sf_dir, "labels"), "toxic", allowed, toxicity.SAMPLE))
    scored = toxicity.score(docs.select(*COLUMNS), model, keep=COLUMNS[1:])
    return scored.where(F.col("score") < TOXIC_AT).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest identifier.

    Null and empty texts are equal; a null identifier comes last; of rows that
    repeat identifier and text one stays; no document gives an empty table.
    """
    release(spark)
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    kept = keep(kept)
    rows = docs.select(*COLUMNS, F.sha2(normalised(F.col("text")), 256).alias("sha"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha")))
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():  # identifiers should be unique; rows that repeat one with its text are copies as well
        rows = rows.dropDuplicates(["doc_id", "sha"])
    return rows.select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more.

    Texts without words and rows without an identifier are linked with nothing and
    stay; rows that share an identifier stay or go together.
    """
    release(spark)
    groups = near_groups(docs, k=5, percent=80).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    gone = keep(groups.where("not kept").select(F.col("doc_id").alias("gone_id")))  # much fewer than those that stay
    return docs.select(*COLUMNS).join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one at a source's cut whole if most of it is taken.

    A text without words, null or not, is never taken; a null source is a source;
    rows that share an identifier are taken equally often.
    """
    release(spark)
    taken = mix(docs)
    times = F.when(F.col("size") > 0, F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2))).otherwise(0)
    times = taken.groupBy(F.col("doc_id").alias("taken_id")).agg(F.max(times).cast("int").alias("times"))
    times = keep(times.where("times > 0"))
    repeated = docs.select(*COLUMNS).join(times, F.col("doc_id").eqNullSafe(F.col("taken_id")))
    return repeated.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and the digest of what they decode to.

    A null text has no ids, like an empty one; rows are independent of each other.
    """
    release(spark)
    ranks = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
    found = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, kept=KEPT_BYTES, block=BLOCK_CHARS)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", tokenise),
]

#: The first stage learns a classifier, which SQL can't express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, last = table(spark, sf_dir, "documents"), None
    for place, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if place == len(STAGES) - 1:
            return done
        path = f"{shared_dir(spark)}/millrace-pipeline/{uuid.uuid4().hex}-{name}"
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        if last is not None:
            remove(spark, last)
        last = path
    return docs
