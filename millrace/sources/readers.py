"""Readers: CSV with a schema, label folders, page stores, dictionaries, databases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, empty_as: str | None = None) -> DataFrame:
    """CSV with a header; without a schema all columns are text.  ``empty_as`` fills missing text."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    rows = (reader.schema(schema) if schema is not None else reader).csv(path)
    return rows if empty_as is None else rows.na.fill(empty_as)


def country_of(path, special: dict[str, str] | None = None):
    """The country in a file name ``x_y_COUNTRY_PARTS_z.csv``: what stands between the second and the last part."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    parts = F.split(name, "_")
    found = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 3, F.lit(0))), "_")
    return found if not special else F.coalesce(F.create_map(*[F.lit(x) for pair in special.items() for x in pair])[found], found)


def read_label_folder(spark: SparkSession, folder: str, special: dict[str, str] | None = None) -> DataFrame:
    """All CSV files of a folder with the country their names tell."""
    rows = spark.read.option("header", True).csv(folder)
    return rows.withColumn("country", country_of(F.col("_metadata.file_path"), special))


def upsert_labels(old: DataFrame, new: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Labels of ``new`` over those of ``old``; keys only in ``new`` are added."""
    joined = old.select(*keys, F.col(label).alias("__old")).join(new.select(*keys, F.col(label).alias("__new")), keys, "full_outer")
    return joined.select(*keys, F.coalesce("__new", "__old").alias(label))


def page_store(single: DataFrame, children: DataFrame, blobs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, html array) from three stores: one page, numbered children, blobs; missing pages are left out."""
    stores = [
        single.select(*keys, F.lit(0).alias("ord"), F.col("content").alias("html")),
        children.select(*keys, (F.col("n") + 1).cast("int").alias("ord"), F.col("content").alias("html")),
        blobs.select(*keys, F.lit(1 << 30).alias("ord"), F.col("data").cast("string").alias("html")),
    ]
    pages = reduce(DataFrame.unionByName, stores).where("html is not null")
    ordered = pages.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ord", "html"))).alias("pages"))
    return ordered.select(*keys, F.transform("pages", lambda p: p["html"]).alias("html"))


def word_counts(spark: SparkSession, path: str) -> DataFrame:
    """(word, freq) of upper-case words in text files, a vocabulary for spelling."""
    words = spark.read.text(path).select(F.explode(F.regexp_extract_all(F.upper("value"), F.lit("[A-Z]+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("freq"))


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """A database table with a projection; partition options make the read parallel.  Needs the database's driver."""
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return rows.select(*columns) if columns else rows
