"""How often tour codes stand in fare sheets, and the export with correction candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.extract import TOUR_CODE
from millrace.functions.text import spelling_candidates
from millrace.session import cut

NOT_FOUND = "Not found"
BROADCAST_CODES = 100_000


def is_tour_code(word: Column, known: Column | None = None) -> Column:
    """Whether a word is among known codes (an array), or begins like a code."""
    fits = F.coalesce(word.rlike(f"^{TOUR_CODE}"), F.lit(False))
    return fits if known is None else fits | F.coalesce(F.array_contains(known, word), F.lit(False))


def codes_in_name(name: Column) -> Column:
    """The tour codes in a file name, in order, once each."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(name, F.lit("")), F.lit("[A-Za-z0-9]+FF[0-9]+"), F.lit(0)))


def file_counts(codes: DataFrame, sheets: DataFrame) -> DataFrame:
    """(code, faretype, file_cnt, paper_cnt, filed_cnt, extension_dates) of each code.

    ``codes`` are (code); ``sheets`` are (sheet, tourcodes array, text, faretype,
    extension_date).  A code's files are the sheets that list it; a code that no
    sheet lists is searched as a word of the texts.  The type is that of the first
    sheet; without a sheet, or if that one has no type, the code is not found.
    ``extension_dates`` are (sheet, date) of the filed ones.
    """
    facts = ["sheet", "faretype", "extension_date"]
    wanted = cut(codes.select("code").where("code is not null").distinct())
    few = F.broadcast if wanted.count() <= BROADCAST_CODES else lambda df: df  # then the words of the texts are not shuffled
    listed = cut(sheets.select(*facts, F.explode(F.array_distinct("tourcodes")).alias("code")).join(few(wanted), "code"))
    others = wanted.join(listed.select("code").distinct(), "code", "left_anti").withColumn("word", F.lower("code"))
    words = sheets.select(*facts, F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\w]+"))).alias("word"))
    found = listed.unionByName(words.join(few(others), "word").select("code", *facts))
    dated = F.when((F.col("faretype") == "filed") & F.col("extension_date").isNotNull(), F.struct("sheet", "extension_date"))
    counted = found.groupBy("code").agg(
        F.min_by(F.struct("faretype"), "sheet")["faretype"].alias("faretype"), F.count("*").alias("file_cnt"), F.count_if(F.col("faretype") == "paper").alias("paper_cnt"),
        F.count_if(F.col("faretype") == "filed").alias("filed_cnt"), F.array_sort(F.collect_list(dated)).alias("extension_dates"),
    )
    typed = wanted.join(counted.where("faretype is not null"), "code", "left")
    counts = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("file_cnt", "paper_cnt", "filed_cnt")}
    return typed.withColumns(counts).withColumn("faretype", F.coalesce("faretype", F.lit(NOT_FOUND)))


def candidates_of(codes: DataFrame, master: DataFrame) -> DataFrame:
    """(code, candidate): itself if the master list has it, else all of the list one edit away, else itself."""
    near = spelling_candidates(codes.select(F.col("code").alias("word")), master.select(F.col("code").alias("word"), F.lit(1).alias("freq")))
    best = near.groupBy("word").agg(F.min("distance").alias("least"))
    kept = near.join(best, "word").where(F.col("distance") == F.col("least")).select(F.col("word").alias("code"), "candidate")
    return codes.select("code").distinct().join(kept, "code", "left").select("code", F.coalesce("candidate", "code").alias("candidate"))


def export(codes: DataFrame, sheets: DataFrame, master: DataFrame) -> DataFrame:
    """(tour_cd, code, candidate, filed, faretype, file_cnt, paper_cnt, filed_cnt): the lines of the export.

    ``codes`` are (tour_cd, code, filed) with Y, N or null; ``master`` are (code).
    A code that is neither found nor marked goes out once for each candidate of its
    correction, with the candidate's counts.  A code that is filed by the sheets but
    not marked Y counts as paper.
    """
    unmarked = codes.where("filed is null or filed = ''")
    near = cut(candidates_of(unmarked, master))
    # the sheets are read once, for the codes and for all that they may have to be corrected to
    wanted = codes.select("code").unionByName(near.select(F.col("candidate").alias("code"))).distinct()
    own = cut(file_counts(wanted, sheets).drop("extension_dates"))
    lost = unmarked.join(own.where(F.col("faretype") == NOT_FOUND), "code", "left_semi")
    corrected = lost.join(near, "code").join(own.withColumnRenamed("code", "candidate"), "candidate")
    rest = codes.join(lost.select("code", "tour_cd"), ["code", "tour_cd"], "left_anti").withColumn("candidate", F.col("code")).join(own, "code")
    paper = F.when((F.coalesce("filed", F.lit("")) != "Y") & (F.col("faretype") == "filed"), "paper").otherwise(F.col("faretype"))
    names = ["tour_cd", "code", "candidate", "filed", "faretype", "file_cnt", "paper_cnt", "filed_cnt"]
    return corrected.select(*names).unionByName(rest.withColumn("faretype", paper).select(*names))
