"""Writers: CSV and code lists, snapshots, the star schema, models and the run registry."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_id(now: datetime | None = None) -> str:
    """A run's stamp, to the second."""
    return (now or datetime.now(UTC)).strftime("%Y%m%d%H%M%S")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays are joined by ``|``.  An empty table writes just the header."""
    flat = [F.array_join(c, "|").alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", "\"").csv(path)


def write_csv_file(df: DataFrame, path: str) -> None:
    """One CSV file of that name, for tables a single task can write."""
    spark = df.sparkSession
    write_csv(df.coalesce(1), f"{path}.parts")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in files.listStatus(folder(f"{path}.parts")) if f.getPath().getName().startswith("part-"))
    files.delete(folder(path), True)
    files.rename(part, folder(path))
    files.delete(folder(f"{path}.parts"), True)


def write_code_lines(df: DataFrame, keys: list[str], codes: str, path: str) -> None:
    """One line for each row: its keys and its codes, parted by tabs."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.array_join(codes, "\t"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_record(spark: SparkSession, record: dict[str, object], path: str) -> None:
    """One record as CSV."""
    spark.createDataFrame([{k: None if v is None else str(v) for k, v in record.items()}], ", ".join(f"`{k}` string" for k in record)).coalesce(1).write.mode("overwrite").option("header", True).option("escape", "\"").csv(path)


def snapshot(df: DataFrame, name: str, stamp: str | None = None) -> str:
    """Save a copy as a table with the run's stamp in its name."""
    target = f"{name}_{stamp or run_id()}"
    df.write.mode("overwrite").saveAsTable(target)
    return target


def snapshot_to(df: DataFrame, folder: str, stamp: str | None = None) -> str:
    """Save a copy as Parquet in a folder named by the run's stamp; returns where."""
    path = f"{folder}/{stamp or run_id()}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_unique(df: DataFrame, keys: list[str], path: str) -> None:
    """Overwrite a table that has a primary key; rows that break it stop the write."""
    broken = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if broken:
        raise ValueError(f"not unique by {keys}: {broken[0].asDict()}")
    df.write.mode("overwrite").parquet(path)


def split_failed(df: DataFrame, failed: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rest, failed rows): documents that failed before, apart from the rest."""
    known = failed.select(*keys).distinct()
    return df.join(known, keys, "left_anti"), df.join(known, keys, "left_semi")


def register_run(spark: SparkSession, path: str, **facts: object) -> None:
    """Append one row about a run to the registry."""
    row = {"run_id": run_id(), **{k: None if v is None else str(v) for k, v in facts.items()}}
    spark.createDataFrame([(row["run_id"], {k: v for k, v in row.items() if k != "run_id"})], "run_id string, facts map<string,string>").write.mode("append").parquet(path)


def save_model(model, path: str) -> None:
    """Save a fitted Spark ML model; load it with its class's ``load``."""
    model.write().overwrite().save(path)
