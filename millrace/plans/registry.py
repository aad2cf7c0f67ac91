"""Where queries are registered: a function's name, its DataFrame, its DuckDB text."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register the decorated (spark, sf_dir) function, with its SQL if there is one."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_sinks: list[tuple[SparkSession, str]] = []


def sink(spark: SparkSession, name: str) -> str:
    """A new folder for what a query writes and reads again, in the shared folder; deleted at the end."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
    path = f"{folder.rstrip('/')}/millrace-sinks/{name}-{uuid.uuid4().hex}"
    _sinks.append((spark, path))
    return path


@atexit.register
def _delete_sinks() -> None:
    with contextlib.suppress(Exception):  # the gateway may already be gone
        for spark, path in _sinks:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
