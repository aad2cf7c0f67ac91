"""A session with the settings the engine relies on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(name: str = "millrace", master: str | None = None, **more: str) -> SparkSession:
    """Get or make a session; ``more`` are settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("__", "."): v for k, v in more.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint, for what is read twice and must be the same both times, or for the rounds of a loop.

    The folder is that of ``spark.checkpoint.dir``, which a cluster has to name; a
    local session without one gets a temporary folder.
    """
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder in the one of :func:`cut` that is deleted at the block's end; what is worked out from it has to be collected or cut inside."""
    path = f"{_checkpoint_folder(spark)}/stored-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as Parquet in a :func:`scratch` folder, for what is read in many rounds; values that recur take a fraction of a checkpoint's bytes."""
    with scratch(df.sparkSession) as path:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)


def _checkpoint_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each context.

    They can then run its functions wherever the driver was started from.
    """
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    context._millrace_shipped = True
    here = Path(__file__).resolve().parent
    if not here.is_dir():  # this is a shipped copy itself
        return
    folder = Path(tempfile.mkdtemp(prefix="millrace-"))
    shutil.copytree(here, folder / "package" / here.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(folder / "millrace"), "zip", folder / "package"))
    shutil.rmtree(folder / "package")  # executors fetch the archive when they first need it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
