"""Intermediate results that survive the loss of an executor.

Three kinds, by what they are for:

* :func:`keep` for narrow tables that are read several times: kept on the
  executors' disks, and worked out again from their lineage where a copy is lost
  (not on top of each other, as a plan shows those it rests on with each mention);
* :func:`cut` for rounds of a loop, whose lineage would grow, and for wide tables:
  a checkpoint in the folder the cluster names in ``spark.checkpoint.dir``;
* :func:`store` for wide tables of which different columns are read: Parquet in
  that folder.

Each written file costs the executor's file system a few calls (and a local one a
few processes), so only what needs it is written.  Where ``spark.checkpoint.dir``
is empty, a local test gets a temporary folder and a cluster an error.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import re
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from millrace.session import ship

_written: list[tuple[SparkSession, str]] = []
_kept: list[DataFrame] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only if none is named and all run in this process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame that reads it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the shared folder, without its lineage.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark deletes the
    files once no DataFrame reads them.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def keep(df: DataFrame) -> DataFrame:
    """``df``, worked out now and kept on the executors' disks until :func:`release`."""
    kept = df.persist(StorageLevel.DISK_ONLY)
    kept.count()
    _kept.append(kept)
    return kept


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Free what :func:`keep` holds; DataFrames that still read it work it out again."""
    while _kept:
        _kept.pop().unpersist()


@atexit.register
def _delete_written() -> None:
    try:
        while _written and _written[0][0].sparkContext._jsc is not None:
            remove(*_written.pop())
    except Exception:  # the gateway may already be gone
        pass


def give_back() -> None:
    """Return a worker's free memory to the system; the worker lives on for other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """For functions over the Arrow batches of a partition: give memory back when they end."""

    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def bound_batches(spark: SparkSession, rows: int = 1000, size: str = "32m") -> None:
    """Bound what one Arrow batch of texts can hold, by rows and by bytes; make sure the workers know this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def free_name(name: str, taken: tuple[str, ...]) -> str:
    """A column name beside the ``taken`` ones, among which ``score`` must not be, as it is added."""
    if "score" in (t.lower() for t in taken):
        raise ValueError("a column called score can't be kept, as the result has one")
    while name.lower() in (t.lower() for t in taken):
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
