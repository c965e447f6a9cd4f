"""Helpers shared by the corpus operators.

Null handling, checkpoints and shipping of Python code to workers are decided
here once.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_code(*modules: str) -> None:
    """Pickle the named modules by value, so that executors need numpy, pandas
    and pyarrow but not this package."""
    for name in ("tillroll.llm.common", *modules):
        cloudpickle.register_pickle_by_value(sys.modules[name])


def give_back() -> None:
    """Return what a Python worker has freed to the system: workers are reused, and
    what one stage leaves with them would add to the next one's peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run``, an iterator function of a Python worker, with ``give_back`` at its end."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint in the shared folder that
    ``spark.checkpoint.dir`` names; lost executors do not lose it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` agrees with that on pure ASCII, where it
    is the fast path; anything else goes through ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
             .otherwise(F.translate(text, upper, upper.lower())))



#: Rows that a frame of a few numbers may have to be broadcast (about 2 MB), and rows of ids
#: that may be broadcast to a scan of all texts, which would have to be shuffled otherwise.
BROADCAST_ROWS, BROADCAST_IDS = 60_000, 1_000_000


def small_side(ids: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``ids`` (materialised, a few numbers a row), marked for broadcast if it is
    known to be small; beyond that Spark shuffles both sides of the join."""
    return F.broadcast(ids) if ids.count() <= most else ids


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (at most about ``rows`` rows of a few numbers) in no more partitions than
    there are cores, if that is no more than may be broadcast to a scan.  The driver
    keeps a record of every task, and a job that reads ``df`` has one for each partition."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism) if rows <= BROADCAST_IDS else df


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the ids in ``gone`` (column ``id_col``).  Rows without an id stay."""
    out = cut(gone.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("gone_id")).distinct())
    return docs.join(small_side(out, BROADCAST_IDS), docs[id_col] == out["gone_id"], "left_anti")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
