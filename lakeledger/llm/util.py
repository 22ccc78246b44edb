"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeledger.session import checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package: the folder that holds it is
    put on their search path (on a cluster the package is installed or sent
    with ``--py-files``; the extra entry is then harmless)."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if _ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, path] if path else [_ROOT])
    checkpoint_dir(spark)
    # Texts are long: Spark's default of 10,000 rows a batch is tens of MB for
    # each task, in the JVM and in Python.  A session's own setting stays.
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, "3000")
    return spark


_CACHES: dict[str, Callable[[], None]] = {}


def claim(name: str, clear: Callable[[], None] | None = None) -> None:
    """Called by an operator in a Python worker: the caches that others left
    there (workers are used again) are emptied, and ``clear`` empties its own
    when the next one comes."""
    others = [k for k in _CACHES if k != name]
    for other in others:
        _CACHES.pop(other)()
    if others:
        gc.collect()
        _give_back()
    if clear is not None:
        _CACHES[name] = clear


def _give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that;
    an executor's next operator needs it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores until no column has it (names that differ in
    case alone are the same to Spark)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder (cuts the lineage; the
    folder is removed with the session's checkpoint data)."""
    return df.checkpoint(eager=True)
