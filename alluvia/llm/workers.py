"""Python workers find this package and get their rows in small batches."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> SparkSession:
    """Puts the package's folder on the workers' path, wherever the session was started from.

    Enough where executors see that folder; elsewhere the package is shipped as usual, by ``--py-files`` or an installation.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *known])
    return spark


#: Fixed value: bytes of rows that pass to a Python worker at once.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Inside the block, tasks hand rows to Python workers in Arrow batches of about ``BATCH_BYTES``, a larger row by itself.

    A task holds a batch as vectors, once more as a stream (both outside the heap, in buffers that double) and again in its worker: with
    Spark's 64 MB that is several hundred MB. For work that ends inside the block; the session's own setting holds again after it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    earlier = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, earlier)
