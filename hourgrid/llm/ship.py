"""Gives the package to the Python workers, wherever they run, and bounds the batches they get."""

from __future__ import annotations

from pyspark.sql import SparkSession

from hourgrid.session import ship_package

__all__ = ["BATCH_BYTES", "BATCH_KEY", "bound_batches", "ship_package"]

#: Bytes of a batch that goes to a Python worker. An executor holds several copies of one for each running task, outside its heap.
BATCH_BYTES, BATCH_KEY = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bounds the batches that Python workers get in this session by ``BATCH_BYTES``, unless a bound was set already.

    The default, 10,000 rows up to 64 MB, is a whole partition of documents. The bound stays, since frames that are returned
    read it when they run.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)
