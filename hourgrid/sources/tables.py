"""Parquet tables: partitioned and batched writes that count their rows on the way."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is filled in by the action that runs it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows laid out by ranges of ``keys``.

    Ranges are cut from a sample, so a day or hour with a large share of the rows is divided among
    tasks as long as the keys go down to the place.
    """
    return df.repartitionByRange(*keys)


def write_by_date(df: DataFrame, path: str, order: Sequence[str] = fv.JOIN_KEYS, time: str = "time") -> int:
    """Write with one folder per date, replacing only the dates at hand. Returns the rows written."""
    laid_out = spread(df, order).withColumn("date", F.to_date(time))
    rows, seen = counted(laid_out.sortWithinPartitions(*order))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
    return seen.get["rows"]


def append(df: DataFrame, path: str) -> int:
    """Append, every task on its own. Returns the rows written."""
    rows, seen = counted(df)
    rows.write.mode("append").parquet(path)
    return seen.get["rows"]


def write_batches(df: DataFrame, path: str, batch: int = fv.INSERT_BATCH) -> int:
    """The same in files of at most ``batch`` rows, for receivers that take small batches only."""
    rows, seen = counted(df)
    rows.write.mode("append").option("maxRecordsPerFile", batch).parquet(path)
    return seen.get["rows"]
