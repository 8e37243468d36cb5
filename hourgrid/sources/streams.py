"""Scans of raw streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import fixed_values as fv
from hourgrid import schemas
from hourgrid.functions import calendar


def scan_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One raw stream with a declared schema: no inference pass, no surprise in types."""
    return spark.read.schema(schema).parquet(path)


def scan_periods(
    spark: SparkSession, root: str, periods: Iterable[str], file_name: str, schema: T.StructType
) -> DataFrame:
    """The same stream of many period folders in one scan, with the folder's name as ``period``.

    The folders form one glob, so a period without a folder is passed over, and all files are
    read by one job instead of a loop of jobs.
    """
    glob = f"{root}/{{{','.join(periods)}}}/{file_name}"
    return spark.read.schema(schema).parquet(glob).withColumn("period", folder_below(root))


def scan_folders(spark: SparkSession, root: str, folders: Iterable[str]) -> dict[str, DataFrame]:
    """The four streams of many day or period folders, one scan for each stream."""
    names = list(folders)
    return {
        s: scan_periods(spark, root, names, fv.STREAM_FILE.format(stream=s), schemas.raw_stream(s)).drop("period")
        for s in fv.STREAMS
    }


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root``, wherever Spark can list it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def file_state(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of change of each file at ``path`` and below, wherever Spark can list it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True)
    state = []
    while found.hasNext():
        f = found.next()
        state.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(state))


def folder_below(root: str) -> Column:
    """Name of the folder directly below ``root`` in the row's file path."""
    last = root.rstrip("/").rsplit("/", 1)[-1]
    return F.split(F.substring_index(F.col("_metadata.file_path"), f"/{last}/", -1), "/")[0]


def month_periods(years: Iterable[int]) -> list[str]:
    return [f"{y:04d}_{m:02d}" for y in years for m in range(1, 13)]


def lagged_day(as_of: dt.date | str, lag_days: int = fv.LAG_DAYS) -> Column:
    """The day to process: ``lag_days`` before ``as_of``."""
    return F.date_sub(F.lit(as_of).cast("date"), lag_days)


def subset(
    df: DataFrame,
    columns: Sequence[str],
    day: Column | None = None,
    hours: Sequence[int] = fv.HOURS,
    area: Mapping[str, float] = fv.AREA,
    time: str = "time",
) -> DataFrame:
    """Chosen variables, day, hours and box. Day and box are plain ranges that reach the scan."""
    ts = F.col(time)
    kept = df.where(
        F.col("latitude").between(F.lit(float(area["south"])), F.lit(float(area["north"])))
        & F.col("longitude").between(F.lit(float(area["west"])), F.lit(float(area["east"])))
    )
    if day is not None:
        kept = kept.where(calendar.on_day(ts, day))
    if set(hours) != set(fv.HOURS):
        kept = kept.where(F.hour(ts).isin(*hours))
    return kept.select(time, "latitude", "longitude", *columns)
