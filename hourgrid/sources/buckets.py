"""Cleaned streams kept in buckets of hour and place, so that joining them shuffles no row.

Each stream is a bucketed table below one folder; all have the same number of buckets. A delivery is shuffled once, when it is
added, by the hash that names the buckets, so that each task writes one file. Afterwards the four streams lie side by side: a
join of them, over all deliveries or a range of hours, reads bucket by bucket. The bucket comes from a place's 64-bit
key and the hour together, hence a hot hour or a hot place is spread over all buckets. The key stands for the two coordinates
because Spark normalizes floating join keys, and would shuffle by what it normalized.

The number of buckets is fixed when the folder is made: choose it so that the bucket of a stream, over all that it will hold, fits
a task's sort, say 1 GB. The tables are entered into the session's catalog when they are opened; the folder alone keeps
them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import fixed_values as fv
from hourgrid import schemas
from hourgrid.functions import measures
from hourgrid.sources import versions

KEYS = ("time", "location_id")
_COUNT = "buckets"


def bucketed_stream(stream: str) -> T.StructType:
    """Schema of a stream in buckets: its cell, the place's key, its measures."""
    cell = [T.StructField("time", T.TimestampNTZType()), T.StructField("location_id", T.LongType())]
    at = [T.StructField(c, T.DoubleType()) for c in ("latitude", "longitude")]
    return T.StructType(cell + at + [T.StructField(m, T.DoubleType()) for m in schemas.stream_measures(stream)])


def _open(spark: SparkSession, root: str) -> dict[str, str]:
    """Names in the catalog of the folder's tables."""
    folder = versions.Folder(spark, root)
    if _COUNT not in folder.names(""):
        raise ValueError(f"{root} holds no bucketed streams")
    count = int(folder.text(_COUNT))
    mark, names = hashlib.md5(folder.root.encode()).hexdigest()[:16], {}
    for s in fv.STREAMS:
        names[s] = f"hourgrid_{mark}_{s}"
        if not spark.catalog.tableExists(names[s]):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bucketed_stream(s).fields)
            keys, place = ", ".join(KEYS), f"{folder.root}/{s}".replace("'", "\\'")
            spark.sql(
                f"create table {names[s]} ({columns}) using parquet "
                f"clustered by ({keys}) sorted by ({keys}) into {count} buckets location '{place}'"
            )
    return names


def create(spark: SparkSession, root: str, buckets: int) -> None:
    """Make the folder; its number of buckets stays as it is."""
    if buckets < 1:
        raise ValueError("buckets must be positive")
    if not versions.Folder(spark, root).create(_COUNT, str(buckets)):
        raise ValueError(f"{root} holds bucketed streams already")


def add(spark: SparkSession, root: str, streams: Mapping[str, DataFrame]) -> None:
    """Append cleaned streams (time, latitude, longitude, measures), any of the four.

    Other columns are ignored, and rows without a time or a coordinate are kept, though they join with nothing. Files of earlier
    deliveries stay as they are. A delivery that is added twice is there twice: see ``load.pending``.
    """
    unknown = [s for s in streams if s not in fv.STREAMS]
    if unknown:
        raise ValueError(f"unknown streams {unknown}; expected some of {list(fv.STREAMS)}")
    names, count = _open(spark, root), int(versions.Folder(spark, root).text(_COUNT))
    for s, df in streams.items():
        at = F.col("latitude"), F.col("longitude")
        known = at[0].isNotNull() & at[1].isNotNull()
        keyed = df.withColumn("location_id", F.when(known, measures.location_key(*at)))
        schemas.conform_to(keyed, bucketed_stream(s)).repartition(count, *KEYS).write.insertInto(names[s])


def read(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four streams with all that was added, for ``conform.join_buckets``."""
    return {s: _read(spark, name) for s, name in _open(spark, root).items()}


def _read(spark: SparkSession, name: str) -> DataFrame:
    spark.catalog.refreshTable(name)  # another session may have added files
    return spark.table(name)
