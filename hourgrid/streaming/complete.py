"""Days that enter the star when their four streams agree, known from state that is kept from file to file.

Each new file adds to the state of its days, one row a day whatever its size: for every stream the number of cells, an order-free
print of them, and the folders they came in. A day agrees when all four streams have the same cells, and only then is
a load started, of the days that agreed in this batch. A day that changes afterwards is loaded again, as a correction. State older than the watermark is
dropped; what arrives later than that is not counted any more, and is reported.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourgrid import fixed_values as fv
from hourgrid import schemas
from hourgrid.operators import clean, conform
from hourgrid.plans import daily
from hourgrid.sources import streams
from hourgrid.streaming import ingest

_EPOCH = dt.date(1970, 1, 1)
LOG = "day date, " + ", ".join(f"{s} long" for s in fv.STREAMS) + ", agrees boolean, batch long"


def cell_arrivals(spark: SparkSession, raw_root: str, files_per_batch: int = 100) -> DataFrame:
    """The cells of new files of all four streams: stream, folder, time, latitude, longitude. Measures are not read."""
    found = []
    for s in fv.STREAMS:
        path = f"{raw_root}/*/{fv.STREAM_FILE.format(stream=s)}"
        rows = ingest.file_stream(spark, path, schemas.raw_stream(s), files_per_batch)
        rows = rows.withColumn("folder", streams.folder_below(raw_root))
        found.append(clean.clean_stream(rows, ["folder"]).withColumn("stream", F.lit(s)))
    return reduce(DataFrame.unionByName, found)


def agreement(cells: DataFrame, wait: str) -> DataFrame:
    """Per day: ``folders``, for each stream its cells, and whether all streams have the same ones (``agrees``).

    For a batch of cells as for a stream of them. A cell that comes twice counts twice. Cells without time belong to no
    day. The day is held as a time stamp at midnight of UTC, since a watermark needs one, whatever the session's zone.
    """
    midnight = F.timestamp_seconds(F.datediff(F.to_date("time"), F.lit(_EPOCH)).cast("long") * 86_400)
    days = cells.where(F.col("time").isNotNull()).withColumn("midnight", midnight)
    if cells.isStreaming:
        days = days.withWatermark("midnight", wait)
    low, high = conform.cell_hash(*fv.JOIN_KEYS)
    sums: list[Column] = [F.collect_set("folder").alias("folders")]
    for s in fv.STREAMS:
        here = F.col("stream") == s
        sums += [F.count_if(here).alias(s), F.sum(F.when(here, low)).alias(f"{s}_low"), F.sum(F.when(here, high)).alias(f"{s}_high")]
    first, *rest = fv.STREAMS
    same = [F.col(f"{first}{part}").eqNullSafe(F.col(f"{s}{part}")) for s in rest for part in ("", "_low", "_high")]
    day = F.date_add(F.lit(_EPOCH), F.floor(F.unix_seconds("midnight") / 86_400).cast("int"))
    return days.groupBy("midnight").agg(*sums).select(
        day.alias("day"), "folders", *fv.STREAMS, reduce(lambda a, b: a & b, same).alias("agrees")
    )


def start_agreed_ingest(
    spark: SparkSession, raw_root: str, root: str, checkpoint: str, wait: str = "60 days", files_per_batch: int = 100
) -> StreamingQuery:
    """Load the days whose streams agree by the files that have arrived, then stop; the next start goes on from there.

    ``wait`` is how far a day may lie behind the newest one and still be counted. ``checkpoint`` holds the state, the files that
    are done, and the log of changed days. A batch that runs again after a failure writes its part of the log anew
    and loads nothing twice, since the ledger of the star lists what was delivered. A day that agrees but holds a cell twice does not
    pass the load's checks: it stays out of the ledger, and does not keep other days from being loaded.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        log = f"{checkpoint}/day_log/batch={batch_id}"
        batch.select("day", "folders", *fv.STREAMS, "agrees").write.mode("overwrite").parquet(log)
        agreed = session.read.parquet(log).where("agrees")
        # one folder for each delivery of the agreed days, as the load needs to list them
        folders = [r["folder"] for r in agreed.select(F.explode("folders").alias("folder")).distinct().collect()]
        if folders:
            daily.load_folders(session, raw_root, sorted(folders), root, may_wait=True, only=agreed.select("day"))

    return (
        agreement(cell_arrivals(spark, raw_root, files_per_batch), wait)
        .writeStream.outputMode("update")
        .foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def day_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of each day when it last changed: cells of each stream, and whether they agree."""
    found = spark.read.schema(LOG).parquet(f"{checkpoint}/day_log")
    last = found.groupBy("day").agg(F.max(F.struct("batch", *fv.STREAMS, "agrees")).alias("last"))
    return last.select("day", *[F.col("last")[c].alias(c) for c in (*fv.STREAMS, "agrees")])


def late_groups(progress: Iterable) -> int:
    """How many days' parts came too late to be counted, from the progress of a query (``recentProgress``).

    Each is what one task read of a day that the watermark had passed.
    """
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
