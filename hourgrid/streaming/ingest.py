"""Incremental ingest of new files into a fact table or the star."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hourgrid import schemas
from hourgrid.operators import checks, load
from hourgrid.plans import daily
from hourgrid.sources import streams, tables


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files below ``path`` as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_unseen(
    spark: SparkSession,
    batch: DataFrame,
    table: str,
    schema: T.StructType,
    keys: Sequence[str],
    key: str,
    order: str | None = None,
) -> int:
    """Append the batch's rows that the table lacks, one per key; returns the rows written.

    A batch that runs again after a failure, or a file that is delivered twice, adds nothing. Only
    the stored rows in the batch's range of ``key`` are read for the comparison. Of several rows with one
    key the batch keeps the one with the greatest ``order``; a stored row always wins. A null in a key
    is an error, since such a row could not be told from its copies.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    nulls = batch.where(has_null).count()
    if nulls:
        raise checks.GateError(f"null_keys: {nulls} rows")
    rest = [f.name for f in schema.fields if f.name not in keys]
    rest.sort(key=lambda name: name != order)
    rows = batch.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    rows = rows.select([F.col(f.name) if f.name in keys else F.col("_row")[f.name].alias(f.name) for f in schema.fields])
    low, high = batch.agg(F.min(key), F.max(key)).first()
    if low is None:
        return 0
    stored = spark.read.schema(schema).parquet(table).where(F.col(key).between(low, high))
    return tables.append(load.unseen(rows, stored, keys), table)


def start_ingest(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    schema: T.StructType,
    keys: Sequence[str],
    key: str,
    checkpoint: str,
    order: str | None = None,
) -> StreamingQuery:
    """Process all files that are there, in batches, then stop. The next start takes the new ones.

    ``checkpoint`` records the files that are done; it takes the place of a skip-if-present guard.
    """
    spark = source.sparkSession
    spark.createDataFrame([], schema).write.mode("append").parquet(table)

    def load_batch(batch: DataFrame, _batch_id: int) -> None:
        append_unseen(batch.sparkSession, transform(batch), table, schema, keys, key, order)

    return (
        source.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_star_ingest(
    spark: SparkSession,
    raw_root: str,
    root: str,
    checkpoint: str,
    files_per_batch: int = 400,
    versions: bool = False,
    max_lost: int | None = 0,
) -> StreamingQuery:
    """Load the folders in which files of any raw stream have arrived, then stop.

    A day enters the star once all its streams are there in full, but for ``max_lost`` cells: until then
    the ledger does not list the day, and the next file to arrive in its folder tries it again.
    """
    at = [f for f in schemas.raw_stream("accum").fields if f.name in ("latitude", "longitude")]
    arrivals = file_stream(spark, f"{raw_root}/*/*.parquet", T.StructType(at), files_per_batch)
    arrivals = arrivals.select(streams.folder_below(raw_root).alias("folder"))

    def load_batch(batch: DataFrame, _batch_id: int) -> None:
        # At most one folder per file of the batch.
        folders = [r["folder"] for r in batch.distinct().collect()]
        if not folders:
            return
        try:
            daily.load_folders(batch.sparkSession, raw_root, folders, root, versions, max_lost, may_wait=True)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # none of the folders has all streams yet
                raise

    return (
        arrivals.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
