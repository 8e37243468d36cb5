"""The supplied tables read as observations.

``lineitem`` gives time, place and measures; ``events`` gives an hourly stream; ``embeddings``
gives 8 x 8 grids. Nothing is filtered or sampled: each query reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions import calendar


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _time() -> Column:
    return F.col("l_shipdate") + calendar.hours((F.col("l_partkey") % 24))


def _latitude(row: Column | None = None) -> Column:
    return F.lit(38.0) + (F.col("l_suppkey") % 27 if row is None else row) * F.lit(0.25)


def _longitude(column: Column | None = None) -> Column:
    return F.lit(68.0) + (F.col("l_suppkey") % 57 if column is None else column) * F.lit(0.25)


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time and place of every row, not yet distinct."""
    return table(spark, sf_dir, "lineitem").select(
        _time().alias("time"), _latitude().alias("latitude"), _longitude().alias("longitude")
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per time and place.

    The rows are dealt out by cell before they are grouped. Few rows of one task share a cell, so that grouping them first
    would shuffle as many, after a hash table of a task's whole input that spills when the input is large. Whole numbers
    stand for the place: Spark groups doubles by another expression than it deals them out by, and would shuffle twice.
    """
    named = {"q": "l_quantity", "pk": "l_partkey", "tax": "l_tax", "disc": "l_discount", "ep": "l_extendedprice", "ln": "l_linenumber", "sk": "l_suppkey"}
    rows = table(spark, sf_dir, "lineitem").select(
        _time().alias("time"), (F.col("l_suppkey") % 27).alias("_row"), (F.col("l_suppkey") % 57).alias("_column"),
        *[F.col(c).alias(n) for n, c in named.items()],
    )
    at = ["time", "_row", "_column"]
    found = rows.repartition(*at).groupBy(*at).agg(*[F.max(n).alias(n) for n in named])
    place = _latitude(F.col("_row")).alias("latitude"), _longitude(F.col("_column")).alias("longitude")
    return found.select("time", *place, *named)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converted observations with their calendar parts."""
    q, pk, ln, sk = (F.col(c) for c in ("q", "pk", "ln", "sk"))
    ts = F.col("time")
    return cells(spark, sf_dir).select(
        "time",
        "latitude",
        "longitude",
        *calendar.calendar_parts(ts),
        (q * 1.25 - 25).alias("temperature_c"),
        (q * 1.25 - 25 - (pk % 40) * 0.25).alias("dewpoint_c"),
        ((F.lit(90000.0) + pk) / 100).alias("pressure_hpa"),
        (F.col("tax") * 10).alias("precipitation_mm"),
        F.sqrt((ln * ln + (sk % 10) * (sk % 10)).cast("double")).alias("wind_speed_ms"),
        (F.col("disc") * 10).alias("cloud_cover"),
        F.col("ep").alias("solar_radiation"),
    )


def raw_streams(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw streams; each lacks some cells, so that joining them loses rows."""
    return streams_of(cells(spark, sf_dir))


def streams_of(g: DataFrame) -> dict[str, DataFrame]:
    q, pk = F.col("q"), F.col("pk")
    t2m = q * 1.25 - 25 + 273.15
    at = ["time", "latitude", "longitude"]
    return {
        "instant": g.where(pk % 89 != 0).select(
            *at,
            t2m.alias("t2m"),
            (t2m - (pk % 40) * 0.25).alias("d2m"),
            (F.lit(90000.0) + pk).alias("msl"),
            F.col("ln").cast("double").alias("u10"),
            (F.col("sk") % 10).cast("double").alias("v10"),
            (F.col("disc") * 10).alias("tcc"),
        ),
        "accum": g.where(pk % 97 != 0).select(*at, (F.col("tax") / 100).alias("tp")),
        "avg": g.where(pk % 101 != 0).select(*at, F.col("ep").alias("avg_sdswrf")),
        "max": g.where(pk % 103 != 0).select(
            *at, (q * 1.25 - 25 + 274.15).alias("mx2t"), (q * 1.25 - 25 + 272.15).alias("mn2t")
        ),
    }


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with a preliminary and a final data version; either may be missing, and the
    preliminary one lacks some values. Some suppliers' cells come without a version."""
    version = F.when(F.col("l_suppkey") % 5 == 0, F.lit(None)).when(F.col("l_linestatus") == "O", 5).otherwise(1)
    gap = version.eqNullSafe(5) & (F.col("l_linenumber") == 3)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.to_date("l_shipdate").cast("timestamp_ntz").alias("time"),
            _latitude().alias("latitude"),
            _longitude().alias("longitude"),
            version.alias("expver"),
        )
        .agg(F.max(F.when(~gap, F.col("l_quantity"))).alias("t2m"), F.max("l_tax").alias("tp"))
    )


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector of 64 values as a grid of 8 latitudes by 8 longitudes."""
    axis = [F.lit(i * 0.25) for i in range(8)]
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.array(*[F.lit(38.0) + a for a in axis]).alias("latitude"),
        F.array(*[F.lit(68.0) + a for a in axis]).alias("longitude"),
        F.col("embedding").alias("value"),
    )
