"""Star tables: two dimensions, one fact, and the view over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.functions import calendar, measures

# Largest dimension that is sent to every executor: hours of 200 years, or a global grid of 0.25
# degrees, at some 60 bytes a row.
BROADCAST_ROWS = 2_000_000


def time_dimension(df: DataFrame) -> DataFrame:
    """Distinct hours of ``df.time`` with their calendar parts.

    The hour keys are made distinct first; the calendar parts are then computed once per hour.
    """
    hours = df.select(calendar.time_key(F.col("time")).alias("time_id")).distinct()
    ts = F.col("timestamp")
    return schemas.conform_to(
        hours.withColumn("timestamp", calendar.time_of_key(F.col("time_id"))).select(
            "time_id", ts, *calendar.calendar_parts(ts)
        ),
        schemas.DIM_TIME,
    )


def location_dimension(df: DataFrame) -> DataFrame:
    """Distinct places. Grouped by coordinates, which the id is a hash of."""
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    places = df.select(lat.alias("latitude"), lon.alias("longitude")).distinct()
    return schemas.conform_to(
        places.withColumn("location_id", measures.location_key(F.col("latitude"), F.col("longitude"))),
        schemas.DIM_LOCATION,
    )


def fact(df: DataFrame) -> DataFrame:
    return schemas.conform_to(df, schemas.FACT_WEATHER)


def join_dimension(facts: DataFrame, dim: DataFrame, key: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join to a dimension, broadcast only when it was counted to be small enough.

    Of a stored dimension the count reads file footers. A larger dimension is left to a shuffled
    join, where adaptive execution splits hot keys.
    """
    if dim.count() <= broadcast_rows:
        dim = F.broadcast(dim)
    return facts.join(dim, key, "inner")


def with_time(facts: DataFrame, dim_time: DataFrame, **kw) -> DataFrame:
    return join_dimension(facts, dim_time, "time_id", **kw)


def weather_full(facts: DataFrame, dim_time: DataFrame, dim_location: DataFrame, **kw) -> DataFrame:
    """Facts with calendar and place; the time dimension's quarter stays out."""
    return join_dimension(with_time(facts, dim_time.drop("quarter"), **kw), dim_location, "location_id", **kw)
