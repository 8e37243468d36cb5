"""Declared schemas of the raw streams and the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_STREAM_MEASURES = {
    "instant": ("t2m", "d2m", "msl", "u10", "v10", "tcc"),
    "accum": ("tp",),
    "avg": ("avg_sdswrf",),
    "max": ("mx2t", "mn2t"),
}


def stream_measures(stream: str) -> tuple[str, ...]:
    if stream not in _STREAM_MEASURES:
        raise ValueError(f"unknown stream {stream!r}; expected one of {sorted(_STREAM_MEASURES)}")
    return _STREAM_MEASURES[stream]


def raw_stream(stream: str, measure_type: T.DataType | None = None) -> T.StructType:
    """Schema of one raw stream.

    Older files call the time column ``time``, newer ones ``valid_time``; ``expver`` and
    ``number`` may or may not be there. All are declared, and Spark reads a column that a file
    lacks as null, so files of different age fit into one scan.
    """
    measure_type = measure_type or T.FloatType()
    return T.StructType(
        [
            T.StructField("time", T.TimestampNTZType()),
            T.StructField("valid_time", T.TimestampNTZType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("expver", T.IntegerType()),
            T.StructField("number", T.IntegerType()),
        ]
        + [T.StructField(m, measure_type) for m in stream_measures(stream)]
    )


DIM_TIME = T.StructType(
    [
        T.StructField("time_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
    ]
)

DIM_LOCATION = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

FACT_WEATHER = T.StructType(
    [
        T.StructField("time_id", T.LongType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("dewpoint_c", T.DoubleType()),
        T.StructField("max_temp_c", T.DoubleType()),
        T.StructField("min_temp_c", T.DoubleType()),
        T.StructField("pressure_hpa", T.DoubleType()),
        T.StructField("precipitation_mm", T.FloatType()),
        T.StructField("wind_speed_ms", T.DoubleType()),
        T.StructField("cloud_cover", T.FloatType()),
        T.StructField("solar_radiation", T.FloatType()),
    ]
)

# How fact_weather lies on disk: with the revision that decides between two values of a fact, and one folder per
# year, so that a year range skips folders.
FACT_WEATHER_STORED = T.StructType(
    FACT_WEATHER.fields + [T.StructField("revision", T.LongType()), T.StructField("year", T.IntegerType())]
)

# One row for each delivery of a day: facts staged, raw rows over all streams, and a print of their content.
LEDGER = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("rows", T.LongType()),
        T.StructField("arrived", T.LongType()),
        T.StructField("print", T.LongType()),
    ]
)


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns, in order and type. A missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
