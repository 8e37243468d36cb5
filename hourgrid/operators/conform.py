"""Joining the four cleaned streams and converting their units."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid import schemas
from hourgrid.functions import calendar, measures


def join_streams(streams: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join of the streams on time and place; cells that a stream lacks vanish.

    All joins share one key, so each input is shuffled once and no join adds a shuffle.
    """
    absent = [s for s in fv.STREAMS if s not in streams]
    if absent:
        raise ValueError(f"missing streams {absent}")
    return reduce(lambda a, b: a.join(b, list(fv.JOIN_KEYS), "inner"), [streams[s] for s in fv.STREAMS])


def join_buckets(streams: Mapping[str, DataFrame]) -> DataFrame:
    """``join_streams`` of streams that lie in buckets: the same rows, by merging bucket with bucket.

    The sorts are those of one bucket each. Coordinates are compared as well, as ranges, since an equality would
    become a key that the buckets do not have; so two places with one key stay apart.
    """
    first, *rest = fv.STREAMS
    joined = streams[first].alias(first)
    for s in rest:
        same = [F.col(f"{first}.{k}") == F.col(f"{s}.{k}") for k in ("time", "location_id")]
        for c in ("latitude", "longitude"):
            same += [F.col(f"{first}.{c}") <= F.col(f"{s}.{c}"), F.col(f"{first}.{c}") >= F.col(f"{s}.{c}")]
        joined = joined.join(streams[s].alias(s).hint("merge"), reduce(lambda a, b: a & b, same), "inner")
    measured = [F.col(f"{s}.{m}") for s in fv.STREAMS for m in schemas.stream_measures(s)]
    return joined.select(*[F.col(f"{first}.{k}") for k in fv.JOIN_KEYS], *measured)


def convert_units(df: DataFrame) -> DataFrame:
    """Raw measures to Celsius, hectopascal, millimetre and wind speed, with the star's keys."""
    time, lat, lon = (F.col(k) for k in fv.JOIN_KEYS)
    return df.select(
        *fv.JOIN_KEYS,
        calendar.time_key(time).alias("time_id"),
        measures.location_key(lat, lon).alias("location_id"),
        measures.kelvin_to_celsius(F.col("t2m")).alias("temperature_c"),
        measures.kelvin_to_celsius(F.col("d2m")).alias("dewpoint_c"),
        measures.kelvin_to_celsius(F.col("mx2t")).alias("max_temp_c"),
        measures.kelvin_to_celsius(F.col("mn2t")).alias("min_temp_c"),
        measures.pascal_to_hectopascal(F.col("msl")).alias("pressure_hpa"),
        measures.metre_to_millimetre(F.col("tp")).alias("precipitation_mm"),
        measures.wind_speed(F.col("u10"), F.col("v10")).alias("wind_speed_ms"),
        F.col("tcc").alias("cloud_cover"),
        F.col("avg_sdswrf").alias("solar_radiation"),
    )


def cell_hash(*columns: str) -> tuple[Column, Column]:
    """The lower and the upper 31 bits of a hash of a row, to be summed."""
    row = F.xxhash64(*columns)
    return row.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(row, 33)


def content_print(*columns: str) -> list[Column]:
    """Two sums over the rows' hashes: a print of a multiset of rows, whatever their order.

    A changed value changes the print, and a copy adds its hash again where an exclusive or would cancel it. Each sum is over
    31 bits of a row, so that four billion rows of a day and stream stay inside 64 bits.
    """
    low, high = cell_hash(*columns)
    return [F.sum(low).alias("low"), F.sum(high).alias("high")]


def deliveries(streams: Mapping[str, DataFrame]) -> DataFrame:
    """Per day what the streams hold: ``arrived`` rows, a ``print`` of their content, ``most`` rows of a stream.

    The print covers keys and measures of all rows, copies too, and does not depend on their order. Rows without time are a
    day of their own, null.
    """
    per_stream = []
    for s in fv.STREAMS:
        rows = streams[s].select(F.lit(s).alias("stream"), *fv.JOIN_KEYS, *schemas.stream_measures(s))
        days = rows.groupBy(F.to_date("time").alias("day"))
        per_stream.append(days.agg(F.count(F.lit(1)).alias("n"), *content_print("stream", *fv.JOIN_KEYS, *schemas.stream_measures(s))))
    days = reduce(lambda a, b: a.unionByName(b), per_stream).groupBy("day")
    half = F.lit(1 << 31).cast("long")
    whole = (F.sum(F.col("high") % half) % half) * half + F.sum(F.col("low") % half) % half
    return days.agg(F.sum("n").alias("arrived"), whole.alias("print"), F.max("n").alias("most"))


def join_coverage(streams: Mapping[str, DataFrame]) -> DataFrame:
    """Per stream: cells it has and cells the inner join loses.

    One shuffle for all streams: the keys are stacked with a flag per stream and grouped, instead
    of one anti join for each.
    """
    names = [s for s in fv.STREAMS if s in streams]
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [
            streams[s].select(*fv.JOIN_KEYS, *[F.lit(int(s == other)).alias(other) for other in names])
            for s in names
        ],
    )
    cells = stacked.groupBy(*fv.JOIN_KEYS).agg(*[F.max(s).alias(s) for s in names])
    everywhere = reduce(lambda a, b: a & b, [F.col(s) == 1 for s in names])
    totals = cells.agg(
        *[F.count_if(F.col(s) == 1).alias(s) for s in names],
        *[F.count_if((F.col(s) == 1) & ~everywhere).alias(s + "_lost") for s in names],
    )
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("stream"), F.col(s).alias("cells"), F.col(s + "_lost").alias("lost"))
            for s in names
        ]
    )
    return totals.select(F.inline(rows))
