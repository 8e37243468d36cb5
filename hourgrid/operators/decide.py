"""Forecast summary, sector recommendations and the wording of the key indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid.functions import measures

_FIELDS = ("sector", "icon", "status", "action", "detail")


def forecast_summary(forecast: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row: forecast temperature range, mean wind and total precipitation of the window.

    The text rounds halves to the even neighbour.
    """
    p = F.col(prediction)
    row = forecast.agg(
        F.avg(p).alias("avg_temp"),
        F.min(p).alias("min_temp"),
        F.max(p).alias("max_temp"),
        F.avg("wind_speed_ms").alias("avg_wind"),
        F.sum(F.col("precipitation_mm").cast("double")).alias("total_precip"),
    )
    low, high = (F.bround(F.col(c), 0).cast("long") for c in ("min_temp", "max_temp"))
    text = F.when(F.col("min_temp").isNotNull(), F.format_string(fv.FORECAST_TEXT, low, high))
    return row.withColumn("forecast_text", text)


def _advice(values: tuple[str, ...]) -> Column:
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(_FIELDS, values, strict=True)])


def recommendations(summary: DataFrame) -> DataFrame:
    """One row per sector from the forecast summary; none when there was no forecast."""
    low, high, mean = F.col("min_temp"), F.col("max_temp"), F.col("avg_temp")
    wind, rain = F.col("avg_wind"), F.col("total_precip")
    utilities = (
        F.when(low < fv.SEVERE_FROST_C, _advice(fv.UTILITIES_FROST))
        .when(low < fv.FREEZING_C, _advice(fv.UTILITIES_WINTER))
        .otherwise(_advice(fv.UTILITIES_MILD))
    )
    farming = (
        F.when((high > fv.HEAT_C) & (rain < fv.DROUGHT_MM), _advice(fv.FARMING_DROUGHT))
        .when((mean > fv.GROWING_MIN_C) & (mean < fv.GROWING_MAX_C), _advice(fv.FARMING_GOOD))
        .otherwise(_advice(fv.FARMING_FROST))
    )
    transport = (
        F.when((wind > fv.STORM_WIND_MS) | (rain > fv.STORM_RAIN_MM), _advice(fv.TRANSPORT_STORM))
        .when((low < fv.FREEZING_C) & (rain > fv.ICE_RAIN_MM), _advice(fv.TRANSPORT_ICE))
        .otherwise(_advice(fv.TRANSPORT_CLEAR))
    )
    return summary.where(low.isNotNull()).select(F.inline(F.array(utilities, farming, transport)))


def kpi_status(kpi_row: DataFrame) -> DataFrame:
    """Wording and class of the anomaly and of the extreme days."""
    anomaly = F.col("temp_anomaly")
    more = F.col("extreme_days") - F.col("extreme_hist_avg")
    rounded = F.floor(more + 0.5).cast("long").cast("string")
    sign = F.when(anomaly > 0, "+").otherwise("")
    before, after = fv.KPI_MORE_DAYS
    return kpi_row.select(
        "year",
        F.concat(sign, measures.number_text(anomaly)).alias("anomaly_text"),
        F.when(anomaly > 0, fv.KPI_WARMER)
        .when(anomaly < 0, fv.KPI_COLDER)
        .when(anomaly == 0, fv.KPI_NORMAL)
        .otherwise(fv.KPI_NO_DATA)
        .alias("anomaly_status"),
        F.when(anomaly > 0, fv.KPI_WORSE)
        .when(anomaly < 0, fv.KPI_BETTER)
        .otherwise(fv.KPI_NEUTRAL)
        .alias("anomaly_class"),
        F.when(more > 0, F.concat(F.lit(before), rounded, F.lit(after)))
        .when(more <= 0, fv.KPI_NOT_MORE_DAYS)
        .otherwise(fv.KPI_NO_DATA)
        .alias("extreme_status"),
        F.when(more > 0, fv.KPI_WORSE)
        .when(more <= 0, fv.KPI_BETTER)
        .otherwise(fv.KPI_NEUTRAL)
        .alias("extreme_class"),
    )
