"""Key indicators, trend, histogram, correlations and drill-down.

Every time-based question starts from ``day_profile``: the observations are folded once into one
row per day, with map-side combine, so whatever the grid's size only days are shuffled and the
questions themselves run over some thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid.functions import calendar, measures

GRAINS = ("year", "month", "day")
FUNCTIONS = ("avg", "max", "min")


def _partials() -> list[Column]:
    temp, rain = F.col("temperature_c"), F.col("precipitation_mm").cast("double")
    return [
        F.count(temp).alias("n"),
        F.sum(temp).alias("t_sum"),
        F.min(temp).alias("t_min"),
        F.max(temp).alias("t_max"),
        F.sum(rain).alias("p_sum"),
        F.min(rain).alias("p_min"),
        F.max(rain).alias("p_max"),
        F.max(measures.is_extreme(temp)).alias("extreme"),
    ]


def fold() -> list[Column]:
    """Partials of several rows into one."""
    return [
        F.sum("n").alias("n"),
        F.sum("t_sum").alias("t_sum"),
        F.min("t_min").alias("t_min"),
        F.max("t_max").alias("t_max"),
        F.sum("p_sum").alias("p_sum"),
        F.min("p_min").alias("p_min"),
        F.max("p_max").alias("p_max"),
        F.max("extreme").alias("extreme"),
    ]


def day_profile(
    obs: DataFrame,
    dim_time: DataFrame | None = None,
    start_year: int | None = None,
    end_year: int | None = None,
) -> DataFrame:
    """One row per day: counts, sums and extremes of temperature and precipitation.

    ``obs`` has ``temperature_c``, ``precipitation_mm`` and ``time_id`` (or ``time``). The key
    spells out its own calendar, so no join is needed. With ``dim_time`` the hours are folded
    first and only then joined, which keeps the inner join's meaning (hours that the dimension
    lacks drop out) without sending the facts through a join.
    """
    by_key = "time_id" in obs.columns
    if start_year is not None and end_year is not None:
        if by_key:
            obs = obs.where(calendar.key_in_years(F.col("time_id"), start_year, end_year))
            if "year" in obs.columns:  # the stored facts' folder
                obs = obs.where(F.col("year").between(start_year, end_year))
        else:
            first = F.make_timestamp_ntz(*[F.lit(v) for v in (start_year, 1, 1, 0, 0, 0)])
            after = F.make_timestamp_ntz(*[F.lit(v) for v in (end_year + 1, 1, 1, 0, 0, 0)])
            obs = obs.where((F.col("time") >= first) & (F.col("time") < after))
    if dim_time is not None:
        hours = obs.groupBy("time_id").agg(*_partials())
        days = hours.join(dim_time.select("time_id", F.to_date("timestamp").alias("date")), "time_id")
        days = days.groupBy("date").agg(*fold())
    else:
        date = calendar.date_of_key(F.col("time_id")) if by_key else F.to_date("time")
        days = obs.groupBy(date.alias("date")).agg(*_partials())
    return with_calendar(days)


def with_calendar(days: DataFrame) -> DataFrame:
    """Rows of days with their year and month."""
    return days.withColumns({"year": F.year("date"), "month": F.month("date")})


def _mean(rounded: int) -> Column:
    return F.round(F.try_divide(F.col("t_sum"), F.col("n")), rounded)


def _years(days: DataFrame) -> DataFrame:
    return days.groupBy("year").agg(
        F.sum("t_sum").alias("t_sum"), F.sum("n").alias("n"), F.count_if("extreme").alias("extreme_days")
    )


def last_year(dim_time: DataFrame) -> DataFrame:
    """Latest year of the calendar as a one-row frame; the fallback year when it is empty."""
    return dim_time.agg(F.coalesce(F.max("year"), F.lit(fv.FALLBACK_YEAR)).alias("year"))


def extreme_days(days: DataFrame) -> DataFrame:
    return _years(days).select("year", "extreme_days")


def kpi(days: DataFrame, year: Column | int | None = None, history_only: bool = False) -> DataFrame:
    """The latest year against all years before it: mean temperature and extreme days.

    The historic number of extreme days is divided by all years, the latest included, unless
    ``history_only``. Without data the row has the fallback year and nulls.
    """
    years = _years(days)
    if year is None:
        # One row per calendar year reaches this window.
        latest = F.max("year").over(Window.partitionBy())
    else:
        latest = year if isinstance(year, Column) else F.lit(year)
    years = years.withColumns({"_is_last": F.col("year") == latest, "_is_past": F.col("year") < latest})
    is_last, is_past = F.col("_is_last"), F.col("_is_past")
    shown = F.max(F.when(is_last, F.col("year"))) if year is None else F.max(latest)
    counted = F.count_if(is_past) if history_only else F.count("year")
    row = years.agg(
        F.coalesce(shown, F.lit(fv.FALLBACK_YEAR)).alias("year"),
        F.round(
            F.try_divide(F.sum(F.when(is_last, F.col("t_sum"))), F.sum(F.when(is_last, F.col("n")))), 2
        ).alias("current_temp"),
        F.round(
            F.try_divide(F.sum(F.when(is_past, F.col("t_sum"))), F.sum(F.when(is_past, F.col("n")))), 2
        ).alias("history_temp"),
        F.coalesce(F.sum(F.when(is_last, F.col("extreme_days"))), F.lit(0)).alias("extreme_days"),
        F.round(
            F.try_divide(F.coalesce(F.sum(F.when(is_past, F.col("extreme_days"))), F.lit(0)), counted), 1
        ).alias("extreme_hist_avg"),
    )
    anomaly = measures.positive_zero(F.round(F.col("current_temp") - F.col("history_temp"), 2))
    return row.withColumn("temp_anomaly", anomaly)


def yearly_trend(days: DataFrame, width: int = fv.TREND_YEARS) -> DataFrame:
    """Yearly mean and its moving average over the last ``width`` rows, gaps not filled."""
    mean = F.try_divide(F.col("t_sum"), F.col("n"))
    frame = Window.orderBy("year").rowsBetween(-(width - 1), Window.currentRow)
    return (
        _years(days)
        .select("year", _mean(2).alias("avg_temp"), F.round(F.avg(mean).over(frame), 2).alias("trend_line"))
        .orderBy("year")
    )


def temp_histogram(days: DataFrame) -> DataFrame:
    """Days per whole degree of the daily mean."""
    degree = F.floor(F.try_divide(F.col("t_sum"), F.col("n"))).alias("temp_bin")
    return days.groupBy(degree).agg(F.count(F.lit(1)).alias("days_count")).orderBy("temp_bin")


def correlations(obs: DataFrame) -> DataFrame:
    """One row: correlation of temperature with each factor, in one pass."""
    temp = F.col("temperature_c")
    return obs.agg(
        *[
            measures.positive_zero(F.round(measures.pearson(temp, F.col(column).cast("double")), 3)).alias(code)
            for code, _, column in fv.FACTORS
        ]
    )


def correlation_ranking(row: DataFrame) -> DataFrame:
    """Factors by strength, ties in their given order; the colour tells the sign."""
    entries = F.array(
        *[
            F.struct(
                (-F.coalesce(F.abs(F.col(code)), F.lit(-1.0))).alias("weakness"),
                F.lit(i).alias("place"),
                F.lit(name).alias("name"),
                F.col(code).alias("value"),
            )
            for i, (code, name, _) in enumerate(fv.FACTORS)
        ]
    )
    ranked = row.select(F.posexplode(F.array_sort(entries)).alias("pos", "f"))
    colour = F.when(F.col("f.value") > 0, fv.POSITIVE_COLOUR).otherwise(fv.OTHER_COLOUR)
    return ranked.select(
        (F.col("pos") + 1).alias("rank"), F.col("f.name").alias("name"), F.col("f.value").alias("value"),
        colour.alias("colour"),
    )


def drill_arguments(
    group_by: str = "year",
    agg_func: str = "avg",
    start_year: int | str | None = fv.DRILL_START_YEAR,
    end_year: int | str | None = fv.DRILL_END_YEAR,
) -> tuple[str, str, int | None, int | None]:
    """Checked arguments: an unknown grain means year, an unknown function means avg, no year means all."""
    start, end = (None if y is None else int(y) for y in (start_year, end_year))
    if start is not None and end is not None and start > end:
        raise ValueError(f"start year {start} is after end year {end}")
    agg_func = agg_func.lower()
    return (
        group_by if group_by in GRAINS else "year",
        agg_func if agg_func in FUNCTIONS else "avg",
        start,
        end,
    )


def drill_down(
    obs: DataFrame,
    group_by: str = "year",
    agg_func: str = "avg",
    start_year: int | str | None = fv.DRILL_START_YEAR,
    end_year: int | str | None = fv.DRILL_END_YEAR,
    dim_time: DataFrame | None = None,
) -> DataFrame:
    """Temperature and precipitation per period of the years given, or of all years with None.

    Under avg, precipitation is summed.
    """
    grain, func, start, end = drill_arguments(group_by, agg_func, start_year, end_year)
    return drill_days(day_profile(obs, dim_time, start, end), grain, func)


def drill_days(days: DataFrame, grain: str, func: str) -> DataFrame:
    """The same from rows of days."""
    keys = {"year": ["year"], "month": ["year", "month"], "day": ["year", "month", "date"]}[grain]
    periods = days.groupBy(*keys).agg(*fold())
    temp, rain = {
        "avg": (F.try_divide(F.col("t_sum"), F.col("n")), F.col("p_sum")),
        "max": (F.col("t_max"), F.col("p_max")),
        "min": (F.col("t_min"), F.col("p_min")),
    }[func]
    columns = {k: F.col(k) for k in keys}
    label = calendar.period_label(grain, columns["year"], columns.get("month"), columns.get("date"))
    return periods.orderBy(*keys).select(
        label.alias("label"), F.round(temp, 2).alias("temp"), F.round(rain, 2).alias("precip")
    )
