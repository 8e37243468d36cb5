"""Stored profiles of the facts: mergeable partials, kept up to date by every load.

``day_profile`` has one row a day with counts, sums and extremes, from which key indicators, trend, histogram and drill-down
are answered. ``day_moments`` has one row a day and factor with counts, means, squared deviations and their
products, from which the correlations of any range follow. ``place_months`` has one row a place and month with a bit for each
day that had an extreme hour: bits of several places are combined by OR and counted, so distinct days of any set of
places are exact. The new facts of a load are folded and added as rows of their own, which merge when they are read; where stored values were corrected, the days, or places and months, that
hold them are folded anew from the facts, since extremes and bits cannot be taken back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import fixed_values as fv
from hourgrid.functions import calendar, measures
from hourgrid.operators import analytics

DAY_PROFILE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("n", T.LongType()),
        T.StructField("t_sum", T.DoubleType()),
        T.StructField("t_min", T.DoubleType()),
        T.StructField("t_max", T.DoubleType()),
        T.StructField("p_sum", T.DoubleType()),
        T.StructField("p_min", T.DoubleType()),
        T.StructField("p_max", T.DoubleType()),
        T.StructField("extreme", T.BooleanType()),
    ]
)
MOMENTS = ("n", "x_mean", "y_mean", "xx", "yy", "xy", "x_min", "x_max", "y_min", "y_max")
DAY_MOMENTS = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("factor", T.StringType()), T.StructField("n", T.LongType())]
    + [T.StructField(m, T.DoubleType()) for m in MOMENTS[1:]]
)
PLACE_MONTHS = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("days", T.LongType()),
    ]
)
TABLES = {"day_profile": DAY_PROFILE, "day_moments": DAY_MOMENTS, "place_months": PLACE_MONTHS}
#: What tells the rows of a profile apart, and which facts a row is folded from.
KEYS = {"day_profile": ["date"], "day_moments": ["date", "factor"], "place_months": ["location_id", "year", "month"]}
SCOPE = {"day_profile": ["date"], "day_moments": ["date"], "place_months": ["location_id", "year", "month"]}


def keyed(facts: DataFrame) -> DataFrame:
    """Facts with the calendar that their hour key spells out."""
    key = F.col("time_id")
    parts = {"date": calendar.date_of_key(key), "year": calendar.year_of_key(key), "month": calendar.month_of_key(key)}
    return facts.withColumns(parts)


def fold_days(facts: DataFrame) -> DataFrame:
    return analytics.day_profile(facts).select([f.name for f in DAY_PROFILE.fields])


def _paired(x: Column, y: Column) -> list[Column]:
    """Partials of the rows that have both values."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    n = F.count(px)
    spread = [F.min(px), F.max(px), F.min(py), F.max(py)]
    return [n, F.avg(px), F.avg(py), F.var_pop(px) * n, F.var_pop(py) * n, F.covar_pop(px, py) * n, *spread]


def fold_moments(facts: DataFrame) -> DataFrame:
    """Moments of temperature with each factor, by day; all factors in one pass."""
    temp = F.col("temperature_c")
    partials = {
        code: [p.alias(f"{code}_{m}") for p, m in zip(_paired(temp, F.col(column).cast("double")), MOMENTS, strict=True)]
        for code, _, column in fv.FACTORS
    }
    days = keyed(facts).groupBy("date").agg(*[p for ps in partials.values() for p in ps])
    rows = [F.struct(F.lit(code).alias("factor"), *[F.col(f"{code}_{m}").alias(m) for m in MOMENTS]) for code in partials]
    return days.select("date", F.inline(F.array(*rows))).where("n > 0")


def merge_moments(moments: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each ``keys`` from many. Deviations are moved to the common mean by the distance of the means, so that
    nothing is lost for values that are large against their spread.

    One row for each day and factor reaches the windows, not the facts.
    """
    rows = moments.where("n > 0")
    group = Window.partitionBy(*keys)
    share = F.col("n") / F.sum("n").over(group)
    # means are taken from the distance to one of them, which keeps the digits of large values
    means = {}
    for c in ("x", "y"):
        first = F.min(f"{c}_mean").over(group)
        means[f"_{c}"] = first + F.sum(F.col(f"_{c}_part")).over(group)
    rows = rows.withColumns({f"_{c}_part": share * (F.col(f"{c}_mean") - F.min(f"{c}_mean").over(group)) for c in ("x", "y")})
    rows = rows.withColumns(means)
    dx, dy = F.col("x_mean") - F.col("_x"), F.col("y_mean") - F.col("_y")
    moved = rows.withColumns({"_xx": F.col("xx") + F.col("n") * dx * dx, "_yy": F.col("yy") + F.col("n") * dy * dy, "_xy": F.col("xy") + F.col("n") * dx * dy})
    return moved.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("_x").alias("x_mean"), F.max("_y").alias("y_mean"),
        F.sum("_xx").alias("xx"), F.sum("_yy").alias("yy"), F.sum("_xy").alias("xy"),
        *[of(f"{c}_{name}").alias(f"{c}_{name}") for c in ("x", "y") for name, of in (("min", F.min), ("max", F.max))],
    )


def fold_places(facts: DataFrame) -> DataFrame:
    """Days with an extreme hour, as bits of the month, by place."""
    hot = keyed(facts.where(measures.is_extreme(F.col("temperature_c"))))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), calendar.day_of_key(F.col("time_id")) - 1)
    return hot.groupBy("location_id", "year", "month").agg(F.bit_or(bit).alias("days"))


FOLD = {"day_profile": fold_days, "day_moments": fold_moments, "place_months": fold_places}


def merged(name: str, rows: DataFrame) -> DataFrame:
    """One row for each key of a profile from rows of several loads."""
    if name == "day_profile":
        out = rows.groupBy("date").agg(*analytics.fold())
    elif name == "day_moments":
        out = merge_moments(rows, KEYS[name])
    else:
        out = rows.groupBy(*KEYS[name]).agg(F.bit_or("days").alias("days"))
    return out.select([f.name for f in TABLES[name].fields])


def corrected_rows(name: str, stored: DataFrame, added: DataFrame, corrected: DataFrame, facts: DataFrame) -> DataFrame:
    """A profile's rows after a load that corrected facts: those that hold one are folded anew from ``facts``, as they are now."""
    scope = SCOPE[name]
    touched = keyed(corrected).select(*scope).distinct()
    again = FOLD[name](keyed(facts).join(touched, scope, "left_semi").select(facts.columns))
    kept = stored.unionByName(FOLD[name](added)).join(touched, scope, "left_anti")
    return merged(name, kept.unionByName(again))


def _in_years(profile: DataFrame, start_year: int | None, end_year: int | None) -> DataFrame:
    if start_year is not None:
        profile = profile.where(F.col("date") >= F.make_date(F.lit(start_year), F.lit(1), F.lit(1)))
    if end_year is not None:
        profile = profile.where(F.col("date") < F.make_date(F.lit(end_year + 1), F.lit(1), F.lit(1)))
    return profile


def days(profile: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """The stored profile as the analytic operators take it, of a range of years if given; several loads of a day are merged."""
    return analytics.with_calendar(merged("day_profile", _in_years(profile, start_year, end_year)))


def correlations(moments: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """One row: the correlation of temperature with each factor over a range of years, null for a constant."""
    both = merge_moments(_in_years(moments, start_year, end_year), ["factor"])
    varies = (F.col("x_min") < F.col("x_max")) & (F.col("y_min") < F.col("y_max"))
    ratio = F.when(varies, F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")))
    value = measures.positive_zero(F.round(ratio, 3))
    return both.agg(*[F.max(F.when(F.col("factor") == code, value)).alias(code) for code, _, _ in fv.FACTORS])


def extreme_days_by_place(place_months: DataFrame) -> DataFrame:
    """Distinct days with an extreme hour for each place and year."""
    return merged("place_months", place_months).groupBy("location_id", "year").agg(F.sum(F.bit_count("days")).cast("long").alias("extreme_days"))


def extreme_days_of(place_months: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Distinct days a year on which any of ``places`` (location_id), or any place at all, had an extreme hour."""
    if places is not None:
        place_months = place_months.join(places.select("location_id").distinct(), "location_id", "left_semi")
    months = place_months.groupBy("year", "month").agg(F.bit_or("days").alias("days"))
    return months.groupBy("year").agg(F.sum(F.bit_count("days")).cast("long").alias("extreme_days"))
