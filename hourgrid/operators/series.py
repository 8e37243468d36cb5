"""Time-ordered operators: feature table, chronological split, latest rows, forecast frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid.functions import calendar, measures

ORDER = ("time", "latitude", "longitude")
# Default of spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT = 1000
# The sketch's error in rank is one part in so many of all rows.
SKETCH = 10_000


def ml_features(weather: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Target and the features in their fixed order; daily extremes stay out, they leak the target."""
    return weather.select(*keep, fv.TARGET, *fv.FEATURES)


def in_time_order(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    return df.orderBy(*order)


def preview(df: DataFrame, rows: int = 5, order: Sequence[str] = ORDER) -> DataFrame:
    """The first rows in time order, for a look at the data."""
    return df.orderBy(*order).limit(rows)


def hash_sample(
    df: DataFrame, keys: Sequence[str], buckets: int = fv.SAMPLE_BUCKETS, portable: bool = False
) -> DataFrame:
    """Repeatable 1-in-``buckets`` sample by key. Put it before joins: it needs the keys only."""
    return df.where(measures.hash_bucket([F.col(k) for k in keys], buckets, portable) == 0)


def _split_point(df: DataFrame, order: Sequence[str], test_share: float) -> DataFrame:
    """The last key of the first part, as one row.

    A sketch of the times gives two between which the cut must fall, with the number of rows, in one pass. The next
    counts exactly: all rows before the bracket as one, and those inside by time and the first of the other
    columns. A last one, by the rest of the key, looks only at rows that are equal in these. All count with map-side combine, so no step
    holds the rows of an hour, however many there are. Rows without time come first.
    """
    time, *ties = order
    first, rest = ties[:1], ties[1:]
    early = F.lit("0001-01-01").cast("timestamp_ntz").cast(df.schema[time].dataType) if df.schema[time].dataType.typeName().startswith("timestamp") else None
    at = F.coalesce(F.col(time), early) if early is not None else F.col(time)
    rows = df.select(at.alias("_at"), *order)
    near = [min(max(1 - test_share + side * 2 / SKETCH, 0.0), 1.0) for side in (-1, 1)]
    bracket = F.percentile_approx("_at", near, SKETCH).alias("between")
    total = F.count(F.lit(1))
    # The bracket is wider than a row, to which the cut is rounded, only if there are enough rows.
    first_time = F.when(total < SKETCH, F.min("_at")).alias("first")
    sketch = rows.agg(F.struct(bracket, first_time, (total - F.ceil(F.lit(test_share) * total)).alias("take")).alias("s")).scalar()
    low, high = F.coalesce(sketch["first"], sketch["between"][0]), sketch["between"][1]

    def cut(counts: DataFrame, keys: list[str], take: Column) -> DataFrame:
        """The key at which ``take`` rows are reached, and how many of its rows belong to them."""
        upto = F.sum("n").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
        numbered = counts.withColumns({"_upto": upto, "_take": take})
        reached = numbered.where((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("n") < F.col("_take")))
        return reached.withColumn("_left", F.col("_take") - F.col("_upto") + F.col("n")).drop("n", "_upto", "_take")

    inside = F.col("_at") >= low
    keys = [F.when(inside, F.col(c)).alias(c) for c in ("_at", time, *first)]
    counts = rows.where(F.col("_at") <= high).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = cut(counts, ["_at", *first], sketch["take"])
    if not rest:
        return found.select(*order)
    there = found.select(F.struct(time, "_at", *first, "_left").alias("s")).scalar()
    same = F.col("_at") == there["_at"]
    for c in first:
        same &= F.col(c).eqNullSafe(there[c])
    counts = rows.where(same).groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    return cut(counts, rest, there["_left"]).select(*order)


def chrono_split(
    df: DataFrame, test_share: float = fv.TEST_SHARE, order: Sequence[str] = ORDER
) -> DataFrame:
    """Adds ``is_test``: the last ``ceil(test_share * n)`` rows in time order, no shuffling of rows.

    ``order`` should identify a row, as the star's keys do; copies of the key at which the cut
    falls stay together in the first part, so that no observation is on both sides. The rows are
    never sorted or numbered: they are compared with that one key, so the split is a map over the
    input after two counting passes over the key columns, and one over the rows of a single time.
    """
    if not 0 < test_share < 1:
        raise ValueError("test_share must be between 0 and 1")
    point = _split_point(df, order, test_share).select(F.struct(*order)).scalar()
    return df.withColumn("is_test", F.coalesce(F.struct(*order) > point, F.lit(True)))


def latest_rows(df: DataFrame, rows: int = fv.WINDOW_ROWS, order: Sequence[str] = ORDER) -> DataFrame:
    """The newest ``rows`` rows over all places, ties by place."""
    time, *ties = order
    return df.orderBy(F.desc(time), *ties).limit(rows)


def latest_hours_per_location(
    df: DataFrame, hours: int = fv.WINDOW_ROWS, place: Sequence[str] = ("latitude", "longitude")
) -> DataFrame:
    """The newest ``hours`` rows of each place.

    Spark limits each task's rows per place before the shuffle, so a place with a large share of
    all rows sends ``hours`` rows per task and no more. Beyond ``GROUP_LIMIT`` rows, where Spark does
    not, each place is cut down to its newest days first.
    """
    newest = Window.partitionBy(*place).orderBy(F.desc("time"))
    if hours > GROUP_LIMIT:
        # Beyond Spark's limit a place would go to one task whole: first the day of each place from
        # which on it has enough rows, one row per place and day, then only the rows since then.
        day = F.to_date("time")
        days = df.groupBy(*place, day.alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
        later = Window.partitionBy(*place).orderBy(F.desc("_day"))
        days = days.withColumn("_before", F.sum("_rows").over(later) - F.col("_rows")).where(F.col("_before") < hours)
        since = days.groupBy(*place).agg(F.min("_day").alias("_since"))
        df = df.join(since, list(place)).where(F.to_date("time") >= F.col("_since")).select(df.columns)
    return df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= hours).drop("_n")


def first_slice(df: DataFrame, rows: int = fv.SLICE_ROWS, order: Sequence[str] = ORDER) -> DataFrame:
    """The first ``rows`` points of the test part, to compare with their predictions."""
    return preview(df, rows, order)


def forecast_frame(latest: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Re-uses the window's rows as the pattern of the coming hours.

    Row ``step`` (from 1, oldest first) is stamped ``step`` hours after the newest time. The input
    is the limited window of ``latest_rows``, which alone may run in one task.
    """
    time = order[0]
    ordered = Window.orderBy(*order)
    newest = F.max(time).over(Window.partitionBy())
    return latest.withColumns({"step": F.row_number().over(ordered), "_newest": newest}).select(
        "*", (F.col("_newest") + calendar.hours(F.col("step"))).alias("forecast_time")
    ).drop("_newest")


def forecast_frame_per_location(latest: DataFrame, hours: int = fv.WINDOW_ROWS) -> DataFrame:
    """The same for each place: every hour of the window returns ``hours`` hours later."""
    return latest.withColumn("forecast_time", F.col("time") + calendar.hours(hours))


def with_band(
    forecast: DataFrame,
    prediction: str = "prediction",
    base: float = fv.BAND_BASE,
    per_hour: float = fv.BAND_PER_HOUR,
) -> DataFrame:
    """Upper and lower bound around the prediction, wider with each step."""
    half: Column = F.lit(base) + (F.col("step") - 1) * F.lit(per_hour)
    return forecast.withColumns({"upper": F.col(prediction) + half, "lower": F.col(prediction) - half})
