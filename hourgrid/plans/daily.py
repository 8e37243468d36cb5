"""The daily run: scan, clean, join, check, load, and train on demand."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid import schemas, session
from hourgrid.functions import calendar
from hourgrid.operators import checks, clean, conform, decide, load, model, series, star
from hourgrid.sources import streams
from hourgrid.sources import versions as table_versions


def cleaned(raw: Mapping[str, DataFrame], versions: bool = False) -> dict[str, DataFrame]:
    return {s: clean.clean_stream(df, schemas.stream_measures(s), versions) for s, df in raw.items()}


def load_folders(
    spark: SparkSession,
    raw_root: str,
    folders: Iterable[str],
    root: str,
    versions: bool = False,
    max_lost: int | None = 0,
    may_wait: bool = False,
    revision: int | None = None,
    only: DataFrame | None = None,
) -> dict:
    """Load folders of raw streams into the star below ``root``; returns rows written per table.

    One folder is a daily load, a list of months is a backfill: either way each stream is one
    scan. The ledger lists the deliveries of each day by their rows and a print of their content; what
    it lists is passed over before anything is joined, and a day for which other rows or values arrive is
    loaded again, which adds what it lacks and corrects what differs: a later load replaces values of an earlier one,
    or, with ``revision``, one of a greater revision those of a smaller. The joined rows are written once to the shared
    folder for as long as the load runs. ``only`` (day) names the days to look at; the rows of others are left alone.

    A day may lose ``max_lost`` cells of a stream in the join, none by default and any number with
    None, and may hold no key twice. Days that fail stay pending and do not keep the others from being
    loaded; they are an error at the end, unless they ``may_wait`` for what is still to arrive. The
    facts of the load are checked against the dimensions before tables, profiles and ledger become visible, all at once.
    """
    with session.job_scratch(spark):
        raw = cleaned(streams.scan_folders(spark, raw_root, folders), versions)
        if only is not None:
            raw = {s: of_days(df, only) for s, df in raw.items()}
        return _load(spark, raw, root, max_lost, may_wait, revision)


def of_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """The rows of some ``days``, which are one row each and counted all the same before they are broadcast."""
    day = F.broadcast(days) if days.count() <= star.BROADCAST_ROWS else days
    return rows.join(day, F.to_date(rows["time"]) == day["day"], "left_semi")


def _load(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, max_lost: int | None, may_wait: bool, revision: int | None
) -> dict:
    nothing = {"dim_location": 0, "dim_time": 0, "fact_weather": 0, "fact_corrected": 0}
    found = conform.deliveries(raw)
    delivered = session.stored(load.pending(found, load.read_table(spark, root, "ledger")), "deliveries")
    if delivered.isEmpty():
        if not may_wait and found.isEmpty():
            raise checks.GateError("fact_not_empty: 1 rows")
        return nothing
    days = delivered.where("day is not null").select("day")

    joined = conform.join_streams({s: of_days(df, days) for s, df in raw.items()})
    staged = session.stored(conform.convert_units(joined), "staged")
    state = session.stored(day_state(staged, delivered), "days")
    good = F.col("twice") == 0
    if max_lost is not None:
        good &= F.col("lost") <= max_lost
    done = state.where(good & (F.col("rows") > 0))
    bounds = done.agg(F.min("day"), F.max("day")).first()
    written = nothing
    if bounds[0] is not None:
        # Read several times: facts, both dimensions, and the range of hours. Without a failed day it is all that was staged.
        failed = state.where(~good & (F.col("rows") > 0))
        facts = staged if failed.isEmpty() else session.stored(of_days(staged, done.select("day")), "todo")
        written = load.load_star(
            spark, root, star.fact(facts), star.time_dimension(facts), star.location_dimension(facts), revision, done,
            lambda version: checks.require(stored_checks(version, *bounds)),
        )
    if not may_wait:
        checks.require(failed_days(state.where(~good)))
    return written


def day_state(staged: DataFrame, delivered: DataFrame) -> DataFrame:
    """Each delivery (day, arrived, print) with its joined ``rows``, keys that come ``twice``, and cells ``lost``."""
    cells = staged.groupBy("time_id", "location_id").agg(F.count(F.lit(1)).alias("n"))
    days = cells.groupBy(calendar.date_of_key(F.col("time_id")).alias("day")).agg(
        F.count(F.lit(1)).alias("cells"), F.sum(F.col("n") - 1).alias("twice")
    )
    state = delivered.join(days, "day", "left").fillna(0, ["cells", "twice"])
    lost = F.greatest(F.col("most") - F.col("cells"), F.lit(0))
    return state.select("day", F.col("cells").alias("rows"), "arrived", "print", "twice", lost.alias("lost"))


def failed_days(failed: DataFrame) -> DataFrame:
    """The failed days as checks: cells that the join lost, and keys that come twice."""
    totals = failed.agg(
        F.coalesce(F.sum("lost"), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("twice"), F.lit(0)).alias("twice"),
        F.concat_ws(" ", F.sort_array(F.collect_set(F.coalesce(F.col("day").cast("string"), F.lit("no time"))))).alias("days"),
    )
    found = [("fact_unique_keys", "twice"), ("join_coverage", "lost")]
    rows = [F.struct(F.concat(F.lit(f"{n} on "), "days").alias("check"), F.col(c).alias("bad_rows")) for n, c in found]
    return totals.select(F.inline(F.array(*rows))).withColumn("passed", F.col("bad_rows") == 0)


def stored_checks(commit: table_versions.Commit, first: dt.date, last: dt.date) -> DataFrame:
    """Facts of the days, as a version will have them, whose hour or place its dimensions lack."""
    low, high = (int(d.strftime("%Y%m%d")) * 100 for d in (first, last))
    facts = commit.read("fact_weather", load.TABLES["fact_weather"], low, high + 23)
    facts = facts.where(F.col("year").between(first.year, last.year) & F.col("time_id").between(low, high + 23))
    dim_time, dim_location = (commit.read(t, load.TABLES[t]) for t in ("dim_time", "dim_location"))
    found = checks.orphans(facts, dim_time, "time_id", "fact_time_known").unionByName(
        checks.orphans(facts, dim_location, "location_id", "fact_location_known")
    )
    return found.withColumn("passed", F.col("bad_rows") == 0)


def open_star(spark: SparkSession, root: str, version: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts, time and location dimensions of a version, by default the newest; also registered as temporary views."""
    version = table_versions.newest(spark, root) if version is None else version
    facts, dim_time, dim_location = (
        load.read_table(spark, root, name, version) for name in ("fact_weather", "dim_time", "dim_location")
    )
    facts = facts.drop("revision")
    facts.createOrReplaceTempView("fact_weather")
    dim_time.createOrReplaceTempView("dim_time")
    dim_location.createOrReplaceTempView("dim_location")
    star.weather_full(facts.drop("year"), dim_time, dim_location).createOrReplaceTempView("weather_full")
    return facts, dim_time, dim_location


def training_rows(
    spark: SparkSession,
    root: str,
    year: int | None = None,
    buckets: int | None = None,
    sample_keys: Sequence[str] = checks.FACT_KEYS,
    portable: bool = False,
) -> DataFrame:
    """Feature rows of the star, of one year and sampled by key if asked; both filters run on the
    facts, before the joins."""
    facts, dim_time, dim_location = open_star(spark, root)
    if year is not None:
        facts = facts.where((F.col("year") == year) & calendar.key_in_years(F.col("time_id"), year, year))
    if buckets is not None:
        facts = series.hash_sample(facts, sample_keys, buckets, portable)
    weather = star.weather_full(facts.drop("year"), dim_time, dim_location)
    return series.ml_features(weather.withColumnRenamed("timestamp", "time"), keep=["time"])


def train_star(
    spark: SparkSession, root: str, path: str, year: int | None = None, buckets: int | None = None, **forest
) -> tuple[PipelineModel, DataFrame]:
    """Train on the earlier part, score the later part, save the model."""
    split = series.chrono_split(session.stored(training_rows(spark, root, year, buckets), "features"))
    fitted = model.train(split.where(~F.col("is_test")), **forest)
    model.save(fitted, path)
    return fitted, model.evaluate(model.predict(fitted, split.where("is_test")))


def run_daily(
    spark: SparkSession, raw_root: str, folder: str, root: str, model_path: str, max_lost: int | None = 0, **forest
) -> DataFrame:
    """Load one folder, then train. An error or a failed check in the load keeps training from running."""
    load_folders(spark, raw_root, [folder], root, max_lost=max_lost)
    return train_star(spark, root, model_path, **forest)[1]


def latest_window(spark: SparkSession, root: str, rows: int = fv.WINDOW_ROWS) -> DataFrame:
    """The newest ``rows`` feature rows of the star, ties by place.

    The newest hours come from the time dimension. Facts are counted from there backwards, by ever longer
    spans, until there are enough; only their folders and row groups are read.
    """
    facts, dim_time, dim_location = open_star(spark, root)
    newest = dim_time.agg(F.max("timestamp")).first()[0]
    span, low = 24, None
    while newest is not None:
        first = dim_time.where(F.col("timestamp") > F.lit(newest) - calendar.hours(F.lit(span)))
        low, earliest = first.agg(F.min("time_id")).first()[0], dim_time.agg(F.min("time_id")).first()[0]
        facts_since = facts.where((F.col("year") >= low // 1_000_000) & (F.col("time_id") >= low))
        if low == earliest or facts_since.join(dim_time.select("time_id"), "time_id", "left_semi").count() >= rows:
            facts = facts_since
            break
        span *= 8
    weather = star.weather_full(facts.drop("year"), dim_time, dim_location)
    features = series.ml_features(weather.withColumnRenamed("timestamp", "time"), keep=["time"])
    return series.latest_rows(features, rows)


def forecast(spark: SparkSession, root: str, model_path: str) -> dict[str, DataFrame]:
    """The saved model applied to the latest window: hours with their band, their summary, and the advice.

    The predictions are stored once, since all three read them.
    """
    frame = series.forecast_frame(latest_window(spark, root))
    return serve(session.stored(model.predict(model.load(model_path), frame), "forecast"))


def serve(predicted: DataFrame) -> dict[str, DataFrame]:
    """Band, summary and advice from a forecast frame with its ``prediction``."""
    summary = decide.forecast_summary(predicted)
    return {"hours": series.with_band(predicted), "summary": summary, "advice": decide.recommendations(summary)}
