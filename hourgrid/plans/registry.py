"""The registered queries: every operator run over the whole of the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import fixed_values as fv
from hourgrid import session
from hourgrid.functions import calendar, measures
from hourgrid.operators import analytics, checks, clean, conform, decide, load, model, profiles, series, star
from hourgrid.plans import daily
from hourgrid.sources import batch_sink, binding, buckets, streams, tables, versions
from hourgrid.streaming import complete, ingest

Query = Callable[[SparkSession, str], DataFrame]

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
EVENT_FACTS = T.StructType(
    [
        T.StructField("time_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _wide_types(df: DataFrame) -> DataFrame:
    """Integers as long, floats as double, dates as text: types that both engines print alike."""
    wide = {"int": "long", "float": "double", "date": "string"}
    return df.select([F.col(n).cast(wide[t]).alias(n) if t in wide else F.col(n) for n, t in df.dtypes])


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: measures.positive_zero(F.round(n, digits)) for n in names})


# --- scans --------------------------------------------------------------------------------


def scan_stream(spark, sf):
    return streams.scan_stream(spark, f"{sf}/events.parquet", EVENTS)


def backfill_scan(spark, sf):
    """Month folders written once, then read back by one scan over all of them."""
    root = session.scratch_path(spark, "backfill")
    at = list(series.ORDER)
    rows = binding.observations(spark, sf).select(*at, "temperature_c")
    month = calendar.period_label("month", F.year("time"), F.month("time"), F.to_date("time"))
    months = tables.spread(rows, at).withColumn("period", F.translate(month, "-", "_"))
    months.write.partitionBy("period").parquet(root)
    folders = [f for f in streams.list_folders(spark, root) if f.startswith("period=")]
    found = streams.scan_periods(spark, root, folders, "*.parquet", rows.schema)
    period = F.split("period", "=")[1]
    return found.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("temperature_c").alias("min_temp"),
        F.max("temperature_c").alias("max_temp"),
    )


def bbox_subset(spark, sf):
    obs = binding.observations(spark, sf)
    box = {"north": 43.0, "west": 70.0, "south": 39.0, "east": 80.0}
    return streams.subset(obs, ["temperature_c", "pressure_hpa"], hours=range(6, 18), area=box)


def lagged_day(spark, sf):
    events = binding.table(spark, sf, "events")
    return events.where(calendar.on_day(F.col("ts"), streams.lagged_day("2024-01-20"))).select(
        "event_id", "ts", "user_id", "value"
    )


def last_year(spark, sf):
    return analytics.last_year(star.time_dimension(binding.keys(spark, sf)))


# --- cleaning and conforming --------------------------------------------------------------


def grid_flatten(spark, sf):
    return clean.flatten_grid(binding.grids(spark, sf), ["latitude", "longitude"], ["value"], keep=["vec_id"])


def version_merge(spark, sf):
    return clean.merge_versions(binding.versions(spark, sf), fv.JOIN_KEYS, ["t2m", "tp"])


def clean_stream(spark, sf):
    raw = binding.raw_streams(spark, sf)["accum"].withColumnRenamed("time", "valid_time")
    raw = raw.withColumns({"number": F.lit(0), "expver": F.lit(1)})
    return clean.clean_stream(raw, ["tp"])


def stream_join4(spark, sf):
    return conform.join_streams(binding.raw_streams(spark, sf))


def _conformed(spark, sf):
    return conform.convert_units(conform.join_streams(binding.raw_streams(spark, sf)))


def conform_units(spark, sf):
    return _conformed(spark, sf).drop("location_id")


def bucketed_join4(spark, sf):
    """The streams kept in buckets, in two deliveries of the odd and the even days, and joined without a shuffle."""
    root = session.scratch_path(spark, "buckets")
    cells = session.stored(binding.cells(spark, sf), "cells")
    buckets.create(spark, root, spark.sparkContext.defaultParallelism)
    for part in (0, 1):
        buckets.add(spark, root, binding.streams_of(cells.where(F.dayofyear("time") % 2 == part)))
    return conform.join_buckets(buckets.read(spark, root))


def join_coverage(spark, sf):
    return conform.join_coverage(binding.raw_streams(spark, sf))


# --- star ---------------------------------------------------------------------------------


def _observed(spark, sf):
    """Observations with the star's keys."""
    return binding.observations(spark, sf).withColumns(
        {
            "time_id": calendar.time_key(F.col("time")),
            "location_id": measures.location_key(F.col("latitude"), F.col("longitude")),
        }
    )


_FACT_COLUMNS = (
    "time_id", "location_id", "temperature_c", "dewpoint_c", "pressure_hpa", "precipitation_mm",
    "wind_speed_ms", "cloud_cover", "solar_radiation",
)


def _star(spark, sf):
    """Facts and dimensions. The dimensions come from the distinct keys of the source, so that
    they do not wait for the aggregation that the facts need."""
    keys = binding.keys(spark, sf)
    return _observed(spark, sf).select(*_FACT_COLUMNS), star.time_dimension(keys), star.location_dimension(keys)


def fact_build(spark, sf):
    return star.fact(_conformed(spark, sf)).drop("location_id")


def dim_time(spark, sf):
    return star.time_dimension(binding.keys(spark, sf))


def dim_location(spark, sf):
    return star.location_dimension(binding.keys(spark, sf)).drop("location_id")


def fact_time_join(spark, sf):
    facts, times, _ = _star(spark, sf)
    times = session.stored(times, "dim_time")
    return star.with_time(facts, times).drop("location_id")


def weather_full(spark, sf):
    facts, times, places = _star(spark, sf)
    times, places = session.stored(times, "dim_time"), session.stored(places, "dim_location")
    return star.weather_full(facts, times, places).drop("location_id")


def quality_checks(spark, sf):
    """The checks on the star as it was loaded and stored."""
    facts, times, places = daily.open_star(spark, _loaded(spark, sf)["root"])
    return checks.quality_checks(facts, times, places)


#: Of the observations, what the star and the features are made of.
_KEPT = (*series.ORDER, "month", "hour", "day_of_week", *_FACT_COLUMNS, "max_temp_c", "min_temp_c")

_made: dict[tuple, dict] = {}


def _once(spark, sf, name: str, make: Callable[[], dict]) -> dict:
    """What ``make`` returns, made once for each application and state of the source's files: paths of stored tables."""
    key = (spark.sparkContext.applicationId, name, streams.file_state(spark, f"{sf}/lineitem.parquet"))
    if key not in _made:
        _made[key] = make()
    return _made[key]


def forget() -> None:
    """Later queries make their stored tables anew: for measurements."""
    _made.clear()


def _loaded(spark, sf) -> dict:
    """A stored star of all observations: its ``root``, the rows ``written`` to each table, and where the ``observed`` rows are."""

    def make() -> dict:
        root = session.scratch_path(spark, "star")
        load.create_star(spark, root)
        keyed = _observed(spark, sf).withColumns({"max_temp_c": F.col("temperature_c"), "min_temp_c": F.col("temperature_c")})
        observed = session.scratch_path(spark, "observed")
        keyed.select(*_KEPT).write.parquet(observed)
        keyed = spark.read.parquet(observed)
        return {
            "root": root,
            "observed": observed,
            "written": load.load_star(spark, root, star.fact(keyed), star.time_dimension(keyed), star.location_dimension(keyed)),
        }

    return _once(spark, sf, "star", make)


def _star_facts(spark, sf):
    """Facts and time dimension of the stored star."""
    facts, times, _ = daily.open_star(spark, _loaded(spark, sf)["root"])
    return facts, times


def _star_days(spark, sf):
    return analytics.day_profile(*_star_facts(spark, sf))


def star_kpi(spark, sf):
    return analytics.kpi(_star_days(spark, sf))


def star_trend(spark, sf):
    return analytics.yearly_trend(_star_days(spark, sf))


def star_histogram(spark, sf):
    return analytics.temp_histogram(_star_days(spark, sf))


def star_correlations(spark, sf):
    facts, times = _star_facts(spark, sf)
    return analytics.correlations(star.with_time(facts.drop("year"), times))


def star_drill_range(spark, sf):
    """Months of a range of years, which reach the scan as folders and as a range of hour keys."""
    facts, times = _star_facts(spark, sf)
    return analytics.drill_down(facts, "month", "avg", 1996, 1999, times)


def star_drill_known_hours(spark, sf):
    """Years of a star whose time dimension lacks the hours before six: their facts drop out."""
    facts, times = _star_facts(spark, sf)
    return analytics.drill_down(facts, "year", "max", None, None, times.where(F.col("hour") >= 6))


def star_features(spark, sf):
    """The training rows of a year, of one hour in twenty by a portable bucket."""
    root = _loaded(spark, sf)["root"]
    return daily.training_rows(spark, root, 1998, fv.SAMPLE_BUCKETS, ["time_id"], portable=True)


def star_latest(spark, sf):
    return daily.latest_window(spark, _loaded(spark, sf)["root"])


def late_day_reload(spark, sf):
    """Raw files of every second hour, loaded; then those of all hours: the rest of each day is added."""
    path = session.scratch_path(spark, "late")
    cells = session.stored(binding.cells(spark, sf), "cells")
    odd = F.hour("time") % 2 == 1
    for folder, rows in (("half", cells.where(odd)), ("whole", cells)):
        _write_raw(rows, f"{path}/raw/{folder}")
    load.create_star(spark, f"{path}/tables")
    for folder in ("half", "whole"):
        daily.load_folders(spark, f"{path}/raw", [folder], f"{path}/tables", max_lost=None)
    facts, times, places = daily.open_star(spark, f"{path}/tables")
    return star.weather_full(facts.drop("year"), times, places).drop("location_id")


def _corrected(spark, sf) -> dict:
    """A stored star of two loads that overlap by half a year: its ``root`` and the version ``before`` the second.

    The first brings preliminary temperatures for some hours, ten degrees too high; the second adds the later years and
    corrects what it holds of the first.
    """

    def make() -> dict:
        root = session.scratch_path(spark, "corrected")
        load.create_star(spark, root)
        keyed = _observed(spark, sf).withColumns({"max_temp_c": F.col("temperature_c"), "min_temp_c": F.col("temperature_c")})
        keyed = session.stored(keyed.select(*_KEPT), "observed")
        too_high = F.col("temperature_c") + F.when(F.hour("time") % 7 == 0, 10.0).otherwise(0.0)
        first = keyed.where(F.col("time_id") < 2000010100).withColumn("temperature_c", too_high)
        before = None
        for rows in (first, keyed.where(F.col("time_id") >= 1999070100)):
            load.load_star(spark, root, star.fact(rows), star.time_dimension(rows), star.location_dimension(rows))
            before = versions.newest(spark, root) if before is None else before
        return {"root": root, "before": before}

    return _once(spark, sf, "corrected", make)


_SHOWN = ("time_id", "timestamp", "latitude", "longitude", *_FACT_COLUMNS[2:])


def fact_correction(spark, sf):
    """The star after a load that corrects stored facts: the later value of each key."""
    facts, times, places = daily.open_star(spark, _corrected(spark, sf)["root"])
    return star.weather_full(facts.drop("year"), times, places).select(*_SHOWN)


def star_before_correction(spark, sf):
    """The version before that load, which stays readable."""
    made = _corrected(spark, sf)
    facts, times, places = daily.open_star(spark, made["root"], made["before"])
    return star.weather_full(facts.drop("year"), times, places).select(*_SHOWN)


def _profile(spark, sf, name: str):
    return load.read_table(spark, _corrected(spark, sf)["root"], name)


def profile_kpi(spark, sf):
    """Key indicators from the stored days of that star, without its facts; so for the others."""
    return analytics.kpi(profiles.days(_profile(spark, sf, "day_profile")))


def profile_trend(spark, sf):
    return analytics.yearly_trend(profiles.days(_profile(spark, sf, "day_profile")))


def profile_histogram(spark, sf):
    return analytics.temp_histogram(profiles.days(_profile(spark, sf, "day_profile")))


def profile_drill_day(spark, sf):
    return analytics.drill_days(profiles.days(_profile(spark, sf, "day_profile")), "day", "max")


def profile_drill_range(spark, sf):
    return analytics.drill_days(profiles.days(_profile(spark, sf, "day_profile"), 1997, 2000), "month", "avg")


def profile_correlations(spark, sf):
    return profiles.correlations(_profile(spark, sf, "day_moments"), 1996, 1999)


def place_extreme_days(spark, sf):
    """Distinct days with an extreme hour of each place and year, from bits by month."""
    found = profiles.extreme_days_by_place(_profile(spark, sf, "place_months"))
    places = load.read_table(spark, _corrected(spark, sf)["root"], "dim_location")
    return star.join_dimension(found, places, "location_id").drop("location_id")


def region_extreme_days(spark, sf):
    """The same for all places of a box together, a day counted once."""
    places = load.read_table(spark, _corrected(spark, sf)["root"], "dim_location")
    box = places.where(F.col("latitude").between(40.0, 42.0) & F.col("longitude").between(70.0, 76.0))
    return profiles.extreme_days_of(_profile(spark, sf, "place_months"), box)


def redelivered_days(spark, sf):
    """Days pending after all were delivered, and some again: with other values, with copies of rows, or as they were."""
    raw = {s: session.stored(df, s) for s, df in binding.raw_streams(spark, sf).items()}
    ledger = session.stored(conform.deliveries(raw), "ledger")
    rain = raw["accum"].withColumn("tp", F.when((F.dayofyear("time") % 50 == 7) & (F.col("latitude") == 40.0), F.col("tp") + 0.001).otherwise(F.col("tp")))
    warm = raw["max"].where((F.dayofyear("time") % 60 == 11) & (F.col("longitude") == 70.0))
    again = raw | {"accum": rain, "max": raw["max"].unionByName(warm).unionByName(warm)}
    return load.pending(conform.deliveries(again), ledger).select("day")


def _write_raw(cells: DataFrame, folder: str) -> None:
    """The four raw streams as files, as they arrive."""
    for name, df in binding.streams_of(cells).items():
        kept = [c if c in fv.JOIN_KEYS else F.col(c).cast("float").alias(c) for c in df.columns]
        arrived = df.select(*kept).withColumnRenamed("time", "valid_time")
        arrived.write.parquet(f"{folder}/{fv.STREAM_FILE.format(stream=name)}")


# --- loads --------------------------------------------------------------------------------


def write_clean(spark, sf):
    path = session.scratch_path(spark, "clean")
    events = binding.table(spark, sf, "events").select(F.col("ts").alias("time"), "event_id", "value")
    tables.write_by_date(events, path, order=["time", "event_id"])
    return spark.read.parquet(path).select("event_id", "time", "value", F.col("date").cast("string").alias("date"))


def dim_upsert(spark, sf):
    orders = binding.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    turn = F.lit("1998-07-01").cast("timestamp_ntz")
    before, since = orders.where(F.col("o_orderdate") < turn), orders.where(F.col("o_orderdate") >= turn)
    existing = load.latest_per_key(before, ["o_custkey"], "o_orderkey")
    return load.dim_upsert(existing, since, ["o_custkey"], order="o_orderkey")


def fact_append_antijoin(spark, sf):
    """Two loads that overlap by half a year; the second has other values, which must not win."""
    facts = _observed(spark, sf).select("time_id", "location_id", "temperature_c", "pressure_hpa")
    facts = session.stored(facts, "facts")
    first = facts.where(F.col("time_id") < 2000010100)
    second = facts.where(F.col("time_id") >= 1999070100).withColumn("temperature_c", F.col("temperature_c") + 100)
    return load.append_facts(first, second).drop("location_id")


def batched_sink(spark, sf):
    path = session.scratch_path(spark, "batches")
    obs = binding.observations(spark, sf)
    tables.write_batches(obs, path)
    stored = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("temperature_c").alias("t")
    )
    return stored.agg(
        F.sum("n").alias("rows"), F.sum("t").alias("sum_temp"),
        (F.max("n") <= fv.INSERT_BATCH).alias("within_batch"),
    )


def delivered_batches(spark, sf):
    """The same by a sink that delivers each batch once, with the rows that its tasks counted."""
    path = session.scratch_path(spark, "delivered")
    obs = binding.observations(spark, sf)
    batch_sink.deliver(obs, path)
    audit = batch_sink.delivered(spark, path).agg(F.sum("rows").alias("counted"), (F.max("rows") <= fv.INSERT_BATCH).alias("within_batch"))
    held = batch_sink.read(spark, path, obs.schema).agg(F.count(F.lit(1)).alias("rows"), F.sum("temperature_c").alias("sum_temp"))
    return held.select("rows", "sum_temp", audit.select("counted").scalar().alias("counted"), audit.select("within_batch").scalar().alias("within_batch"))


def load_audit(spark, sf):
    """Rows that the load of the star wrote, beside the rows that its tables hold."""
    loaded = _loaded(spark, sf)
    names = ("dim_location", "dim_time", "fact_weather")
    held = load.load_audit({n: load.read_table(spark, loaded["root"], n) for n in names})
    written = F.create_map(*[F.lit(x) for n in names for x in (n, loaded["written"][n])])
    return held.select("table", written[F.col("table")].cast("long").alias("written"), "rows")


def pending_days(spark, sf):
    ledger = binding.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return load.pending_days(binding.keys(spark, sf), ledger)


def star_load(spark, sf):
    """The whole way: raw files as they arrive, scanned, cleaned, joined, checked, loaded into an
    empty star, and read back through the view."""
    path = session.scratch_path(spark, "star")
    _write_raw(session.stored(binding.cells(spark, sf), "cells"), f"{path}/raw/all")
    load.create_star(spark, f"{path}/tables")
    # The streams lack some cells on purpose.
    daily.load_folders(spark, f"{path}/raw", ["all"], f"{path}/tables", max_lost=None)
    facts, times, places = daily.open_star(spark, f"{path}/tables")
    return star.weather_full(facts.drop("year"), times, places).drop("location_id")


def stream_ingest(spark, sf):
    """The event file or files as a stream, loaded twice; the second load must add nothing."""
    path = session.scratch_path(spark, "stream")
    source = f"{sf}/event[s].parquet"

    def facts(batch: DataFrame) -> DataFrame:
        return batch.select(calendar.time_key(F.col("ts")).alias("time_id"), "event_id", "user_id", "value")

    for run in ("first", "again"):
        stream = ingest.file_stream(spark, source, EVENTS)
        query = ingest.start_ingest(
            stream, facts, f"{path}/facts", EVENT_FACTS, ["time_id", "event_id"], "time_id", f"{path}/{run}"
        )
        query.awaitTermination()
    return spark.read.schema(EVENT_FACTS).parquet(f"{path}/facts")


def _agreed(spark, sf) -> dict:
    """A star fed by files of the streams that arrive out of step, in folders by year: its ``root`` and the ``log`` of days.

    The first start finds two streams of all folders and the others of one; the second finds the rest.
    """

    def make() -> dict:
        path = session.scratch_path(spark, "agreed")
        arriving = {s: session.stored(df, s) for s, df in binding.streams_of(session.stored(binding.cells(spark, sf), "cells")).items()}
        load.create_star(spark, f"{path}/tables")
        first = [(2, "max"), (0, "accum"), (2, "instant"), (1, "accum"), (0, "instant"), (2, "avg"), (1, "instant"), (2, "accum")]
        rest = [(1, "max"), (0, "avg"), (1, "avg"), (0, "max")]
        for files in (first, rest):
            for part, s in files:
                rows = arriving[s].where(F.year("time") % 3 == part)
                rows = rows.select([c if c in fv.JOIN_KEYS else F.col(c).cast("float").alias(c) for c in rows.columns])
                rows.withColumnRenamed("time", "valid_time").write.parquet(f"{path}/raw/part{part}/{fv.STREAM_FILE.format(stream=s)}")
            # years arrive in no order, so no day is ever too late here
            complete.start_agreed_ingest(spark, f"{path}/raw", f"{path}/tables", f"{path}/state", wait="36500 days").awaitTermination()
        return {"root": f"{path}/tables", "log": f"{path}/state"}

    return _once(spark, sf, "agreed", make)


def agreed_day_ingest(spark, sf):
    """The star of the days whose streams came to agree, as a load of those days alone would give it."""
    facts, times, places = daily.open_star(spark, _agreed(spark, sf)["root"])
    return star.weather_full(facts.drop("year"), times, places).drop("location_id")


def waiting_days(spark, sf):
    """The days that still wait, with the cells of each stream."""
    return complete.day_log(spark, _agreed(spark, sf)["log"]).where(~F.col("agrees")).drop("agrees")


# --- analytics ----------------------------------------------------------------------------


def _days(spark, sf):
    return analytics.day_profile(binding.observations(spark, sf))


def kpi(spark, sf):
    return analytics.kpi(_days(spark, sf))


def kpi_status(spark, sf):
    return decide.kpi_status(kpi(spark, sf))


def extreme_days(spark, sf):
    return analytics.extreme_days(_days(spark, sf))


def yearly_trend(spark, sf):
    return analytics.yearly_trend(_days(spark, sf))


def temp_histogram(spark, sf):
    return analytics.temp_histogram(_days(spark, sf))


def correlations(spark, sf):
    return analytics.correlations(binding.observations(spark, sf))


def correlation_ranking(spark, sf):
    return analytics.correlation_ranking(correlations(spark, sf))


def drill(spark, sf, grain, func):
    """For all the years of the data."""
    return analytics.drill_down(binding.observations(spark, sf), grain, func, None, None)


def calendar_parts(spark, sf):
    ts = F.col("ts")
    return binding.table(spark, sf, "events").select("event_id", *calendar.calendar_parts(ts))


def time_key(spark, sf):
    return binding.table(spark, sf, "events").select("event_id", calendar.time_key(F.col("ts")).alias("time_id"))


def drill_labels(spark, sf):
    orders = binding.table(spark, sf, "orders")
    ts = F.col("o_orderdate")
    parts = F.year(ts), F.month(ts), F.to_date(ts)
    return orders.select(
        "o_orderkey", *[calendar.period_label(g, *parts).alias(f"{g}_label") for g in analytics.GRAINS]
    )


def hash_sample(spark, sf):
    events = binding.table(spark, sf, "events")
    return series.hash_sample(events, ["event_id", "user_id"], portable=True).select("event_id", "user_id", "value")


# --- series, model, decisions -------------------------------------------------------------


def _features(spark, sf):
    return series.ml_features(binding.observations(spark, sf), keep=["time"])


def _stored_features(spark, sf):
    """For what reads the features several times: splitting, scoring, fitting."""
    return session.stored(_features(spark, sf), "features")


def ml_features(spark, sf):
    return series.in_time_order(_features(spark, sf))


def chrono_split(spark, sf):
    return series.chrono_split(_stored_features(spark, sf)).select(*series.ORDER, "is_test")


def latest_168_rows(spark, sf):
    return series.latest_rows(_features(spark, sf))


def latest_168h_per_location(spark, sf):
    return series.latest_hours_per_location(_features(spark, sf)).select(*series.ORDER, "temperature_c")


def _forecast(spark, sf):
    """Forecast frame with the persistence prediction: the window's own temperature."""
    frame = series.forecast_frame(series.latest_rows(_features(spark, sf)))
    return frame.withColumn("prediction", F.col(fv.TARGET))


def forecast_frame(spark, sf):
    return series.forecast_frame(series.latest_rows(_features(spark, sf)))


def forecast_per_location(spark, sf):
    latest = series.latest_hours_per_location(_features(spark, sf))
    return series.forecast_frame_per_location(latest).select(*series.ORDER, fv.TARGET, "forecast_time")


def forecast_band(spark, sf):
    banded = series.with_band(_forecast(spark, sf))
    return _rounded(banded, 6, "upper", "lower").select("step", "forecast_time", "prediction", "upper", "lower")


def forecast_summary(spark, sf):
    return _rounded(decide.forecast_summary(_forecast(spark, sf)), 6, "avg_temp", "avg_wind", "total_precip")


def recommendations(spark, sf):
    return decide.recommendations(decide.forecast_summary(_forecast(spark, sf)))


def _scored(spark, sf):
    """Test part with the climatology of the training part as prediction."""
    split = series.chrono_split(_stored_features(spark, sf))
    return model.climatology(split.where(~F.col("is_test")), split.where("is_test"))


def eval_metrics(spark, sf):
    return _rounded(model.evaluate(_scored(spark, sf)), 6, "mae", "r2")


def eval_extents(spark, sf):
    return model.extents(_scored(spark, sf))


def eval_slice(spark, sf):
    return series.first_slice(_scored(spark, sf)).select(*series.ORDER, fv.TARGET, "prediction")


def _fitted(spark, sf) -> dict:
    """Forest fitted on the whole earlier part and saved (``model``), its predictions for the whole later part (``path``), and
    the least and greatest temperature that it was fitted on."""

    def make() -> dict:
        split = series.chrono_split(_stored_features(spark, sf))
        earlier = split.where(~F.col("is_test"))
        low, high = earlier.agg(F.min(fv.TARGET), F.max(fv.TARGET)).first()
        forest, saved = model.train(earlier), session.scratch_path(spark, "forest-model")
        model.save(forest, saved)
        path = session.scratch_path(spark, "forest")
        model.predict(forest, split.where("is_test")).write.parquet(path)
        return {"path": path, "model": saved, "low": low, "high": high}

    return _once(spark, sf, "forest", make)


def _within(made: dict):
    return F.col("prediction").between(made["low"] - 1e-9, made["high"] + 1e-9)


def _forest(spark, sf) -> DataFrame:
    """Predictions of the forest, and whether each lies among the temperatures that it was fitted on."""
    made = _fitted(spark, sf)
    return spark.read.parquet(made["path"]).withColumn("within_range", _within(made))


def rf_scored(spark, sf):
    """Each row of the later part with its temperature and the forest's prediction."""
    return _forest(spark, sf).select(*series.ORDER, fv.TARGET, "prediction")


def rf_predictions(spark, sf):
    return _forest(spark, sf).select(*series.ORDER, fv.TARGET, "within_range")


def rf_quality(spark, sf):
    """The forest's predictions as a whole: all there, finite, and closer than the climatology's."""
    found = _forest(spark, sf)
    baseline = model.evaluate(_scored(spark, sf)).first()["r2"]
    r2 = model.evaluate(found).select("r2").scalar()
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return found.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(finite).alias("all_finite")).withColumn(
        "better_than_climatology", r2 > F.lit(baseline)
    )


def _served(spark, sf) -> dict:
    """The serving plan with the climatology of the earlier part as the model, on the stored star and the observations it was
    loaded from, which need not be made again."""
    loaded = _loaded(spark, sf)
    split = series.chrono_split(series.ml_features(spark.read.parquet(loaded["observed"]), keep=["time"]))
    frame = series.forecast_frame(daily.latest_window(spark, loaded["root"]))
    return daily.serve(model.climatology(split.where(~F.col("is_test")), frame))


def serve_hours(spark, sf):
    banded = _served(spark, sf)["hours"]
    return _rounded(banded, 6, "prediction", "upper", "lower").select("step", "forecast_time", "prediction", "upper", "lower")


def serve_summary(spark, sf):
    return _rounded(_served(spark, sf)["summary"], 6, "avg_temp", "min_temp", "max_temp", "avg_wind", "total_precip")


def serve_advice(spark, sf):
    return _served(spark, sf)["advice"]


def _forest_served(spark, sf) -> dict:
    """The saved forest, read back and applied to the latest window of the stored star."""
    return daily.forecast(spark, _loaded(spark, sf)["root"], _fitted(spark, sf)["model"])


def rf_serve_hours(spark, sf):
    """Forecast by the saved forest, with its band."""
    banded = _forest_served(spark, sf)["hours"]
    return _rounded(banded, 6, "prediction", "upper", "lower").select("step", "forecast_time", "prediction", "upper", "lower")


def rf_serve_quality(spark, sf):
    """The hours of that forecast, whether each prediction lies among the fitted temperatures, and how wide its band is."""
    banded = _forest_served(spark, sf)["hours"].withColumn("width", F.col("upper") - F.col("lower"))
    banded = banded.withColumn("within_range", F.coalesce(_within(_fitted(spark, sf)), F.lit(False)))
    return _rounded(banded, 6, "width").select("step", "forecast_time", "within_range", "width")


def rf_serve_summary(spark, sf):
    return _rounded(_forest_served(spark, sf)["summary"], 6, "avg_temp", "min_temp", "max_temp", "avg_wind", "total_precip")


def rf_serve_advice(spark, sf):
    return _forest_served(spark, sf)["advice"]


_PLAIN = (
    scan_stream, backfill_scan, bbox_subset, lagged_day, last_year,
    write_clean, dim_upsert, fact_append_antijoin, batched_sink, delivered_batches, load_audit, pending_days,
    grid_flatten, version_merge, clean_stream, conform_units,
    fact_build, ml_features, hash_sample,
    stream_join4, bucketed_join4, fact_time_join, weather_full, join_coverage, dim_time, dim_location,
    kpi, extreme_days, yearly_trend, temp_histogram, correlations, correlation_ranking,
    forecast_summary, eval_metrics, eval_extents, chrono_split, latest_168_rows,
    latest_168h_per_location, eval_slice, calendar_parts, drill_labels, time_key,
    star_load, stream_ingest, agreed_day_ingest, waiting_days, rf_predictions, rf_quality, forecast_frame, forecast_per_location, forecast_band, recommendations, kpi_status,
    quality_checks, late_day_reload,
    star_kpi, star_trend, star_histogram, star_correlations, star_drill_range, star_drill_known_hours,
    star_features, star_latest, serve_hours, serve_summary, serve_advice,
    rf_scored, rf_serve_hours, rf_serve_quality, rf_serve_summary, rf_serve_advice,
    fact_correction, star_before_correction, profile_kpi, profile_trend, profile_histogram, profile_drill_day,
    profile_drill_range, profile_correlations, place_extreme_days, region_extreme_days, redelivered_days,
)


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {q.__name__: q for q in _PLAIN}
    for grain in analytics.GRAINS:
        for func in analytics.FUNCTIONS:
            named[f"drill_{grain}_{func}"] = partial(drill, grain=grain, func=func)
    return {name: _comparable(query) for name, query in named.items()}


def _comparable(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _wide_types(query(spark, sf_dir))

    return run
