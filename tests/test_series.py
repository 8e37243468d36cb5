import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid.operators import series

T0 = dt.datetime(2024, 1, 1)


def points(spark, rows):
    schema = "time timestamp_ntz, latitude double, longitude double, temperature_c double"
    return spark.createDataFrame([(T0 + dt.timedelta(hours=h), y, x, 1.0 * i) for i, (h, y, x) in enumerate(rows)], schema)


def grid(hours, hot=0):
    rows = [(h, 40.0 + y, 70.0 + x) for h in range(hours) for y in range(3) for x in range(3)]
    rows += [(hours // 2, 50.0 + i // 40, 80.0 + i % 40) for i in range(hot)]
    random.Random(5).shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "rows", [grid(20), grid(13, hot=200), grid(1), grid(1)[:1], grid(1)[:2], grid(1)[:5], grid(4)[:11]]
)
@pytest.mark.parametrize("share", [0.2, 0.5])
def test_split_takes_the_last_rows_exactly(spark, rows, share):
    got = series.chrono_split(points(spark, rows), share).collect()
    ordered = sorted(rows)
    n_test = math.ceil(share * len(rows))
    test = {(r["time"], r["latitude"], r["longitude"]) for r in got if r["is_test"]}
    assert len(got) == len(rows)
    assert test == {(T0 + dt.timedelta(hours=h), y, x) for h, y, x in ordered[len(rows) - n_test :]}


def test_split_keeps_copies_of_a_key_together_and_all_rows(spark):
    rows = [(h, 40.0, 70.0) for h in range(10)] + [(7, 40.0, 70.0)] * 5
    got = series.chrono_split(points(spark, rows)).collect()
    assert len(got) == 15
    sides = {}
    for r in got:
        sides.setdefault(r["time"], set()).add(r["is_test"])
    assert all(len(s) == 1 for s in sides.values())
    assert [t.hour for t, s in sorted(sides.items()) if s == {True}] == [8, 9]


def test_preview(spark):
    assert [r["time"].hour for r in series.preview(points(spark, [(h, 40.0, 70.0) for h in (9, 2, 5)]), 2).collect()] == [2, 5]


def test_split_of_nothing(spark):
    assert series.chrono_split(points(spark, [])).collect() == []
    with pytest.raises(ValueError):
        series.chrono_split(points(spark, []), 1.5)


def test_latest_rows_and_forecast_frame(spark):
    rows = grid(30)
    latest = series.latest_rows(points(spark, rows), 20)
    want = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))[:20]
    assert {(r["time"], r["latitude"], r["longitude"]) for r in latest.collect()} == {
        (T0 + dt.timedelta(hours=h), y, x) for h, y, x in want
    }
    frame = series.forecast_frame(latest).orderBy("step").collect()
    newest = T0 + dt.timedelta(hours=29)
    assert [r["step"] for r in frame] == list(range(1, 21))
    assert [r["forecast_time"] for r in frame] == [newest + dt.timedelta(hours=s) for s in range(1, 21)]
    assert [(r["time"], r["latitude"], r["longitude"]) for r in frame] == [
        (T0 + dt.timedelta(hours=h), y, x) for h, y, x in sorted(want)
    ]


def test_fewer_rows_than_the_window(spark):
    frame = series.forecast_frame(series.latest_rows(points(spark, grid(2))))
    assert frame.count() == 18 and frame.agg(F.max("step")).first()[0] == 18
    assert series.forecast_frame(series.latest_rows(points(spark, []))).count() == 0


def test_latest_hours_of_each_place(spark):
    rows = [(h, 40.0, 70.0) for h in range(400)] + [(h, 41.0, 70.0) for h in range(0, 50, 7)]
    got = series.latest_hours_per_location(points(spark, rows), 10)
    times = {}
    for r in got.collect():
        times.setdefault(r["latitude"], set()).add(r["time"])
    assert times[40.0] == {T0 + dt.timedelta(hours=h) for h in range(390, 400)}
    assert times[41.0] == {T0 + dt.timedelta(hours=h) for h in range(0, 50, 7)}
    shifted = series.forecast_frame_per_location(got, 10).where("latitude = 40")
    assert {r["forecast_time"] for r in shifted.collect()} == {T0 + dt.timedelta(hours=h) for h in range(400, 410)}


def test_band_grows_by_step(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (168, 10.0)], "step int, prediction double")
    got = {r["step"]: (r["lower"], r["upper"]) for r in series.with_band(df).collect()}
    assert got[1] == (8.5, 11.5)
    assert got[2] == pytest.approx((8.45, 11.55))
    assert got[168] == pytest.approx((10 - 9.85, 10 + 9.85))


def test_features_keep_their_order_and_no_leak(spark):
    names = [*reversed(fv.FEATURES), "max_temp_c", "min_temp_c", fv.TARGET]
    df = spark.createDataFrame([tuple(range(len(names)))], ", ".join(f"{n} int" for n in names))
    assert series.ml_features(df).columns == [fv.TARGET, *fv.FEATURES]


def test_sample_is_a_function_of_the_key(spark):
    df = spark.range(4000).withColumn("half", F.col("id") % 2)
    whole = {r["id"] for r in series.hash_sample(df, ["id"]).collect()}
    part = {r["id"] for r in series.hash_sample(df.where("half = 0").repartition(7), ["id"]).collect()}
    assert part == {i for i in whole if i % 2 == 0}
    assert 120 < len(whole) < 280


def test_split_of_microsecond_times(spark):
    rng = random.Random(7)
    times = [dt.datetime(2020 + i % 3, 5, 1 + i % 2, 3, i % 2, 0, rng.randrange(10**6)) for i in range(400)]
    df = spark.createDataFrame([(t, 1.0, 2.0) for t in times], "time timestamp_ntz, latitude double, longitude double")
    got = {r["time"]: r["is_test"] for r in series.chrono_split(df).collect()}
    want = sorted(times)
    assert [got[t] for t in want] == [i >= 400 - 80 for i in range(400)]


def test_more_latest_hours_than_spark_limits_by_itself(spark, monkeypatch):
    df = points(spark, grid(50))
    want = sorted(map(tuple, series.latest_hours_per_location(df, 30).collect()))
    monkeypatch.setattr(series, "GROUP_LIMIT", 5)
    assert sorted(map(tuple, series.latest_hours_per_location(df, 30).collect())) == want and len(want) == 270


def test_split_of_a_hot_hour_and_of_rows_without_time(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1, 5), 40.0 + i % 9, 70.0 + i // 9) for i in range(300)]  # one hour holds most rows
    rows += [(dt.datetime(2024, 1, 1 + i % 3, i % 24), 40.0, 60.0 - i) for i in range(90)] + [(None, 40.0, 70.0 + i) for i in range(30)]
    spark.createDataFrame(rows, "time timestamp_ntz, latitude double, longitude double").write.parquet(f"{tmp_path}/t")
    for share in (0.01, 0.2, 0.5, 0.95, 0.99):
        split = series.chrono_split(spark.read.parquet(f"{tmp_path}/t"), share)
        got = {tuple(r)[:3]: r["is_test"] for r in split.collect()}
        ordered = sorted(rows, key=lambda r: (r[0] is not None, r))
        n = len(rows) - math.ceil(share * len(rows))
        assert [got[r] for r in ordered] == [False] * n + [True] * (len(rows) - n)


@pytest.mark.parametrize("hours,places", [(24, 3), (14, 2)])
def test_split_of_few_rows_whose_cut_ends_an_hour(spark, hours, places):
    """The bracket of the sketch is narrower than a row here, and began behind the cut: all rows became test rows."""
    rows = [(h, 38.0 + p, 68.0 + p) for h in range(hours) for p in range(places)]
    got = series.chrono_split(points(spark, rows)).orderBy(*series.ORDER).collect()
    n_test = math.ceil(0.2 * len(rows))
    assert [r["is_test"] for r in got] == [i >= len(rows) - n_test for i in range(len(rows))]
