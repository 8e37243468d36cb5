import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import clean

T0 = dt.datetime(2024, 1, 1)


def test_flatten_three_axes_against_numpy(spark):
    rng = np.random.default_rng(1)
    temp, rain = rng.random((3, 2, 4)), rng.random((3, 2, 4))
    times = [T0 + dt.timedelta(hours=h) for h in range(3)]
    lats, lons = [44.5, 44.25], [68.0, 68.25, 68.5, 68.75]
    grid = spark.createDataFrame(
        [("a", times, lats, lons, temp.ravel().tolist(), rain.ravel().tolist())],
        "name string, time array<timestamp_ntz>, latitude array<double>, longitude array<double>, "
        "t2m array<double>, tp array<double>",
    )
    got = clean.flatten_grid(grid, ["time", "latitude", "longitude"], ["t2m", "tp"], keep=["name"]).collect()
    want = {
        ("a", t, y, x): (temp[i, j, k], rain[i, j, k])
        for i, t in enumerate(times) for j, y in enumerate(lats) for k, x in enumerate(lons)
    }
    assert {(r["name"], r["time"], r["latitude"], r["longitude"]): (r["t2m"], r["tp"]) for r in got} == want


def versions(spark, rows):
    schema = "time timestamp_ntz, latitude double, longitude double, expver int, t2m double, tp double"
    return spark.createDataFrame([(T0, float(place), 68.0, *rest) for place, *rest in rows], schema)


def test_versions_are_merged_per_variable(spark):
    nan = float("nan")
    df = versions(
        spark,
        [
            (1, 5, 10.0, None), (1, 1, 11.0, 0.1),  # one variable missing in the preferred version
            (2, 5, 20.0, 0.2),  # only the preferred version
            (3, 1, 30.0, 0.3),  # only the other one
            (4, 5, nan, 0.4), (4, 1, 40.0, 0.9),  # a gap written as NaN
            (5, 9, 50.0, 0.5),  # neither version
        ],
    )
    got = clean.merge_versions(df, ["time", "latitude", "longitude"], ["t2m", "tp"])
    assert {r["latitude"]: (r["t2m"], r["tp"]) for r in got.collect()} == {
        1.0: (10.0, 0.1), 2.0: (20.0, 0.2), 3.0: (30.0, 0.3), 4.0: (40.0, 0.4),
    }


def test_merging_versions_of_a_hot_cell_combines_before_the_shuffle(spark):
    df = versions(spark, [(1, 5, 1.0, 1.0)] * 3000 + [(p, 1, 2.0, 2.0) for p in range(2, 100)])
    plan = clean.merge_versions(df, ["time", "latitude", "longitude"], ["t2m"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("time_columns", [("time",), ("valid_time",), ("time", "valid_time")])
@pytest.mark.parametrize("auxiliary", [(), ("number",), ("expver", "number")])
def test_clean_stream_gives_canonical_columns(spark, time_columns, auxiliary):
    df = versions(spark, [(1, 1, 10.0, 0.1)]).drop("expver")
    for name in auxiliary:
        df = df.withColumn(name, F.lit(0))
    if time_columns == ("valid_time",):
        df = df.withColumnRenamed("time", "valid_time")
    elif len(time_columns) == 2:
        df = df.withColumn("valid_time", F.col("time")).withColumn("time", F.lit(None).cast("timestamp_ntz"))
    got = clean.clean_stream(df, ["t2m", "tp"])
    assert got.dtypes == [
        ("time", "timestamp_ntz"), ("latitude", "double"), ("longitude", "double"), ("t2m", "double"), ("tp", "double"),
    ]
    assert tuple(got.first()) == (T0, 1.0, 68.0, 10.0, 0.1)


def test_clean_stream_with_versions(spark):
    got = clean.clean_stream(versions(spark, [(1, 5, None, 0.1), (1, 1, 7.0, 0.2)]), ["t2m", "tp"], versions=True)
    assert [tuple(r)[3:] for r in got.collect()] == [(7.0, 0.1)]


def test_a_cell_without_a_version_is_kept_and_gives_way(spark):
    df = versions(spark, [(1, None, 1.0, 0.1), (2, None, 2.0, 0.2), (2, 1, 3.0, None), (3, None, 4.0, None), (3, 1, None, 0.3), (3, 5, 5.0, None)])
    got = clean.merge_versions(df, ["time", "latitude", "longitude"], ["t2m", "tp"])
    assert {r["latitude"]: (r["t2m"], r["tp"]) for r in got.collect()} == {1.0: (1.0, 0.1), 2.0: (3.0, 0.2), 3.0: (5.0, 0.3)}


def test_a_grid_that_does_not_fit_its_axes_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0], [0.1, 0.2, 0.3]), ([1.0], [3.0], [0.1])], "y array<double>, x array<double>, v array<double>")
    with pytest.raises(Exception, match="3 values for a grid of 2 cells"):
        clean.flatten_grid(df, ["y", "x"], ["v"]).collect()
