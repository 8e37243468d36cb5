import datetime as dt

import pytest
from explained import plan_of
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.operators import checks, conform, star

T0 = dt.datetime(2024, 1, 1)
COLUMNS = {"instant": "t2m, d2m, msl, u10, v10, tcc", "accum": "tp", "avg": "avg_sdswrf", "max": "mx2t, mn2t"}
VALUES = {
    "instant": (283.15, 273.15, 101300.0, 3.0, 4.0, 0.5), "accum": (0.001,), "avg": (100.0,), "max": (284.15, 282.15),
}


def streams(spark, missing):
    """Four streams over 6 cells; ``missing`` names the cells a stream lacks."""
    made = {}
    for name, columns in COLUMNS.items():
        rows = [
            (T0 + dt.timedelta(hours=i), 40.0 + i, 70.0, *VALUES[name]) for i in range(6) if i not in missing.get(name, ())
        ]
        fields = ", ".join(f"{c} double" for c in columns.split(", "))
        made[name] = spark.createDataFrame(rows, f"time timestamp_ntz, latitude double, longitude double, {fields}")
    return made


def test_join_keeps_common_cells_and_coverage_counts_the_rest(spark):
    raw = streams(spark, {"accum": (1,), "max": (1, 2)})
    joined = conform.join_streams(raw)
    assert sorted(r["latitude"] for r in joined.collect()) == [40.0, 43.0, 44.0, 45.0]
    got = {r["stream"]: (r["cells"], r["lost"]) for r in conform.join_coverage(raw).collect()}
    assert got == {"instant": (6, 2), "accum": (5, 1), "avg": (6, 2), "max": (4, 0)}


def test_a_missing_stream_is_an_error(spark):
    raw = streams(spark, {})
    del raw["avg"]
    with pytest.raises(ValueError, match="avg"):
        conform.join_streams(raw)
    with pytest.raises(ValueError):
        schemas.stream_measures("hourly")


def test_joining_shuffles_each_stream_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(conform.join_streams(streams(spark, {})))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 4


def test_star_tables(spark):
    rows = conform.convert_units(conform.join_streams(streams(spark, {})))
    facts, times, places = star.fact(rows), star.time_dimension(rows), star.location_dimension(rows)
    # createDataFrame and literals differ in nullability only
    for df, schema in ((facts, schemas.FACT_WEATHER), (times, schemas.DIM_TIME), (places, schemas.DIM_LOCATION)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]
    row = facts.orderBy("time_id").first().asDict()
    assert row["time_id"] == 2024010100
    assert (row["temperature_c"], row["dewpoint_c"], row["max_temp_c"], row["min_temp_c"]) == (10.0, 0.0, 11.0, 9.0)
    assert (row["pressure_hpa"], row["wind_speed_ms"], row["precipitation_mm"]) == (1013.0, 5.0, 1.0)
    view = star.weather_full(facts, times, places)
    assert view.count() == facts.count() == 6
    assert "quarter" not in view.columns
    assert all(r["passed"] for r in checks.quality_checks(facts, times, places).collect())


def test_time_dimension_has_one_row_per_hour(spark):
    stamps = [T0, T0 + dt.timedelta(minutes=30), T0 + dt.timedelta(hours=1), T0]
    times = star.time_dimension(spark.createDataFrame([(t,) for t in stamps], "time timestamp_ntz"))
    assert sorted((r["time_id"], r["timestamp"]) for r in times.collect()) == [
        (2024010100, T0), (2024010101, T0 + dt.timedelta(hours=1)),
    ]


def test_dimension_is_broadcast_only_within_the_counted_bound(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
        dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        small = star.join_dimension(facts, dim, "k", broadcast_rows=50)
        large = star.join_dimension(facts, dim, "k", broadcast_rows=49)
        assert "BroadcastHashJoin" in plan_of(small)
        assert "SortMergeJoin" in plan_of(large) and "Broadcast" not in plan_of(large)
        assert sorted(small.collect()) == sorted(large.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_checks_find_each_fault(spark):
    facts = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (3, None), (9, 99)], "time_id long, location_id long")
    times = spark.createDataFrame([(1,), (2,), (3,), (3,)], "time_id long")
    places = spark.createDataFrame([(10,), (None,)], "location_id long")
    result = checks.quality_checks(facts, times, places)
    got = {r["check"]: r["bad_rows"] for r in result.collect()}
    assert got == {
        "fact_not_empty": 0, "fact_null_keys": 1, "fact_unique_keys": 1,
        "dim_time_not_empty": 0, "dim_time_null_keys": 0, "dim_time_unique_keys": 1,
        "dim_location_not_empty": 0, "dim_location_null_keys": 1, "dim_location_unique_keys": 0,
        "fact_time_known": 1, "fact_location_known": 2,
    }
    with pytest.raises(checks.GateError, match="fact_unique_keys: 1 rows"):
        checks.require(result)


def test_empty_facts_fail_the_gate(spark):
    facts = spark.createDataFrame([], "time_id long, location_id long")
    with pytest.raises(checks.GateError, match="fact_not_empty"):
        checks.require(checks.quality_checks(facts, facts.select("time_id"), facts.select("location_id")))
