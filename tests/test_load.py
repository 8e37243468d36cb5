import datetime as dt
import os

import pytest
from explained import plan_of
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid import schemas, session
from hourgrid.operators import analytics, checks, load, series, star
from hourgrid.plans import daily
from hourgrid.sources import streams, tables, versions

VALUES = {
    "instant": (283.15, 273.15, 101300.0, 3.0, 4.0, 0.5), "accum": (0.001,), "avg": (100.0,), "max": (284.15, 282.15),
}


def write_day(spark, folder, day, hours=24, places=3, skip=(), time_name="time", first=0, version=1):
    """One day's folder of four raw files; ``skip`` names streams that are left out."""
    for name in fv.STREAMS:
        if name in skip:
            continue
        rows = [
            (dt.datetime.combine(day, dt.time(h)), 38.0 + 0.25 * p, 68.0 + 0.25 * p, version, 0, *[v + (i == 0) * h / 4 for i, v in enumerate(VALUES[name])])
            for h in range(first, hours) for p in range(places)
        ]
        measures = ", ".join(f"{m} float" for m in schemas.stream_measures(name))
        schema = f"{time_name} timestamp_ntz, latitude double, longitude double, expver int, number int, {measures}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{fv.STREAM_FILE.format(stream=name)}")


def counts(spark, root):
    return {t: load.read_table(spark, root, t).count() for t in load.TABLES}


@pytest.fixture
def star_root(spark, tmp_path):
    root = str(tmp_path / "star")
    load.create_star(spark, root)
    return root


def test_created_tables_are_empty_and_typed(spark, star_root):
    assert set(counts(spark, star_root).values()) == {0}
    assert load.read_table(spark, star_root, "dim_time").schema == schemas.DIM_TIME


def test_loading_twice_changes_nothing_and_recreating_empties(spark, star_root, tmp_path):
    day = dt.date(2024, 2, 29)
    write_day(spark, f"{tmp_path}/d", day)
    assert daily.load_folders(spark, str(tmp_path), ["d"], star_root) == {
        "dim_location": 3, "dim_time": 24, "fact_weather": 72, "fact_corrected": 0,
    }
    before = counts(spark, star_root)
    assert before == {"dim_time": 24, "dim_location": 3, "fact_weather": 72, "ledger": 1}
    assert set(daily.load_folders(spark, str(tmp_path), ["d"], star_root).values()) == {0}
    assert counts(spark, star_root) == before
    # Without the ledger the key comparison alone keeps the load from repeating rows.
    commit = versions.Commit(spark, star_root)
    commit.remove("ledger", commit.paths("ledger"))
    commit.finish()
    assert set(daily.load_folders(spark, str(tmp_path), ["d"], star_root).values()) == {0}
    assert counts(spark, star_root) == before
    load.create_star(spark, star_root)
    assert set(counts(spark, star_root).values()) == {0}


def test_days_of_two_years_and_both_time_names(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/a", dt.date(2023, 12, 31))
    write_day(spark, f"{tmp_path}/b", dt.date(2024, 1, 1), time_name="valid_time")
    daily.load_folders(spark, str(tmp_path), ["a"], star_root)
    daily.load_folders(spark, str(tmp_path), ["b"], star_root)
    facts, times, places = daily.open_star(spark, star_root)
    assert (facts.count(), times.count(), places.count()) == (144, 48, 3)
    assert spark.table("weather_full").count() == 144
    assert all(r["passed"] for r in checks.quality_checks(facts, times, places).collect())
    last = times.where("time_id = 2023123123").first()
    assert (last["day_of_week"], last["quarter"], last["hour"]) == (7, 4, 23)


def test_backfill_loads_many_folders_at_once(spark, star_root, tmp_path):
    for d in (1, 2, 3):
        write_day(spark, f"{tmp_path}/2024_0{d}", dt.date(2024, d, 1), hours=2, skip=("avg",) if d == 2 else ())
    with pytest.raises(checks.GateError, match="join_coverage on 2024-02-01: 6 rows"):
        daily.load_folders(spark, str(tmp_path), streams.month_periods([2024]), star_root)
    assert counts(spark, star_root) == {"dim_location": 3, "dim_time": 4, "fact_weather": 12, "ledger": 2}
    done = [r["day"] for r in load.read_table(spark, star_root, "ledger").collect()]
    assert sorted(done) == [dt.date(2024, 1, 1), dt.date(2024, 3, 1)]  # the month without a stream stays open


def test_a_day_with_a_missing_stream_is_not_marked_done(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/d", dt.date(2024, 1, 1), skip=("max",))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.load_folders(spark, str(tmp_path), ["d"], star_root)
    assert set(counts(spark, star_root).values()) == {0}


def test_lost_cells_and_empty_joins_stop_the_load(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/d", dt.date(2024, 1, 1), hours=4, skip=("avg",))
    write_day(spark, f"{tmp_path}/d", dt.date(2024, 1, 1), hours=3, skip=("instant", "accum", "max"))
    with pytest.raises(checks.GateError, match="join_coverage on 2024-01-01: 3 rows"):
        daily.load_folders(spark, str(tmp_path), ["d"], star_root)
    write_day(spark, f"{tmp_path}/e", dt.date(2024, 1, 1), hours=0)
    with pytest.raises(checks.GateError, match="fact_not_empty"):
        daily.load_folders(spark, str(tmp_path), ["e"], star_root)
    assert set(counts(spark, star_root).values()) == {0}
    assert daily.load_folders(spark, str(tmp_path), ["d"], star_root, max_lost=3)["fact_weather"] == 9


def test_the_late_half_of_a_day_is_added(spark, star_root, tmp_path):
    day = dt.date(2024, 1, 1)
    write_day(spark, f"{tmp_path}/early", day, hours=12)
    write_day(spark, f"{tmp_path}/late", day, hours=24, first=12)
    for folder, rows in (("early", 36), ("late", 36), ("early", 0), ("late", 0)):
        assert daily.load_folders(spark, str(tmp_path), [folder], star_root)["fact_weather"] == rows
    write_day(spark, f"{tmp_path}/all", day)
    assert daily.load_folders(spark, str(tmp_path), ["all"], star_root)["fact_weather"] == 0
    assert counts(spark, star_root) == {"dim_location": 3, "dim_time": 24, "fact_weather": 72, "ledger": 3}


def test_a_day_with_a_partial_stream_stays_pending(spark, star_root, tmp_path):
    day = dt.date(2024, 1, 2)
    write_day(spark, f"{tmp_path}/good", dt.date(2024, 1, 1))
    write_day(spark, f"{tmp_path}/bad", day, skip=("avg",))
    write_day(spark, f"{tmp_path}/bad", day, hours=3, skip=("instant", "accum", "max"))
    with pytest.raises(checks.GateError, match="join_coverage on 2024-01-02: 63 rows"):
        daily.load_folders(spark, str(tmp_path), ["good", "bad"], star_root)
    assert [r["day"] for r in load.read_table(spark, star_root, "ledger").collect()] == [dt.date(2024, 1, 1)]
    assert counts(spark, star_root)["fact_weather"] == 72
    with pytest.raises(checks.GateError, match="join_coverage"):
        daily.run_daily(spark, str(tmp_path), "bad", star_root, f"{tmp_path}/model")
    assert not os.path.exists(f"{tmp_path}/model")
    write_day(spark, f"{tmp_path}/mended", day)
    assert daily.load_folders(spark, str(tmp_path), ["mended"], star_root)["fact_weather"] == 72


def test_keys_that_come_twice_keep_their_day_pending(spark, star_root, tmp_path):
    for folder in ("a", "b"):
        write_day(spark, f"{tmp_path}/{folder}", dt.date(2024, 1, 1), hours=2)
    with pytest.raises(checks.GateError, match="fact_unique_keys on 2024-01-01"):
        daily.load_folders(spark, str(tmp_path), ["a", "b"], star_root, max_lost=None)
    assert set(counts(spark, star_root).values()) == {0}


def test_files_with_and_without_versions_are_loaded_together(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/a", dt.date(2024, 1, 1), hours=2)
    write_day(spark, f"{tmp_path}/b", dt.date(2024, 1, 2), hours=3, version=None)
    write_day(spark, f"{tmp_path}/c", dt.date(2024, 1, 3), hours=4, version=5)
    written = daily.load_folders(spark, str(tmp_path), ["a", "b", "c"], star_root, versions=True)
    assert written["fact_weather"] == 3 * (2 + 3 + 4)


def test_a_load_leaves_nothing_behind_and_reads_the_staged_rows_seldom(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/d", dt.date(2024, 1, 1), hours=2)
    below = f"{session.shared_folder(spark).removeprefix('file:')}/hourgrid/{spark.sparkContext.applicationId}"
    before = set(os.listdir(below)) if os.path.isdir(below) else set()
    daily.load_folders(spark, str(tmp_path), ["d"], star_root)
    assert set(os.listdir(below)) == before


def test_the_shared_folder_has_to_be_shared():
    class Session:
        def __init__(self, folder, master, given=None):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = type("C", (), {"master": master, "getCheckpointDir": lambda _: given})()

    assert session.shared_folder(Session("hdfs://n/x/", "yarn")) == "hdfs://n/x"
    assert session.shared_folder(Session(None, "yarn", "hdfs://n/y")) == "hdfs://n/y"
    assert session.shared_folder(Session("file:/tmp/x", "local[2]")) == "file:/tmp/x"
    for folder, master in ((None, "yarn"), (None, "local[8]"), ("file:/tmp/x", "yarn")):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_folder(Session(folder, master))


def test_the_latest_window_prunes_and_widens(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/a", dt.date(2022, 5, 1), places=9)
    write_day(spark, f"{tmp_path}/b", dt.date(2023, 12, 31), places=9)
    write_day(spark, f"{tmp_path}/c", dt.date(2024, 1, 1), hours=2, places=9)  # the newest day has 18 rows only
    for folder in ("a", "b", "c"):
        daily.load_folders(spark, str(tmp_path), [folder], star_root)
    got = daily.latest_window(spark, star_root)
    plan = plan_of(got)
    assert "GreaterThanOrEqual(time_id," in plan and "(year" in plan.split("PartitionFilters: [")[1]
    whole = daily.training_rows(spark, star_root)
    want = series.latest_rows(whole)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 168
    few = daily.latest_window(spark, star_root, rows=10)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, series.latest_rows(whole, 10).collect()))
    assert daily.latest_window(spark, star_root, rows=10_000).count() == whole.count()


def test_the_latest_window_of_nothing(spark, star_root):
    assert daily.latest_window(spark, star_root).count() == 0


def test_a_saved_model_serves_the_latest_window(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/d", dt.date(2024, 1, 1), places=9)
    daily.run_daily(spark, str(tmp_path), "d", star_root, f"{tmp_path}/model", trees=2, depth=3)
    served = daily.forecast(spark, star_root, f"{tmp_path}/model")
    hours = served["hours"].collect()
    assert len(hours) == 168 and all(r["lower"] < r["prediction"] < r["upper"] for r in hours)
    assert max(r["forecast_time"] for r in hours) == dt.datetime(2024, 1, 1, 23) + dt.timedelta(hours=168)
    summary = served["summary"].first()
    assert summary["min_temp"] == min(r["prediction"] for r in hours)
    assert len(served["advice"].collect()) == 3


def test_daily_run_trains_only_after_a_good_load(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/d", dt.date(2024, 1, 1))
    got = daily.run_daily(spark, str(tmp_path), "d", star_root, f"{tmp_path}/model", trees=2, depth=3).first()
    assert got["rows"] == 15 and os.path.isdir(f"{tmp_path}/model")  # ceil(0.2 * 72)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run_daily(spark, str(tmp_path), "absent", star_root, f"{tmp_path}/never")
    assert not os.path.exists(f"{tmp_path}/never")


def test_training_rows_by_year_and_sample(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/a", dt.date(2023, 12, 31))
    write_day(spark, f"{tmp_path}/b", dt.date(2024, 1, 1), places=30)
    daily.load_folders(spark, str(tmp_path), ["a"], star_root)
    daily.load_folders(spark, str(tmp_path), ["b"], star_root)
    assert daily.training_rows(spark, star_root).count() == 72 + 720
    assert daily.training_rows(spark, star_root, year=2023).count() == 72
    sampled = daily.training_rows(spark, star_root, year=2024, buckets=20)
    assert sampled.columns == ["time", fv.TARGET, *fv.FEATURES]
    assert 10 < sampled.count() < 80


def test_upsert_latest_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 3), (2, "z", 2), (3, "n", 1)], "k long, v string, seq int")
    got = load.dim_upsert(old, new, ["k"], order="seq")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "y"), (3, "n")]
    again = load.dim_upsert(got, new, ["k"], order="seq")
    assert sorted(again.collect()) == sorted(got.collect())


def test_append_keeps_stored_facts(spark):
    old = spark.createDataFrame([(1, 1, 5.0)], "time_id long, location_id long, t double")
    new = spark.createDataFrame([(1, 1, 6.0), (1, 2, 7.0)], "time_id long, location_id long, t double")
    got = load.append_facts(old, new)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 5.0), (1, 2, 7.0)]


def test_files_hold_at_most_a_batch(spark, tmp_path):
    assert tables.write_batches(spark.range(1050, numPartitions=2), f"{tmp_path}/t", batch=100) == 1050
    sizes = spark.read.parquet(f"{tmp_path}/t").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == 1050 and max(r["count"] for r in sizes) <= 100


def test_rewriting_a_date_leaves_the_others(spark, tmp_path):
    def day(d, value):
        rows = [(dt.datetime(2024, 1, d, h), 40.0, 70.0, value) for h in range(5)]
        return spark.createDataFrame(rows, "time timestamp_ntz, latitude double, longitude double, v int")

    path = f"{tmp_path}/t"
    tables.write_by_date(day(1, 1).unionByName(day(2, 1)), path)
    assert tables.write_by_date(day(2, 9), path) == 5
    got = {tuple(r) for r in spark.read.parquet(path).groupBy("date", "v").count().select(F.col("date").cast("string"), "v", "count").collect()}
    assert got == {("2024-01-01", 1, 5), ("2024-01-02", 9, 5)}


def test_periods_are_read_in_one_scan_and_absent_ones_passed_over(spark, tmp_path):
    schema = "time timestamp_ntz, tp float"
    for period, n in (("2022_01", 3), ("2022_03", 4)):
        rows = [(dt.datetime(2022, 1, 1, h), 1.0) for h in range(n)]
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/raw/{period}/accum.parquet")
    declared = schemas.raw_stream("accum")
    got = streams.scan_periods(spark, f"{tmp_path}/raw", streams.month_periods([2022]), "accum.parquet", declared)
    assert {tuple(r) for r in got.groupBy("period").count().collect()} == {("2022_01", 3), ("2022_03", 4)}
    assert "number" in got.columns and got.where("number is not null").count() == 0


def test_subset_and_lagged_day(spark):
    rows = [(dt.datetime(2024, 1, d, h), lat, 70.0, 1.0) for d in (14, 15, 16) for h in (0, 12, 23) for lat in (37.0, 38.0, 44.5, 45.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, latitude double, longitude double, t2m double")
    day = streams.lagged_day(dt.date(2024, 1, 20))
    got = streams.subset(df, ["t2m"], day=day, hours=[0, 23])
    assert {(r["time"], r["latitude"]) for r in got.collect()} == {
        (dt.datetime(2024, 1, 15, h), lat) for h in (0, 23) for lat in (38.0, 44.5)
    }


def test_pending_days_and_audit(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 3),) for d in (1, 1, 2, 3)], "time timestamp_ntz")
    done = spark.createDataFrame([(dt.date(2024, 1, 2), 1, 4, 7)], schemas.LEDGER)
    assert sorted(r["day"].day for r in load.pending_days(df, done).collect()) == [1, 3]
    assert {tuple(r) for r in load.load_audit({"a": df, "b": done}).collect()} == {("a", 4), ("b", 1)}


def test_stored_facts_are_pruned_by_folder_and_range(spark, star_root, tmp_path):
    write_day(spark, f"{tmp_path}/a", dt.date(2023, 12, 31))
    daily.load_folders(spark, str(tmp_path), ["a"], star_root)
    facts, times, _ = daily.open_star(spark, star_root)
    plan = plan_of(analytics.drill_down(facts, "day", "avg", 2023, 2024, dim_time=times))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(time_id,2023000000)" in plan
    assert "dewpoint_c" not in plan and "location_id" not in plan
    assert star.with_time(facts.drop("year"), times).count() == 72


def test_days_that_all_agree_are_not_copied_before_the_load(spark, star_root, tmp_path, monkeypatch):
    """the staged rows were stored once more for the load."""
    names, stored = [], daily.session.stored
    monkeypatch.setattr(daily.session, "stored", lambda df, name: names.append(name) or stored(df, name))
    write_day(spark, f"{tmp_path}/d", dt.date(2024, 1, 1))
    assert daily.load_folders(spark, str(tmp_path), ["d"], star_root)["fact_weather"] == 72
    assert "staged" in names and not {"todo", "delta"} & set(names)
