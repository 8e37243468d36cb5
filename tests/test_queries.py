"""Every registered query against its SQL, and the plans it runs by."""

import math

import duckdb
import pytest
from explained import plan_of

import __spark_entry__ as contract
from hourgrid.operators import decide, series
from hourgrid.plans import daily, registry
from hourgrid.sources import streams

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
WRITING = {"delivered_batches", "agreed_day_ingest", "waiting_days", "backfill_scan", "batched_sink", "bucketed_join4", "star_load", "late_day_reload", "stream_ingest", "write_clean"}
QUERIES, SQL = contract.queries(), contract.oracle_sql()
NOT_IN_SQL = {
    "op1_toxicity", "op2_token_counts", "op3_secret_scan", "op7_quality_classifier", "op9_packing", "op12_bpe", "op13_periodic_runs",
    "pipeline",
} & set(QUERIES)  # those of the corpus operators, which can be left out
FOREST = {"rf_scored", "rf_serve_hours", "rf_serve_summary", "rf_serve_advice"}  # predictions of the trained forest


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def ordered(names, rows):
    at = [names.index(n) for n in sorted(names)]

    def plain(v):
        return "-0.0" if isinstance(v, float) and v == 0 and math.copysign(1, v) < 0 else v

    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def test_all_queries_but_trained_ones_and_tokenizers_have_sql():
    assert set(QUERIES) - set(SQL) == NOT_IN_SQL | FOREST and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    found = db.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(got.columns) == sorted(names)
    assert ordered(got.columns, [tuple(r) for r in got.collect()]) == ordered(names, found.fetchall())


def test_served_forest_equals_the_fitted_one(spark, sf_dir, monkeypatch):
    """What is served from the saved forest is what the forest in memory gives for the same frame."""
    kept, train = [], registry.model.train
    monkeypatch.setattr(registry.model, "train", lambda df: kept.append(train(df, trees=12, depth=6)) or kept[-1])
    monkeypatch.setattr(registry, "_made", {})
    served = {n: QUERIES[n](spark, sf_dir).collect() for n in sorted(FOREST | {"rf_serve_quality"})}
    frame = series.forecast_frame(daily.latest_window(spark, registry._loaded(spark, sf_dir)["root"]))
    features = registry._stored_features(spark, sf_dir)
    assert len(kept) == 1
    want = {r["step"]: r for r in series.with_band(kept[0].transform(frame)).collect()}
    assert len(served["rf_serve_hours"]) == len(want) > 100
    for r in served["rf_serve_hours"]:
        for c in ("prediction", "upper", "lower"):
            assert math.isclose(r[c], want[r["step"]][c], abs_tol=2e-6)
        assert r["forecast_time"] == want[r["step"]]["forecast_time"]
    assert all(r["within_range"] for r in served["rf_serve_quality"])
    predictions = [r["prediction"] for r in want.values()]
    assert len(set(predictions)) > 12  # not a constant
    (summary,) = served["rf_serve_summary"]
    assert math.isclose(summary["min_temp"], min(predictions), abs_tol=2e-6)
    assert math.isclose(summary["max_temp"], max(predictions), abs_tol=2e-6)
    assert math.isclose(summary["avg_temp"], sum(predictions) / len(predictions), abs_tol=2e-6)
    exact = series.with_band(kept[0].transform(frame))
    assert [tuple(r) for r in served["rf_serve_advice"]] == [tuple(r) for r in decide.recommendations(decide.forecast_summary(exact)).collect()]
    later = series.chrono_split(features).where("is_test")
    scored = {tuple(r[c] for c in series.ORDER): r for r in kept[0].transform(later).collect()}
    assert len(served["rf_scored"]) == len(scored)
    for r in served["rf_scored"]:
        other = scored[tuple(r[c] for c in series.ORDER)]
        assert r["temperature_c"] == other["temperature_c"] and math.isclose(r["prediction"], other["prediction"], abs_tol=1e-9)


def test_entry_has_one_row(spark):
    assert contract.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(set(SQL) - WRITING - {n for n in SQL if n.startswith("op")}))
def test_plan_has_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow", "CollectLimit"):
        assert node not in plan


def test_top_rows_are_limited_without_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["latest_168_rows"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan_of(QUERIES["eval_slice"](spark, sf_dir))


def test_latest_hours_are_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["latest_168h_per_location"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


def test_split_neither_sorts_nor_shuffles_the_rows(spark, sf_dir):
    plan = plan_of(QUERIES["chrono_split"](spark, sf_dir))
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Sort" not in main and "Window" not in main


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["kpi"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_day_and_box_reach_the_scan(spark, sf_dir, tmp_path):
    plan = plan_of(QUERIES["lagged_day"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan
    registry.bbox_subset(spark, sf_dir).write.parquet(f"{tmp_path}/t")
    plan = plan_of(streams.subset(spark.read.parquet(f"{tmp_path}/t"), ["temperature_c"]))
    assert "GreaterThanOrEqual(latitude,38.0)" in plan  # the box; the list is cut off in print


def test_a_range_of_years_prunes_the_stored_star(spark, sf_dir):
    plan = plan_of(QUERIES["star_drill_range"](spark, sf_dir))
    assert "GreaterThanOrEqual(time_id,1996000000)" in plan and "PartitionFilters: [isnotnull(year" in plan
    assert "dewpoint_c" not in plan


def test_no_year_is_fixed_but_where_a_range_is_the_feature():
    text = open(registry.__file__).read()
    assert "range(19" not in text and "1995" not in text


def test_serving_makes_the_observations_once(spark, sf_dir, monkeypatch):
    """the features were made and stored beside the observations that the star was loaded from."""
    want = sorted(map(tuple, registry._features(spark, sf_dir).collect()))
    found = registry._loaded(spark, sf_dir)["observed"]
    assert sorted(map(tuple, series.ml_features(spark.read.parquet(found), keep=["time"]).collect())) == want
    monkeypatch.setattr(registry, "_stored_features", None)
    assert registry.serve_hours(spark, sf_dir).count() > 100
