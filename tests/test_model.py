import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid.operators import decide, forest, model


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = []
    for _ in range(600):
        dew = rng.uniform(-10, 20)
        others = [rng.random() for _ in range(6)]
        month, hour, weekday = rng.randrange(1, 13), rng.randrange(24), rng.randrange(1, 8)
        data.append((dew + 5 + rng.gauss(0, 0.5), others[0], dew, *others[1:5], 40.0, 70.0, month, hour, weekday))
    doubles = [fv.TARGET, *fv.FEATURES[:8]]
    schema = ", ".join(f"{n} double" for n in doubles) + ", month int, hour int, day_of_week int"
    return spark.createDataFrame(data, schema)


def test_forest_learns_is_saved_and_reads_features_by_name(spark, rows, tmp_path):
    fitted = model.train(rows, trees=5, depth=5)
    scored = model.evaluate(model.predict(fitted, rows)).first()
    assert scored["rows"] == 600 and scored["r2"] > 0.9 and scored["grade"] == fv.GRADE_EXCELLENT
    model.save(fitted, str(tmp_path / "forest"))
    model.save(fitted, str(tmp_path / "forest"))  # a second save replaces the first
    again = model.load(str(tmp_path / "forest"))
    order = list(fv.FEATURES)
    want = model.predict(fitted, rows).select(*order, "prediction").orderBy(*order).collect()
    mixed = rows.select(*reversed(rows.columns))
    assert model.predict(again, mixed).select(*order, "prediction").orderBy(*order).collect() == want


def test_no_rows_to_train_on(rows):
    with pytest.raises(ValueError):
        model.train(rows.limit(0))


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0), (5.0, 7.0), (9.0, None)], "temperature_c double, prediction double")
    got = model.evaluate(df).first()
    assert got["rows"] == 4
    assert got["mae"] == pytest.approx(1.0)
    assert got["r2"] == pytest.approx(1 - 6 / 10)
    assert tuple(model.extents(df).first()) == (1.0, 9.0)


def test_metrics_of_a_constant_and_of_nothing(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "temperature_c double, prediction double")
    assert model.evaluate(flat).first()["r2"] is None
    assert model.evaluate(flat.limit(0)).first()["mae"] is None


@pytest.mark.parametrize(
    "r2,grade",
    [(0.91, fv.GRADE_EXCELLENT), (0.9, fv.GRADE_GOOD), (0.71, fv.GRADE_GOOD), (0.7, fv.GRADE_MORE_DATA), (-2.0, fv.GRADE_MORE_DATA)],
)
def test_grades_are_strict(spark, r2, grade):
    assert spark.range(1).select(model.grade(F.lit(r2))).first()[0] == grade


def test_climatology_keeps_rows_without_a_mean(spark):
    train = spark.createDataFrame([(1, 0, 1.0), (1, 0, 2.0), (2, 5, 9.0)], "month int, hour int, temperature_c double")
    test = spark.createDataFrame([(1, 0, 0.0), (2, 5, 0.0), (7, 7, 0.0)], "month int, hour int, temperature_c double")
    got = {(r["month"], r["hour"]): r["prediction"] for r in model.climatology(train, test).collect()}
    assert got == {(1, 0): 1.5, (2, 5): 9.0, (7, 7): None}


def summary(spark, low, high, mean, wind, rain):
    names = ("min_temp", "max_temp", "avg_temp", "avg_wind", "total_precip")
    values = (low, high, mean, wind, rain)
    return spark.createDataFrame([tuple(map(float, values))], ", ".join(f"{n} double" for n in names))


@pytest.mark.parametrize(
    "values,want",
    [
        ((-15.1, 0, -5, 0, 0), (fv.UTILITIES_FROST, fv.FARMING_FROST, fv.TRANSPORT_CLEAR)),
        ((-15, 30, 5, 10, 20), (fv.UTILITIES_WINTER, fv.FARMING_FROST, fv.TRANSPORT_ICE)),
        ((0, 30, 5.1, 10, 5), (fv.UTILITIES_MILD, fv.FARMING_GOOD, fv.TRANSPORT_CLEAR)),
        ((0, 30.1, 25, 10.1, 0.9), (fv.UTILITIES_MILD, fv.FARMING_DROUGHT, fv.TRANSPORT_STORM)),
        ((1, 31, 25, 0, 1), (fv.UTILITIES_MILD, fv.FARMING_FROST, fv.TRANSPORT_CLEAR)),
        ((-1, 20, 10, 0, 20.1), (fv.UTILITIES_WINTER, fv.FARMING_GOOD, fv.TRANSPORT_STORM)),
        ((-1, 20, 10, 0, 5), (fv.UTILITIES_WINTER, fv.FARMING_GOOD, fv.TRANSPORT_CLEAR)),
    ],
)
def test_recommendations_at_their_limits(spark, values, want):
    got = decide.recommendations(summary(spark, *values)).collect()
    assert [tuple(r) for r in got] == list(want)


def test_summary_text_rounds_halves_to_even(spark):
    df = spark.createDataFrame([(-0.4, 1.0, 0.5), (2.5, 3.0, 0.5)], "prediction double, wind_speed_ms double, precipitation_mm float")
    got = decide.forecast_summary(df).first()
    assert got["forecast_text"] == "Прогноз: 0...2°C"
    assert (got["avg_temp"], got["avg_wind"], got["total_precip"]) == (pytest.approx(1.05), 2.0, 1.0)
    none = decide.forecast_summary(df.limit(0))
    assert none.first()["forecast_text"] is None
    assert decide.recommendations(none).collect() == []


@pytest.mark.parametrize(
    "anomaly,days,usual,want",
    [
        (1.4, 15, 4.5, ("+1.4", fv.KPI_WARMER, fv.KPI_WORSE, "🔺 На 11 дней больше нормы", fv.KPI_WORSE)),
        (-2.0, 4, 4.0, ("-2", fv.KPI_COLDER, fv.KPI_BETTER, fv.KPI_NOT_MORE_DAYS, fv.KPI_BETTER)),
        (0.0, 4, 3.8, ("0", fv.KPI_NORMAL, fv.KPI_NEUTRAL, "🔺 На 0 дней больше нормы", fv.KPI_WORSE)),
        (None, 0, None, (None, fv.KPI_NO_DATA, fv.KPI_NEUTRAL, fv.KPI_NO_DATA, fv.KPI_NEUTRAL)),
    ],
)
def test_kpi_wording(spark, anomaly, days, usual, want):
    schema = "year int, temp_anomaly double, extreme_days long, extreme_hist_avg double"
    got = decide.kpi_status(spark.createDataFrame([(2024, anomaly, days, usual)], schema)).first()
    assert tuple(got)[1:] == want


def test_a_pass_of_the_forest_holds_little_and_gives_the_same_trees(spark, rows):
    """F1-F7: each core held a gigabyte of statistics, and rows remembered their node in each tree for several passes."""
    rows = rows.coalesce(1).cache()
    fitted = model.train(rows, trees=4, depth=6)
    forest = fitted.stages[-1]
    assert forest.getOrDefault("maxMemoryInMB") <= 256 and not forest.getOrDefault("cacheNodeIds")
    many_passes = model.train(rows, trees=4, depth=6, histogram_mb=1)
    assert many_passes.stages[-1].toDebugString.split("\n")[1:] == forest.toDebugString.split("\n")[1:]


def test_a_pass_holds_at_most_64_mb_a_core(spark, rows):
    """F2-F6: 256 MB of statistics for each core, and the trees that so many nodes belong to."""
    rows = rows.coalesce(1).cache()
    forest = model.train(rows, trees=6, depth=8).stages[-1]
    assert forest.getOrDefault("maxMemoryInMB") <= 64
    wide = model.train(rows, trees=6, depth=8, histogram_mb=256).stages[-1]
    assert forest.toDebugString.split("\n")[1:] == wide.toDebugString.split("\n")[1:]


def test_small_partitions_are_fitted_together(spark, rows, monkeypatch):
    """F3-F5: each partition, of few rows too, made and sent its own statistics of all nodes of a pass."""
    fitted, fit = [], model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, df: fitted.append(df.rdd.getNumPartitions()) or fit(self, df))
    many = rows.repartition(8).cache()
    trees = [model.train(df, trees=3, depth=4).stages[-1].toDebugString.split("\n")[1:] for df in (many, many.coalesce(1))]
    monkeypatch.setattr(model, "ROWS_A_TASK", 250)
    forest = model.train(many, trees=3, depth=4).stages[-1]
    assert fitted == [1, 1, 3] and trees[0] == trees[1] and forest.getNumTrees == 3
    model.train(many.limit(600).repartition(2), trees=1, depth=1)
    assert fitted[-1] == 2  # larger partitions stay


def trees_of(fitted):
    return fitted.stages[-1].toDebugString.split("\n")[1:]


@pytest.fixture(scope="module")
def quarters(rows):
    """The rows in one partition, with temperatures whose sums are exact, so that trees do not depend on their order."""
    return rows.withColumn(fv.TARGET, F.round(F.col(fv.TARGET) * 4) / 4).coalesce(1).cache()


def test_a_forest_of_small_nodes_takes_few_jobs(spark, quarters):
    """F2-F8: each node of each tree, of however few rows, was counted over all tasks, in some of very many passes."""
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "")
    try:
        fitted = model.train(quarters, trees=60, depth=12, histogram_mb=1).stages[-1]
    finally:
        context.setJobGroup("others", "")
    assert fitted.getNumTrees == 60 and len(context.statusTracker().getJobIdsForGroup("few-jobs")) < 40


@pytest.mark.parametrize("local,moved,mb", [(400, 10**8, 64), (60, 1500, 1), (0, 1, 1)])
def test_trees_are_the_same_however_their_rows_are_dealt_out(quarters, monkeypatch, local, moved, mb):
    """F2-F8: nodes counted by all tasks, and nodes grown by one, give the trees that are grown whole."""
    want = trees_of(model.train(quarters, trees=5, depth=7))
    monkeypatch.setattr(forest, "LOCAL_ROWS", local)
    monkeypatch.setattr(forest, "MOVED_ROWS", moved)
    before = quarters.sparkSession.conf.get(forest.CLEANUP_KEY)
    assert trees_of(model.train(quarters, trees=5, depth=7, histogram_mb=mb)) == want
    assert quarters.sparkSession.conf.get(forest.CLEANUP_KEY) == before


def test_each_node_has_its_best_cut():
    rng = np.random.default_rng(4)
    bins, n_bins = rng.integers(0, 6, (3, 200)).astype(np.uint8), [6, 6, 6]
    y, w = rng.integers(0, 50, 200) / 4, rng.integers(1, 4, 200).astype(float)
    feature, cut, left, value = forest.grow(bins, y, w, 4, n_bins)

    def cost(rows):
        return (w[rows] * (y[rows] - np.average(y[rows], weights=w[rows])) ** 2).sum()

    todo, seen, leaves = [(0, np.arange(200), 0)], 0, 0
    while todo:
        node, rows, level = todo.pop()
        seen += 1
        assert value[node] == pytest.approx(np.average(y[rows], weights=w[rows]))
        sides = [(rows[bins[i, rows] <= c], rows[bins[i, rows] > c]) for i in range(3) for c in range(5)]
        costs = [cost(a) + cost(b) for a, b in sides if len(a) and len(b)]
        if cut[node] == forest.LEAF:
            leaves += 1
            assert left[node] == node and (level == 4 or not costs or min(costs) > cost(rows) - 1e-9)
            continue
        go = bins[feature[node], rows] > cut[node]
        assert cost(rows[~go]) + cost(rows[go]) == pytest.approx(min(costs)) and min(costs) < cost(rows)
        todo += [(left[node], rows[~go], level + 1), (left[node] + 1, rows[go], level + 1)]
    assert seen == len(cut) and leaves > 8


def test_bins_end_between_few_values_and_at_quantiles_of_many(spark):
    rows = spark.range(1000).select(F.array(F.col("id") % 7, F.col("id"), F.lit(3)).cast("array<double>").alias("x"))
    few, many, one = forest.thresholds(rows, 3, 10)
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and len(one) == 0
    assert len(many) == 9 and all(abs(v - 100 * (k + 1)) <= 2 for k, v in enumerate(many))


@pytest.mark.parametrize("column", [fv.TARGET, "month"])
@pytest.mark.parametrize("value", [None, float("nan")])
def test_missing_values_are_an_error(rows, column, value):
    bad = rows.withColumn(column, F.when(F.rand(1) < 0.02, F.lit(value)).otherwise(F.col(column)).cast("double"))
    with pytest.raises(Exception, match="(?i)null|nan"):
        model.train(bad, trees=2, depth=2)


def test_the_forest_is_as_good_as_that_of_spark(rows):
    assembled = VectorAssembler(inputCols=list(fv.FEATURES), outputCol="features").transform(rows)
    spark_s = RandomForestRegressor(labelCol=fv.TARGET, numTrees=20, maxDepth=8, seed=1, featureSubsetStrategy="all")
    theirs = model.evaluate(spark_s.fit(assembled).transform(assembled)).first()
    ours = model.evaluate(model.predict(model.train(rows, trees=20, depth=8), rows)).first()
    assert ours["r2"] > 0.99 * theirs["r2"] and ours["mae"] < 1.1 * theirs["mae"]
    one = model.train(rows.limit(1), trees=3, depth=5)
    assert model.predict(one, rows).select("prediction").distinct().collect() == rows.limit(1).select(fv.TARGET).collect()
