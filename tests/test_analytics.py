import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid.functions import calendar
from hourgrid.operators import analytics, star


def keyed(df):
    return df.withColumn("time_id", calendar.time_key(F.col("time")))


@pytest.fixture(scope="module")
def sample():
    """Three hundred days over the years 2000, 2001, 2003 and 2004, quarter-degree values."""
    rng = random.Random(7)
    rows = []
    for year in (2000, 2001, 2003, 2004):
        for _ in range(75):
            day = dt.datetime(year, 1, 1) + dt.timedelta(days=rng.randrange(365))
            for hour in rng.sample(range(24), 3):
                for lat in (40.0, 41.0):
                    t = rng.randrange(-100, 160) * 0.25
                    rows.append(((day + dt.timedelta(hours=hour)).isoformat(), lat, 70.0, t, rng.randrange(9) * 0.5))
    return rows


@pytest.fixture(scope="module")
def frame(sample):
    pdf = pd.DataFrame(sample, columns=["time", "lat", "lon", "t", "p"])
    pdf["time"] = pd.to_datetime(pdf["time"])
    return pdf.assign(
        year=pdf.time.dt.year, month=pdf.time.dt.month, date=pdf.time.dt.date, extreme=(pdf.t > 35) | (pdf.t < -20)
    )


def test_kpi_against_pandas(obs, sample, frame):
    got = analytics.kpi(analytics.day_profile(obs(sample))).first().asDict()
    last, past = frame[frame.year == 2004], frame[frame.year < 2004]
    past_days = past[past.extreme].date.nunique()
    assert got["year"] == 2004
    assert got["current_temp"] == pytest.approx(last.t.mean(), abs=0.005)
    assert got["history_temp"] == pytest.approx(past.t.mean(), abs=0.005)
    assert got["temp_anomaly"] == pytest.approx(got["current_temp"] - got["history_temp"], abs=1e-9)
    assert got["extreme_days"] == last[last.extreme].date.nunique()
    assert got["extreme_hist_avg"] == pytest.approx(past_days / 4, abs=0.05)
    alone = analytics.kpi(analytics.day_profile(obs(sample)), history_only=True).first()
    assert alone["extreme_hist_avg"] == pytest.approx(past_days / 3, abs=0.05)


def test_kpi_of_a_given_year(obs, sample, frame):
    got = analytics.kpi(analytics.day_profile(obs(sample)), year=2003).first()
    assert got["year"] == 2003
    assert got["history_temp"] == pytest.approx(frame[frame.year < 2003].t.mean(), abs=0.005)


def test_kpi_without_data_or_history(obs):
    got = analytics.kpi(analytics.day_profile(obs([]))).first().asDict()
    assert got["year"] == fv.FALLBACK_YEAR
    assert got["current_temp"] is None and got["temp_anomaly"] is None and got["extreme_days"] == 0
    one = analytics.kpi(analytics.day_profile(obs([("2020-05-05T01:00", 40.0, 70.0, 36.0, 0.0)]))).first()
    assert (one["year"], one["current_temp"], one["history_temp"], one["extreme_days"]) == (2020, 36.0, None, 1)


def test_trend_frame_counts_rows_not_years(obs, sample, frame):
    got = analytics.yearly_trend(analytics.day_profile(obs(sample)), width=2).collect()
    means = frame.groupby("year").t.mean()
    want = means.rolling(2, min_periods=1).mean()
    assert [r["year"] for r in got] == [2000, 2001, 2003, 2004]
    for r in got:
        assert r["avg_temp"] == pytest.approx(means[r["year"]], abs=0.005)
        assert r["trend_line"] == pytest.approx(want[r["year"]], abs=0.005)


def test_histogram_counts_every_day_once(obs, sample, frame):
    got = {r["temp_bin"]: r["days_count"] for r in analytics.temp_histogram(analytics.day_profile(obs(sample))).collect()}
    want = (frame.groupby("date").t.mean() // 1).value_counts()
    assert got == {int(k): v for k, v in want.items()}
    assert sum(got.values()) == frame.date.nunique()


@pytest.mark.parametrize("grain", analytics.GRAINS)
@pytest.mark.parametrize("func", analytics.FUNCTIONS)
@pytest.mark.parametrize("by_key", [True, False])
def test_drill_down_against_pandas(obs, sample, frame, grain, func, by_key):
    df = keyed(obs(sample)).drop("time") if by_key else obs(sample)
    got = analytics.drill_down(df, grain, func.upper(), 2001, "2003").collect()
    part = frame[frame.year.between(2001, 2003)]
    form = {"year": "%Y", "month": "%Y-%m", "day": "%Y-%m-%d"}[grain]
    groups = part.groupby(part.time.dt.strftime(form))
    temp = getattr(groups.t, {"avg": "mean"}.get(func, func))()
    rain = getattr(groups.p, {"avg": "sum"}.get(func, func))()
    assert [r["label"] for r in got] == list(temp.index)
    for r in got:
        assert r["temp"] == pytest.approx(temp[r["label"]], abs=0.0051)
        assert r["precip"] == pytest.approx(rain[r["label"]], abs=0.0051)


def test_time_dimension_gives_the_same_and_drops_unknown_hours(obs, sample):
    df = keyed(obs(sample))
    times = star.time_dimension(df)
    for question in (analytics.kpi, analytics.yearly_trend, analytics.temp_histogram):
        assert question(analytics.day_profile(df, times)).collect() == question(analytics.day_profile(df)).collect()
    fewer = times.where("year <> 2004")
    assert analytics.kpi(analytics.day_profile(df, fewer)).first()["year"] == 2003


def test_drill_arguments():
    assert analytics.drill_arguments("week", "MEDIAN", "1999", 2001) == ("year", "avg", 1999, 2001)
    assert analytics.drill_arguments() == ("year", "avg", 2000, 2025)
    assert analytics.drill_arguments("day", "MIN")[1] == "min"
    with pytest.raises(ValueError):
        analytics.drill_arguments("day", "min", 2002, 2001)


def test_empty_input_gives_empty_results(obs):
    empty = obs([])
    days = analytics.day_profile(empty)
    assert analytics.yearly_trend(days).collect() == []
    assert analytics.temp_histogram(days).collect() == []
    assert analytics.extreme_days(days).collect() == []
    assert analytics.drill_down(empty, "month").collect() == []


def test_an_hour_that_the_session_zone_skips_is_kept(spark, obs):
    df = keyed(obs([("2024-03-10T02:30", 40.0, 70.0, 1.0, 0.0), ("2024-03-10T23:30", 40.0, 70.0, 3.0, 0.0)]))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for frame in (df, df.drop("time"), df.drop("time_id")):
            assert [tuple(r) for r in analytics.drill_down(frame, "day").collect()] == [("2024-03-10", 2.0, 0.0)]
        hours = star.time_dimension(df).orderBy("time_id")
        assert [(r["time_id"], r["hour"]) for r in hours.collect()] == [(2024031002, 2), (2024031023, 23)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_last_year(spark):
    times = spark.createDataFrame([(2019,), (2021,)], "year int")
    assert analytics.last_year(times).first()["year"] == 2021
    assert analytics.last_year(times.limit(0)).first()["year"] == fv.FALLBACK_YEAR


def measured(spark, rows):
    names = ["temperature_c"] + [column for _, _, column in fv.FACTORS]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def test_correlations_and_ranking(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        t = rng.uniform(-10, 30)
        rows.append((t, t + rng.gauss(0, 20), 2 * t, -t + rng.gauss(0, 5), 7.0, rng.random(), -3 * t))
    df = measured(spark, rows)
    pdf = pd.DataFrame(rows, columns=df.columns)
    row = analytics.correlations(df)
    got = row.first().asDict()
    for code, _, column in fv.FACTORS:
        if code == "clouds":
            assert got[code] is None  # constant
        else:
            assert got[code] == pytest.approx(pdf["temperature_c"].corr(pdf[column]), abs=0.00051)
    ranked = analytics.correlation_ranking(row).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4, 5, 6]
    assert [r["name"] for r in ranked][:2] == ["Точка росы (Влажность)", "Осадки"]  # 1.0 and -1.0: a tie
    assert ranked[-1]["value"] is None
    for r in ranked:
        assert r["colour"] == ("#FF6B6B" if (r["value"] or 0) > 0 else "#4ECDC4")


def test_correlations_without_rows(spark):
    assert set(analytics.correlations(measured(spark, [])).first()) == {None}
