"""Versions, corrections, content prints and stored profiles of the star."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.operators import analytics, conform, load, profiles, star
from hourgrid.plans import daily
from hourgrid.sources import versions

NAMES = schemas.FACT_WEATHER.fieldNames()


def facts_of(spark, values):
    """Facts from {(hour key, place): temperature}; None leaves the temperature out."""
    rows = [(t, p, v, None if v is None else v - 3, v, v, 1000.0 + p, float(t % 7), 2.0 + p % 3, 0.5, float(t % 100)) for (t, p), v in values.items()]
    return spark.createDataFrame(rows, schemas.FACT_WEATHER)


def dims_of(spark, values):
    hours = spark.createDataFrame([(t,) for t in sorted({t for t, _ in values})], "time_id long")
    places = [(p, float(p), float(p)) for p in sorted({p for _, p in values})]
    time = F.make_timestamp_ntz(*[F.substring(F.col("time_id").cast("string"), a, n).cast("int") for a, n in ((1, 4), (5, 2), (7, 2), (9, 2))], F.lit(0), F.lit(0))
    times = star.time_dimension(hours.select(time.alias("time")))
    return times, spark.createDataFrame(places, schemas.DIM_LOCATION)


def put(spark, root, values, revision=None, gate=None):
    return load.load_star(spark, root, facts_of(spark, values), *dims_of(spark, values), revision=revision, gate=gate)


def temperatures(spark, root, version=None):
    rows = load.read_table(spark, root, "fact_weather", version).collect()
    assert len({(r["time_id"], r["location_id"]) for r in rows}) == len(rows)
    return {(r["time_id"], r["location_id"]): r["temperature_c"] for r in rows}


def files(spark, root, version=None):
    return {r["path"]: (r["low"], r["high"]) for r in versions.manifest(spark, root, version).where("table = 'fact_weather'").collect()}


@pytest.fixture
def root(spark, tmp_path):
    load.create_star(spark, str(tmp_path / "star"))
    return str(tmp_path / "star")


def hour(year, month, day, h):
    return ((year * 100 + month) * 100 + day) * 100 + h


FIRST = {(hour(y, 3, d, h), p): 10.0 + d + h / 4 for y in (2022, 2023) for d in (1, 2) for h in range(6) for p in (1, 2)}


def same_as_facts(spark, root):
    """The stored profiles answer as a scan of the facts does."""
    facts = load.read_table(spark, root, "fact_weather").select(NAMES)
    stored = {n: load.read_table(spark, root, n) for n in profiles.TABLES}
    whole = analytics.day_profile(facts)
    folded = profiles.days(stored["day_profile"]).select(whole.columns)
    assert sorted(folded.collect()) == sorted(whole.collect())
    assert profiles.correlations(stored["day_moments"]).collect() == analytics.correlations(facts).collect()
    hot = profiles.keyed(facts.where("temperature_c > 35 or temperature_c < -20"))
    want = hot.groupBy("location_id", "year").agg(F.count_distinct("date").alias("extreme_days"))
    assert sorted(profiles.extreme_days_by_place(stored["place_months"]).collect()) == sorted(want.collect())
    for places in ([1], [1, 2], []):
        some = spark.createDataFrame([(p,) for p in places], "location_id long")
        want = hot.join(some, "location_id").groupBy("year").agg(F.count_distinct("date").alias("extreme_days"))
        assert sorted(profiles.extreme_days_of(stored["place_months"], some).collect()) == sorted(want.collect())
    return stored


def test_a_later_load_corrects_and_leaves_other_files(spark, root):
    assert put(spark, root, FIRST) == {"dim_location": 2, "dim_time": 24, "fact_weather": 48, "fact_corrected": 0}
    before = files(spark, root)
    change = {k: v + 30 for k, v in FIRST.items() if k[0] // 100 == hour(2023, 3, 2, 0) // 100 and k[0] % 100 >= 4}
    later = change | {(hour(2023, 3, 2, 7), 1): -40.0, (hour(2022, 3, 1, 0), 1): FIRST[hour(2022, 3, 1, 0), 1]}
    got = put(spark, root, later)
    assert (got["fact_weather"], got["fact_corrected"]) == (1, len(change)) == (1, 4)
    assert temperatures(spark, root) == FIRST | later
    after = files(spark, root)
    assert all(p in after for p in before if "year=2022" in p)
    gone = set(before) - set(after)
    assert gone and all(before[p][1] >= hour(2023, 3, 2, 4) for p in gone)
    same_as_facts(spark, root)
    again = put(spark, root, later)
    assert (again["fact_weather"], again["fact_corrected"]) == (0, 0) and files(spark, root) == after


def test_older_versions_stay_readable_until_they_expire(spark, root):
    put(spark, root, FIRST)
    first = versions.newest(spark, root)
    changed = {k: v - 50 for k, v in FIRST.items() if k[1] == 2}
    put(spark, root, changed)
    assert temperatures(spark, root, first) == FIRST
    assert temperatures(spark, root) == FIRST | changed
    facts, times, places = daily.open_star(spark, root, first)
    assert star.weather_full(facts.drop("year"), times, places).agg(F.min("temperature_c")).first()[0] == 11.0
    assert versions.expire(spark, root) > 0
    assert temperatures(spark, root) == FIRST | changed and set(versions.pointers(spark, root)) == {first + 1}
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FileNotFound"):
        temperatures(spark, root, first)
    same_as_facts(spark, root)


def test_given_revisions_win_whatever_their_order(spark, root):
    key, other = (hour(2022, 3, 1, 0), 1), (hour(2022, 3, 1, 1), 1)
    put(spark, root, {key: 1.0, other: 1.0}, revision=5)
    assert put(spark, root, {key: 2.0}, revision=4)["fact_corrected"] == 0
    assert put(spark, root, {key: 1.0}, revision=9)["fact_corrected"] == 1  # confirmed by a newer revision
    assert put(spark, root, {key: 3.0, other: 3.0}, revision=7)["fact_corrected"] == 1
    assert temperatures(spark, root) == {key: 1.0, other: 3.0}


def test_nulls_and_numbers_that_are_none_are_values(spark, root):
    key, other = (hour(2022, 3, 1, 0), 1), (hour(2022, 3, 1, 0), 2)
    put(spark, root, {key: None, other: float("nan")})
    assert put(spark, root, {key: None, other: float("nan")})["fact_corrected"] == 0
    assert put(spark, root, {key: 4.0, other: None})["fact_corrected"] == 2
    assert temperatures(spark, root) == {key: 4.0, other: None}


@pytest.mark.parametrize("broken", ["dim_time", "fact_weather", "day_moments", "gate"])
def test_a_broken_load_shows_nothing(spark, root, monkeypatch, broken):
    put(spark, root, FIRST)
    before = versions.newest(spark, root)
    add = versions.Commit.add

    def failing(self, table, *args, **kw):
        if table == broken:
            raise OSError("disk full")
        return add(self, table, *args, **kw)

    def gate(commit):
        if broken == "gate":
            raise OSError("disk full")

    later = {(hour(2024, 3, 1, 0), 3): 1.0} | {k: 0.0 for k in FIRST}
    monkeypatch.setattr(versions.Commit, "add", failing)
    with pytest.raises(OSError, match="disk full"):
        put(spark, root, later, gate=gate)
    monkeypatch.undo()
    assert versions.newest(spark, root) == before and temperatures(spark, root) == FIRST
    assert load.read_table(spark, root, "dim_location").count() == 2
    put(spark, root, later)
    assert temperatures(spark, root) == later


def test_two_writers_cannot_commit_one_version(spark, root):
    a, b = versions.Commit(spark, root), versions.Commit(spark, root)
    a.add("dim_location", spark.createDataFrame([(1, 1.0, 1.0)], schemas.DIM_LOCATION))
    b.add("dim_location", spark.createDataFrame([(2, 2.0, 2.0)], schemas.DIM_LOCATION))
    a.finish()
    with pytest.raises(versions.ConflictError):
        b.finish()
    assert [r["location_id"] for r in load.read_table(spark, root, "dim_location").collect()] == [1]


def test_an_empty_pointer_is_no_version(spark, root):
    put(spark, root, FIRST)
    now = versions.newest(spark, root)
    assert versions.Folder(spark, root).create(f"versions/{now + 1:012d}", "")
    assert versions.newest(spark, root) == now and temperatures(spark, root) == FIRST
    put(spark, root, {(hour(2024, 1, 1, 0), 1): 1.0})
    assert versions.newest(spark, root) == now + 2 and len(temperatures(spark, root)) == 49


def test_a_star_without_a_version_is_empty(spark, tmp_path):
    assert load.read_table(spark, str(tmp_path / "none"), "fact_weather").count() == 0
    assert versions.expire(spark, str(tmp_path / "none")) == 0


def test_profiles_follow_many_loads(spark, root, monkeypatch):
    monkeypatch.setattr(load, "PROFILE_FILES", 2)
    rng = random.Random(1)
    keys = [(hour(y, m, d, h), p) for y in (2022, 2023) for m in (2, 12) for d in (1, 28) for h in (0, 23) for p in (1, 2, 3)]
    held = {}
    for _ in range(4):
        batch = {k: rng.choice([-30.0, -20.0, 0.25, 35.0, 35.25, 40.0, None]) for k in rng.sample(keys, 14)}
        put(spark, root, batch)
        held |= batch
        assert temperatures(spark, root) == held
        stored = same_as_facts(spark, root)
    days = profiles.days(stored["day_profile"])
    facts = load.read_table(spark, root, "fact_weather").select(NAMES)
    whole = analytics.day_profile(facts)
    for question in (analytics.kpi, analytics.yearly_trend, analytics.temp_histogram, analytics.extreme_days):
        assert sorted(question(days).collect()) == sorted(question(whole).collect())
    for grain in analytics.GRAINS:
        for func in analytics.FUNCTIONS:
            assert analytics.drill_days(days, grain, func).collect() == analytics.drill_down(facts, grain, func, None, None).collect()
    some = profiles.days(stored["day_profile"], 2023, 2023)
    assert analytics.drill_days(some, "month", "max").collect() == analytics.drill_down(facts, "month", "max", 2023, 2023).collect()
    assert all("/data/day_profile/" in f for f in analytics.kpi(days).inputFiles())


def test_moments_keep_their_digits(spark):
    rng = random.Random(2)
    rows = [(hour(2022, 1, d, h), 1, 1e8 + rng.random(), 1e8 + rng.random()) for d in range(1, 20) for h in range(24)]
    facts = spark.createDataFrame([(t, p, x, x, None, None, y, 1.0, 1.0, 1.0, 1.0) for t, p, x, y in rows], schemas.FACT_WEATHER)
    parts = profiles.fold_moments(facts)
    got = profiles.merge_moments(parts, ["factor"]).where("factor = 'Давление' or x_mean > 0").collect()
    n = len(rows)
    mx, my = (sum(r[i] - 1e8 for r in rows) / n for i in (2, 3))
    xy = sum((r[2] - 1e8 - mx) * (r[3] - 1e8 - my) for r in rows)
    yy = sum((r[3] - 1e8 - my) ** 2 for r in rows)
    pressure = [r for r in got if r["y_mean"] > 1e7 and abs(r["yy"] - yy) < 1e-4]
    assert pressure and all(abs(r["xy"] - xy) < 1e-4 and r["n"] == n for r in pressure)
    row = profiles.correlations(parts).first()
    assert [x for x in row if x is None]  # constants have no correlation


def stream_rows(spark, changed=None, copies=0):
    out = {}
    for name in ("instant", "accum", "avg", "max"):
        measures = schemas.stream_measures(name)
        rows = [(dt.datetime(2024, 1, 1, h), 38.0, 68.0, *[float(h)] * len(measures)) for h in range(3)]
        if changed == name:
            rows[1] = (*rows[1][:-1], 99.0)
        out[name] = spark.createDataFrame(rows + rows[:1] * copies, "time timestamp_ntz, latitude double, longitude double, " + ", ".join(f"{m} float" for m in measures))
    return out


def test_prints_tell_values_and_copies_apart(spark):
    prints = {}
    for case in ((None, 0), ("instant", 0), ("accum", 0), ("max", 0), (None, 1), (None, 2), (None, 3)):
        (row,) = conform.deliveries(stream_rows(spark, *case)).collect()
        assert row["arrived"] == 12 + 4 * case[1] and row["most"] == 3 + case[1]
        prints[case] = row["print"]
    assert len(set(prints.values())) == len(prints)
    turned = {n: df.orderBy(F.desc("time")) for n, df in stream_rows(spark).items()}
    assert conform.deliveries(turned).first()["print"] == prints[None, 0]


def test_only_shared_hours_are_joined_and_copied(spark, root, monkeypatch):
    """F8-F10: all new facts were shuffled and stored once more, into an empty star too."""
    kept, stored = {}, load.session.stored
    monkeypatch.setattr(load.session, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    assert put(spark, root, FIRST)["fact_weather"] == len(FIRST) and not kept
    last = hour(2023, 3, 2, 5)
    later = {(last, 1): 99.0, (last, 2): FIRST[last, 2], (hour(2023, 3, 3, 0), 1): 40.0, (hour(2024, 1, 1, 0), 3): -30.0}
    written = put(spark, root, later)
    assert (written["fact_weather"], written["fact_corrected"]) == (2, 1)
    assert [(r["time_id"], r["location_id"]) for r in kept["delta"].collect()] == [(last, 1)]
    assert temperatures(spark, root) == FIRST | later
    same_as_facts(spark, root)
    earlier = {(hour(2021, 1, 1, 0), 1): 36.0, (hour(2024, 2, 1, 0), 1): 1.0, (last, 2): 98.0}
    kept.clear()
    assert put(spark, root, earlier)["fact_corrected"] == 1
    assert temperatures(spark, root) == FIRST | later | earlier
    same_as_facts(spark, root)
