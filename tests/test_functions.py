import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from hourgrid.functions import calendar, measures

MOMENTS = [
    dt.datetime(2024, 2, 29, 0, 30),  # leap day
    dt.datetime(2023, 12, 31, 23, 0),  # a Sunday, last hour of the year
    dt.datetime(2024, 1, 1, 0, 0),  # a Monday
    dt.datetime(1999, 7, 4, 5, 59, 59, 999999),
]


@pytest.fixture(scope="module")
def moments(spark):
    return spark.createDataFrame([(m,) for m in MOMENTS], "ts timestamp_ntz")


def test_calendar_parts(moments):
    got = moments.select("ts", *calendar.calendar_parts(F.col("ts"))).collect()
    for r in got:
        t = r["ts"]
        want = (t.year, t.month, t.day, t.hour, t.isoweekday(), (t.month - 1) // 3 + 1)
        assert (r["year"], r["month"], r["day"], r["hour"], r["day_of_week"], r["quarter"]) == want


def test_time_key_equals_formatted_text_and_reads_back(moments):
    key = calendar.time_key(F.col("ts"))
    got = moments.select(
        "ts", key.alias("k"), calendar.time_of_key(key).alias("back"), calendar.date_of_key(key).alias("date"),
        F.date_format("ts", "yyyyMMddHH").cast("long").alias("text"),
    ).collect()
    for r in got:
        assert r["k"] == r["text"] == int(r["ts"].strftime("%Y%m%d%H"))
        assert r["back"] == r["ts"].replace(minute=0, second=0, microsecond=0)
        assert r["date"] == r["ts"].date()


def test_results_do_not_depend_on_the_session_zone(spark, moments):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r["k"] for r in moments.select(calendar.time_key(F.col("ts")).alias("k")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [int(m.strftime("%Y%m%d%H")) for m in MOMENTS]


def test_labels_are_padded(moments):
    ts = F.col("ts")
    parts = F.year(ts), F.month(ts), F.to_date(ts)
    got = moments.select(*[calendar.period_label(g, *parts).alias(g) for g in ("year", "month", "day")]).first()
    assert tuple(got) == ("2024", "2024-02", "2024-02-29")


def test_year_range_as_key_range(spark):
    keys = [1999123123, 2000010100, 2001123123, 2002010100]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r["k"] for r in df.where(calendar.key_in_years(F.col("k"), 2000, 2001)).collect()]
    assert got == [2000010100, 2001123123]


def test_unit_conversion(spark):
    row = spark.createDataFrame([(300.0, 101325.0, 0.00123456, 3.0, 4.0)], "k double, p double, m double, u double, v double")
    got = row.select(
        measures.kelvin_to_celsius(F.col("k")), measures.pascal_to_hectopascal(F.col("p")),
        measures.metre_to_millimetre(F.col("m")), measures.wind_speed(F.col("u"), F.col("v")),
    ).first()
    assert tuple(got) == (26.85, 1013.25, 1.2346, 5.0)


@pytest.mark.parametrize("value,extreme", [(35.0, False), (35.01, True), (-20.0, False), (-20.01, True), (0.0, False)])
def test_extreme_limits_are_strict(spark, value, extreme):
    row = spark.createDataFrame([(value,)], "t double")
    assert row.select(measures.is_extreme(F.col("t"))).first()[0] is extreme


def test_location_key_takes_doubles(spark):
    row = spark.sql("select float(44.25) f, double(44.25) d, float(-0.0) nz, double(0.0) z")
    a, b, c, d = row.select(
        measures.location_key(F.col("f"), F.col("nz")), measures.location_key(F.col("d"), F.col("z")),
        F.xxhash64("f", "nz"), F.xxhash64("d", "z"),
    ).first()
    assert a == b == d
    assert c != d


def test_portable_bucket_matches_md5(spark):
    df = spark.range(500).select("id", (F.col("id") * 7).alias("other"))
    got = df.select("id", "other", measures.hash_bucket([F.col("id"), F.col("other")], 20, portable=True).alias("b"))
    for r in got.collect():
        digest = hashlib.md5(f"{r['id']}|{r['other']}".encode()).hexdigest()
        assert r["b"] == int(digest[:8], 16) % 20


def test_fast_bucket_is_repeatable_and_even(spark):
    df = spark.range(20000).select(measures.hash_bucket([F.col("id")], 20).alias("b"))
    sizes = {r["b"]: r["count"] for r in df.groupBy("b").count().collect()}
    assert set(sizes) == set(range(20)) and min(sizes.values()) > 850 and max(sizes.values()) < 1150
    with pytest.raises(ValueError):
        measures.hash_bucket([F.col("id")], 0)


def test_pearson(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (None, 9.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double, c double")
    x, y, c = F.col("x"), F.col("y"), F.col("c")
    full = df.agg(measures.pearson(x, y), F.corr(x, y), measures.pearson(x, c)).first()
    assert full[0] == pytest.approx(full[1]) and full[2] is None
    assert df.limit(1).agg(measures.pearson(x, y)).first()[0] is None
    assert df.where("x > 99").agg(measures.pearson(x, y)).first()[0] is None


def test_number_text(spark):
    df = spark.createDataFrame([(1.0,), (-0.48,), (0.0,), (10.5,)], "v double")
    assert [r[0] for r in df.select(measures.number_text(F.col("v"))).collect()] == ["1", "-0.48", "0", "10.5"]
