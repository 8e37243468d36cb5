"""Streams kept in buckets: the same rows as the plain join, without a shuffle."""

import datetime as dt

import pytest
from explained import plan_of
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid import schemas
from hourgrid.operators import conform
from hourgrid.sources import buckets, versions

T0 = dt.datetime(2024, 1, 1)


def streams_of(spark, cells, lacking=None):
    """The four streams with one row for each cell (hour, latitude, longitude); stream s lacks the cells in ``lacking[s]``."""
    made = {}
    for at, s in enumerate(fv.STREAMS):
        names = schemas.stream_measures(s)
        rows = [
            (None if h is None else T0 + dt.timedelta(hours=h), y, x, *[100.0 * at + i for i in range(len(names))])
            for h, y, x in cells if (h, y, x) not in (lacking or {}).get(s, ())
        ]
        made[s] = spark.createDataFrame(rows, f"time timestamp_ntz, latitude double, longitude double, {', '.join(f'{m} double' for m in names)}")
    return made


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def root(spark, tmp_path):
    buckets.create(spark, str(tmp_path / "kept"), 3)
    return str(tmp_path / "kept")


CELLS = [(h, 40.0 + y / 4, 70.0) for h in range(5) for y in range(4)]


def test_join_equals_the_plain_join_without_an_exchange(spark, root):
    made = streams_of(spark, CELLS, {"accum": CELLS[:3], "max": CELLS[2:5]})
    buckets.add(spark, root, made)
    got = conform.join_buckets(buckets.read(spark, root))
    plan = plan_of(got)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
    assert plan.count("SelectedBucketsCount: 3 out of 3") == 4
    assert "Exchange" not in plan_of(got.where(F.col("time") >= T0 + dt.timedelta(hours=2)))
    assert sorted(got.columns) == sorted(conform.join_streams(made).columns)
    assert rows(got) == rows(conform.join_streams(made)) and got.count() == 15


def test_range_of_hours_reaches_every_scan(spark, root):
    buckets.add(spark, root, streams_of(spark, CELLS))
    plan = plan_of(conform.join_buckets(buckets.read(spark, root)).where(F.col("time") >= T0))
    assert plan.count("GreaterThanOrEqual(time,2024-01-01T00:00)") == 4


def test_deliveries_add_up_and_keep_their_files(spark, root):
    buckets.add(spark, root, streams_of(spark, CELLS[:8]))
    before = set(versions.Folder(spark, root).names("instant"))
    buckets.add(spark, root, streams_of(spark, CELLS[8:]))
    late = streams_of(spark, [(9, 1.0, 1.0)])
    for s in fv.STREAMS:
        assert conform.join_buckets(buckets.read(spark, root)).count() == len(CELLS)
        buckets.add(spark, root, {s: late[s]})
    got = conform.join_buckets(buckets.read(spark, root))
    assert rows(got) == rows(conform.join_streams(streams_of(spark, [*CELLS, (9, 1.0, 1.0)])))
    assert before - {"_SUCCESS"} < set(versions.Folder(spark, root).names("instant"))
    assert "Exchange" not in plan_of(got)


def test_a_task_writes_one_file_of_a_bucket(spark, root):
    buckets.add(spark, root, streams_of(spark, [(h, float(y), 0.0) for h in range(40) for y in range(10)]))
    assert len([n for n in versions.Folder(spark, root).names("avg") if n.startswith("part-")]) == 3


def test_odd_cells(spark, root):
    """Nulls join with nothing, copies with each other, and zero is zero whatever its sign."""
    odd = [(None, 1.0, 1.0), (1, None, 1.0), (1, 1.0, None), (2, 0.0, -0.0), (3, 5.0, 5.0), (3, 5.0, 5.0)]
    made = streams_of(spark, odd)
    made["avg"] = made["avg"].withColumns({"latitude": -F.col("latitude") * -1, "location_id": F.lit("clash"), "odd name": F.lit(1)})
    buckets.add(spark, root, made)
    got = conform.join_buckets(buckets.read(spark, root))
    assert got.where("latitude = 0").count() == 1 and got.where("latitude = 5").count() == 2**4 and got.count() == 17


def test_places_with_one_key_stay_apart(spark, root, monkeypatch):
    monkeypatch.setattr(buckets.measures, "location_key", lambda *at: F.lit(7).cast("long"))
    made = streams_of(spark, CELLS)
    buckets.add(spark, root, made)
    assert rows(conform.join_buckets(buckets.read(spark, root))) == rows(conform.join_streams(made))


def test_empty_streams(spark, root):
    assert conform.join_buckets(buckets.read(spark, root)).count() == 0
    buckets.add(spark, root, streams_of(spark, []))
    assert conform.join_buckets(buckets.read(spark, root)).count() == 0


def test_folder_alone_keeps_the_streams(spark, root):
    buckets.add(spark, root, streams_of(spark, CELLS))
    for name in buckets._open(spark, root).values():
        spark.sql(f"drop table {name}")  # what another session's catalog does not have
    got = conform.join_buckets(buckets.read(spark, root))
    assert got.count() == len(CELLS) and "Exchange" not in plan_of(got)


def test_misuse_is_an_error(spark, root, tmp_path):
    with pytest.raises(ValueError, match="already"):
        buckets.create(spark, root, 8)
    with pytest.raises(ValueError, match="positive"):
        buckets.create(spark, str(tmp_path / "other"), 0)
    with pytest.raises(ValueError, match="no bucketed"):
        buckets.read(spark, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="unknown streams"):
        buckets.add(spark, root, {"other": spark.range(1)})
