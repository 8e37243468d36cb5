"""How the supplied tables become observations."""

import datetime as dt

import pytest
from explained import plan_of
from pyspark.sql import functions as F

from hourgrid.sources import binding


@pytest.fixture
def sf(spark, tmp_path):
    day = dt.datetime(1998, 3, 1)
    rows = [
        (p, s, n, float(p % 7), 100.0 * n, 0.01 * (p % 5), 0.02 * n, day + dt.timedelta(days=p % 2))
        for p in (0, 1, 24, 25, None) for s in (0, 27, 513, -5, None) for n in (1, 2) if p is not None
    ] + [(3, None, 1, 5.0, None, None, 0.0, None), (None, 9, 1, 2.0, 1.0, 0.0, 0.0, day)] * 2
    schema = "l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_cells_are_dealt_out_before_they_are_grouped(spark, sf):
    """F8-F10: a hash table of a task's whole input came before the shuffle, and spilled."""
    plan = plan_of(binding.cells(spark, sf))
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan.split("Exchange")[1]


def test_cells_are_one_row_per_time_and_place(spark, sf):
    rows = binding.table(spark, sf, "lineitem").withColumns(
        {"time": binding._time(), "latitude": binding._latitude(), "longitude": binding._longitude()}
    )
    names = {"q": "l_quantity", "pk": "l_partkey", "tax": "l_tax", "disc": "l_discount", "ep": "l_extendedprice", "ln": "l_linenumber", "sk": "l_suppkey"}
    want = rows.groupBy("time", "latitude", "longitude").agg(*[F.max(c).alias(n) for n, c in names.items()])
    got = binding.cells(spark, sf)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
