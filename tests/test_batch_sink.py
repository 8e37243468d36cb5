"""Batches that are delivered once, whatever fails and repeats."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourgrid.sources import batch_sink


def files(path):
    return sorted(f for _, _, names in os.walk(f"{path}/batches") for f in names)


def test_batches_add_up_and_are_audited(spark, tmp_path):
    path, df = f"{tmp_path}/sink", spark.range(0, 1003, numPartitions=4).withColumn("v", F.col("id") / 2)
    assert batch_sink.delivered(spark, path).count() == 0 and batch_sink.read(spark, path, df.schema).count() == 0
    batch_sink.deliver(df, path, batch=100)
    batch_sink.deliver(df.where("id >= 1000"), path, batch=100)
    audit = batch_sink.delivered(spark, path).collect()
    assert sum(r["rows"] for r in audit) == 1006 and max(r["rows"] for r in audit) == 100 and len({r["job"] for r in audit}) == 2
    got = batch_sink.read(spark, path, df.schema)
    assert sorted(got.collect()) == sorted([*df.collect(), *df.where("id >= 1000").collect()])
    assert sorted(r["file"].split("/")[1] for r in audit) == files(path)


def test_an_attempt_that_does_not_count_is_not_delivered(spark, tmp_path):
    """A task that wrote all its batches and then failed, and ran again."""
    writer = batch_sink.BatchWriter(f"{tmp_path}/sink", 3)
    rows = [pa.RecordBatch.from_pydict({"id": pa.array(range(a, a + 4), pa.int64())}) for a in (0, 4)]
    lost, counted = writer.write(iter(rows)), writer.write(iter(rows))
    assert [n for _, n in counted.files] == [3, 3, 2] and len(files(f"{tmp_path}/sink")) == 6
    assert batch_sink.delivered(spark, f"{tmp_path}/sink").count() == 0  # nothing before the commit
    writer.commit([counted, writer.write(iter([])), None])
    assert not {f for f, _ in lost.files} & {f"{writer.job}/{f}" for f in files(f"{tmp_path}/sink")}
    got = batch_sink.read(spark, f"{tmp_path}/sink", spark.range(1).schema)
    assert sorted(r["id"] for r in got.collect()) == list(range(8))
    assert batch_sink.delivered(spark, f"{tmp_path}/sink").agg(F.sum("rows")).first()[0] == 8


def test_a_failed_job_delivers_nothing(spark, tmp_path):
    path, df = f"{tmp_path}/sink", spark.range(0, 400, numPartitions=4)
    batch_sink.deliver(df.where("id < 5"), path, batch=2)
    before = files(path)
    bad = df.withColumn("id", F.when(F.col("id") == 399, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        batch_sink.deliver(bad, path, batch=2)
    assert batch_sink.read(spark, path, df.schema).count() == 5
    writer = batch_sink.BatchWriter(path, 3)
    writer.write(iter([pa.RecordBatch.from_pydict({"id": pa.array([1], pa.int64())})]))  # a driver that was lost before its commit
    assert batch_sink.clear(spark, path) >= 1 and files(path) == before
    assert batch_sink.clear(spark, path) == 0 and batch_sink.read(spark, path, df.schema).count() == 5


def test_empty_and_null_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (1, "é"), (1, "é")], "id long, `odd name` string")
    batch_sink.deliver(df.limit(0), f"{tmp_path}/sink")
    assert batch_sink.delivered(spark, f"{tmp_path}/sink").count() == 0
    batch_sink.deliver(df, f"{tmp_path}/sink")
    assert sorted(batch_sink.read(spark, f"{tmp_path}/sink", df.schema).collect(), key=repr) == sorted(df.collect(), key=repr)
    with pytest.raises(ValueError, match="positive"):
        batch_sink.deliver(df, f"{tmp_path}/sink", batch=0)
