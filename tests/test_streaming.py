import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_load import write_day

from hourgrid.functions import calendar
from hourgrid.operators import checks, load
from hourgrid.plans.registry import EVENT_FACTS, EVENTS
from hourgrid.streaming import ingest

KEYS = ["time_id", "event_id"]


def facts(batch):
    return batch.select(calendar.time_key(F.col("ts")).alias("time_id"), "event_id", "user_id", "value")


def land(spark, folder, name, day, ids):
    rows = [(i, dt.datetime(2024, 1, day, i % 24, 10), i % 7, "view", i / 4) for i in ids]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def run(spark, tmp_path):
    def go(checkpoint="ck", files=1):
        stream = ingest.file_stream(spark, f"{tmp_path}/raw/*", EVENTS, files_per_batch=files)
        query = ingest.start_ingest(stream, facts, f"{tmp_path}/facts", EVENT_FACTS, KEYS, "time_id", f"{tmp_path}/{checkpoint}")
        query.awaitTermination()
        return len(query.recentProgress), spark.read.schema(EVENT_FACTS).parquet(f"{tmp_path}/facts")

    return go


def test_stream_equals_batch_and_takes_only_new_files(spark, tmp_path, run):
    raw = f"{tmp_path}/raw"
    land(spark, raw, "day1", 1, range(0, 300))
    land(spark, raw, "day2", 2, range(300, 500))
    _, stored = run()
    assert stored.count() == 500
    land(spark, raw, "day3", 3, range(500, 536))
    _, stored = run()
    want = facts(spark.read.schema(EVENTS).parquet(f"{raw}/*"))
    assert sorted(stored.collect()) == sorted(want.collect())


def test_redelivered_and_replayed_files_add_nothing(spark, tmp_path, run):
    raw = f"{tmp_path}/raw"
    land(spark, raw, "day1", 1, range(100))
    land(spark, raw, "day1_again", 1, range(50, 120))
    _, stored = run()
    assert stored.count() == 120
    _, stored = run(checkpoint="lost")  # the checkpoint is gone: every file comes again
    assert stored.count() == 120
    assert stored.select(*KEYS).distinct().count() == 120


def test_copies_within_one_batch_are_stored_once(spark, tmp_path, run):
    raw = f"{tmp_path}/raw"
    land(spark, raw, "day1", 1, list(range(20)) + [3] * 200)
    _, stored = run(files=10)
    assert stored.count() == 20


def test_a_null_key_is_an_error(spark, tmp_path):
    rows = spark.createDataFrame([(2024010100, None, 1, 1.0)], EVENT_FACTS)
    with pytest.raises(checks.GateError, match="null_keys: 1 rows"):
        ingest.append_unseen(spark, rows, f"{tmp_path}/facts", EVENT_FACTS, KEYS, "time_id")


def test_the_order_column_picks_among_copies(spark, tmp_path):
    path = f"{tmp_path}/facts"
    spark.createDataFrame([], EVENT_FACTS).write.parquet(path)
    rows = spark.createDataFrame([(2024010100, 1, 9, 1.0), (2024010100, 1, 2, 5.0), (2024010100, 1, 3, 4.0)], EVENT_FACTS)
    assert ingest.append_unseen(spark, rows, path, EVENT_FACTS, KEYS, "time_id", order="value") == 1
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2024010100, 1, 2, 5.0)]


def test_an_empty_source_gives_an_empty_table(spark, tmp_path, run):
    land(spark, f"{tmp_path}/raw", "day1", 1, [])
    _, stored = run()
    assert stored.count() == 0


def test_star_ingest_waits_for_all_streams_of_a_day(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/star"
    load.create_star(spark, root)

    def go():
        ingest.start_star_ingest(spark, raw, root, f"{tmp_path}/ck", files_per_batch=3).awaitTermination()
        return {t: load.read_table(spark, root, t).count() for t in load.TABLES}

    write_day(spark, f"{raw}/2024-01-01", dt.date(2024, 1, 1), hours=3)
    write_day(spark, f"{raw}/2024-01-02", dt.date(2024, 1, 2), hours=3, skip=("avg", "max"))
    assert go() == {"dim_time": 3, "dim_location": 3, "fact_weather": 9, "ledger": 1}
    assert go()["fact_weather"] == 9
    write_day(spark, f"{raw}/2024-01-02", dt.date(2024, 1, 2), hours=3, skip=("instant", "accum"))
    assert go() == {"dim_time": 6, "dim_location": 3, "fact_weather": 18, "ledger": 2}
