"""Session for tests and the benchmark, and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

import hourgrid


def local_session(cores: int | str = 8, app: str = "hourgrid", **conf: str) -> SparkSession:
    """A local session. On a cluster the session comes from the cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, else what ``setCheckpointDir`` was given.

    Without either it is an error, and so is a folder of one machine on a cluster of several.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    if named.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{named} lies on one machine: set spark.checkpoint.dir to a folder that all executors reach")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; two calls never share one."""
    path = f"{shared_folder(spark)}/hourgrid/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    for job in _jobs:
        job.append(path)
    return path


_jobs: list[list[str]] = []


@contextlib.contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at the end what was stored inside: for jobs that hand no stored frame to their caller."""
    made: list[str] = []
    _jobs.append(made)
    try:
        yield
    finally:
        _jobs[:] = [j for j in _jobs if j is not made]
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder, and read back from there.

    For frames that a job reads several times: the work behind them runs once, and a lost executor
    repeats a read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds this package to the files of the session's application, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    here = os.path.dirname(os.path.abspath(hourgrid.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="hourgrid-package-"), "hourgrid")
    shutil.make_archive(archive, "zip", os.path.dirname(here), os.path.basename(here))
    spark.sparkContext.addPyFile(f"{archive}.zip")
    _sent.add(app)
