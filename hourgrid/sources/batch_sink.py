"""A sink of small batches, each delivered once even if tasks fail and repeat.

Every attempt of a task writes its batches under names of its own and tells them, with their rows, in its commit message. The
commit lists what the messages of the attempts that counted say, in one file that appears at once, and deletes what other attempts
left. Readers and the audit go by these lists: the audit's numbers are those that the tasks counted while writing.
"""

from __future__ import annotations

import contextlib
import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from hourgrid import fixed_values as fv
from hourgrid.sources import versions

COMMITS = "job string, file string, rows long"
FORMAT = "hourgrid_batches"


@dataclass
class Written(WriterCommitMessage):
    """Files that a task wrote, with their rows."""

    files: list[tuple[str, int]]


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: int):
        self.path, self.batch, self.job = path.rstrip("/"), batch, uuid.uuid4().hex

    def _at(self, name: str) -> tuple[fs.FileSystem, str]:
        local = self.path.removeprefix("file:") if self.path.startswith("file:/") else self.path
        store, at = fs.FileSystem.from_uri(local if "://" in local else f"file:///{local.lstrip('/')}")
        return store, f"{at}/{name}"

    def _put(self, attempt: str, n: int, held: Sequence[pa.RecordBatch]) -> tuple[str, int]:
        name = f"{self.job}/{attempt}-{n:06d}.parquet"
        store, at = self._at(f"batches/{name}")
        rows = pa.Table.from_batches(held)
        pq.write_table(rows, at, filesystem=store)
        return name, rows.num_rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        attempt, files, held, size = uuid.uuid4().hex, [], [], 0
        store, at = self._at(f"batches/{self.job}")
        store.create_dir(at, recursive=True)
        for rows in iterator:
            while rows.num_rows:
                part = rows.slice(0, self.batch - size)
                rows, size = rows.slice(part.num_rows), size + part.num_rows
                held.append(part)
                if size == self.batch:
                    files.append(self._put(attempt, len(files), held))
                    held, size = [], 0
        if size:
            files.append(self._put(attempt, len(files), held))
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        files = [f for m in messages if m for f in m.files]
        store, at = self._at(f"batches/{self.job}")
        store.create_dir(at, recursive=True)
        known = {name.rsplit("/", 1)[-1] for name, _ in files}
        for found in store.get_file_info(fs.FileSelector(at)):
            if found.base_name not in known:
                store.delete_file(found.path)
        lines = "".join(json.dumps({"job": self.job, "file": name, "rows": n}) + "\n" for name, n in files)
        store, folder = self._at("commits")
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/_{self.job}.json") as out:  # names with _ are not read
            out.write(lines.encode())
        store.move(f"{folder}/_{self.job}.json", f"{folder}/{self.job}.json")

    def abort(self, messages: list[Written | None]) -> None:
        """Delete what the job wrote. A task that is being killed may still write: see ``clear``."""
        store, at = self._at(f"batches/{self.job}")
        with contextlib.suppress(OSError):  # no commit lists these files, so what is left is space only
            store.delete_dir(at)


class BatchSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("batches are only appended")
        return BatchWriter(self.options["path"], int(self.options["batch"]))


def deliver(df: DataFrame, path: str, batch: int = fv.INSERT_BATCH) -> None:
    """Append ``df`` in files of at most ``batch`` rows; either all of it is delivered, once, or nothing."""
    if batch < 1:
        raise ValueError("batch must be positive")
    # by value, so that executors need no package for it
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        df.sparkSession.dataSource.register(BatchSource)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
    df.write.format(FORMAT).mode("append").option("batch", batch).save(path)


def delivered(spark: SparkSession, path: str) -> DataFrame:
    """The audit: each delivered file (job, file) with the rows that its task counted."""
    if not any(n.endswith(".json") and n[0] != "_" for n in versions.Folder(spark, path).names("commits")):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).json(f"{path}/commits")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All delivered rows."""
    files = sorted(r["file"] for r in delivered(spark, path).collect())
    return spark.read.schema(schema).parquet(*[f"{path}/batches/{f}" for f in files]) if files else spark.createDataFrame([], schema)


def clear(spark: SparkSession, path: str) -> int:
    """Delete what broken deliveries left, and return how many those were. No delivery may be running."""
    folder = versions.Folder(spark, path)
    known = {n.removesuffix(".json") for n in folder.names("commits")}
    broken = [job for job in folder.names("batches") if job not in known]
    for job in broken:
        folder.delete(f"batches/{job}")
    return len(broken)
