"""Token counts: pieces are counted once for each distinct pre-token.

Each task cuts its documents into pre-tokens and folds a chunk of documents at a time into the frequencies of
each distinct pre-token in each document. The frequencies are dealt out by the hash of the pre-token, packed, one
row for each chunk and bucket. There, all chunks meet that hold a pre-token: it is encoded once, its number of pieces
is joined to the frequencies, and each chunk gets the sums of its documents, packed again, which a last step adds up. No
ids are kept. A frequent pre-token is one entry a chunk, however often it occurs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm import pretokens
from hourgrid.session import stored

#: Pre-tokens of a chunk, counted with repetitions.
CHUNK = 2_000_000
#: Pre-tokens whose counts a task remembers.
MEMO_ENTRIES = 400_000
#: A bucket's frequencies; bucket -1 describes the chunk's documents.
BUCKET = "bucket int, chunk long, packed binary"


def _packed(*arrays: np.ndarray, text: bytes = b"") -> bytes:
    head = np.array([len(a) for a in arrays], "<u4").tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays) + text, 1)


def _unpacked(packed: bytes, *kinds: str) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.decompress(packed)
    at, out = 4 * len(kinds), []
    for kind, n in zip(kinds, np.frombuffer(raw, "<u4", len(kinds)), strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out, raw[at:]


class _Chunk:
    """Documents and their pre-tokens, as numbers in the order of first use."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.docs: list[np.ndarray] = []
        self.size = 0

    def add(self, pieces: list[str]) -> None:
        number = self.number
        self.docs.append(np.fromiter((number.setdefault(p, len(number)) for p in pieces), np.uint32, len(pieces)))
        self.size += len(pieces) + 1

    def rows(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """For each bucket its pre-tokens, with their documents and how often each holds them."""
        names = [p.encode() for p in self.number]
        place = np.repeat(np.arange(len(self.docs), dtype=np.uint64), [len(d) for d in self.docs])
        keys = np.concatenate(self.docs).astype(np.uint64) << np.uint64(32) | place
        keys, times = np.unique(keys, return_counts=True)
        piece = (keys >> np.uint64(32)).astype(np.int64)
        bucket = np.fromiter((zlib.crc32(n) % buckets for n in names), np.int64, len(names))
        order = np.argsort(bucket[piece], kind="stable")
        piece, at, times = piece[order], (keys[order] & np.uint64(2**32 - 1)).astype("<u4"), times[order].astype("<u4")
        ends = np.searchsorted(bucket[piece], np.arange(buckets), side="right")
        for b, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if end > start:
                own, held = np.unique(piece[start:end], return_counts=True)
                texts = [names[p] for p in own]
                sizes = np.array([len(t) for t in texts], "<u4")
                yield b, _packed(sizes, held.astype("<u4"), at[start:end], times[start:end], text=b"".join(texts))


def _cut(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, chunk = pretokens.cutter(path), _Chunk()
        doc_ids: list[int | None] = []
        n_bytes: list[int] = []
        number = TaskContext.get().partitionId() << 32

        def rows() -> pa.RecordBatch:
            known = np.array([d is not None for d in doc_ids], "<i8")
            about = _packed(known, np.array([d or 0 for d in doc_ids], "<i8"), np.array(n_bytes, "<i8"))
            made = [(-1, about), *(chunk.rows(buckets) if chunk.number else ())]
            b, packed = zip(*made, strict=True)
            chunks = pa.array([number] * len(made), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), chunks, pa.array(packed, pa.binary())], ["bucket", "chunk", "packed"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                special, pieces = cut.cut(text)
                doc_ids.append(doc_id)
                n_bytes.append(len(text.encode()))
                chunk.add(pieces + special)
                if chunk.size >= CHUNK:
                    yield rows()
                    chunk, doc_ids, n_bytes, number = _Chunk(), [], [], number + 1
        if doc_ids:
            yield rows()

    return run


def _count(path: str):
    """Sums for the documents of each chunk, from the buckets of a task; rows come bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, now, counts = pretokens.cutter(path), None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, chunk = batch.column("bucket")[i].as_py(), batch.column("chunk")[i]
                if bucket != now or len(counts) > MEMO_ENTRIES:
                    now, counts = bucket, {}
                (sizes, held, at, times), text = _unpacked(batch.column("packed")[i].as_py(), "<u4", "<u4", "<u4", "<u4")
                ends = np.cumsum(sizes)
                pieces = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                new = [p for p in pieces if p not in counts]
                counts.update(zip(new, map(len, cut.encode([p.decode() for p in new])), strict=True))
                n = np.fromiter(map(counts.__getitem__, pieces), np.int64, len(pieces))
                sums = np.bincount(at, times * np.repeat(n, held)).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([chunk.as_py()], pa.int64()), pa.array([_packed(sums)], pa.binary())],
                    ["bucket", "chunk", "packed"],
                )

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each chunk with the sums of all buckets; rows come chunk by chunk, its documents first."""

    def done(docs: tuple, sums: np.ndarray) -> pa.RecordBatch:
        known, doc_ids, n_bytes = docs
        columns = [pa.array(doc_ids, pa.int64(), mask=known == 0), pa.array(n_bytes), pa.array(sums)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    docs, sums = None, np.empty(0, np.int64)
    for batch in batches:
        for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed"), strict=True):
            if bucket < 0:
                if docs is not None:
                    yield done(docs, sums)
                docs = tuple(_unpacked(packed.as_py(), "<i8", "<i8", "<i8")[0])
                sums = np.zeros(len(docs[0]), np.int64)
            else:
                (some,), _ = _unpacked(packed.as_py(), "<i8")
                sums[: len(some)] += some
    if docs is not None:
        yield done(docs, sums)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty and has no tokens; a null or repeated doc_id is kept as it is, since rows
    are told apart by their place. Special strings in a text are one token each, as the library's default
    has it. Other columns are ignored.
    """
    spark = docs.sparkSession
    # as many buckets as a shuffle has partitions, so that a bucket's distinct pre-tokens fit into a task
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut(path, buckets), BUCKET)
    chunks = stored(cut, "pretokens")
    held = chunks.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket")
    parts = held.mapInArrow(_count(path), BUCKET).unionByName(chunks.where("bucket < 0"))
    parts = parts.repartition("chunk").sortWithinPartitions("chunk", "bucket").select("bucket", "packed")
    sums = parts.mapInArrow(_add_up, "doc_id long, n_bytes long, n_tokens long")
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
