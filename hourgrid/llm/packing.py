"""Packing by power-of-two pieces: no sequence crosses documents and none needs padding.

The ids of a document, ``n`` of them, are cut into ``n // size`` pieces of the full size and one piece for
each binary digit of the rest, the longest first. Pieces of one length form a bucket, from which batches
of equal length are drawn; each piece is a sequence by itself, whose length is a power of two. Documents
are cut by the tasks that read them, so nothing is shuffled.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm import pretokens

END_ID = 1
#: Pre-tokens that a task remembers, documents cut at a time, and new pre-tokens encoded at a time.
MEMO_ENTRIES, DOCS, TOGETHER = 700_000, 256, 20_000
#: Pre-tokens that a worker remembers from task to task, some 25 MB.
KEPT_ENTRIES = 150_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PIECES_IDS = PIECES + ", ids array<int>"


def binary_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids, the longest first; ``size`` is a power of two."""
    rest = n % size
    return [size] * (n // size) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


class _Memo(dict):
    """Ids of pre-tokens as little-endian bytes; emptied when it holds ``MEMO_ENTRIES``."""

    def __init__(self, cut: pretokens.Cutter):
        super().__init__()
        self.cut = cut
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in cut.special.items()}
        self.update(self.special)

    def learn(self, pieces: set[str]) -> None:
        new = pieces - self.keys()
        if len(self) + len(new) > MEMO_ENTRIES:
            self.clear()
            self.update(self.special)
            new = pieces - self.keys()
        new = list(new)
        for a in range(0, len(new), TOGETHER):
            some = new[a : a + TOGETHER]
            self.update(zip(some, self.cut.encode_words(some), strict=True))

    def shrink(self) -> None:
        """Forget all but the ``KEPT_ENTRIES`` that came first, among them most of the frequent ones."""
        kept = list(itertools.islice(self.items(), KEPT_ENTRIES))
        self.clear()
        self.update(self.special)
        self.update(kept)


@functools.cache
def _memo(path: str) -> _Memo:
    """One memo for each worker process and vocabulary."""
    return _Memo(pretokens.cutter(path))


def _pack(path: str, size: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()
    names = [f.split(" ")[0] for f in (PIECES_IDS if with_ids else PIECES).split(", ")]
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids

    def packed(batch: pa.RecordBatch, memo: _Memo) -> pa.RecordBatch:
        out: list[tuple] = []
        for a in range(0, batch.num_rows, DOCS):
            part = batch.slice(a, DOCS)
            texts = [memo.cut.in_order(t.as_py() or "") for t in part.column(1)]
            memo.learn(set().union(*texts))
            for doc_id, pieces in zip(part.column(0).to_pylist(), texts, strict=True):
                ids = b"".join(map(memo.__getitem__, pieces)) + end
                start, n = 0, len(ids) // 4
                for length in binary_lengths(n, size):
                    piece = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, start, length, zlib.crc32(piece), n)
                    out.append((*row, np.frombuffer(piece, "<u4").astype("i4")) if with_ids else row)
                    start += length
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(path)
        try:
            for batch in batches:
                yield packed(batch, memo)
        finally:
            memo.shrink()

    return run


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket.

    ``bucket`` is the binary logarithm of the length, and ``sequence_id`` modulo 64 too; ``with_ids`` adds
    the ids. Every document, an empty or null text too, ends in ``end_id`` and so has one piece at least. A
    null or repeated doc_id is kept: each row is cut by itself. Other columns are ignored.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = rows.mapInArrow(_pack(path, size, end_id, with_ids), PIECES_IDS if with_ids else PIECES)
    bucket = F.round(F.log2("length")).cast("long")
    return pieces.withColumns(
        {
            "bucket": bucket,
            "sequence_id": F.monotonically_increasing_id() * 64 + bucket,
            "offset": F.lit(0).cast("long"),
        }
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Pieces written to one folder for each bucket, from which batches of one length are read."""
    pieces.write.partitionBy("bucket").parquet(path)
