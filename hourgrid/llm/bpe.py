"""Byte-pair encoding and decoding by a contiguous array of parts and ranks.

A pre-token is held as the ids of its parts and, beside them, the rank of each adjacent pair. The pair of least rank,
the leftmost of several, is merged by deleting the boundary between its parts, and only the ranks of its two neighbours
are looked up anew, until no adjacent pair can be merged. For the short words that texts are made of, scanning an
array for its minimum is faster than any ordered structure. A pre-token of more than ``LONG`` bytes keeps its parts in a
linked list and its pairs in a heap, which merges the same pairs in the same order without a scan for each.

Texts are cut into pre-tokens by the tasks that read them, so nothing is shuffled; each task remembers the ids of
a bounded number of pre-tokens.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm import pretokens

#: Pre-tokens whose ids a task remembers, and those that are too long to be remembered, or to be scanned.
MEMO_ENTRIES, LONG = 400_000, 128
#: Bytes of texts in one batch of results.
BATCH_BYTES = 16 << 20
NO_RANK = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Bytes with a visible Latin-1 character stand for themselves, the others, in order, for the characters from 256 on.
    """
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Codec:
    """Merges, and bytes of each id, of a byte-level vocabulary file.

    The driver and the tasks read the file at ``path``, so it has to be there on every machine.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        vocabulary: dict[str, int] = said["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.first = [vocabulary[letter] for letter in letters]
        #: (id, id) to rank and id of the merged pair, as one number.
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(said["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocabulary[a], vocabulary[b]] = rank << 32 | vocabulary[a + b]
        added = {t["id"]: t["content"] for t in said["added_tokens"]}
        self.special = {content: i for i, content in added.items()}
        self.bytes_of = [b""] * (max([*vocabulary.values(), *added]) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(map(byte_of.__getitem__, token))
        for i, content in added.items():
            self.bytes_of[i] = content.encode()
        self.cut = pretokens.cutter(path)
        self.memo: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token."""
        return self.merge_short(word) if len(word) <= LONG else self.merge_long(word)

    def merge_short(self, word: bytes) -> list[int]:
        merges = self.merges
        parts = list(map(self.first.__getitem__, word))
        # ranks[i] is that of parts i and i + 1; the last has no neighbour
        ranks = [merges.get(pair, NO_RANK) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            parts[i] = least & 0xFFFFFFFF
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = merges.get((parts[i], parts[i + 1]), NO_RANK)
            if i:
                ranks[i - 1] = merges.get((parts[i - 1], parts[i]), NO_RANK)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        merges, n = self.merges, len(word)
        parts = list(map(self.first.__getitem__, word))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in merges]
        heapq.heapify(heap)
        while heap:
            least, i = heapq.heappop(heap)
            j = after[i]
            # an entry is stale when its part is gone or one of its two parts has changed since
            if parts[i] < 0 or j == n or merges.get((parts[i], parts[j])) != least:
                continue
            parts[i], parts[j] = least & 0xFFFFFFFF, -1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (found := merges.get((parts[i], parts[j]))) is not None:
                    heapq.heappush(heap, (found, i))
            if (h := before[i]) >= 0 and (found := merges.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (found, h))
        return [p for p in parts if p >= 0]

    def ids_of(self, piece: str) -> bytes:
        """Ids of a pre-token or special string, as little-endian unsigned 32-bit integers."""
        found = self.memo.get(piece)
        if found is None:
            ids = [self.special[piece]] if piece in self.special else self.merge(piece.encode())
            found = np.array(ids, "<u4").tobytes()
            if len(piece) <= LONG:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.ids_of, self.cut.in_order(text)))

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters, an id beyond the vocabulary nothing."""
        numbers, known = np.frombuffer(ids, "<u4"), len(self.bytes_of)
        if len(numbers) and int(numbers.max()) >= known:
            numbers = numbers[numbers < known]
        return b"".join(map(self.bytes_of.__getitem__, numbers.tolist())).decode("utf-8", "replace")


@functools.cache
def codec(path: str) -> Codec:
    """One codec for each worker process and vocabulary."""
    return Codec(path)


def _in_parts(rows: Iterator[tuple], kinds: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """Rows, whose last cell is the largest, as batches of bounded bytes."""

    def batch(some: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*some, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[-1] or b"")
        if size >= BATCH_BYTES:
            yield batch(held)
            held, size = [], 0
    yield batch(held)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_tokens, ids (little-endian unsigned 32-bit integers).

    Equal to the tokenizers library's ids for the vocabulary file at ``path``, without added special tokens; a special
    string in a text is one id, as its default has it. A null text counts as empty and has no ids. Null and
    repeated ids of documents are kept: each row is encoded by itself. Other columns are ignored.
    """
    kinds = [("doc_id", pa.int64()), ("ids", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            ids = (own.encode(t.as_py() or "") for t in b.column(1))
            yield from _in_parts(zip(b.column(0).to_pylist(), ids, strict=True), kinds)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = rows.mapInArrow(run, "doc_id long, ids binary")
    return made.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (any columns, ids as ``encode`` gives them) with ``text`` in the place of ``ids``.

    Null ids give null. What the ids spell that is no UTF-8 becomes replacement characters; special tokens give their strings.
    """
    others = [c for c in encoded.columns if c not in ("ids", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            kinds = [(n, b.schema.field(n).type) for n in others] + [("text", pa.string())]
            texts = (None if i.as_py() is None else own.decode(i.as_py()) for i in b.column("ids"))
            cells = [b.column(n).to_pylist() for n in others]
            yield from _in_parts(zip(*cells, texts, strict=True), kinds)

    types = dict(encoded.dtypes)
    return encoded.select(*others, "ids").mapInArrow(run, ", ".join([*(f"`{n}` {types[n]}" for n in others), "text string"]))
