"""Vector codes: each part of a vector by its nearest codebook entry, found in a tree of split points.

Vectors of whole numbers are cut into equal parts; each part position has a codebook, fitted by rounds of assignment and
exact averaging. Assignment searches a geometric near-neighbour access tree (GNAT) over the entries: a node has a few
entries as split points, each other entry belongs to its nearest split point, and for every split point and every group of
entries the range of their distances is stored. A query's distances to the split points rule out every group whose range is
farther from them than the best entry so far. Only what is strictly farther is ruled out, with square roots rounded
to the safe side, and what remains is compared by whole squared distances and, at a tie, by index; so the result
is that of comparing all entries.

A round is one pass over the vectors: each task sends the sums and counts of its entries, which add up to the next
codebooks. Nothing else leaves the tasks, and the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Split points of a node, and entries of a group that are compared without a further node.
SPLITS, GROUP = 4, 2
#: Labels whose totals are broadcast, some 20 bytes each; more are joined by shuffle, dealt out over so many salts.
BROADCAST_LABELS, SALTS = 200_000, 32
#: Relative error that covers the rounding of a square root and a subtraction.
SLACK = 2.0**-50
Books = list[list[list[int]]]


def finite(vector: str) -> Column:
    """Whether the vector is there and each component is there and finite."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(F.col(vector).isNotNull() & fine, F.lit(False))


def _squared(a: Sequence[int], b: Sequence[int]) -> int:
    return sum((x - y) * (x - y) for x, y in zip(a, b, strict=True))


def _root_up(x: int) -> int:
    return math.isqrt(x - 1) + 1 if x > 0 else 0


@dataclass
class Node:
    """Split points by index, and for each its group; ``ranges[i][j]``: squared distances of split i to group j."""

    splits: list[int]
    groups: list[Node | list[int] | None]
    ranges: list[list[tuple[int, int]]]


class Tree:
    """GNAT over the entries of one codebook."""

    def __init__(self, entries: list[list[int]]):
        self.entries = entries
        self.distance = [[_squared(a, b) for b in entries] for a in entries]
        everyone = list(range(len(entries)))
        self.root = self._node(everyone)
        # Queries of components up to ``limit`` and entries up to ``far`` have squared distances inside 64 bits. Farther entries
        # are nearest to no such query, as long as an entry lies within ``limit``.
        width = max(len(entries[0]), 1)
        self.limit = math.isqrt((1 << 62) // width) // (2 + 2 * _root_up(width))
        far = self.limit * (1 + 2 * _root_up(width))
        largest = [max(map(abs, e), default=0) for e in entries]
        self.has_near = min(largest) <= self.limit
        self.near = self._node([e for e in everyone if largest[e] <= far])
        self.array = np.array([e if x <= far else [0] * len(e) for e, x in zip(entries, largest, strict=True)], np.int64)

    def _node(self, members: list[int]) -> Node | list[int] | None:
        if len(members) <= GROUP:
            return members or None
        splits = members[:1]
        while len(splits) < min(SPLITS, len(members)):  # the member farthest from the split points so far
            rest = [m for m in members if m not in splits]
            splits.append(max(rest, key=lambda m: (min(self.distance[m][s] for s in splits), -m)))
        groups: list[list[int]] = [[] for _ in splits]
        for m in members:
            if m not in splits:
                groups[min(range(len(splits)), key=lambda i: (self.distance[m][splits[i]], i))].append(m)
        held = [[[self.distance[s][m] for m in group] for group in groups] for s in splits]
        return Node(splits, [self._node(g) for g in groups], [[(min(d, default=0), max(d, default=0)) for d in row] for row in held])

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance of each query, a row of components within ``limit``, if ``has_near``."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        at = np.full(len(queries), len(self.entries))

        def compare(on: np.ndarray, entry: int) -> np.ndarray:
            apart = queries[on] - self.array[entry]
            d = np.einsum("ij,ij->i", apart, apart)
            nearer = (d < best[on]) | ((d == best[on]) & (entry < at[on]))
            best[on[nearer]], at[on[nearer]] = d[nearer], entry
            return d

        def visit(node: Node | list[int] | None, on: np.ndarray) -> None:
            if not len(on) or node is None:
                return
            if isinstance(node, list):
                for entry in node:
                    compare(on, entry)
                return
            to_split = [np.sqrt(compare(on, s).astype(float)) for s in node.splits]
            for j, group in enumerate(node.groups):
                if group is None:
                    continue
                reach = np.sqrt(best[on].astype(float)) * (1 + SLACK)
                out = np.zeros(len(on), bool)
                for d, row in zip(to_split, node.ranges, strict=True):
                    low, high = math.sqrt(row[j][0]) * (1 - SLACK), math.sqrt(row[j][1]) * (1 + SLACK)
                    out |= np.maximum(d * (1 - SLACK) - high, low - d * (1 + SLACK)) * (1 - SLACK) > reach
                visit(group, on[~out])

        visit(self.near, np.arange(len(queries)))
        return at, best

    def nearest_of_any(self, query: Sequence[int]) -> tuple[int, int]:
        """The same for one query with components of any size."""
        best: tuple[int, int] | None = None

        def compare(entry: int) -> int:
            nonlocal best
            d = _squared(query, self.entries[entry])
            best = min(best, (d, entry)) if best else (d, entry)
            return d

        def visit(node: Node | list[int] | None) -> None:
            if node is None:
                return
            if isinstance(node, list):
                for entry in node:
                    compare(entry)
                return
            to_split = [compare(s) for s in node.splits]
            for j, group in enumerate(node.groups):
                reach = _root_up(best[0])
                if not any(
                    math.isqrt(d) - _root_up(row[j][1]) > reach or math.isqrt(row[j][0]) - _root_up(d) > reach
                    for d, row in zip(to_split, node.ranges, strict=True)
                ):
                    visit(group)

        visit(self.root)
        return best[1], best[0]


def whole(x: float, scale: int) -> int:
    """floor(scale * x) of a finite number, exactly."""
    top, bottom = float(x).as_integer_ratio()
    return scale * top // bottom


class _Batch:
    """Vectors of one Arrow batch as whole numbers; large ones apart."""

    def __init__(self, column: pa.Array, dim: int, scale: int, trees: list[Tree]):
        floats = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
        limit = min((t.limit for t in trees), default=0)
        fits = (np.abs(floats) < limit // scale).all(axis=1)
        if not all(t.has_near for t in trees):
            fits[:] = False
        self.small = np.flatnonzero(fits)
        self.large = np.flatnonzero(~fits)
        self.ints = np.floor(floats[self.small] * scale).astype(np.int64).reshape(len(self.small), len(trees), dim // len(trees))
        self.any = [[whole(x, scale) for x in floats[i]] for i in self.large]


def _limbs(x: int) -> Iterator[tuple[int, int]]:
    """A whole number as multiples of powers of 2^32, the greatest one signed: sums of many stay inside 64 bits."""
    at = 0
    while not -(1 << 31) <= x < 1 << 31:
        yield at, x & 0xFFFFFFFF
        x >>= 32
        at += 1
    yield at, x


def _sums(books: Books, scale: int):
    """Sums and counts of the parts of each entry, as limbs of one cell for each position and one for the count."""
    dim = sum(len(b[0]) for b in books)
    width = dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(b) for b in books]
        total = np.zeros((len(books), max(map(len, books)), width + 1), object)
        for batch in batches:
            held = _Batch(batch.column(0), dim, scale, trees)
            for p, tree in enumerate(trees):
                if len(held.small):
                    parts = held.ints[:, p]
                    at, _ = tree.nearest(parts)
                    for e in np.unique(at):
                        own = parts[at == e]
                        total[p, e] += np.append(own.sum(axis=0), len(own)).astype(object)
                for vector in held.any:
                    part = vector[p * width : (p + 1) * width]
                    total[p, tree.nearest_of_any(part)[0]] += np.array([*part, 1], object)
        rows = [(cell, limb, v) for cell, x in enumerate(total.ravel()) for limb, v in _limbs(int(x)) if v]
        cells, limbs, values = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(limbs, pa.int32()), pa.array(values, pa.int64())], ["cell", "limb", "value"])

    return run


def _next_books(vectors: DataFrame, books: Books, scale: int) -> Books:
    """Codebooks after one round: each entry the floor of its parts' mean; an entry without parts stays."""
    sums = vectors.select("embedding").mapInArrow(_sums(books, scale), "cell int, limb int, value long")
    width, most = len(books[0][0]), max(map(len, books))
    total = [0] * (len(books) * most * (width + 1))
    for r in sums.groupBy("cell", "limb").agg(F.sum("value").alias("value")).collect():
        total[r["cell"]] += r["value"] << 32 * r["limb"]
    out = []
    for p, book in enumerate(books):
        out.append([])
        for e, entry in enumerate(book):
            at = (p * most + e) * (width + 1)
            *summed, count = total[at : at + width + 1]
            out[-1].append([s // count for s in summed] if count else entry)
    return out


def _fitting(size: int) -> Column:
    return finite("embedding") & (F.size("embedding") == size)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books:
    """Codebooks by part, entry and position, from ``vectors`` (vec_id, embedding); empty without a fitting vector.

    They begin as the parts of the ``entries`` smallest vec_ids, of one id in the order of their vectors, nulls last. Fitting are
    vectors of finite components whose number is that of the first of them and a multiple of ``parts``.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    size = F.size("embedding")
    rows = vectors.where(finite("embedding") & (size > 0) & (size % parts == 0)).select("vec_id", "embedding")
    ordered = (F.col("vec_id").asc_nulls_last(), F.col("embedding"))
    first = [r["embedding"] for r in rows.orderBy(*ordered).limit(entries).collect()]
    if not first:
        return []
    dim = len(first[0])
    rows = rows.where(_fitting(dim))
    if any(len(v) != dim for v in first):
        first = [r["embedding"] for r in rows.orderBy(*ordered).limit(entries).collect()]
    width = dim // parts
    books = [[[whole(x, scale) for x in v[p * width : (p + 1) * width]] for v in first] for p in range(parts)]
    for _ in range(rounds):
        books = _next_books(rows, books, scale)
    return books


def _code(books: Books, scale: int, names: list[str]):
    dim = sum(len(b[0]) for b in books)
    width = dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(b) for b in books]
        for batch in batches:
            held = _Batch(batch.column("embedding"), dim, scale, trees)
            codes, errors = np.empty(batch.num_rows, object), np.empty(batch.num_rows, object)
            found = [tree.nearest(held.ints[:, p]) if len(held.small) else ((), ()) for p, tree in enumerate(trees)]
            if len(held.small):
                at = np.stack([a for a, _ in found], axis=1).astype(np.uint8)
                codes[held.small] = [row.tobytes().hex() for row in at]
                # a sum of parts may pass 64 bits where one part does not
                errors[held.small] = sum(d.astype(object) for _, d in found)
            for i, vector in zip(held.large, held.any, strict=True):
                near = [t.nearest_of_any(vector[p * width : (p + 1) * width]) for p, t in enumerate(trees)]
                codes[i], errors[i] = bytes(a for a, _ in near).hex(), sum(d for _, d in near)
            errors = [int(e) if e < 1 << 63 else None for e in errors]
            columns = [batch.column(n) for n in names] + [pa.array(codes.tolist(), pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "code", "error"])

    return run


def encode(vectors: DataFrame, books: Books, keep: Sequence[str] = ("vec_id",), scale: int = SCALE) -> DataFrame:
    """The columns ``keep`` of each finite vector with its ``code``, two hex digits for each part, and ``error``.

    ``error`` is the sum of the squared distances, null where it passes 64 bits. A vector whose length does not fit the
    codebooks has neither. Vectors that are null or hold a null or what is not finite have no row; null and repeated ids are kept.
    """
    names = [n for n in keep if n not in ("embedding", "code", "error")]
    types = dict(vectors.dtypes)
    held = vectors.where(finite("embedding")).select(*names, "embedding")
    dim = sum(len(b[0]) for b in books)
    fits = _fitting(dim) if books else F.lit(False)
    others = held.where(~fits).select(*names, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not books:
        return others
    shape = ", ".join([*(f"`{n}` {types[n]}" for n in names), "code string", "error long"])
    return held.where(fits).mapInArrow(_code(books, scale, names), shape).unionByName(others)


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows with the same label, nulls together, summed.

    Null where the sum or one of its errors passes 64 bits. The totals, one row for each label, are broadcast when
    they were counted to be few; many are joined by shuffle with the rows of a label dealt out over ``SALTS`` tasks.
    """
    coded = stored(coded, "codes")
    key, lost = F.col(label).alias("_label"), F.count_if(F.col("code").isNotNull() & F.col("error").isNull())
    total = F.when(lost == 0, F.try_sum("error"))
    totals = stored(coded.groupBy(key).agg(total.alias("label_error")), "label-errors")
    if totals.count() <= BROADCAST_LABELS:
        joined = coded.join(F.broadcast(totals), F.col(label).eqNullSafe(F.col("_label")))
    else:
        salted = coded.withColumn("_salt", F.pmod(F.xxhash64("code", "error", *coded.columns[:1]), F.lit(SALTS)))
        every = totals.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        joined = salted.join(every, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_of")))
    return joined.select(*coded.columns, "label_error")


def digest(books: Books) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
