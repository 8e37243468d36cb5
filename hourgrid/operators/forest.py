"""Random forest of regression trees: wide nodes by histograms over all tasks, small ones each in a single task.

``RandomForestRegressor`` sends statistics of all features and bins for each node of each pass, to the last level: with 100 trees
of depth 15 some three million nodes, most of a few rows. Here that is done only for nodes of more than ``LOCAL_ROWS`` rows. A
node of fewer is grown to its leaves by one task, which gets its rows; while the whole table has fewer, a task grows some trees.

The method is the same: features cut into at most ``maxBins`` bins, a bag of rows for each tree with Poisson weights, all features
tried at each node, the cut that lowers the variance most, the mean as prediction, and the mean of the trees as the forest's.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import session

#: Rows of a node, or of a whole table, up to which one task holds them: 19 bytes a row with 11 features, and some 100 for those of a tree.
LOCAL_ROWS = 4_000_000
#: Rows, counted once a tree, that are shuffled at a time when nodes are dealt out.
MOVED_ROWS = 100_000_000
#: Accuracy of the sketch that bins are cut by: one part of all rows in so many.
SKETCH = 10_000
#: With this set, Spark deletes what a query shuffled as soon as it ends, not when the driver happens to collect its garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The cut of a leaf, beyond all bins.
LEAF = 255

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
"""feature, cut, left and value of each node, the root first. A row goes to ``left`` if its bin is ``cut`` at most, else to the node
after it. A leaf leads to itself, with the cut ``LEAF``."""

BLOCK = "part int, chunk int, n int, bins binary, y binary"
BAGGED = "tree int, node int, part int, chunk int, n int, bins binary, y binary, w binary"
GROWN = "tree int, node int, feature binary, cut binary, left binary, value binary"
COUNTED = "tree int, node int, part int, sums binary"
CUT = "tree int, node int, feature int, cut int, n_left double, n_right double, value_left double, value_right double"


# --- bins ---------------------------------------------------------------------------------


def thresholds(rows: DataFrame, features: int, max_bins: int) -> list[np.ndarray]:
    """For each of the ``features`` of ``x`` the upper ends of its bins but the last: between values if these are few, else quantiles."""
    x = [F.col("x")[i] for i in range(features)]
    at = [k / max_bins for k in range(1, max_bins)]
    found = rows.agg(
        *[F.percentile_approx(c, at, SKETCH).alias(f"q{i}") for i, c in enumerate(x)],
        *[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)],
    ).first()
    few = [i for i in range(features) if found[f"n{i}"] <= 2 * max_bins]
    sets = rows.agg(F.count(F.lit(1)), *[F.collect_set(x[i]).alias(f"s{i}") for i in few]).first() if few else {}
    ends = []
    for i in range(features):
        values = np.unique(sets[f"s{i}"]) if i in few else np.array([])
        if 0 < len(values) <= max_bins:
            low, high = values[:-1], values[1:]
            with np.errstate(invalid="ignore"):
                middle = low + (high - low) / 2
            ends.append(np.where(np.isfinite(middle) & (middle < high), middle, low))
        else:
            ends.append(np.unique(found[f"q{i}"]))
    return ends


def binned(x: pa.Array, ends: Sequence[np.ndarray]) -> np.ndarray:
    """The bins of an array of feature arrays, one row for each feature."""
    flat = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(ends))
    return np.stack([np.searchsorted(e, flat[:, i]) for i, e in enumerate(ends)]).astype(np.uint8)


# --- growing ------------------------------------------------------------------------------


def bag(seed: int, tree: int, part: int, chunk: int, n: int) -> np.ndarray:
    """How often the tree's bag has each of the ``n`` rows of a block."""
    return np.random.default_rng([seed, tree, part, chunk]).poisson(1.0, n).astype(np.uint8)


def best_cut(n: np.ndarray, y: np.ndarray, total_n: np.ndarray, total_y: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the last bin of the left side, and the score, which must exceed ``least``: else ``LEAF``.

    ``n`` and ``y`` have the counts and sums of each node's bins. The variance falls as the squared sums over counts rise.
    """
    n, y = n[:, :-1].cumsum(1), y[:, :-1].cumsum(1)
    right_n, right_y = total_n[:, None] - n, total_y[:, None] - y
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((n > 0) & (right_n > 0), y * y / n + right_y * right_y / right_n, -np.inf)
    cut = score.argmax(1)
    score = score[np.arange(len(cut)), cut]
    return np.where(score > least, cut, LEAF), score


def no_cut(n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The score of the nodes as they are, and as much as rounding may add to it."""
    return y * y / n * (1 + 1e-12)


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, levels: int, n_bins: Sequence[int]) -> Tree:
    """The tree of rows with weights ``w``, of ``levels`` levels below its root at most, grown level by level."""
    wy, made, first, k = w * y, [], 0, 1
    at = np.zeros(len(y), np.intp)
    for level in range(levels + 1):
        n, s = np.bincount(at, w, k), np.bincount(at, wy, k)
        feature, cut, best = np.zeros(k, np.uint8), np.full(k, LEAF, np.uint8), no_cut(n, s)
        for i, b in enumerate(n_bins if level < levels else ()):
            if b > 1:
                key = at * b + bins[i]
                found, score = best_cut(*[np.bincount(key, v, k * b).reshape(k, b) for v in (w, wy)], n, s, best)
                better = found != LEAF
                feature[better], cut[better], best[better] = i, found[better], score[better]
        split = cut != LEAF
        left = np.arange(first, first + k, dtype=np.int32)
        left[split] = first + k + 2 * np.arange(split.sum())
        made.append((feature, cut, left, s / n))
        if not split.any():
            break
        if not (kept := split[at]).all():
            bins, at, w, wy = bins[:, kept], at[kept], w[kept], wy[kept]
        right = bins[feature[at], np.arange(len(at))] > cut[at]
        at = 2 * (split.cumsum() - 1)[at] + right
        first, k = first + k, 2 * int(split.sum())
    return tuple(np.concatenate(c) for c in zip(*made, strict=True))


def reached(tree: Tree, bins: np.ndarray, levels: int) -> np.ndarray:
    """The node in which each row ends."""
    feature, cut, left, _ = tree
    at, rows = np.zeros(bins.shape[1], np.intp), np.arange(bins.shape[1])
    for _ in range(levels):
        at = left[at] + (bins[feature[at], rows] > cut[at])
    return at


def grafted(tree: Tree, node: int, sub: Tree) -> Tree:
    """``tree`` with ``sub`` in place of one of its leaves."""
    to = np.arange(len(tree[0]) - 1, len(tree[0]) - 1 + len(sub[0]), dtype=np.int32)
    to[0] = node
    sub = (sub[0], sub[1], to[sub[2]], sub[3])
    for old, new in zip(tree, sub, strict=True):
        old[node] = new[0]
    return tuple(np.concatenate([old, new[1:]]) for old, new in zip(tree, sub, strict=True))


def _block(row: dict, features: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["bins"], np.uint8).reshape(features, row["n"]), np.frombuffer(row["y"])


def _rows(blocks: pa.Table | pa.RecordBatch) -> list[dict]:
    """The blocks by their place, without a copy of what they hold."""
    names = blocks.column_names
    rows = [dict(zip(names, r, strict=True)) for r in zip(*blocks.columns, strict=True)]
    plain = [{c: v.as_buffer() if pa.types.is_binary(v.type) else v.as_py() for c, v in r.items()} for r in rows]
    return sorted(plain, key=lambda r: (r["part"], r.get("chunk")))


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _grown_row(tree: int, node: int, grown: Tree) -> tuple:
    return tree, node, *[a.tobytes() for a in grown]


def _tree(row: dict) -> Tree:
    return tuple(np.frombuffer(row[c], t) for c, t in (("feature", np.uint8), ("cut", np.uint8), ("left", np.int32), ("value", np.float64)))


@contextlib.contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


class _Growth:
    """Grows the trees over stored blocks of binned rows."""

    def __init__(self, blocks: DataFrame, n_bins: list[int], trees: int, depth: int, seed: int, memory_mb: int):
        self.blocks, self.n_bins, self.trees, self.depth, self.seed, self.memory = blocks, n_bins, trees, depth, seed, memory_mb << 20

    def run(self) -> list[Tree]:
        if self.blocks.agg(F.sum("n")).first()[0] <= LOCAL_ROWS:
            return [tree for _, _, tree in self.whole_trees()]
        tops, ends = self.top_levels()
        for t, node, sub in self.parts(tops, ends):
            tops[t] = grafted(tops[t], node, sub)
        return tops

    def collected(self, grown: DataFrame) -> list[tuple[int, int, Tree]]:
        """What the tasks have grown, in order: written first, so that the driver takes it up task by task."""
        rows = session.stored(grown, "trees").toLocalIterator()
        return sorted(((r["tree"], r["node"], _tree(r)) for r in rows), key=lambda r: r[:2])

    def whole_trees(self) -> list[tuple[int, int, Tree]]:
        """All trees, each task growing some of them from all rows."""
        spark, trees, depth, seed, n_bins = self.blocks.sparkSession, self.trees, self.depth, self.seed, self.n_bins
        tasks = min(trees, max(spark.sparkContext.defaultParallelism, 8))

        def grow_some(key: tuple, rows: pa.Table) -> pa.Table:
            found = _rows(rows)
            blocks = [_block(r, len(n_bins)) for r in found]
            bins, y = np.concatenate([b for b, _ in blocks], axis=1), np.concatenate([y for _, y in blocks])
            at, made = [(r["part"], r["chunk"], r["n"]) for r in found], []
            for t in range(key[0].as_py(), trees, tasks):
                w = np.concatenate([bag(seed, t, *a) for a in at])
                some = np.flatnonzero(w)
                if not len(some):  # a bag of few rows may be empty
                    some, w = np.arange(len(y)), np.ones(len(y))
                made.append(_grown_row(t, 0, grow(bins[:, some], y[some], w[some].astype(float), depth, n_bins)))
            return pa.Table.from_batches([_batch(GROWN, made)])

        dealt = self.blocks.crossJoin(F.broadcast(spark.range(tasks).select(F.col("id").cast("int").alias("task"))))
        return self.collected(dealt.repartitionByRange(tasks, "task").groupBy("task").applyInArrow(grow_some, GROWN))

    def top_levels(self) -> tuple[list[Tree], list[dict[int, int]]]:
        """The trees down to nodes of at most ``LOCAL_ROWS`` rows, and the level of each of these nodes, which are still to be grown."""
        tops = [[[0], [LEAF], [0], [0.0]] for _ in range(self.trees)]
        wide, ends = [[0] for _ in tops], [{} for _ in tops]
        held = max(1, self.memory // (16 * sum(self.n_bins)))  # nodes whose counts and sums a task may hold
        for level in range(self.depth):
            todo = [(t, node) for t in range(self.trees) for node in wide[t]]
            wide = [[] for _ in tops]
            for i in range(0, len(todo), held):
                for r in self.cuts(tops, todo[i : i + held], level):
                    t, node, top = r["tree"], r["node"], tops[r["tree"]]
                    if r["cut"] == LEAF:
                        continue
                    top[0][node], top[1][node], top[2][node] = r["feature"], r["cut"], len(top[0])
                    for side in ("left", "right"):
                        child = len(top[0])
                        for c, v in zip(top, (0, LEAF, child, r[f"value_{side}"]), strict=True):
                            c.append(v)
                        if level + 1 < self.depth:
                            if r[f"n_{side}"] > LOCAL_ROWS:
                                wide[t].append(child)
                            else:
                                ends[t][child] = level + 1
        types = np.uint8, np.uint8, np.int32, np.float64
        return [tuple(np.array(c, k) for c, k in zip(top, types, strict=True)) for top in tops], ends

    def cuts(self, tops: list, nodes: list[tuple[int, int]], level: int) -> list:
        """The best cut of each of the nodes, which are some of one level: their bins are counted by all tasks."""
        n_bins, seed, places = self.n_bins, self.seed, {}
        for t, node in nodes:
            places.setdefault(t, []).append(node)
        types = np.uint8, np.uint8, np.int32, np.float64
        some = {t: (tuple(np.array(c, k) for c, k in zip(tops[t], types, strict=True)), np.array(found)) for t, found in places.items()}
        starts = np.concatenate([[0], np.cumsum(n_bins)])

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            sums = {t: np.zeros((len(found), 2, starts[-1])) for t, (_, found) in some.items()}
            for row in (r for b in batches for r in _rows(b)):
                bins, y = _block(row, len(n_bins))
                for t, (tree, found) in some.items():
                    w = bag(seed, t, row["part"], row["chunk"], row["n"]).astype(float)
                    number = np.full(len(tree[0]), -1)
                    number[found] = np.arange(len(found))
                    at = number[reached(tree, bins, level)]
                    kept = np.flatnonzero((at >= 0) & (w > 0))
                    at, weights = at[kept], (w[kept], w[kept] * y[kept])
                    for i, b in enumerate(n_bins):
                        key = at * b + bins[i, kept]
                        for j, v in enumerate(weights):
                            sums[t][:, j, starts[i] : starts[i + 1]] += np.bincount(key, v, len(found) * b).reshape(-1, b)
            for t, (_, found) in some.items():
                for node, s in zip(found, sums[t], strict=True):
                    yield _batch(COUNTED, [(t, int(node), part, s.tobytes())])

        def cut(key: tuple, rows: pa.Table) -> pa.Table:
            found = _rows(rows)
            n, y = sum(np.frombuffer(r["sums"]).reshape(2, -1) for r in found)[:, None, :]
            total_n, total_y = n[:, : n_bins[0]].sum(1), y[:, : n_bins[0]].sum(1)
            best, made = no_cut(total_n, total_y), (0, LEAF, 0.0, 0.0, 0.0, 0.0)
            for i in range(len(n_bins)):
                own = slice(starts[i], starts[i + 1])
                c, score = best_cut(n[:, own], y[:, own], total_n, total_y, best) if n_bins[i] > 1 else ([LEAF], best)
                if c[0] != LEAF:
                    best, upto = score, slice(starts[i], starts[i] + int(c[0]) + 1)
                    left_n, left_y = n[0, upto].sum(), y[0, upto].sum()
                    right_n, right_y = total_n[0] - left_n, total_y[0] - left_y
                    made = (i, int(c[0]), left_n, right_n, left_y / left_n, right_y / right_n)
            return pa.Table.from_batches([_batch(CUT, [(key[0].as_py(), key[1].as_py(), *made)])])

        return self.blocks.mapInArrow(count, COUNTED).groupBy("tree", "node").applyInArrow(cut, CUT).collect()

    def parts(self, tops: list[Tree], ends: list[dict[int, int]]) -> Iterator[tuple[int, int, Tree]]:
        """What grows from the ``ends``: the rows of each go to one task, those of some trees at a time."""
        at_once = max(1, MOVED_ROWS // self.blocks.agg(F.sum("n")).first()[0])
        todo = [t for t in range(self.trees) if ends[t]]
        for first in range(0, len(todo), at_once):
            yield from self.parts_of({t: (tops[t], ends[t]) for t in todo[first : first + at_once]})

    def parts_of(self, some: dict[int, tuple[Tree, dict[int, int]]]) -> list[tuple[int, int, Tree]]:
        n_bins, seed, depth = self.n_bins, self.seed, self.depth

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in (r for b in batches for r in _rows(b)):
                bins, y = _block(row, len(n_bins))
                for t, (tree, ends) in some.items():
                    w = bag(seed, t, row["part"], row["chunk"], row["n"])
                    at, made = reached(tree, bins, max(ends.values())), []
                    for node in ends:
                        if len(kept := np.flatnonzero((at == node) & (w > 0))):
                            held = bins[:, kept].tobytes(), y[kept].tobytes(), w[kept].tobytes()
                            made.append((t, node, row["part"], row["chunk"], len(kept), *held))
                    yield _batch(BAGGED, made)

        def grow_one(key: tuple, rows: pa.Table) -> pa.Table:
            t, node, found = key[0].as_py(), key[1].as_py(), _rows(rows)
            blocks = [_block(r, len(n_bins)) for r in found]
            bins, y = np.concatenate([b for b, _ in blocks], axis=1), np.concatenate([y for _, y in blocks])
            w = np.concatenate([np.frombuffer(r["w"], np.uint8) for r in found]).astype(float)
            grown = grow(bins, y, w, depth - some[t][1][node], n_bins)
            return pa.Table.from_batches([_batch(GROWN, [_grown_row(t, node, grown)])])

        return self.collected(self.blocks.mapInArrow(deal, BAGGED).groupBy("tree", "node").applyInArrow(grow_one, GROWN))


# --- estimator and model ------------------------------------------------------------------


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree below its root", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, 255 at most", TypeConverters.toInt)
    maxMemoryInMB = Param(Params._dummy(), "maxMemoryInMB", "counts and sums of bins that a task holds at once", TypeConverters.toInt)
    cacheNodeIds = Param(Params._dummy(), "cacheNodeIds", "whether rows remember their nodes: they never do", TypeConverters.toBoolean)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(numTrees=20, maxDepth=5, maxBins=32, maxMemoryInMB=64, cacheNodeIds=False, seed=0)


class Forest(_ForestParams, Estimator):
    def __init__(self, **params) -> None:
        super().__init__()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        spark = dataset.sparkSession
        session.ship_package(spark)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), _label(F.col(self.getLabelCol())).alias("y"))
        features = rows.select(F.size("x")).first()[0]
        ends = thresholds(rows, features, self.getOrDefault("maxBins"))
        # Sums are of distances from a whole number near the mean, which loses no digit of them and keeps them small.
        near = float(round(rows.agg(F.avg("y")).first()[0]))

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for chunk, batch in enumerate(batches):
                y = batch.column("y").to_numpy(zero_copy_only=False) - near
                yield _batch(BLOCK, [(part, chunk, len(y), binned(batch.column("x"), ends).tobytes(), y.tobytes())])

        with session.job_scratch(spark), _shuffles_deleted(spark):
            stored = session.stored(rows.mapInArrow(blocks, BLOCK), "bins")
            names = "numTrees", "maxDepth", "seed", "maxMemoryInMB"
            trees, depth, seed, memory = (self.getOrDefault(n) for n in names)
            spread = stored.repartition(max(spark.sparkContext.defaultParallelism, 8))
            grown = _Growth(spread, [len(e) + 1 for e in ends], trees, depth, seed & (2**63 - 1), memory).run()
        return self._copyValues(ForestModel(ends, [(f, c, left, value + near) for f, c, left, value in grown]))


def _label(y: Column) -> Column:
    y, infinite = y.cast("double"), float("inf")
    bad = y.isNull() | F.isnan(y) | (F.abs(y) == infinite)
    return F.when(bad, F.raise_error(F.lit("Labels MUST NOT be Null, NaN or Infinity"))).otherwise(y)


class ForestModel(_ForestParams, Model, MLWritable, MLReadable):
    """The trees, 14 bytes a node, and the upper ends of the bins they cut at."""

    def __init__(self, ends: Sequence[np.ndarray] = (), trees: Sequence[Tree] = ()) -> None:
        super().__init__()
        self.ends, self.trees = list(ends), list(trees)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def toDebugString(self) -> str:
        lines = [f"ForestModel: uid={self.uid}, numTrees={len(self.trees)}, numFeatures={len(self.ends)}"]
        for t, (feature, cut, left, value) in enumerate(self.trees):
            lines.append(f"  Tree {t} (weight 1.0):")
            todo = [(0, 4, "")]
            while todo:
                node, indent, said = todo.pop()
                lines += [" " * (indent - 1) + said] if said else []
                if cut[node] == LEAF:
                    lines.append(" " * indent + f"Predict: {value[node]}")
                    continue
                at = f"feature {feature[node]}", self.ends[feature[node]][cut[node]]
                todo.append((left[node] + 1, indent + 1, f"Else ({at[0]} > {at[1]})"))
                todo.append((left[node], indent + 1, f"If ({at[0]} <= {at[1]})"))
        return "\n".join(lines) + "\n"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        session.ship_package(spark)
        forest = spark.sparkContext.broadcast((self.ends, self.trees, self.getOrDefault("maxDepth")))

        @F.arrow_udf("double")
        def predicted(x: pa.Array) -> pa.Array:
            ends, trees, depth = forest.value
            bins = binned(x, ends)
            return pa.array(sum((tree[3][reached(tree, bins, depth)] for tree in trees), np.zeros(len(x))) / len(trees))

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        ends = [[float(v) for v in e] for e in self.model.ends]
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"ends": ends})
        rows = [_grown_row(t, 0, tree) for t, tree in enumerate(self.model.trees)]
        self.sparkSession.createDataFrame(pa.Table.from_batches([_batch(GROWN, rows)]), GROWN).write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def __init__(self, cls: type[ForestModel]) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.schema(GROWN).parquet(f"{path}/trees").toLocalIterator()
        trees = dict(sorted((r["tree"], _tree(r)) for r in rows))
        model = self.cls([np.array(e) for e in metadata["ends"]], list(trees.values()))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
