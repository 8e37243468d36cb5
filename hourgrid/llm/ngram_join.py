"""N-gram Jaccard join by signature trees: documents connected by similar sets of word shingles.

1. Documents with equal sets form a class; from here on a class is one document.
2. Classes that share a shingle among their first ones, in one order for all, may be similar, others are not
   (prefix filter): with similarity s, sets of n shingles that share none among the first n - ceil(s n) + 1 of each
   cannot be similar. Shingles that many documents hold come last in that order.
3. The classes that share such a shingle form a list, cut where their sizes leave a gap too wide. Equal lists are taken once, longer ones that begin alike are
   merged, and each is joined by a signature tree of its classes' bitmaps, walked against itself (``signature_tree``): what bitmaps and sizes do not rule out is
   connected. Lists longer than ``LIST``, which only copies have, are connected without a test. What is connected in
   this way forms a block; no link leaves it.
4. The classes of a block are joined exactly, by signature trees whose last step compares the sets. A block of more
   than ``CHUNK`` classes is cut into chunks by size: first each chunk is joined with itself, then with the first one,
   and then any two chunks that still hold several components between them.
5. The links' components are found by label propagation.

Only connections are asked for, so documents that are connected already need not be compared, which keeps the
work for a group of copies in proportion to its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.components import components
from hourgrid.llm.shingle_sets import shingle_set
from hourgrid.llm.ship import bound_batches
from hourgrid.llm.signature_tree import Join, bitmap, exact
from hourgrid.session import stored

#: Shingles counted at a time, documents that make one frequent, and how many frequent ones are kept at most:
#: they only set the order of the prefix filter, which finds every link in any order.
COUNTED, FREQUENT, MOST_FREQUENT = 4_000_000, 4, 1_000_000
#: Room for the document that completes ``COUNTED``, grown for a longer one, and counts passed on at a time.
ROOM, PASSED_ON = 300_000, 100_000
LIST, CHUNK = 256, 2000
#: Lists longer than this are merged with those that begin alike.
MERGED = 8
#: Up to so many members of blocks are broadcast to the scan that makes their sets; more are joined by shuffle.
BROADCAST_MEMBERS = 200_000


def prefix_length(n: int, num: int, den: int) -> int:
    """How many first shingles of ``n`` two similar sets share one of."""
    return n - -(-num * n // den) + 1


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    return (x.as_py() or "" for x in batch.column(column))


def _repeated(tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What occurs twice or more in ``tokens``, and how often; sorts them where they are."""
    tokens.sort()
    same = np.zeros(len(tokens) + 1, np.int8)
    np.equal(tokens[1:], tokens[:-1], out=same[1:-1].view(bool))
    ends = np.flatnonzero(same[1:] != same[:-1])  # the first and the last place of each run of equal ones
    for a in range(0, len(ends), 2 * PASSED_ON):
        first, last = ends[a : a + 2 * PASSED_ON : 2], ends[a + 1 : a + 2 * PASSED_ON : 2]
        yield pa.RecordBatch.from_arrays([pa.array(tokens[first]), pa.array(last - first + 1)], ["token", "times"])


def _count(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(COUNTED + ROOM, np.int64), 0
        for batch in batches:
            for text in _texts(batch, "text"):
                tokens = shingle_set(text, words)
                if size + len(tokens) > len(held):
                    held = np.concatenate((held[:size], np.empty(len(tokens) + ROOM, np.int64)))
                held[size : size + len(tokens)] = tokens
                size += len(tokens)
                if size >= COUNTED:
                    yield from _repeated(held[:size])
                    size = 0
        yield from _repeated(held[:size])

    return run


def frequent_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """Hashes of shingles that many documents hold, ascending; counted over all documents.

    Each task counts what it reads, some documents at a time, and passes on what occurs twice there, so that
    a shingle of a sizable share of all documents is counted nearly whole.
    """
    counts = docs.select("text").mapInArrow(_count(words), "token long, times long")
    counts = counts.groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= FREQUENT)
    top = counts.orderBy(F.desc("times"), "token").limit(MOST_FREQUENT).select("token").toArrow()
    return np.sort(top.column("token").to_numpy())


def _sets(words: int, num: int, den: int, frequent: np.ndarray):
    def among(tokens: np.ndarray) -> np.ndarray:
        if not len(frequent):
            return np.zeros(len(tokens), bool)
        at = np.searchsorted(frequent, tokens)
        at[at == len(frequent)] = 0
        return frequent[at] == tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, first, bits = [], [], [], []
            for text in _texts(batch, "text"):
                tokens = shingle_set(text, words)
                sizes.append(len(tokens))
                keys.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                bits.append(bitmap(tokens).tobytes())
                if len(tokens):
                    last = among(tokens)
                    ordered = np.concatenate((tokens[~last], tokens[last]))
                    first.append(ordered[: prefix_length(len(tokens), num, den)])
                else:
                    first.append(tokens)
            made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bits, pa.binary()), _lists(first)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *made], ["doc_id", "text_hash", "n", "key", "bits", "first"]
            )

    return run


def _candidates(num: int, den: int):
    """Edges among the classes of each list that sizes and bitmaps do not rule out; rows come list by list."""

    def edges(rows: list[tuple]) -> list[tuple[int, int]]:
        rows.sort(key=lambda r: (r[1], r[0]))
        join = Join([np.frombuffer(r[2], np.uint64) for r in rows], [r[1] for r in rows], num, den, lambda a, b: True)
        join.within(join.tree(list(range(len(rows)))))
        return [(rows[i][0], rows[r][0]) for i, r in enumerate(join.labels()) if i != r]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            out = []
            for which, *row in zip(*(batch.column(c).to_pylist() for c in ("list", "class", "n", "bits")), strict=True):
                if which != now and rows:
                    out += edges(rows)
                    rows = []
                now = which
                rows.append(tuple(row))
            yield _edges(out)
        if rows:
            yield _edges(edges(rows))

    return run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def _whole_sets(words: int):
    """Sets of the classes' texts, once for each class that a task sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for i, c in enumerate(batch.column("class").to_pylist()):
                if c not in seen:
                    seen.add(c)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            sets = [shingle_set(text, words) for text in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("block"), batch.column("chunk"), _lists(sets)], ["class", "block", "chunk", "tokens"]
            )

    return run


def _join(num: int, den: int):
    """Links found by each task (block, one, two): within a chunk, or between two chunks."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        classes, chunks, sets = [r[0] for r in rows], [r[1] for r in rows], [r[3] for r in rows]
        join = Join([bitmap(s) for s in sets], [len(s) for s in sets], num, den, exact(sets, num, den), [r[2] for r in rows])
        sides = [[i for i, c in enumerate(chunks) if c == chunk] for chunk in sorted(set(chunks))]
        trees = [join.tree(side, lambda d: (tuple(sets[d][:2]), len(sets[d]))) for side in sides]
        if len(trees) == 1:
            join.within(trees[0])
        else:
            join.between(*trees)
        return [(c, classes[r]) for c, r in zip(classes, join.labels(), strict=True) if classes[r] != c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            tasks = zip(*(batch.column(c).to_pylist() for c in ("block", "one", "two")), strict=True)
            cells = zip(*(batch.column(c).to_pylist() for c in ("class", "chunk", "component")), strict=True)
            tokens, out = batch.column("tokens"), []
            for i, (which, cell) in enumerate(zip(tasks, cells, strict=True)):
                if which != now and rows:
                    out += links(rows)
                    rows = []
                now = which
                rows.append((*cell, tokens[i].values.to_numpy()))
            yield _edges(out)
        if rows:
            yield _edges(links(rows))

    return run


def _tasks_joined(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links found by the tasks (block, one, two) of ``rows``, which have class, chunk, component and tokens."""
    rows = rows.select("block", "one", "two", "class", "chunk", "component", "tokens")
    rows = rows.repartition("block", "one", "two").sortWithinPartitions("block", "one", "two")
    return rows.mapInArrow(_join(num, den), "a long, b long")


def _blocks(classes: DataFrame, num: int, den: int) -> DataFrame:
    """``node`` and ``component``: the block of each class that may be linked with another."""
    postings = classes.select("class", "n", F.explode("first").alias("token"))
    # by size, a class without a neighbour of a similar size has no partner in the list; gaps cut a list into runs
    by_size = Window.partitionBy("token").orderBy("n", "class")
    near = postings.withColumns({"before": F.lag("n").over(by_size), "after": F.lead("n").over(by_size)})
    joins_before = F.coalesce(F.col("before") * den >= F.col("n") * num, F.lit(False))
    near = near.where(joins_before | (F.col("n") * den >= F.col("after") * num))
    held = near.withColumn("run", F.sum((~joins_before).cast("int")).over(by_size))
    of_run = Window.partitionBy("token", "run")
    held = held.withColumns({"held": F.count("*").over(of_run), "pivot": F.min("class").over(of_run)})
    held = stored(held.select("token", "run", "class", "held", "pivot"), "postings")
    lists = held.where(F.col("held") <= LIST).groupBy("token", "run", "pivot", "held")
    lists = lists.agg(F.sort_array(F.collect_list("class")).alias("classes"))
    short = lists.where(F.col("held") <= MERGED).select("classes").distinct()
    # the shingles of one passage have nearly the same list, with the same least class: their union is one list
    long = lists.where(F.col("held") > MERGED).groupBy("pivot").agg(F.array_distinct(F.flatten(F.collect_list("classes"))).alias("classes"))
    # stored, so that a list keeps its number when a lost task runs again
    lists = stored(short.unionByName(long.select("classes")).select(F.monotonically_increasing_id().alias("list"), "classes"), "lists")
    rows = lists.select("list", F.explode("classes").alias("class")).join(classes.select("class", "n", "bits"), "class")
    rows = rows.repartition("list").sortWithinPartitions("list").select("list", "class", "n", "bits")
    near = rows.mapInArrow(_candidates(num, den), "a long, b long")
    long_lists = held.where((F.col("held") > LIST) & (F.col("pivot") < F.col("class")))
    return components(near.unionByName(long_lists.select(F.col("pivot").alias("a"), F.col("class").alias("b"))).distinct())


def _linked(docs: DataFrame, classes: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``node`` and ``component`` of the classes that are linked with others."""
    blocks = _blocks(classes, num, den).select(F.col("node").alias("class"), F.col("component").alias("block"))
    members = blocks.join(classes.select("class", "n", "rep_id", "rep_hash"), "class")
    by_size = Window.partitionBy("block").orderBy("n", "class")
    members = members.withColumn("chunk", F.floor((F.row_number().over(by_size) - 1) / CHUNK))
    members = stored(members, "members")

    def sets_of(some: DataFrame) -> DataFrame:
        """The texts of members, one for each class, as whole sets."""
        some = some.select("class", "block", "chunk", "rep_id", "rep_hash")
        if some.count() <= BROADCAST_MEMBERS:
            some = F.broadcast(some)
        same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash"))
        texts = docs.select("doc_id", "text", "text_hash").join(some, same)
        schema = "class long, block long, chunk long, tokens array<long>"
        return texts.select("class", "block", "chunk", "text").mapInArrow(_whole_sets(words), schema)

    alone = sets_of(members).withColumns({"one": F.col("chunk"), "two": F.col("chunk"), "component": F.col("class")})
    links = stored(_tasks_joined(alone, num, den), "links")
    label = components(links)
    chunks = members.groupBy("block", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    cut = stored(chunks.where("chunk > 0").select("block").distinct(), "cut")
    if cut.isEmpty():
        return label

    members = members.join(cut, "block")
    sets = stored(sets_of(members), "sets")
    chunks = stored(chunks.join(cut, "block"), "chunks")
    right = chunks.select("block", F.col("chunk").alias("two"), F.col("low").alias("low2"))
    near = (F.col("one") < F.col("two")) & (F.col("high") * den >= F.col("low2") * num)
    pairs = chunks.withColumnRenamed("chunk", "one").join(right, "block").where(near).select("block", "one", "two")
    for some in (F.col("one") == 0, F.col("one") > 0):
        known = label.select(F.col("node").alias("class"), "component")
        held = members.join(known, "class", "left").select("block", "chunk", F.coalesce("component", "class").alias("component"))
        spans = held.groupBy("block", "chunk").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        one = spans.select("block", F.col("chunk").alias("one"), F.col("least").alias("l1"), F.col("most").alias("m1"))
        two = spans.select("block", F.col("chunk").alias("two"), F.col("least").alias("l2"), F.col("most").alias("m2"))
        several = F.greatest("m1", "m2") > F.least("l1", "l2")
        left = pairs.where(some).join(one, ["block", "one"]).join(two, ["block", "two"]).where(several).select("block", "one", "two")
        sides = left.select("block", "one", "two", F.explode(F.array("one", "two")).alias("chunk"))
        rows = sets.join(known, "class", "left").withColumn("component", F.coalesce("component", "class")).join(sides, ["block", "chunk"])
        links = stored(links.unionByName(_tasks_joined(rows, num, den)), "links")
        label = components(links)
    return label


def near_groups(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Documents are linked when the Jaccard similarity of their sets of ``words``-word shingles is ``num`` / ``den`` or
    more; ``component_id`` is the least doc_id that links reach. With fewer words the whole sequence is one shingle.
    Texts that are null, empty or blank have no shingle and no link, and are their own component. Rows with a null
    or repeated doc_id are kept and linked by their texts; a null is never the least. Other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    frequent = frequent_shingles(docs, words)
    schema = "doc_id long, text_hash long, n long, key binary, bits binary, first array<long>"
    sets = stored(docs.mapInArrow(_sets(words, num, den, frequent), schema), "prefixes")
    rep = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    classes = sets.where("n > 0").groupBy("key", "n").agg(
        rep.alias("rep"), F.min("doc_id").alias("least_id"), F.any_value("first").alias("first"), F.any_value("bits").alias("bits")
    )
    classes = classes.select(
        F.monotonically_increasing_id().alias("class"), "key", "n", "least_id", "first", "bits",
        F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"),
    )
    classes = stored(classes, "classes")
    linked = _linked(docs, classes, words, num, den)

    labelled = classes.select("class", "key", "least_id").join(linked.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "class"))
    ids = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_key = labelled.join(ids, "component").select("key", "component_id")
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("key")).alias("key"))
    return rows.join(by_key, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
