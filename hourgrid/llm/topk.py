"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation over sparse integer rows.

Candidates and queries are cut into blocks by key; each pair of blocks is one group. A group builds the
posting lists of its candidates, one for each term, and for every query walks its terms: the weighted
postings of a term are added to a dense array of scores. The best of each array are found by partition
selection and leave the group; a last step merges them. Every score is computed, none is estimated. Pairs whose
inner product may not fit in 64 bits are summed in whole numbers of any size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
#: The greatest 64-bit score, and doubles from which on all are whole.
MOST, WHOLE = 2**63 - 1, 2.0**53


def scaled(vector: Column | str, scale: float = 256.0) -> Column:
    """Components as ``floor(scale * x)``, x as double: whole numbers, as doubles since they may exceed 64 bits."""
    vector = F.col(vector) if isinstance(vector, str) else vector

    def whole(x: Column) -> Column:
        y = F.lit(scale) * x.cast("double")
        return F.when(F.abs(y) < WHOLE, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, whole)


def finite(vector: Column | str, scale: float = 256.0) -> Column:
    """Whether the vector is there and each component is there and finite once scaled, as every finite float is."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(F.lit(scale) * x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _postings(rows: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, ...]]]:
    """Ids and greatest weights of the rows, and for each term the places of the rows that hold it, with weights.

    Weights are there as they came, and as 64-bit numbers where they fit, else 0.
    """
    lengths = rows["terms"].map(len).to_numpy()
    place = np.repeat(np.arange(len(rows)), lengths)
    term = np.concatenate([np.asarray(t, "i8") for t in rows["terms"]]) if len(rows) else np.empty(0, "i8")
    weight = np.concatenate([np.asarray(w, kind) for w in rows["weights"]]) if len(rows) else np.empty(0, kind)
    size = np.abs(weight.astype("f8"))  # rounding is up to the caller
    most = np.zeros(len(rows))
    most[lengths > 0] = np.maximum.reduceat(size, (np.cumsum(lengths) - lengths)[lengths > 0]) if len(size) else 0
    order = np.argsort(term, kind="stable")
    term, place, weight = term[order], place[order], weight[order]
    narrow = weight if kind == "i8" else np.where(size[order] < 2.0**63, weight, 0).astype("i8")
    found, starts = np.unique(term, return_index=True)
    ends = np.append(starts[1:], len(term))
    lists = {int(t): (place[a:b], narrow[a:b], weight[a:b]) for t, a, b in zip(found, starts, ends, strict=True)}
    return rows["id"].to_numpy("i8"), most, lists


def _beyond(score: int) -> tuple[int, int | None, bytes | None]:
    """A score as what orders it: its side of the 64-bit numbers, itself if among them, else bytes of the same order."""
    if -MOST <= score <= MOST:
        return 0, score, None
    size = -(-score.bit_length() // 8)
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return (1, None, key) if score > 0 else (-1, None, bytes(255 - x for x in key))


FOUND = "query_id long, query_row long, vec_id long, side int, score long, beyond binary"


def _best(k: int, kind: str):
    def wide_best(row: int, wide: np.ndarray, scores: np.ndarray, terms, weights, rows, ids, lists) -> list[tuple]:
        """The best of a query, where scores of ``wide`` candidates are summed in whole numbers of any size."""
        exact = scores.astype(object)
        exact[wide] = 0
        for t, w in zip(terms, weights, strict=True):
            if (hit := lists.get(int(t))) is not None:
                own = wide[hit[0]]
                exact[hit[0][own]] += np.array([int(x) for x in hit[2][own]], object) * int(w)
        return heapq.nsmallest(k, ((-exact[i], ids[i]) for i in np.flatnonzero(rows != row)))

    def run(queries: Iterator[pd.DataFrame] | pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        beyond: list[tuple] = []
        ids, most, lists = _postings(candidates, kind)
        rows, largest = candidates["row"].to_numpy("i8"), max(most, default=0)
        for query_id, row, terms, weights in zip(*(queries[c] for c in ("id", "row", "terms", "weights")), strict=True):
            # the greatest candidate weight with which no sum can leave 64 bits; halved, as doubles are rounded
            reach = MOST // (2 * sum(abs(int(w)) for w in weights) + 1)
            scores = np.zeros(len(ids), "i8")
            if reach:
                for t, w in zip(terms, weights, strict=True):
                    if (hit := lists.get(int(t))) is not None:
                        scores[hit[0]] += hit[1] * int(w)
            if largest > reach:
                found = wide_best(row, most > reach, scores, terms, weights, rows, ids, lists)
                beyond += [(query_id, row, i, *_beyond(int(-s))) for s, i in found]
                continue
            others = np.flatnonzero(rows != row)
            own = scores[others]
            if len(own) > k:  # all that reach the k-th best score, so that ties can go to the smaller id
                reach = np.partition(own, len(own) - k)[len(own) - k]
                others = others[own >= reach]
                own = scores[others]
            top = np.lexsort((ids[others], -own))[:k]
            out.append((np.full(len(top), query_id, "i8"), np.full(len(top), row, "i8"), ids[others][top], own[top]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, "i8")] * 4
        made = pd.DataFrame(dict(zip(("query_id", "query_row", "vec_id", "score"), columns, strict=True)))
        made.insert(3, "side", 0)
        made["beyond"] = None
        if beyond:
            more = {c: list(v) for c, v in zip(made.columns, zip(*beyond, strict=True), strict=True)}
            more = pd.DataFrame(more | {"score": pd.array(more["score"], "Int64")})  # by way of doubles it would be rounded
            made = pd.concat([made.astype({"score": "Int64"}), more], ignore_index=True) if len(made) else more
        return made

    return run


def _spread(rows: DataFrame, name: str, blocks: int) -> DataFrame:
    """Each row to one block by the hash of its place."""
    return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))


def top_k(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """The ``k`` best candidates of each query row: query_id, rank, vec_id, score.

    ``vectors`` has ``id`` (long) and ``weights`` (whole numbers, as array<long> or array<double>); a row's own terms
    are the places of its nonzero weights, so rows may differ in length. Scores are compared exactly at any size; one
    beyond 64 bits has its rank, and null as its score, since that column is a long. ``queries`` tells the rows that are queries; the
    candidates of a query are all rows but itself. Rows with a repeated id are told apart by their place: each
    is a query of its own, and a copy of the query under its id is a candidate. Rows without id or weights
    take no part. Ties go to the smaller id. Blocks follow the row count, so a group has at most about
    ``QUERY_BLOCK`` queries and ``CANDIDATE_BLOCK`` candidates.
    """
    kind = "i8" if dict(vectors.dtypes)["weights"] == "array<bigint>" else "f8"
    weights = F.transform("weights", lambda w, i: F.struct(i.cast("long").alias("t"), w.alias("w")))
    sparse = F.filter(weights, lambda x: x["w"] != 0)
    rows = vectors.where(F.col("id").isNotNull() & F.col("weights").isNotNull()).select(
        "id",
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(queries, F.lit(False)).alias("is_query"),
        sparse["t"].alias("terms"),
        sparse["w"].alias("weights"),
    )
    n, n_queries = rows.agg(F.count("*"), F.count_if("is_query")).first()
    query_blocks, candidate_blocks = 1 + n_queries // QUERY_BLOCK, 1 + n // CANDIDATE_BLOCK
    every = lambda name, blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(name)
    asked = _spread(rows.where("is_query"), "qb", query_blocks).select("*", every("cb", candidate_blocks))
    offered = _spread(rows, "cb", candidate_blocks).select("*", every("qb", query_blocks))
    found = (
        asked.drop("is_query")
        .groupBy("qb", "cb")
        .cogroup(offered.drop("is_query").groupBy("qb", "cb"))
        .applyInPandas(_best(k, kind), FOUND)
    )
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("side"), F.desc("score"), F.desc("beyond"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
