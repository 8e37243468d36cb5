"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are all words of the examples, a bounded sample of the labelled documents (``SAMPLE``); their document
frequencies are counted over all documents. A term's weight is its TF-IDF, times a factor between ``FLOOR`` and 1 that grows
with how clearly the term's share differs between the labels: no term is left out. The examples are held in an inverted
index whose postings lie in blocks of examples; for each term and block the greatest weight is
known. A search first sums what frequent words give, whose postings are dense; a block's upper bound is the
greatest of these sums in it plus what its other words can add. It takes the blocks by this bound, first one, then ever more
at once, and ends when no further block can reach the k-th best cosine, so its result is exact. The neighbours vote with their cosine as weight; a logistic curve, fitted on votes about each
part of the examples by the others, whose factors do not know that part's labels, turns the vote into a score. The neighbours
are the evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.quality_crf import sampled

#: At most so many examples of each label; neighbours that vote.
SAMPLE, NEIGHBOURS = 512, 25
#: Least factor of a term, and the standard score at which the rest of the factor is one half.
FLOOR, CLEAR = 0.02, 5.0
BLOCK = 128
#: Words that at least this share of the examples hold have their postings as a dense row.
FREQUENT = 1 / 16
#: Examples of one label whose sets of words are so alike (Jaccard) are copies.
ALIKE = 0.8
#: Weight of the vote "not toxic" that is always there.
DOUBT = 0.5
#: Parts of the examples that the curve is fitted by.
FOLDS = 5
#: A lesser cosine is rounding.
TINY = 1e-12
WORD = re.compile(r"\w+")
EVIDENCE = "array<struct<doc_id:bigint,cosine:double,label:int>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [Counter(words_of(text.as_py())) for text in batch.column("text")]
        words = pa.array([sorted(c) for c in counts], pa.list_(pa.string()))
        times = pa.array([[c[w] for w in sorted(c)] for c in counts], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), words, times], ["doc_id", "label", "words", "times"])


def examples(drawn: DataFrame, sample: int = SAMPLE) -> list[tuple[int, int, dict[str, int]]]:
    """(doc_id, label, count of each word) of up to ``sample`` examples of each label from ``drawn`` (doc_id, label, text).

    Of equal texts with one label the one with the least doc_id stays; an id with several texts gives an
    example for each. Of texts whose words are alike (see ``without_copies``) one stays.
    """
    rows = drawn.groupBy("label", "text").agg(F.min("doc_id").alias("doc_id"))
    order = (F.xxhash64("doc_id"), "doc_id", F.sha2("text", 256))
    some = [rows.where(F.col("label") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    counted = some[0].unionByName(some[1]).select("doc_id", "label", "text")
    counted = counted.mapInArrow(_word_counts, "doc_id long, label int, words array<string>, times array<long>")
    found = [(r["doc_id"], r["label"], dict(zip(r["words"], r["times"], strict=True))) for r in counted.collect()]
    return without_copies(sorted(found, key=lambda e: (e[0], e[1], sorted(e[2].items()))))


def without_copies(rows: list[tuple[int, int, dict[str, int]]]) -> list[tuple[int, int, dict[str, int]]]:
    """``rows`` without those that are, by a Jaccard of ``ALIKE`` or more, copies of an earlier row of their label.

    Copies of one text would make all its words look like signs of its label. The bounded rows are compared through
    the words that fewest of them have: of two that are alike, one has to hold one of the other's rarest.
    """
    held: Counter = Counter(w for _, _, counts in rows for w in counts)
    kept, by_word = [], {}
    for row in rows:
        _, label, counts = row
        rarest = sorted(counts, key=lambda w: (held[w], w))
        rarest = rarest[: len(rarest) - int(np.ceil(ALIKE * len(rarest) - 1e-9)) + 1]
        near = {at for w in rarest for at in by_word.get((label, w), ())}
        shared = ((len(kept[at][2].keys() & counts.keys()), len(kept[at][2])) for at in near)
        if any(n >= ALIKE * (m + len(counts) - n) for n, m in shared):
            continue
        for w in rarest:
            by_word.setdefault((label, w), []).append(len(kept))
        kept.append(row)
    return kept


def factors(words: Sequence[str], rows: list[tuple[int, int, dict[str, int]]]) -> np.ndarray:
    """Factor of each word, from ``FLOOR`` to 1, by the standard score of the difference of its shares in the two labels.

    ``words`` holds all words of ``rows``. Without rows of both labels all factors are ``FLOOR``.
    """
    place = {w: i for i, w in enumerate(words)}
    held = np.zeros((2, len(words)))
    for _, label, counts in rows:
        held[label, [place[w] for w in counts]] += 1
    n = np.array([sum(y == v for _, y, _ in rows) for v in (0, 1)], float)
    if not n.all():
        return np.full(len(words), FLOOR)
    share = held.sum(axis=0) / n.sum()
    spread = np.sqrt(share * (1 - share) * (1 / n).sum())
    z = np.divide(held[1] / n[1] - held[0] / n[0], spread, out=np.zeros(len(words)), where=spread > 0)
    return FLOOR + (1 - FLOOR) * z**4 / (z**4 + CLEAR**4)


def _frequencies(words: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counts, n = {w: i for i, w in enumerate(words)}, Counter(), 0
        for batch in batches:
            for text in batch.column("text"):
                counts.update(set(words_of(text.as_py())) & place.keys())
                n += 1
        places = pa.array([*(place[w] for w in counts), -1], pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array([*counts.values(), n], pa.int64())], ["place", "n"])

    return run


def inverse_frequencies(docs: DataFrame, words: list[str]) -> np.ndarray:
    """log((n + 1) / (df + 1)) + 1 of each word, over all documents."""
    counts = docs.select("text").mapInArrow(_frequencies(words), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(len(words) + 1)
    found[counts.column("place").to_numpy()] = counts.column("n").to_numpy()
    return np.log((found[-1] + 1) / (found[:-1] + 1)) + 1


class Index:
    """Examples as unit vectors over ``words``, searched block by block.

    ``weights`` holds each word's weight at one occurrence; n occurrences weigh 1 + log(n) times as much.
    """

    def __init__(self, words: Sequence[str], weights: np.ndarray, rows: list[tuple[int, int, dict[str, int]]]):
        self.words, self.weights = list(words), np.asarray(weights, float)
        self.place = {w: i for i, w in enumerate(self.words)}
        vectors = [(i, y, *self.vector(c)) for i, y, c in rows]
        # alike examples lie in one block, so that bounds are tight
        self.order = sorted(range(len(rows)), key=lambda r: [int(x) for x in vectors[r][2][np.argsort(-vectors[r][3], kind="stable")]])
        vectors = [vectors[r] for r in self.order]
        self.ids = np.array([v[0] for v in vectors], np.int64)
        self.labels = np.array([v[1] for v in vectors], np.int64)
        rows_of = np.repeat(np.arange(len(vectors)), [len(v[2]) for v in vectors])
        terms = np.concatenate([v[2] for v in vectors]) if vectors else np.empty(0, np.int64)
        values = np.concatenate([v[3] for v in vectors]) if vectors else np.empty(0)
        held = np.bincount(terms, minlength=len(self.words))
        #: a word's row among the dense ones, or -1
        self.dense_row = np.where(held >= max(1, FREQUENT * len(vectors)), 0, -1)
        frequent = np.flatnonzero(self.dense_row == 0)
        self.dense_row[frequent] = np.arange(len(frequent))
        self.n_blocks = -(-len(vectors) // BLOCK)
        self.dense = np.zeros((len(frequent), self.n_blocks * BLOCK))
        often = self.dense_row[terms] >= 0
        self.dense[self.dense_row[terms[often]], rows_of[often]] = values[often]
        rows_of, terms, values = rows_of[~often], terms[~often], values[~often]
        by_term = np.lexsort((rows_of, terms))
        self.rows, self.values, terms = rows_of[by_term], values[by_term], terms[by_term]
        cell = terms * self.n_blocks + self.rows // BLOCK
        #: where the postings of a word in a block begin, and their greatest weight
        self.starts = np.searchsorted(cell, np.arange(len(self.words) * self.n_blocks + 1)).astype(np.int32)
        most = np.zeros(len(self.words) * self.n_blocks)
        np.maximum.at(most, cell, self.values)
        self.most = most.reshape(len(self.words), self.n_blocks)

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Places, ascending, and weights of the unit vector of the known words among ``counts``."""
        places = np.array([self.place.get(w, -1) for w in counts], np.int64)
        times = np.fromiter(counts.values(), np.float64, len(counts))
        known = np.flatnonzero(places >= 0)
        known = known[np.argsort(places[known])]
        places, times = places[known], times[known]
        values = (1 + np.log(times)) * self.weights[places]
        return places, values / np.sqrt((values * values).sum()) if len(values) else values

    def search(self, counts: dict[str, int], k: int, without: int | None = None) -> list[tuple[float, int, int]]:
        """The ``k`` greatest cosines, of at least ``TINY``, as (cosine, id, label), ties to the smaller id; not the example in row ``without``."""
        terms, weights = self.vector(counts)
        if not len(terms) or not len(self.ids):
            return []
        row = self.dense_row[terms]
        sums = (weights[row >= 0] @ self.dense[row[row >= 0]]).reshape(self.n_blocks, BLOCK)
        terms, weights = terms[row < 0], weights[row < 0]
        bounds = sums.max(axis=1) + weights @ self.most[terms]
        best, at = np.empty(0), np.empty(0, np.intp)
        order, taken, size = np.argsort(-bounds, kind="stable"), 0, 1
        while taken < self.n_blocks:
            least = best[-1] if len(best) == k else 0.0
            blocks = order[taken : taken + size]
            blocks = blocks[(bounds[blocks] >= least - 1e-9) & (bounds[blocks] > 0)]
            if not len(blocks):
                break
            cells = (terms[:, None] * self.n_blocks + blocks).ravel()
            begins = self.starts[cells]
            sizes = self.starts[cells + 1] - begins
            postings = np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
            added = np.repeat(np.repeat(weights, len(blocks)), sizes) * self.values[postings]
            scores = sums + np.bincount(self.rows[postings], added, sums.size).reshape(sums.shape)
            which, near = np.nonzero(scores[blocks] >= max(least - 1e-9, TINY))
            near += blocks[which] * BLOCK
            if without is not None:
                near = near[near != without]
            best, at = np.concatenate((best, np.round(scores.ravel()[near], 12))), np.concatenate((at, near))
            first = np.lexsort((at, self.ids[at], -best))[:k]
            best, at = best[first], at[first]
            taken, size = taken + size, 8 * size
        return list(zip(best.tolist(), self.ids[at].tolist(), self.labels[at].tolist(), strict=True))


class Scorer:
    """An index and the curve from votes to scores."""

    def __init__(self, index: Index | None, slope: float, offset: float, k: int = NEIGHBOURS):
        self.index, self.slope, self.offset, self.k = index, slope, offset, k

    @staticmethod
    def vote(found: list[tuple[float, int, int]]) -> float:
        return sum(s for s, _, y in found if y) / (sum(s for s, _, _ in found) + DOUBT)

    def neighbours(self, text: str | None) -> list[tuple[float, int, int]]:
        return self.index.search(Counter(words_of(text)), self.k) if self.index else []

    def score(self, found: list[tuple[float, int, int]]) -> float:
        return float(1 / (1 + np.exp(-(self.slope * self.vote(found) + self.offset))))


def votes_across(words: Sequence[str], rare: np.ndarray, rows: list[tuple[int, int, dict[str, int]]], k: int) -> np.ndarray:
    """The vote about each of ``rows`` by an index of the other parts, with factors from these alone.

    With factors that know an example's own label, the votes would look clearer than those about new texts, and the curve
    would take weak votes for strong ones. The parts take the rows of each label in turn.
    """
    part, seen = [], Counter()
    for _, label, _ in rows:
        part.append(seen[label] % FOLDS)
        seen[label] += 1
    votes = np.zeros(len(rows))
    for fold in set(part):
        others = [r for r, p in zip(rows, part, strict=True) if p != fold]
        index = Index(words, factors(words, others) * rare, others)
        for at in (a for a, p in enumerate(part) if p == fold):
            votes[at] = Scorer.vote(index.search(rows[at][2], k))
    return votes


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, k: int = NEIGHBOURS) -> Scorer:
    """A scorer from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1, each id once).

    Without examples of both labels every score is the smoothed share of label 1. The driver holds the words of the
    examples, at most twice ``sample``, and builds their index.
    """
    drawn, counts = sampled(docs, labels, sample)
    rows = examples(drawn, sample)
    n1, n = counts.get(1, 0), sum(counts.values())
    base = float(np.log((n1 + 1) / (n - n1 + 1)))
    words = sorted({w for _, _, c in rows for w in c})
    if {y for _, y, _ in rows} != {0, 1} or not words:
        return Scorer(None, 0.0, base, k)
    rare = inverse_frequencies(docs, words)
    index = Index(words, factors(words, rows) * rare, rows)
    votes, y = votes_across(words, rare, rows, k), np.array([label for _, label, _ in rows])
    weight = np.array([counts[v] / (y == v).sum() for v in (0, 1)])[y]
    slope, offset = _fit_curve(votes, y.astype(float), weight)
    return Scorer(index, slope, offset, k)


def _fit_curve(votes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    x = np.stack([votes, np.ones(len(y))], axis=1)
    beta, ridge = np.zeros(2), 1e-3 * weight.sum() / len(y)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        beta -= np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(beta[0]), float(beta[1])


def _score(scorer: Scorer, evidence: int):
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            of_text = {t: scorer.neighbours(t) for t in set(texts)}
            found = [of_text[t] for t in texts]
            scores = pa.array([scorer.score(f) for f in found], pa.float64())
            held = [[{"doc_id": i, "cosine": s, "label": y} for s, i, y in f[:evidence]] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores, pa.array(held, kind)], ["doc_id", "score", "evidence"])

    return run


def score(docs: DataFrame, scorer: Scorer, evidence: int = 5) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, score, evidence (the nearest examples).

    The score depends on ``text`` alone. A null or empty text, and any without a known word, has no neighbours, and the
    score of a vote of 0. Null or repeated ids are kept; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(scorer, evidence), f"doc_id long, score double, evidence {EVIDENCE}")
