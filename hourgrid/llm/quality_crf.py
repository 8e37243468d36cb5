"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line is described by what it is made of (symbols, digits, repeated words, ...) and by the same of the lines before
and after it. The field's line marginals, from forward and backward sums over the whole text, are averaged with the
lines' lengths as weights; a logistic curve fitted on the training documents turns that average into a score.

Line labels are the labels of their documents. The field is fitted on a bounded sample of labelled documents
(``SAMPLE``, ``SEGMENTS``, ``SEGMENT_LINES``); scoring reads every line of every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.session import stored

#: At most so many labelled documents of each label are fitted on, and of each so many segments of so many lines.
SAMPLE, SEGMENTS, SEGMENT_LINES = 2000, 8, 32
ROUNDS, RATE, PENALTY = 150, 0.1, 1e-3
#: Documents whose lines are walked together.
TOGETHER = 1000

SYMBOLS, DIGITS, STOPS = b"#$%&*+<=>@[\\]^_`{|}~/", b"0123456789", b".,;:!?"
UPPER = bytes(range(0x41, 0x5B))
N_OWN = 10
N_FEATURES = 1 + 3 * N_OWN + 2


def _own_features(line: bytes) -> tuple[float, ...]:
    words = line.split()
    n, size = len(words), len(line)
    if not n:
        return (1.0,) + (0.0,) * (N_OWN - 1)

    def share(chars: bytes) -> float:
        return (size - len(line.translate(None, chars))) / size

    same = sum(map(bytes.__eq__, words, words[1:])) / max(n - 1, 1)
    return (
        0.0,
        share(SYMBOLS),
        share(DIGITS),
        share(STOPS),
        share(UPPER),
        same,
        1 - len(set(words)) / n,
        words.count(b"|") / n,
        min(size / n, 40) / 40,
        min(np.log1p(n) / 8, 1.0),
    )


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each line, and the lines' lengths in bytes plus one. An empty text is one empty line."""
    lines = (text or "").encode().split(b"\n")
    own = np.array([_own_features(x) for x in lines], np.float32)
    n = len(lines)
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, 0] = 1
    out[:, 1 : 1 + N_OWN] = own
    out[1:, 1 + N_OWN : 1 + 2 * N_OWN] = own[:-1]
    out[:-1, 1 + 2 * N_OWN : 1 + 3 * N_OWN] = own[1:]
    out[0, -2], out[-1, -1] = 1, 1
    return out, np.array([len(x) + 1 for x in lines], np.float64)


def _both(a: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Rows of log sums over the first state of ``a`` (rows, first) and ``step`` (first, second)."""
    return np.logaddexp(a[:, :1] + step[0], a[:, 1:] + step[1])


def forward_backward(unary: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log sums of sequences that lie one after another, and each one's total."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))[order]
    left = lengths[order]
    ahead, back = unary.copy(), np.zeros_like(unary)
    active = [int(np.searchsorted(-left, -t, side="left")) for t in range(int(left[0]) if len(left) else 0)]
    for t in range(1, len(active)):
        at = starts[: active[t]] + t
        ahead[at] += _both(ahead[at - 1], step)
    for t in range(len(active) - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        back[at] = _both(unary[at + 1] + back[at + 1], step.T)
    ends = np.cumsum(lengths) - 1
    total = np.logaddexp(ahead[ends, 0], ahead[ends, 1])
    return ahead, back, total


@dataclass
class Model:
    """Weights of lines (features, states) and of neighbouring states, and the curve from average to score."""

    weights: np.ndarray
    step: np.ndarray
    slope: float
    offset: float

    def goodness(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The probability that each line is good."""
        ahead, back, total = forward_backward(features @ self.weights, lengths, self.step)
        return np.exp(ahead[:, 1] + back[:, 1] - np.repeat(total, lengths))

    def score(self, average: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(average) + self.offset)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _fit_field(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights that make the labels ``y`` of the lines likely; ``weight`` is that of each sequence."""
    w, step = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, step)]
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    later = np.ones(len(x), bool)
    later[first] = False
    to = np.flatnonzero(later)
    each, scale = np.repeat(weight, lengths), weight.dot(lengths)
    truth = np.eye(2)[y]
    pair = np.zeros((2, 2))
    np.add.at(pair, (y[to - 1], y[to]), each[to])
    for i in range(1, ROUNDS + 1):
        unary = x @ w
        ahead, back, total = forward_backward(unary, lengths, step)
        total = np.repeat(total, lengths)
        marginal = np.exp(ahead + back - total[:, None])
        joint = ahead[to - 1][:, :, None] + step + (unary + back)[to][:, None, :] - total[to][:, None, None]
        expected = np.einsum("n,nij->ij", each[to], np.exp(joint))
        for p, m, slope in (
            (w, moments[0], x.T @ ((marginal - truth) * each[:, None]) / scale + PENALTY * w),
            (step, moments[1], (expected - pair) / scale + PENALTY * step),
        ):
            m[0] = 0.9 * m[0] + 0.1 * slope
            m[1] = 0.99 * m[1] + 0.01 * slope**2
            p -= RATE * (m[0] / (1 - 0.9**i)) / (np.sqrt(m[1] / (1 - 0.99**i)) + 1e-8)
    return w, step


def _fit_curve(average: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from averages to labels, by Newton steps."""
    x = np.stack([_logit(average), np.ones(len(y))], axis=1)
    beta = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-2 * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta -= np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(beta[0]), float(beta[1])


SEGMENT = "label int, doc long, n int, whole double, x array<float>, sizes array<double>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ``SEGMENTS`` runs of lines of each document, spread over all of it."""
    for batch in batches:
        rows = []
        for doc, label, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "label", "text")), strict=True):
            x, sizes = line_features(text)
            cuts = np.arange(0, len(x), SEGMENT_LINES)
            if len(cuts) > SEGMENTS:
                cuts = cuts[np.linspace(0, len(cuts) - 1, SEGMENTS).astype(int)]
            for a in cuts:
                part = x[a : a + SEGMENT_LINES]
                rows.append((label, doc, len(part), 1.0, part.ravel(), sizes[a : a + SEGMENT_LINES]))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.float32()), pa.list_(pa.float64())]
        names = [f.split(" ")[0] for f in SEGMENT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def clear_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id`` and ``label`` 0 or 1, for each id whose rows agree."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    agreed = known.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("most"))
    return agreed.where("label = most").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """Labelled documents, at most ``sample`` of each label (doc_id, label, text), and how many there are.

    ``labels`` has doc_id and label, each id once; the sample is drawn by the hash of the id, which is also the order
    in which it is read. Its ids are at most twice ``sample``, so they are broadcast.
    """
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    drawn = None
    for value in (0, 1):
        some = labels.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        drawn = some if drawn is None else drawn.unionByName(some)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(texts.join(F.broadcast(drawn), "doc_id"), "sample"), counts


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 bad or 1 good, each id once).

    Without labels every score is one half; with one label only, all scores are its smoothed share.
    """
    drawn, counts = sampled(docs, labels, sample)
    rows = drawn.select(F.col("doc_id").alias("doc"), "label", "text").mapInArrow(_segments, SEGMENT).toArrow()
    found = set(rows.column("label").to_pylist())
    if len(found) < 2:
        good = counts.get(1, 0) if 1 in found else 0
        n = good + (counts.get(0, 0) if 0 in found else 0)
        p = (good + 1) / (n + 2)
        return Model(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), 0.0, float(np.log(p / (1 - p))))
    lengths = rows.column("n").to_numpy().astype(np.int64)
    x = np.concatenate([a.values.to_numpy() for a in rows.column("x")]).reshape(-1, N_FEATURES).astype(np.float64)
    sizes = np.concatenate([a.values.to_numpy() for a in rows.column("sizes")])
    label, doc = rows.column("label").to_numpy(), rows.column("doc").to_numpy()
    drawn_of = {v: min(sample, counts[v]) for v in counts}
    prior = np.array([counts.get(v, 0) / max(drawn_of.get(v, 0), 1) for v in (0, 1)])
    weights, step = _fit_field(x, np.repeat(label, lengths), lengths, np.ones(len(label)))
    model = Model(weights, step, 1.0, 0.0)

    good = model.goodness(x, lengths)
    docs_of, place = np.unique(doc, return_inverse=True)
    of_line = np.repeat(place, lengths)
    average = np.bincount(of_line, good * sizes) / np.bincount(of_line, sizes)
    y = np.zeros(len(docs_of))
    y[place] = label
    model.slope, model.offset = _fit_curve(average, y, prior[y.astype(int)])
    return model


def _score(model: Model, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, lines, bad = [], [], []
            for a in range(0, batch.num_rows, TOGETHER):
                made = [line_features(t.as_py()) for t in batch.column("text").slice(a, TOGETHER)]
                lengths = np.array([len(s) for _, s in made], np.int64)
                sizes = np.concatenate([s for _, s in made])
                good = model.goodness(np.concatenate([x for x, _ in made]).astype(np.float64), lengths)
                of_line = np.repeat(np.arange(len(made)), lengths)
                average = np.bincount(of_line, good * sizes, len(made)) / np.bincount(of_line, sizes, len(made))
                scores.append(model.score(average))
                lines.append(lengths)
                bad.append(np.bincount(of_line, good < 0.5, len(made)).astype(np.int64))
            parts = [np.concatenate(p) if p else np.empty(0) for p in (scores, lines, bad)]
            kinds = (pa.float64(), pa.int64(), pa.int64())
            more = [pa.array(p, k) for p, k in zip(parts, kinds, strict=True)]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, *more], [*columns, "score", "n_lines", "n_bad_lines"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with all its columns, and score, n_lines and n_bad_lines.

    The score depends on ``text`` alone; a null text is scored as an empty one, which is one empty line. Columns of
    ``docs`` named like the new ones are replaced.
    """
    docs = docs.drop("score", "n_lines", "n_bad_lines")
    schema = f"{', '.join(f'`{n}` {t}' for n, t in docs.dtypes)}, score double, n_lines long, n_bad_lines long"
    return docs.mapInArrow(_score(model, docs.columns), schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the crc32 of the id as text leaves ``fold`` modulo ``folds``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
