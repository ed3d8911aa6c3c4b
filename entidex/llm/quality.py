"""Quality classifier: cumulative-link ordinal regression on graded ratings.

A text is made of hashed features: its distinct lower-case words, the beginnings of those
words (so that kin of a rated word count) and a few marks of form. One weight per hash
bucket is shared by all grades; ordered thresholds cut the score into
grades:  P(grade <= k) = sigmoid(threshold_k - score). It gives the expected grade and
the tail probability of reaching a grade, by which documents are selected.

The fit takes at most `MOST_LABELLED` labelled rows, those with the least hash of their
id; its input and the weights are of bounded size. Every document is scored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entidex.llm.common import map_texts

#: Bound on the labelled rows of a fit.
MOST_LABELLED = 10_000
#: Hash buckets (a power of two) and the rows a bucket must occur in to get a weight.
BUCKETS, LEAST_ROWS = 1 << 20, 5
#: Strength of the penalty on weights, and steps of the fit.
PENALTY, STEPS = 1e-3, 60
#: Bytes of the beginnings of words that count as features.
BEGINNINGS = (5, 7)
#: Grades: 0 toxic, 1 poor, 2 good. Documents are kept if P(grade >= GOOD) is at least `LEAST_TAIL`.
GRADES, GOOD, LEAST_TAIL = 3, 2, 0.5
#: Words a worker keeps with their weights.
KEPT_WORDS = 150_000


def bucket(feature: bytes) -> int:
    return zlib.crc32(feature) & (BUCKETS - 1)


def _level(share: float) -> int:
    """A share in steps that are finer near nothing."""
    return min(9, int(10 * math.sqrt(max(0.0, share))))


def marks(text: str, words: list[bytes], distinct: int) -> list[bytes]:
    """Features of form: shares of symbols, capitals, exclamation and repeated words, and length."""
    n, size = max(1, len(words)), max(1, len(text))
    symbols = sum(map(text.count, "#*$%&|<>"))
    shouted = sum(w.isupper() for w in text.split()) if "!" in text else 0
    return [
        b"\x00symbols%d" % _level(symbols / size),
        b"\x00shouts%d" % _level(text.count("!") / n),
        b"\x00capitals%d" % _level(shouted / n),
        # A text repeats the more words the longer it is: both together make the mark.
        b"\x00repeats%d-%d" % (min(6, int(math.log10(n + 1) * 2)), int(20 * (1 - distinct / n))),
        b"\x00length%d" % min(12, int(math.log2(n + 1))),
    ]


def tokens(text: str | None) -> set[bytes]:
    """Distinct words and marks of a text; a null text is empty and has marks alone."""
    text = text or ""
    words = text.encode("utf-8", "replace").lower().split()
    found = {w.strip(b".,;:!?\"'()") for w in words}
    return found.union(marks(text, words, len(found)))


def buckets_of(token: bytes) -> list[int]:
    """Buckets of a token and of its beginnings."""
    if token[:1] == b"\x00":
        return [bucket(token)]
    return [bucket(token), *(bucket(b"\x01" + token[:n]) for n in BEGINNINGS if len(token) >= n)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """Weights per bucket and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights.astype(np.float32), thresholds

    def scorer(self) -> Callable[[str | None], float]:
        """A function from a text to its score; keeps the weights of words it has met."""
        kept: dict[bytes, int] = {}
        weights = self.weights

        def score(text: str | None) -> float:
            total = 0
            for token in tokens(text):
                weight = kept.get(token)
                if weight is None:
                    if len(kept) >= KEPT_WORDS:
                        kept.clear()
                    # In whole millionths: sums do not depend on the order.
                    weight = kept[token] = sum(round(1e6 * float(weights[b])) for b in buckets_of(token))
                total += weight
            return total / 1e6

        return score

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1 on, a column each."""
        return sigmoid(np.asarray(scores)[:, None] - self.thresholds[None, :])


def fit(rows: list[np.ndarray], grades: np.ndarray) -> Model:
    """Least penalised negative log likelihood, by L-BFGS. rows: buckets of each text."""
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    count = np.bincount(flat, minlength=BUCKETS)
    used = np.flatnonzero(count >= LEAST_ROWS)
    if not len(rows) or not len(used):
        return Model(np.zeros(BUCKETS), np.arange(GRADES - 1) - GRADES / 2)
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    row = np.repeat(np.arange(len(rows)), lengths)
    keep = place[flat] >= 0
    row, column = row[keep], place[flat[keep]]
    n, k = len(rows), GRADES - 1
    at_least = grades[:, None] > np.arange(k)[None, :]  # grade >= j + 1

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, first, gaps = x[:-k], x[-k], np.exp(x[-k + 1 :]) if k > 1 else np.empty(0)
        thresholds = first + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, weights=weights[column], minlength=n)
        above = sigmoid(score[:, None] - thresholds[None, :])
        full = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        i = np.arange(n)
        p = np.maximum(full[i, grades] - full[i, grades + 1], 1e-12)
        slope = np.hstack([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))])
        d_score = -(slope[i, grades] - slope[i, grades + 1]) / p / n
        gradient = np.bincount(column, weights=d_score[row], minlength=len(weights)) + PENALTY * weights
        d_threshold = np.zeros(k + 2)
        np.add.at(d_threshold, grades, slope[i, grades] / p / n)
        np.add.at(d_threshold, grades + 1, -slope[i, grades + 1] / p / n)
        d_threshold = d_threshold[1:-1]
        d_gaps = np.array([d_threshold[j + 1 :].sum() * gaps[j] for j in range(k - 1)])
        value = -np.log(p).mean() + 0.5 * PENALTY * weights @ weights
        return value, np.concatenate([gradient, [d_threshold.sum()], d_gaps])

    shares = np.clip(at_least.mean(axis=0), 1e-3, 1 - 1e-3)
    starts = -np.log(shares / (1 - shares))
    x = np.concatenate([np.zeros(len(used)), [starts[0]], np.log(np.maximum(np.diff(starts), 0.1))])
    value, gradient = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        direction, alphas = -gradient, []
        for s, y, rho in reversed(past):
            alphas.append(rho * (s @ direction))
            direction = direction - alphas[-1] * y
        if past:
            s, y, _ = past[-1]
            direction = direction * ((s @ y) / (y @ y))
        for (s, y, rho), alpha in zip(past, reversed(alphas)):
            direction = direction + s * (alpha - rho * (y @ direction))
        slope, step = gradient @ direction, 1.0
        while True:
            new_value, new_gradient = loss(x + step * direction)
            if new_value <= value + 1e-4 * step * slope or step < 1e-6:
                break
            step *= 0.5
        s, y = step * direction, new_gradient - gradient
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y, 1 / (s @ y))]
        x, done, value, gradient = x + s, abs(value - new_value) < 1e-7, new_value, new_gradient
        if done:
            break
    weights = np.zeros(BUCKETS)
    weights[used] = x[:-k]
    thresholds = x[-k] + np.concatenate([[0.0], np.cumsum(np.exp(x[-k + 1 :]))])
    return Model(weights, thresholds)


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grade of a pair of labels: toxic is least, then poor, then good. Null if quality is."""
    return F.when(toxic >= 1, 0).when(quality < 1, 1).when(quality >= 1, 2)


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade") -> Model:
    """A model from `ratings` (`id_col`, `grade_col`) of some of the documents.

    Of repeated ratings the least counts, null ones do not; ratings of missing documents
    are passed over. Without any, all documents score the same.
    """
    sample = ratings.filter(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("rated")).agg(F.min(grade_col).cast("int").alias("grade"))
    sample = sample.orderBy(F.xxhash64("rated"), "rated").limit(MOST_LABELLED)
    rated = docs.join(F.broadcast(sample), docs[id_col] == sample["rated"]).select("rated", "grade", F.col(text_col).alias("rated_text"))

    def apply(texts: list) -> list[pa.Array]:
        rows = [sorted(b for token in tokens(t) for b in buckets_of(token)) for t in texts]
        return [pa.array(rows, pa.list_(pa.int32()))]

    hashed = map_texts(rated.select(F.struct("rated", "grade").alias("key"), "rated_text"), "key", "rated_text", lambda: apply, "buckets array<int>")
    # Documents with equal ids share a rating; one of them, the least text, is taken.
    one = hashed.select("key.rated", "key.grade", "buckets").groupBy("rated", "grade").agg(F.min("buckets").alias("buckets"))
    found = one.toArrow().sort_by("rated")
    rows = [r.values.to_numpy() if r.is_valid else np.empty(0, np.int64) for r in found.column("buckets")]
    return fit(rows, found.column("grade").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `score`, `tails` (P(grade >= k), k from 1 on) and `expected_grade` of every row.

    A null text counts as empty; repeated rows repeat; an empty table gives none; other
    columns are not read.
    """

    def make():
        scorer = model.scorer()

        def apply(texts: list) -> list[pa.Array]:
            scores = np.array([scorer(t) for t in texts], np.float64)
            tails = model.tails(scores)
            return [pa.array(scores), pa.array(tails.tolist(), pa.list_(pa.float64())), pa.array(tails.sum(axis=1))]

        return apply

    return map_texts(docs, id_col, text_col, make, "score double, tails array<double>, expected_grade double")


def selected(scored: DataFrame, least_grade: int = GOOD, least_tail: float = LEAST_TAIL) -> DataFrame:
    """`scored` with `kept`: whether a grade is reached with enough probability."""
    return scored.withColumn("kept", F.get("tails", F.lit(least_grade - 1)) >= least_tail)
