"""Operator 6: quality scores by a support vector machine with naive Bayes features.

Features are the distinct byte n-grams (one to three bytes, hashed into a fixed
table) of a text.  Each is scaled by the log-ratio of its smoothed shares in the two
classes, and the vector to unit length; a linear hinge-loss model is fitted to these
by dual coordinate descent, and interpolated with the mean weight.  A logistic curve,
fitted on labelled rows that the descent did not see, turns margins into scores.

Fitting uses at most ``SAMPLE`` labelled rows, those with the smallest hashed
ids, whatever the corpus; every row is scored, in its own task, with two
broadcast tables of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import arrays

BITS = 16  # of the feature table
SAMPLE = 6000  # labelled rows that are used for fitting, at most
FEATURES = 16_000_000  # of all rows that are used for fitting, at most
ORDERS = (1, 2, 3)  # bytes of an n-gram
COST, EPOCHS, MIX, SMOOTHING = 1.0, 12, 0.75, 1.0
LEAST_SCORE = 0.7


class _Features:
    """Distinct feature indices of texts, by stamping a table."""

    def __init__(self):
        self.stamp = np.zeros(1 << BITS, np.int32)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        parts = []
        for n in ORDERS:
            if len(data) >= n:
                key = np.full(len(data) - n + 1, n, np.uint32)
                for i in range(n):
                    key = (key << np.uint32(8)) | data[i:len(data) - n + 1 + i]
                parts.append(((key * np.uint32(2654435769)) >> np.uint32(32 - BITS)).astype(np.int32))
        if not parts:
            return np.zeros(0, np.int32)
        at = np.concatenate(parts)
        order = np.arange(len(at), dtype=np.int32)
        self.stamp[at] = order
        return at[self.stamp[at] == order]


def _per_text(column: pa.Array, make) -> list:
    """``make`` of the features of each text; long texts go through in blocks."""
    features, data_offsets = _Features(), arrays.text_buffers(column)
    data, offsets = data_offsets
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a <= arrays.BLOCK:
            found = features(data[a:b])
        else:  # blocks overlap so that no n-gram is lost
            found = np.unique(np.concatenate([features(data[i:min(b, i + arrays.BLOCK + max(ORDERS) - 1)]) for i in range(a, b, arrays.BLOCK)]))
        out.append(make(found))
    return out


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _per_text(batch.column(1), lambda f: np.sort(f))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["quality", "doc_id", "features"])


def _vector(weights: np.ndarray, ratio: np.ndarray, f: np.ndarray) -> float:
    r = ratio[f]
    size = float(np.sqrt((r * r).sum()))
    return float((weights[f] * r).sum()) / size if size else 0.0


class Model:
    """Weights, log-ratios, the bias and the logistic curve."""

    def __init__(self, rows: list[tuple[int, np.ndarray]]):
        n = 1 << BITS
        self.weights, self.ratio, self.bias = np.zeros(n), np.zeros(n), 0.0
        labels = np.array([y for y, _ in rows], np.int64)
        share = (labels.sum() + 1) / (len(labels) + 2)
        self.slope, self.shift = 0.0, float(np.log(share / (1 - share)))
        if labels.min(initial=1) == labels.max(initial=0):
            return  # one class, or no rows: the share of label 1
        held = np.arange(len(rows)) % 5 == 0
        held &= len(rows) >= 50
        if len(set(labels[~held])) < 2:
            held[:] = False  # too few rows to keep some apart
        train = [r for r, h in zip(rows, held, strict=True) if not h]
        self._fit(train)
        margins = np.array([self.margin(f) for _, f in rows])
        use = held if held.any() and 0 < labels[held].sum() < held.sum() else ~held
        self._calibrate(margins[use], labels[use])

    def _fit(self, rows: list[tuple[int, np.ndarray]]) -> None:
        counts = np.full((2, len(self.ratio)), SMOOTHING)
        for y, f in rows:
            counts[y, f] += 1
        shares = counts / counts.sum(axis=1, keepdims=True)
        self.ratio = np.log(shares[1] / shares[0])
        ys = np.array([1 if y else -1 for y, _ in rows])
        # both classes weigh the same, however rare one is
        cost = COST * len(ys) / (2 * np.where(ys > 0, (ys > 0).sum(), (ys < 0).sum()))
        values = []
        for _, f in rows:
            r = self.ratio[f]
            size = np.sqrt((r * r).sum())
            values.append(r / size if size else r)
        w, alpha, bias = np.zeros(len(self.ratio)), np.zeros(len(rows)), 0.0
        diagonal = np.array([(v * v).sum() + 1 for v in values])
        rng = np.random.default_rng(7)
        for _ in range(EPOCHS):
            most = 0.0
            for i in rng.permutation(len(rows)):
                f, v, y = rows[i][1], values[i], ys[i]
                gradient = y * (w[f] @ v + bias) - 1
                new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost[i])
                step = (new - alpha[i]) * y
                if step:
                    w[f] += step * v
                    bias += step
                    most = max(most, abs(step))
                    alpha[i] = new
            if most < 1e-3:
                break
        self.weights = (1 - MIX) * np.abs(w).mean() * np.sign(w) + MIX * w
        self.bias = bias

    def margin(self, f: np.ndarray) -> float:
        return _vector(self.weights, self.ratio, f) + self.bias

    def _calibrate(self, margins: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve by Newton steps, on smoothed targets."""
        up, down = labels.sum(), len(labels) - labels.sum()
        target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
        x = np.c_[margins, np.ones(len(margins))]
        b = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            g = x.T @ (p - target) + 1e-3 * b
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), g)
            b = b - np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
        self.slope, self.shift = float(max(b[0], 0.0)), float(b[1])

    def score(self, f: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(f) + self.shift, -30, 30))))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(quality, doc_id, features)`` of the rows to fit on, written once: of the
    labelled ids that are not held out and have a document, the first ``SAMPLE`` in
    the order of their hash, and of these as many as have ``FEATURES`` in all.  Rows
    without a label of 0 or 1 are left out; of several labels of an id the largest
    counts, of several texts that of the smallest hash."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("quality IN (0, 1) AND doc_id IS NOT NULL").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    chosen = (known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # repeated ids meet before the shuffle, so that one of a third of the rows is a row a task
    one = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", F.col("quality").cast("long").alias("quality"))  # SAMPLE rows
           .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    rows = stage(one.select("quality", "text", "doc_id").mapInArrow(_sampled, "quality long, doc_id long, features array<int>"), "sample")
    sizes = rows.select("doc_id", F.size("features").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    total, used = 0, []
    for r in sizes:
        total += r.n
        if total > FEATURES:
            return rows.where(F.col("doc_id").isin(used))
        used.append(r.doc_id)
    return rows


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """The model for the sampled rows of ``labels``; the driver holds at most
    ``SAMPLE`` rows and ``FEATURES`` features."""
    rows = sample(docs, labels).select("quality", "features").toArrow()
    rows = [(q, f.values.to_numpy().astype(np.int64)) for q, f in zip(rows.column(0).to_pylist(), rows.column(1), strict=True)]
    rows.sort(key=lambda r: (r[1].tobytes(), r[0]))  # the outcome does not depend on the order of tasks
    order = np.random.default_rng(3).permutation(len(rows))
    return Model([rows[i] for i in order])


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.  Null
    texts are empty; a null id is not held out; without labels of both classes the
    score is the smoothed share of label 1.  Other columns are ignored."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.value.score
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_per_text(batch.column(1), score), pa.float64())], names=["doc_id", "score"])

    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held.alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted")))
