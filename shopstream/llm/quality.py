"""Quality classifier: attention-based multiple-instance learning (operator 9).

A document is a bag of passages.  Every passage is encoded from the pairs of
character classes it holds; gated attention weights say how much each passage
counts; the weighted mean of the encoded passages is scored.  All weights are
learned together from labels of whole documents.

Only the fit uses a sample: at most ``MAX_LABELLED`` labelled documents, those
with the smallest hash of their id, and at most ``MAX_PASSAGES`` passages of
each, evenly spread.  Every passage of every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Words, as_struct, sliced, utf8, with_doc

MAX_LABELLED = 4000
MAX_PASSAGES = 24
PASSAGE_WORDS = 64
CLASSES = 16
FEATURES = CLASSES * CLASSES


def _byte_classes() -> np.ndarray:
    """Class of each byte: letters of any script, capitals, digits, white
    space, and groups of punctuation."""
    out = np.full(256, 15, np.int16)
    out[97:123] = out[128:] = 0
    out[65:91], out[48:58], out[32] = 1, 2, 3
    out[:32] = 4
    for k, group in enumerate((".", ",", "!", "?", "|", "#$%&*@", "-_", "\"'`", "()[]{}<>", ":;"), 5):
        out[[ord(c) for c in group]] = k
    return out


_CLASS = _byte_classes()


def passages(column: pa.Array, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and how many each text has.

    A passage is ``size`` words and what stands between them; a text without
    words is one passage.  Features are square roots of the shares of pairs of
    neighbouring character classes.
    """
    raw, off = utf8(column)
    words = Words(column)
    per = np.maximum(1, -(-words.count // size))
    base = np.cumsum(per) - per
    step = np.zeros(len(raw) + 1, np.int32)     # a passage begins
    inner = np.arange(int(per.sum())) - np.repeat(base, per)
    later = np.flatnonzero(inner > 0)
    step[words.start[np.repeat(words.first[:-1], per)[later] + inner[later] * size]] = 1
    at = np.repeat(np.arange(len(per)), np.diff(off))
    passage = np.cumsum(step[:len(raw)]) if len(raw) else np.zeros(0, np.int64)
    passage = passage + at                       # every text begins one
    c = _CLASS[raw]
    same = passage[1:] == passage[:-1]
    pair = (passage[:-1] * FEATURES + c[:-1] * CLASSES + c[1:])[same]
    x = np.bincount(pair, minlength=int(per.sum()) * FEATURES).reshape(-1, FEATURES).astype(np.float32)
    total = x.sum(axis=1, keepdims=True)
    return np.sqrt(x / np.maximum(total, 1)), per


# ----------------------------------------------------------------- model
@dataclass
class GatedAttention:
    """h = tanh(x W + b); a = softmax(u . (tanh(h V) * sigmoid(h G)));
    score = sigmoid(c . sum(a h) + d)."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    def _forward(self, x: np.ndarray, bag: np.ndarray):
        p = self.weights
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["G"])))
        e = (t * g) @ p["u"]
        begin = np.cumsum(bag) - bag
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), bag))
        a = e / np.repeat(np.add.reduceat(e, begin), bag)
        z = np.add.reduceat(a[:, None] * h, begin)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return h, t, g, a, begin, z, s

    def score(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        if not len(bag):
            return np.zeros(0)
        if self.constant is not None:
            return np.full(len(bag), self.constant)
        return self._forward(x, bag)[-1].astype(np.float64)

    def attention(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        """The weight of every passage in its document."""
        if self.constant is not None:
            return np.repeat(1 / np.maximum(bag, 1), bag)
        return self._forward(x, bag)[3]

    def _gradients(self, x, bag, y):
        p = self.weights
        h, t, g, a, begin, z, s = self._forward(x, bag)
        ds = (s - y) / len(y)
        dz = ds[:, None] * p["c"]
        dz_row = np.repeat(dz, bag, axis=0)
        da = (dz_row * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, begin), bag))
        dt, dg = de[:, None] * p["u"] * g * (1 - t * t), de[:, None] * p["u"] * t * g * (1 - g)
        dh = (a[:, None] * dz_row + dt @ p["V"].T + dg @ p["G"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "G": h.T @ dg, "u": de @ (t * g),
                "c": ds @ z, "d": np.array([ds.sum()])}


def fit(x: np.ndarray, bag: np.ndarray, y: np.ndarray, hidden: int = 32, gate: int = 16, steps: int = 900,
        batch: int = 128, rate: float = 3e-3, decay: float = 1e-4, seed: int = 7) -> GatedAttention:
    """Adam on the log loss.  Without both labels the score is the smoothed
    share of label 1, for every text."""
    y = np.asarray(y, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return GatedAttention({}, float((y.sum() + 1) / (len(y) + 2)))
    rng = np.random.default_rng(seed)
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    prior = np.log(y.mean() / (1 - y.mean()))
    p = {"W": init(x.shape[1], hidden) * 4, "b": np.zeros(hidden, np.float32), "V": init(hidden, gate),
         "G": init(hidden, gate), "u": init(gate), "c": init(hidden), "d": np.array([prior], np.float32)}
    model = GatedAttention(p)
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    begin, step = np.cumsum(bag) - bag, 0
    epochs = max(1, -(-steps // max(1, len(y) // batch)))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        lr = rate * (1 - epoch / epochs) + rate / 20
        for part in np.array_split(order, max(1, len(y) // batch)):
            own = bag[part]
            rows = np.repeat(begin[part] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
            step += 1
            for k, grad in model._gradients(x[rows], own, y[part]).items():
                grad = grad + decay * p[k] * (k in ("W", "V", "G", "c"))
                m[k] += 0.1 * (grad - m[k])
                v[k] += 0.001 * (grad * grad - v[k])
                p[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


# ----------------------------------------------------------------- Spark
def held_out(doc_id="doc_id"):
    """Whether a row is kept from the fit: crc32 of the id as text mod 5 is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame, limit: int, max_passages: int):
    """Passages, bag sizes and labels of the sample."""
    labelled = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
                .groupBy("doc_id").agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("y"))
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))      # `limit` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            x, per = passages(b.column("text"))
            base, keep = np.cumsum(per) - per, np.minimum(per, max_passages)
            rank = np.arange(int(keep.sum())) - np.repeat(np.cumsum(keep) - keep, keep)
            rows = np.repeat(base, keep) + rank * np.repeat(per, keep) // np.repeat(keep, keep)
            x = x[rows].astype(np.float16)
            ends = np.append(0, np.cumsum(keep)).tolist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array(keep, pa.int32()),
                 pa.array([x[a:e].tobytes() for a, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                names=["doc_id", "y", "n", "x"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(labelled.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
            .select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, n int, x binary")
            .dropDuplicates(["doc_id"]).orderBy("doc_id").limit(limit).collect())
    if not rows:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), np.zeros(0, np.float32)
    x = np.concatenate([np.frombuffer(r.x, np.float16) for r in rows]).reshape(-1, FEATURES).astype(np.float32)
    return x, np.array([r.n for r in rows]), np.array([r.y for r in rows], np.float32)


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, max_passages: int = MAX_PASSAGES) -> GatedAttention:
    """Fit on labelled documents that are not held out (see ``_training``)."""
    return fit(*_training(docs, labels, limit, max_passages))


def quality_scores(docs: DataFrame, model: GatedAttention, threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, with score (0 to 1) and
    predicted (1 if score >= threshold).

    Only ``text`` is looked at; a null text is empty, and an empty text is one
    passage without features.  Repeated rows are scored each; an empty table
    gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = as_struct(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            score = sent.value.score(*passages(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(score, pa.float64())], names=["doc", "score"])

    return (rows.mapInArrow(run, with_doc(rows, "score double"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def quality_digests(docs: DataFrame, model: GatedAttention) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return (quality_scores(docs.select("doc_id", "text"), model)
            .select(F.col("doc.doc_id").alias("doc_id"), "score", "predicted")
            .select("doc_id", held_out().alias("held_out"), "score", "predicted"))
