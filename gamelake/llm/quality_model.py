"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

Random indexing: each token bucket has a fixed sparse index vector (a few +1 and -1 in
``DIMS`` places). A bucket's word vector is the sum of the index vectors of the tokens
within ``REACH`` places of it, over all documents. Tokens are runs of letters, capitals,
digits and signs, so that shouting and symbol noise have vectors of their own.

A document is the mean and the spread of its tokens' vectors, and a few pooled shares
(distinct tokens, token kinds, length). A network of two layers in numpy, trained on a
sample of labelled training texts, gives a logit, and a temperature fitted on texts kept
aside makes it a calibrated probability.

The vectors are ``BUCKETS`` x ``DIMS`` numbers whatever the corpus holds; Spark sums them
with partial sums in each task.

Cases: null and empty texts have no token and all features 0; equal texts score alike;
with one label value or none in the sample the score is its share (0.5 without rows);
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.llm import textvec
from gamelake.llm.tables import joined_ids, stored, training_row

BUCKETS, DIMS, NONZERO, REACH = 8192, 32, 2, 2
TRAIN_ROWS = 20_000     # labelled texts that are learned from, the first by a hash of their id
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 3e-3, 1e-4
ASIDE = 0.15

_KIND = np.full(256, 4, np.uint8)                       # signs
_KIND[[0x20, 9, 11, 12, 13]] = 0                        # space
_KIND[10] = 5                                           # line break
_KIND[97:123] = 1                                       # small letters, and all of non-ASCII
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_rng = np.random.default_rng(9)
_PLACE = _rng.integers(0, DIMS, (BUCKETS, NONZERO))
_SIGN = _rng.choice([-1, 1], (BUCKETS, NONZERO))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, kind, bytes) of every token of the texts behind each other in ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none, none
    kind = _KIND[data]
    head = np.ones(n, bool)
    head[1:] = kind[1:] != kind[:-1]
    head[offsets[:-1][offsets[:-1] < n]] = True
    start = np.flatnonzero(head)
    size = np.diff(np.append(start, n))
    own = kind[start]
    keep = own > 0
    start, size, own = start[keep], size[keep], own[keep].astype(np.int64)
    h = textvec.range_hash(data, start, start + size)
    bucket = (h % np.uint64(BUCKETS - 64)).astype(np.int64) + 64
    # Capitals, digits and line breaks are known by their length only.
    flat = (own == 2) | (own == 3) | (own == 5)
    bucket[flat] = own[flat] * 8 + np.minimum(size[flat], 7)
    return np.searchsorted(offsets, start, "right") - 1, bucket, own, size


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The ``BUCKETS`` x ``DIMS`` vectors of all documents, centred and of length 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(BUCKETS * DIMS), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in textvec.slices(batch.column("text")):
                text, bucket, _, _ = tokens(data, offsets)
                seen += np.bincount(bucket, minlength=BUCKETS)
                for k in range(1, REACH + 1):
                    near = np.flatnonzero(text[k:] == text[:-k])
                    a, b = bucket[near], bucket[near + k]
                    for j in range(NONZERO):
                        total += np.bincount(a * DIMS + _PLACE[b, j], _SIGN[b, j], BUCKETS * DIMS)
                        total += np.bincount(b * DIMS + _PLACE[a, j], _SIGN[a, j], BUCKETS * DIMS)
        at = np.flatnonzero(seen)
        sums = total.reshape(BUCKETS, DIMS)[at].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(seen[at]), *(pa.array(sums[:, i].copy()) for i in range(DIMS))],
            ["bucket", "n", *(f"v{i}" for i in range(DIMS))])

    names = [f"v{i}" for i in range(DIMS)]
    schema = ", ".join(f"{c} long" for c in ["bucket", "n", *names])
    summed = docs.select("text").mapInArrow(run, schema).groupBy("bucket").agg(
        F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names))
    rows = summed.toPandas()  # at most BUCKETS rows
    vectors = np.zeros((BUCKETS, DIMS), np.float32)
    if len(rows):
        v = rows[names].to_numpy(float) / rows["n"].to_numpy(float)[:, None]
        v -= np.average(v, axis=0, weights=rows["n"])
        vectors[rows["bucket"].to_numpy()] = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-9)
    return vectors


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of every text: mean and spread of its vectors, and shares."""
    n = len(offsets) - 1
    text, bucket, kind, size = tokens(data, offsets)
    count = np.bincount(text, minlength=n).astype(float)
    safe = np.maximum(count, 1)
    # Sums over the text's tokens in order, at a bounded memory: one dimension at a time.
    cut = np.searchsorted(text, np.arange(n + 1))
    out = np.zeros((n, 2 * DIMS + 10))
    for i in range(DIMS):
        c = np.concatenate([[0.0], np.cumsum(vectors[bucket, i], dtype=float)])
        out[:, i] = (c[cut[1:]] - c[cut[:-1]]) / safe
        c = np.concatenate([[0.0], np.cumsum(vectors[bucket, i].astype(float) ** 2)])
        out[:, DIMS + i] = np.sqrt(np.maximum((c[cut[1:]] - c[cut[:-1]]) / safe - out[:, i] ** 2, 0))
    pair = np.unique(text * BUCKETS + bucket)
    follow = np.bincount(text[1:][(text[1:] == text[:-1]) & (bucket[1:] == bucket[:-1])], minlength=n) if len(text) else 0
    out[:, 2 * DIMS] = np.bincount(pair // BUCKETS, minlength=n) / safe
    out[:, 2 * DIMS + 1] = follow / safe
    for k in range(1, 6):
        out[:, 2 * DIMS + 1 + k] = np.bincount(text[kind == k], minlength=n) / safe
    out[:, 2 * DIMS + 7] = np.log1p(count)
    out[:, 2 * DIMS + 8] = np.bincount(text, size, n) / safe / 10
    out[:, 2 * DIMS + 9] = np.bincount(text[kind == 4], size[kind == 4], n) / safe
    return out


class Network(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the log loss; then a temperature on the rows kept aside."""
    rng = np.random.default_rng(5)
    n, d = x.shape
    if not n or y.min() == y.max():
        share = float(y.mean()) if n else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1),
                       float(np.log(share / (1 - share))), 1.0)
    order = rng.permutation(n)
    aside, fit = order[:int(ASIDE * n)], order[int(ASIDE * n):]
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    z = (x - mean) / scale
    theta = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta], 0
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for k in range(0, len(fit), BATCH):
            a, b = z[fit[k:k + BATCH]], y[fit[k:k + BATCH]]
            pre = a @ theta[0] + theta[1]
            hidden = np.maximum(pre, 0)
            err = (1 / (1 + np.exp(-np.clip(hidden @ theta[2] + theta[3], -30, 30))) - b) / len(b)
            back = np.outer(err, theta[2]) * (pre > 0)
            grads = [a.T @ back + DECAY * theta[0], back.sum(0), hidden.T @ err + DECAY * theta[2], np.array([err.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                theta[i] = theta[i] - RATE * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]), 1.0)
    logit, kept = net.logit(x[aside]), y[aside]
    loss = lambda s: np.mean(np.logaddexp(0, logit / s) - kept * logit / s) if len(aside) else s
    return net._replace(temperature=float(min(np.geomspace(0.5, 10, 60), key=loss)))


def _mapped(df: DataFrame, keep: list[str], vectors: np.ndarray, made, kind: T.DataType, name: str) -> DataFrame:
    """The columns ``keep`` with ``name``: ``made`` of each text's features."""
    shared = df.sparkSession.sparkContext.broadcast(vectors)
    schema = df.select(*keep).schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textvec.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                values = made(pooled(data, offsets, shared.value))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), values], [*keep, name])

    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


class Model(NamedTuple):
    vectors: np.ndarray
    network: Network


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Vectors from all documents, the network from at most ``rows`` labelled training texts."""
    vectors = word_vectors(docs)
    chosen = (labels.where(training_row(F.col("doc_id")) & F.col("quality").isin(0, 1))
              .select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows))
    texts = stored(joined_ids(docs.select("doc_id", "text"), chosen, "inner"), "quality-training")
    lists = lambda x: pa.array(list(x), pa.list_(pa.float64()))
    # The sample's features: `rows` x 74 numbers, in an order of their own.
    found = _mapped(texts, ["quality"], vectors, lists, T.ArrayType(T.DoubleType()), "x").toPandas()
    x = np.stack(found["x"].to_numpy()) if len(found) else np.zeros((0, 2 * DIMS + 10))
    y = found["quality"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    return Model(vectors, train(x[order], y[order]))


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the documents with ``score``, 0 to 1."""
    network = model.network
    return _mapped(docs, keep, model.vectors, lambda x: pa.array(network.probability(x)), T.DoubleType(), "score")
