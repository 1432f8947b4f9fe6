"""A convolutional network over bytes in numpy: learned filters, the strongest answer per chunk, chunks combined into one probability."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitalsieve.llm.common import held_out, training_rows, utf8

#: Labelled documents of each class to learn from, at most, and chunks of each, spread over the whole document.
PER_CLASS, CHUNKS = 1500, 6
#: Bytes of a chunk, bytes from one chunk to the next (they overlap by more than a filter), bytes of a filter, filters.
SIZE, STRIDE, WIDTH, FILTERS = 256, 244, 7, 16
EPOCHS, BATCH, RATE = 8, 128, 0.08


@dataclass(frozen=True)
class Network:
    filters: np.ndarray  # (WIDTH, 256, FILTERS): what each byte adds at each place of a filter
    bias: np.ndarray
    weights: np.ndarray  # of means and maxima over chunks, and the constant


def chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover all of ``text``; the last one is filled with zeros."""
    n = 1 + max(0, -(-(len(text) - SIZE) // STRIDE))
    data = np.zeros((n - 1) * STRIDE + SIZE, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(data, (n, SIZE), (STRIDE, 1))


def convolved(x: np.ndarray, filters: np.ndarray) -> np.ndarray:
    places = SIZE - WIDTH + 1
    out = filters[0][x[:, :places]]
    for i in range(1, WIDTH):
        out += filters[i][x[:, i : i + places]]
    return out


def pooled(x: np.ndarray, net: Network) -> np.ndarray:
    """(chunks, FILTERS): the strongest answer of each filter in each chunk."""
    return np.concatenate([np.tanh(np.maximum(convolved(x[i : i + 64], net.filters).max(axis=1) + net.bias, 0)) for i in range(0, len(x), 64)])


def document_features(text: bytes, net: Network) -> np.ndarray:
    """Means and maxima over all chunks, a block of chunks at a time."""
    x = chunks(text)
    total, most = np.zeros(FILTERS), np.zeros(FILTERS)
    for i in range(0, len(x), 1024):
        p = pooled(x[i : i + 1024], net)
        total += p.sum(axis=0)
        most = np.maximum(most, p.max(axis=0))
    return np.concatenate([total / len(x), most, [1.0]])


def _train_filters(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Network:
    """Filters, biases and one linear layer on chunks with their document's label, by Adagrad. Gradients pass the pool at its maximum only."""
    rng = np.random.default_rng(7)
    filters = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
    bias, out = np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS + 1).astype(np.float32)
    seen = [np.full(a.shape, 0.1, np.float32) for a in (filters, bias, out)]
    places = np.arange(WIDTH)
    for epoch in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            z = convolved(x[at], filters)
            where = z.argmax(axis=1)
            top = np.take_along_axis(z, where[:, None, :], axis=1)[:, 0] + bias
            act = np.tanh(np.maximum(top, 0))
            p = 1 / (1 + np.exp(-np.clip(act @ out[:-1] + out[-1], -30, 30)))
            error = (weight[at] * (p - y[at]) / len(at)).astype(np.float32)
            grad_top = error[:, None] * out[:-1] * (1 - act**2) * (top > 0)
            grad_filters = np.zeros_like(filters)
            used = x[at][np.arange(len(at))[:, None, None], where[:, :, None] + places]  # (batch, FILTERS, WIDTH)
            np.add.at(grad_filters, (places[None, None, :], used, np.arange(FILTERS)[None, :, None]), np.broadcast_to(grad_top[:, :, None], used.shape))
            grads = (grad_filters, grad_top.sum(axis=0), np.concatenate([act.T @ error, [error.sum()]]) + 1e-4 * out)
            for value, grad, square in zip((filters, bias, out), grads, seen, strict=True):
                square += grad**2
                value -= RATE * grad / np.sqrt(square)
    return Network(filters, bias, out)


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic weights by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.3 * np.eye(len(beta)), x.T @ (weight * (y - p)) - 0.3 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _measured(rows: DataFrame, net: Network, columns: list[str]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_features(v.as_py(), shared.value) for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), *batch.columns[1:]], ["features", *columns])

    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in columns)
    return rows.select("text", *columns).mapInArrow(measure, f"features array<double>, {kinds}")


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    """A network from at most ``per_class`` labelled documents of each class that are not held out.

    The driver gets CHUNKS chunks of SIZE bytes of each, spread over the whole document, to learn the filters from, and then one row of features
    of each whole document to learn how chunks combine; both are bounded. With labels of one class only, every score is that class's.
    """
    rows = training_rows(docs, labels, "quality", per_class).select(F.col("text").cast("binary").alias("text"), "label").persist()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, kinds = [], []
            for value, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                x = chunks(value.as_py())
                at = np.unique(np.linspace(0, len(x) - 1, CHUNKS).astype(int))
                parts += [x[i].tobytes() for i in at]
                kinds += [label] * len(at)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), pa.array(kinds, pa.int32())], ["chunk", "label"])

    sample = rows.mapInArrow(cut, "chunk binary, label int").orderBy(F.xxhash64("chunk"), "label").collect()
    y = np.array([r["label"] for r in sample], np.float32)
    empty = Network(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS + 1))
    if not len(y) or y.min() == y.max():
        empty.weights[-1] = 0.0 if not len(y) else 4.0 * (2 * y[0] - 1)
        return empty
    x = np.frombuffer(b"".join(bytes(r["chunk"]) for r in sample), np.uint8).reshape(-1, SIZE)
    balance = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    net = _train_filters(x, y, balance)
    points = _measured(rows, net, ["label"]).collect()
    rows.unpersist()
    f, label = np.array([r["features"] for r in points]), np.array([r["label"] for r in points], float)
    share = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).agg(F.avg("quality")).first()[0]
    weight = np.where(label == 1, share / label.mean(), (1 - share) / (1 - label.mean()))
    return Network(net.filters, net.bias, _fit(f, label, weight))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, from the bytes of the whole text alone. One pass, no shuffle.

    NULL and empty texts are one chunk of zeros. Repeated rows are scored each, equal texts alike.
    """
    net = learn(docs, labels)
    rows = docs.select(utf8().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    dot = F.aggregate(F.zip_with("features", F.lit(net.weights.tolist()), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    scores = _measured(rows, net, ["doc_id"]).select("doc_id", (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), dot))))).alias("score"))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
