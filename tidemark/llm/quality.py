"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Each passage is encoded by a hidden
layer over its surface statistics, gated attention weighs the passages, and the
weighted sum gives the document's probability. Only document labels are used: the
attention learns which passages speak for a label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import chunks, word_bounds, word_hashes

PASSAGE_WORDS = 64
# Labelled rows of each class the network is fitted on, taken in the order of a hash of their key.
SAMPLE_ROWS = 2_000
HIDDEN, GATES, EPOCHS, RATE = 16, 8, 240, 0.02

_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "|", "#$%&*@^~+=", "\n", "<>{}[]()/\\_\"'`-"]
_CLASS = np.full(256, len(_CLASSES) + 1, np.int64)
for _n, _letters in enumerate(_CLASSES):
    _CLASS[[ord(c) for c in _letters]] = _n
_CLASS[0x80:] = len(_CLASSES)  # bytes of characters beyond ASCII
_N_CLASSES = len(_CLASSES) + 2
_LAGS = (1, 2, 3)
FEATURES = _N_CLASSES + len(_LAGS) + 4


def passages(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per range of texts: first row, rows, a feature row per passage, and the row each passage belongs to.

    A text without words is one passage whose features are all zero.
    """
    for first, data, offsets in chunks(texts):
        rows = len(offsets) - 1
        starts, ends, owner = word_bounds(data, offsets)
        words = np.bincount(owner, minlength=rows)
        row_start = np.cumsum(words) - words
        place = np.arange(len(starts)) - row_start[owner]
        opens = np.flatnonzero(place % PASSAGE_WORDS == 0)  # first word of each passage
        empty = np.flatnonzero(words == 0)
        features = np.zeros((len(opens) + len(empty), FEATURES), np.float32)
        belongs = np.concatenate([owner[opens], empty])
        if len(opens):
            features[: len(opens)] = _features(data, offsets, starts, ends, owner, opens)
        order = np.argsort(belongs, kind="stable")
        yield first, rows, features[order], belongs[order]


def _features(data, offsets, starts, ends, owner, opens) -> np.ndarray:
    n_words = np.diff(np.append(opens, len(starts))).astype(np.float32)
    text_from = starts[opens]
    text_to = np.append(text_from[1:], len(data))
    text_to = np.minimum(text_to, offsets[owner[opens] + 1])
    length = (text_to - text_from).astype(np.float32)
    edges = np.column_stack([text_from, text_to]).ravel()
    kinds = _CLASS[data]
    out = np.zeros((len(opens), FEATURES), np.float32)
    for kind in range(_N_CLASSES):
        running = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kinds == kind, out=running[1:])
        out[:, kind] = np.diff(running[edges])[::2] / length
    hashes = word_hashes(data, starts, ends)
    column = _N_CLASSES
    for lag in _LAGS:  # words that repeat the one before, or one a little earlier
        same = np.zeros(len(starts), np.float32)
        same[lag:] = (hashes[lag:] == hashes[:-lag]) & (owner[lag:] == owner[:-lag])
        out[:, column] = np.add.reduceat(same, opens) / n_words
        column += 1
    size = (ends - starts).astype(np.float32)
    mean = np.add.reduceat(size, opens) / n_words
    out[:, column] = mean / 10
    out[:, column + 1] = np.sqrt(np.maximum(0, np.add.reduceat(size**2, opens) / n_words - mean**2)) / 10
    last = kinds[ends - 1]
    out[:, column + 2] = np.add.reduceat((last >= 3).astype(np.float32), opens) / n_words
    out[:, column + 3] = n_words / PASSAGE_WORDS
    return out


def _forward(net: dict, x: np.ndarray, bags: np.ndarray):
    """Passage encodings, attention and document scores; ``bags`` are the first passages of the documents."""
    h = np.tanh(x @ net["w"] + net["b"])
    t, g = np.tanh(h @ net["v"]), 1 / (1 + np.exp(-(h @ net["u"])))
    logit = (t * g) @ net["a"]
    counts = np.diff(np.append(bags, len(x)))
    raised = np.exp(logit - np.repeat(np.maximum.reduceat(logit, bags), counts))
    weight = raised / np.repeat(np.add.reduceat(raised, bags), counts)
    z = np.add.reduceat(weight[:, None] * h, bags)
    p = 1 / (1 + np.exp(-np.clip(z @ net["c"] + net["d"], -30, 30)))
    return h, t, g, weight, counts, z, p


def _gradients(net: dict, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict:
    h, t, g, weight, counts, z, p = _forward(net, x, bags)
    dl = (p - y) / len(y)
    dz = np.repeat(dl, counts)[:, None] * net["c"]
    dw = (dz * h).sum(1)
    dlogit = weight * (dw - np.repeat(np.add.reduceat(weight * dw, bags), counts))
    dt = dlogit[:, None] * net["a"] * g * (1 - t**2)
    dg = dlogit[:, None] * net["a"] * t * g * (1 - g)
    dh = (weight[:, None] * dz + dt @ net["v"].T + dg @ net["u"].T) * (1 - h**2)
    return {
        "w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ dlogit,
        "c": z.T @ dl, "d": dl.sum(),
    }


def _trained(x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict:
    """Adam over the whole sample from a fixed start."""
    rng = np.random.default_rng(7)
    shapes = {"w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, GATES), "u": (HIDDEN, GATES), "a": (GATES,), "c": (HIDDEN,), "d": ()}
    net = {k: (rng.normal(0, 0.3, s) if s and k != "b" else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
    mean = {k: np.zeros_like(v) for k, v in net.items()}
    square = {k: np.zeros_like(v) for k, v in net.items()}
    for step in range(1, EPOCHS + 1):
        for k, grad in _gradients(net, x, bags, y).items():
            mean[k] = 0.9 * mean[k] + 0.1 * grad
            square[k] = 0.99 * square[k] + 0.01 * grad**2
            net[k] = (net[k] - RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A training row per document: label and the bytes of its passages' features."""
    for batch in batches:
        labels = batch.column(0).to_pylist()
        for first, rows, x, belongs in passages(batch.column(1)):
            ends = np.searchsorted(belongs, np.arange(rows), "right")
            starts = np.searchsorted(belongs, np.arange(rows), "left")
            blobs = [x[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[first : first + rows], pa.int32()), pa.array(blobs, pa.binary())], ["label", "bag"]
            )


def fit(labelled: DataFrame) -> dict:
    """The network fitted on rows of ``label`` (0 or 1) and ``text``; the caller bounds the rows.

    Each class counts by its rows. No rows give a network that scores a half, one class a constant.
    """
    found = labelled.select(F.col("label").cast("int"), "text").mapInArrow(_bags, "label int, bag binary")
    rows = sorted((r["label"], bytes(r["bag"])) for r in found.collect())  # at most the sample; a bag is a fifth of its text
    if len({label for label, _ in rows}) < 2:
        net = _trained(np.zeros((1, FEATURES), np.float32), np.zeros(1, int), np.zeros(1)) | {"c": np.zeros(HIDDEN, np.float32)}
        return net | {"d": np.float32(0 if not rows else 4 if rows[0][0] else -4), "mean": np.zeros(FEATURES, np.float32), "scale": np.ones(FEATURES, np.float32)}
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, b in rows]
    counts = np.array([len(b) for b in bags])
    x = np.concatenate(bags)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    net = _trained((x - mean) / scale, np.cumsum(counts) - counts, np.array([label for label, _ in rows], np.float32))
    return net | {"mean": mean, "scale": scale}


def score(docs: DataFrame, net: dict, *, text: str = "text") -> DataFrame:
    """All columns of the rows plus ``score`` (0 to 1) and ``attention``, the weight of each passage of 64 words.

    Whole texts are scored. A null or empty text is one passage without words.
    Columns of the names added are replaced; repeated rows score alike.
    """
    kept = [c for c in docs.columns if c not in ("score", "attention")]
    source = docs.select(*kept, docs[text].alias("_scored_text"))
    schema = docs.select(*kept).schema.add("score", "double")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", attention array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, x, belongs in passages(batch.column(batch.num_columns - 1)):
                bags = np.searchsorted(belongs, np.arange(rows), "left")
                weight, p = (r := _forward(net, (x - net["mean"]) / net["scale"], bags))[3], r[-1]
                offsets = pa.array(np.append(bags, len(x)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(weight.astype(np.float32)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, rows).columns[:-1], pa.array(p.astype(float), pa.float64()), lists],
                    [*kept, "score", "attention"],
                )

    return source.mapInArrow(run, out)
