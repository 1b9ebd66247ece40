"""Toxic passages by maximum-scoring segments.

Words and their prefixes get log-odds between toxic and clean labelled documents
under a Dirichlet prior from the whole corpus; words of clean documents count
against a passage. A linear scan over a text's token scores finds every maximal
segment (Ruzzo and Tompa). The segments' scores are set against the extreme-value
law of chance segments, whose scale and constant are estimated from the best
segments of clean documents, and the evidence of the significant ones is turned
into a probability on the labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import chunks, mixed, slices, word_bounds, word_hashes

# Labelled rows of each class the model is fitted on, taken in the order of a hash of their key.
SAMPLE_ROWS = 10_000
# Labelled documents a word must occur in to count as evidence, the least z-score of its log-odds,
# and the least cautious bound of them, in nats.
LEAST_DOCS = 3
LEAST_Z = 4.0
LEAST_ODDS = 1.5
PREFIXES = (4, 5, 6)
# Weight of the corpus prior, in documents.
PRIOR_DOCS = 50.0
# Cost of a word without log-odds of its own, and of a text without any evidence.
GAP = 0.05
NO_HIT = 5.0
# A passage is significant if fewer than this many of its score are expected in a clean text of the length.
SIGNIFICANCE = 0.01
# Documents are counted in whole fractions of this, so that sums do not depend on their order.
UNIT = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")
_GROUP_CHARS = 2_000_000


@dataclass(frozen=True)
class Model:
    """Token scores, calibration of a text's evidence, and the law of chance segments.

    ``scores`` are positive for words and prefixes of toxic documents and
    negative for words of clean ones. By chance, ``k`` times the words of a text
    times ``exp(-scale * x)`` segments score ``x`` or more.
    """

    scores: dict[str, float]
    slope: float
    offset: float
    scale: float = 1.0
    k: float = 0.1


def _keys(word: str) -> list[str]:
    """A word and its prefixes, which stand for its stem."""
    return [word, *(word[:n] + "~" for n in PREFIXES if len(word) > n)]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    """Slices of the batches with the words of their last column; null has none."""
    for batch in (part for b in batches for part in slices(b, b.num_columns - 1)):
        texts = batch.column(batch.num_columns - 1).to_pylist()
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size > _GROUP_CHARS or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), [_WORD.findall((t or "").lower()) for t in texts[start : i + 1]]
                start, size = i + 1, 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of the documents of each class per key: key, toxic, clean; the key null counts all documents."""
    for batch, words in _texts(batches):
        found = {0: Counter(), 1: Counter()}
        for label, weight, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), words, strict=True):
            found[label].update(dict.fromkeys({None, *(k for w in set(own) for k in _keys(w))}, weight))
        keys = list(found[0] | found[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *(pa.array([found[c][k] for k in keys], pa.int64()) for c in (1, 0))],
            ["key", "toxic", "clean"],
        )


def _prior_counts(wanted: frozenset[str]):
    """Documents that hold each wanted key; the key null counts all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _texts(batches):
            found: Counter = Counter({None: len(words)})
            hits = {w: k for w in set().union(*words) if (k := wanted.intersection(_keys(w)))}
            for own in words:
                found.update(set().union(*(hits[w] for w in hits.keys() & set(own))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["key", "docs"]
            )

    return run


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, *, doc_id: str = "doc_id", text: str = "text", label: str = "label") -> DataFrame:
    """At most ``rows`` labelled documents of each class: ``label`` and ``text``.

    The chosen keys are a bounded table, so it is broadcast. Of several rows with a chosen key the one
    of the least text hash is taken, so the bound holds for rows. Null and other labels are left out.
    """
    chosen = None
    for value in (0, 1):
        own = labels.where(F.col(label) == value).select(F.col(doc_id).alias("_key"), F.lit(value).alias("label")).distinct()
        own = own.orderBy(F.xxhash64("_key"), "_key").limit(rows)
        chosen = own if chosen is None else chosen.unionByName(own)
    own = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text"))
    found = own.join(F.broadcast(chosen), F.col("_doc") == F.col("_key"))
    return found.groupBy("_key", "label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).select("label", "text")


def _weighed(labelled: DataFrame) -> DataFrame:
    """Sampled rows with equal texts reduced to one, and a weight for each.

    Rows of a class that share their least word triple are mostly copies of one
    text. All of them count, but together as one document: else a copied text's
    words would look frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1)):
                starts, ends, owner = word_bounds(data, offsets)
                h = word_hashes(data, starts, ends)
                least = np.zeros(len(offsets) - 1, np.uint64)
                if len(h):
                    following = np.append(h, h[-1:].repeat(2))
                    triple = mixed(h + following[1:-1] * np.uint64(3) + following[2:] * np.uint64(5))
                    opens = np.flatnonzero(np.diff(owner, prepend=-1))
                    least[owner[opens]] = np.minimum.reduceat(triple, opens)
                part = batch.slice(first, len(least))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least.astype(np.int64))], ["label", "text", "least"])

    found = labelled.dropDuplicates(["label", "text"]).mapInArrow(run, "label int, text string, least long")
    sizes = found.groupBy("label", "least").agg(F.count(F.lit(1)).alias("copies"))
    return found.join(sizes, ["label", "least"]).select("label", F.expr(f"{UNIT} div copies").alias("weight"), "text")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, *, doc_id: str = "doc_id", text: str = "text", label: str = "label") -> Model:
    """Scores of the words that mark toxic documents, the law of chance segments, and their calibration.

    ``labels`` are the rows to learn from, ``rows`` the documented bound of the
    sample. The prior counts all documents. Without a labelled row of either
    class nothing is significant and every text scores the share of toxic rows
    (a half of nothing at all).
    """
    labelled = _weighed(sample(docs, labels, rows, doc_id=doc_id, text=text, label=label))
    seen = labelled.mapInArrow(_counted, "key string, toxic long, clean long").groupBy("key").agg(
        (F.sum("toxic") / UNIT).alias("toxic"), (F.sum("clean") / UNIT).alias("clean")
    )
    total = seen.where("key IS NULL").first()
    n_toxic, n_clean = (total["toxic"], total["clean"]) if total else (0, 0)
    if not n_toxic or not n_clean:
        return Model({}, 0.0, math.log((n_toxic + 0.5) / (n_clean + 0.5)))
    # A key takes some LEAST_DOCS documents of the bounded sample to be significant either way.
    toxic_share, clean_share = F.col("toxic") / n_toxic, F.col("clean") / n_clean
    up = (F.col("toxic") >= LEAST_DOCS) & (toxic_share > 2 * clean_share)
    down = (F.col("clean") >= LEAST_Z**2) & (clean_share > 2 * toxic_share) & ~F.col("key").endswith("~")
    likely = {r["key"]: (r["toxic"], r["clean"]) for r in seen.where((up | down) & F.col("key").isNotNull()).collect()}
    counted = docs.select(text).mapInArrow(_prior_counts(frozenset(likely)), "key string, docs long")
    prior = {r["key"]: r["docs"] for r in counted.groupBy("key").agg(F.sum("docs").alias("docs")).collect()}
    scores = {}
    for key, (toxic, clean) in likely.items():
        share = PRIOR_DOCS * prior.get(key, 0) / prior[None]
        a, b = max(toxic + share, 0.01), max(clean + share, 0.01)
        odds = math.log(a / (n_toxic + PRIOR_DOCS - a)) - math.log(b / (n_clean + PRIOR_DOCS - b))
        spread = math.sqrt(1 / max(a, 0.5) + 1 / max(b, 0.5))
        if odds / spread >= LEAST_Z and odds - spread >= LEAST_ODDS:
            scores[key] = odds - spread
        elif odds / spread <= -LEAST_Z and not key.endswith("~"):
            scores[key] = odds + spread
    found = labelled.select("label", "text").mapInArrow(_best(scores), "label int, words long, scores array<double>")
    found = found.toPandas()  # at most 2 * rows lists of the segments' scores
    label_of, words_of = found["label"].to_numpy(float), found["words"].to_numpy(float)
    best = np.array([max(s, default=0.0) for s in found["scores"]])
    least = min((s for s in scores.values() if s > 0), default=LEAST_ODDS)
    scale, k = chance_law(best[label_of == 0], words_of[label_of == 0], least)
    model = Model(scores, 1.0, 0.0, scale, k)
    evidence = [_evidence_of(model, [(0, 0, s) for s in own], n) for own, n in zip(found["scores"], words_of, strict=True)]
    return Model(scores, *_calibrate(np.array(evidence), label_of), scale, k)


def chance_law(best: np.ndarray, words: np.ndarray, least: float) -> tuple[float, float]:
    """Scale and constant of the extreme-value law, from the best segment scores of clean texts and their words.

    Maximum likelihood: a text of ``n`` words stays below ``x`` with probability
    ``exp(-k * n * exp(-scale * x))``. Scores below ``least``, the smallest a
    segment can have, say only that. One text's worth of prior holds the scale
    near 1 where clean texts have next to no segments.
    """
    best, words = np.append(np.asarray(best, float), least), np.append(np.asarray(words, float), 100.0)
    seen = best >= least
    seen[-1] = False
    m, hits = np.maximum(best, least), seen.sum() + 1.0
    low, high = 0.01, 50.0
    for _ in range(100):
        scale = (low + high) / 2
        raised = words * np.exp(-scale * (m - least))
        # The prior counts as one hit that lies 1 above the least score, as it does on average at scale 1.
        slope = hits / scale - m[seen].sum() - (least + 1) + hits * (raised * m).sum() / raised.sum()
        low, high = (scale, high) if slope > 0 else (low, scale)
    return float(scale), float(hits / (words * np.exp(-scale * m)).sum())


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic law, by Newton's method with a slight pull to zero."""
    w, design = np.zeros(2), np.column_stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 0.1 * w
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def segments(scores: list[float | None]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, end, score)`` of token scores; None costs ``GAP``.

    Linear time: only tokens above zero start or end a segment, and each open
    segment knows the last one before it that has a smaller sum on its left, so
    no search passes over the same segment twice.
    """
    out: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum at the end, last with a smaller sum before
    total, last = 0.0, -1
    for i, score in enumerate(scores):
        if score is None:
            continue
        total -= GAP * (i - last - 1)
        last = i
        if score <= 0:
            total += score
            continue
        first, before, total = i, total, total + score
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= before:
                j = out[j][4]
            if j < 0 or out[j][3] >= total:
                out.append((first, i + 1, before, total, j))
                break
            first, _, before, _, smaller = out[j]
            del out[j:]
            j = smaller
    return [(first, end, right - left) for first, end, left, right, _ in out]


def _by_chance(model: Model, n_words: float) -> float:
    """The scaled score from which a passage of a text of so many words is significant."""
    return math.log((1 + model.k * n_words) / SIGNIFICANCE)


def significant(model: Model, found: list[tuple[int, int, float]], n_words: int) -> list[tuple[int, int, float]]:
    """Segments with their excess over chance: scaled score less the least significant one."""
    chance = _by_chance(model, n_words)
    return [(a, b, model.scale * s - chance) for a, b, s in found if model.scale * s > chance]


def _evidence_of(model: Model, found: list[tuple[int, int, float]], n_words: float) -> float:
    """Evidence of a text: the log of its segments' excess, or how far its best one falls short."""
    passed = significant(model, found, n_words)
    if passed:
        return math.log1p(sum(s for _, _, s in passed))
    best = max((s for _, _, s in found), default=0.0)
    return (model.scale * best if best else -NO_HIT) - _by_chance(model, n_words)


def _scored(scores: dict[str, float], words: list[list[str]]) -> Iterator[list[tuple[int, int, float]]]:
    """The segments of each text; a word counts by its most toxic key."""
    known = {w: max(s) for w in set().union(*words) if (s := [scores[k] for k in _keys(w) if k in scores])}
    toxic = {w for w, s in known.items() if s > 0}
    for own in words:
        yield [] if toxic.isdisjoint(own) else segments(list(map(known.get, own)))


def _best(scores: dict[str, float]):
    """Words of each text and the scores of its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _texts(batches):
            values = [[s for _, _, s in found] for found in _scored(scores, words)]
            columns = [batch.column(0).cast(pa.int32()), pa.array(map(len, words), pa.int64()), pa.array(values, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "words", "scores"])

    return run


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of the rows plus ``score`` (0 to 1) and ``passages``.

    ``passages`` are the significant toxic segments: first word, end word and
    excess score; words are runs of letters. A null or empty text has none and
    gets the score of a text without evidence. Columns of the names added are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "passages")]
    source = docs.select(*kept, docs[text].alias("_scored_text"))
    passage = "array<struct<first:int,end:int,excess:double>>"
    schema = docs.select(*kept).schema.add("score", "double")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", passages {passage}"
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("excess", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _texts(batches):
            scores, passages = [], []
            for found, own in zip(_scored(model.scores, words), words, strict=True):
                x = model.slope * _evidence_of(model, found, len(own)) + model.offset
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, x)))))
                passages.append([dict(first=a, end=b, excess=s) for a, b, s in significant(model, found, len(own))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array(passages, kind)], [*kept, "score", "passages"]
            )

    return source.mapInArrow(run, out)
