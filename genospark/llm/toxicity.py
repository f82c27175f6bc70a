"""Toxicity scores from a counterfactual-regularised linear classifier.

Features are the hashed words of a text, and the hashed first 4 to 7 bytes of longer words, each counted once. Fitting is
logistic regression on labelled documents, with a penalty on how far the score moves when the identity terms of a
sentence are exchanged for others of their kind, so that naming a group carries no weight by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import Words, parts, slices, words
from .tables import saved

# Identity terms; terms in one line may stand for each other.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("she", "he"),
    ("her", "his"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "straight", "bisexual"),
    ("transgender", "cisgender"),
    ("immigrants", "citizens", "refugees"),
    ("african", "european", "american", "arab", "mexican", "chinese"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
)
PREFIXES = (4, 5, 6, 7)
WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


@dataclass
class Model:
    """weights by bucket, bias, and the number of bits of a bucket."""

    weights: np.ndarray
    bias: float
    bits: int


def buckets(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each different feature of each text, in order of the text."""
    at = w.texts()
    found = w.bare().hashes(PREFIXES)
    text = np.concatenate([at[h != 0] for h in found])
    bucket = np.concatenate([((h[h != 0] ^ np.uint64(k * 0x9E3779B9)) >> np.uint64(64 - bits)).astype(np.int64) for k, h in enumerate(found)])
    pairs = np.unique((text << bits) | bucket)
    return pairs >> bits, pairs & ((1 << bits) - 1)


@lru_cache(maxsize=1)
def swap_table() -> dict[str, str]:
    """Each identity term and the one that takes its place: the next of its line."""
    return {a: line[(i + 1) % len(line)] for line in IDENTITY_TERMS for i, a in enumerate(line)}


def swapped(text: str) -> str | None:
    """The text with its identity terms exchanged, in any case; None if it has none."""
    table = swap_table()
    twin = WORD.sub(lambda m: table.get(m[0].lower(), m[0]), text)
    return twin if twin != text else None


def one(text: str, bits: int) -> np.ndarray:
    """The sorted different buckets of a text."""
    data = text.encode()
    return buckets(words(np.frombuffer(data, np.uint8), np.array([0, len(data)])), bits)[1]


def sample_features(docs: DataFrame, labels: DataFrame, bits: int, fit_rows: int) -> DataFrame:
    """(label, features, gone, come): at most fit_rows labelled documents, the first by a hash of the id.

    features: the buckets of the text; gone and come: those that it loses and gains when its identity terms are exchanged.
    An id with several texts has the first of them by the alphabet; where its labels disagree, label 1.
    """
    y = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    # texts meet only the ids that were picked, whose number is bounded
    picked = y.join(docs.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 64):
            columns: list[list] = [[], [], []]
            for text in b.column("text").to_pylist():
                own, twin = one(text, bits), swapped(text)
                other = own if twin is None else one(twin, bits)
                for c, x in zip(columns, (own, np.setdiff1d(own, other), np.setdiff1d(other, own))):
                    c.append(x.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("label"), *[pa.array(c, pa.list_(pa.int32())) for c in columns]], ["label", "features", "gone", "come"])

    one_each = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return one_each.select("label", "text").mapInArrow(run, "label int, features array<int>, gone array<int>, come array<int>")


def telling(sample: DataFrame, n: int, toxic: int, screen: float) -> DataFrame:
    """(bucket) of the features that get a weight: those in three rows at least whose shares of the two labels differ by `screen` standard errors."""
    seen = sample.select("label", F.explode("features").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("spread"), F.sum("label").alias("hits"))
    share = F.col("spread") / n
    error = F.sqrt((share * (1 - share) + 1 / n) * (1 / toxic + 1 / (n - toxic)))
    gap = F.abs(F.col("hits") / toxic - (F.col("spread") - F.col("hits")) / (n - toxic))
    return seen.where((F.col("spread") >= 3) & (gap >= screen * error)).select("bucket")


@dataclass
class Sparse:
    """A sparse matrix by its entries."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def times(self, w: np.ndarray, rows: int) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], rows)

    def back(self, g: np.ndarray, columns: int) -> np.ndarray:
        return np.bincount(self.column, self.value * g[self.row], columns)


def sparse(parts: list[tuple[list[np.ndarray], float]]) -> Sparse:
    """Rows of column numbers, each list with the value that its entries have."""
    row = [np.repeat(np.arange(len(x), dtype=np.int32), [len(r) for r in x]) for x, _ in parts]
    return Sparse(np.concatenate(row), np.concatenate([c for x, _ in parts for c in (*x, np.zeros(0, np.int32))]), np.concatenate([np.full(len(r), v, np.float32) for r, (_, v) in zip(row, parts)]))


def loss_and_gradient(w: np.ndarray, bias: float, x: Sparse, gap: Sparse, y: np.ndarray, l2: float, counterfactual: float) -> tuple[float, np.ndarray, float]:
    """Mean log loss + counterfactual * mean (score - score of the twin) ** 2 + l2 / 2 * |w| ** 2, scores before the sigmoid; its gradient by w and bias."""
    n = len(y)
    z = np.clip(x.times(w, n) + bias, -30, 30)
    moved = gap.times(w, n)
    g = (1 / (1 + np.exp(-z)) - y) / n
    loss = float(np.mean(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z) + counterfactual * np.mean(moved**2) + l2 / 2 * (w @ w))
    return loss, x.back(g, len(w)) + gap.back(counterfactual * 2 * moved / n, len(w)) + l2 * w, float(g.sum())


def fit(y: np.ndarray, x: Sparse, gap: Sparse, size: int, steps: int = 300, l2: float = 4e-4, counterfactual: float = 1.0) -> tuple[np.ndarray, float]:
    """(weights, bias) of the logistic regression by Adam on all rows at once; gap: rows of a text minus its twin."""
    w = np.zeros(size)
    bias = float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        _, grad, gb = loss_and_gradient(w, bias, x, gap, y, l2, counterfactual)
        g = np.append(grad, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        step = 0.05 / (1 - 0.9**t) * m / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, bias


def toxicity_model(docs: DataFrame, labels: DataFrame, bits: int = 18, fit_rows: int = 12_000, screen: float = 4.0, **options) -> Model:
    """Fitted on at most fit_rows rows of labels(doc_id, toxic) joined with docs(doc_id, text).

    Spark makes and counts the features; most are rare, say nothing of other texts and stay behind. The driver gets the
    numbers of the others in these rows: 4 bytes for each, of fit_rows rows and 2 ** bits columns at most. Fewer labelled
    rows are all used; without any of one of the labels the model gives every text the share of label 1.
    """
    sample = saved(sample_features(docs, labels, bits, fit_rows))
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    weights = np.zeros(1 << bits, np.float32)
    if not 0 < toxic < n:
        share = min(max(toxic / n if n else 0.0, 1e-3), 1 - 1e-3)
        return Model(weights, float(np.log(share / (1 - share))), bits)
    used = np.array(sorted(r["bucket"] for r in telling(sample, n, toxic, screen).collect()), np.int32)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(1 << bits, -1, np.int32)
        number[used] = np.arange(len(used))
        for b in parts(batches, 64):
            columns = [[(k := number[x.values.to_numpy()])[k >= 0].tobytes() for x in b.column(c)] for c in ("features", "gone", "come")]
            yield pa.RecordBatch.from_arrays([b.column("label"), *[pa.array(c, pa.binary()) for c in columns]], ["label", "features", "gone", "come"])

    rows = sample.mapInArrow(numbered, "label int, features binary, gone binary, come binary").toArrow()
    own, gone, come = ([np.frombuffer(x.as_py(), np.int32) for x in rows.column(c)] for c in ("features", "gone", "come"))
    weights[used], bias = fit(rows.column("label").to_numpy().astype(np.float64), sparse([(own, 1.0)]), sparse([(gone, 1.0), (come, -1.0)]), len(used), **options)
    return Model(weights, bias, bits)


def toxicity_scores(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= threshold): one row per row of docs(text, ...).

    Null and empty texts score by the bias alone. Whole texts are read, in slices of an Arrow batch. Other columns stay,
    a null doc_id too; earlier columns called score or predicted are replaced. An empty table gives no rows.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in parts(batches):
            score = np.zeros(b.num_rows)
            for a, z, data, bounds in slices(b.column("text")):
                text, bucket = buckets(words(data, bounds), m.bits)
                score[a:z] = np.bincount(text, m.weights[bucket], z - a)
            score = 1 / (1 + np.exp(-np.clip(score + m.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*b.schema.names, "score", "predicted"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double, predicted int"])
    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
