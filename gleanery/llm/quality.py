"""Supervised subword embeddings: a text classifier of hashed word and character n-gram vectors.

A document is the average of the vectors of its words and of the character n-grams inside them (with word-boundary
marks); a linear layer and softmax give the label. Vectors and layer are trained by stochastic gradient descent in
numpy. As the softmax has two labels and the average is linear, scoring needs one number for each bucket: the vector
times the difference of the two output rows, so whole corpora are scored with array lookups.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import boxed, chunks, mix64, _power, release_memory, text_buffer

BUCKETS = 1 << 17
DIM = 10
NGRAMS = (3, 4, 5)
#: Passes over the sample, more if it is small: at least so many steps.
EPOCHS, LEAST_STEPS = 8, 30_000
RATE = 0.5
#: The classifier is fitted on at most so many labelled rows of each label.
MAX_TRAIN = {0: 2000, 1: 4000}
THRESHOLD = 0.7

_MUL = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
#: Place values of the characters of an n-gram; odd numbers, so none is lost.
_PLACE = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64)) for k in range(max(NGRAMS))]


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of UTF-8 texts, every kind of blank as one, with one blank before each text and after the last."""
    n = len(offsets) - 1
    letters = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    out = np.full(len(letters) + n + 1, 32, np.uint32)
    place = np.arange(len(letters)) + np.repeat(np.arange(1, n + 1), np.diff(starts))
    out[place] = np.where((letters >= 9) & (letters <= 13), 32, letters)
    return out, starts + np.arange(n + 1)


def features(data: np.ndarray, offsets: np.ndarray):
    """For words and each n-gram length: bucket, whether it counts, and first entry of each text (n+1 values).

    N-grams of characters; the first and last may be the blank around a word, inner ones may not.
    """
    text, starts = _spaced(data, offsets)
    wide = text.astype(np.uint64)
    blank = text == 32
    first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    last = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    # A word's hash is a sum over its characters, each mixed with its place in the word.
    total = np.zeros(len(wide) + 1, np.uint64)
    np.cumsum(mix64(wide + np.uint64(1)) * _power("up", len(wide)), out=total[1:])
    whole = mix64((total[last] - total[first]) * _power("down", len(wide) + 1)[first])
    yield (whole >> _SHIFT).astype(np.int32), np.ones(len(first), bool), np.searchsorted(first, starts)
    inner = np.concatenate([[0], np.cumsum(blank)])
    gram = np.zeros(len(wide), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        m = len(text) - n + 1
        if m <= 0:
            break
        gram = gram[:m] + wide[n - 1 :] * _PLACE[n - 1]
        if n in NGRAMS:
            ok = inner[n - 1 : n - 1 + m] == inner[1 : 1 + m]
            key = (gram + np.uint64(n)) * _MUL
            yield ((key ^ key >> np.uint64(29)) * _MUL >> _SHIFT).astype(np.int32), ok, np.minimum(starts, m)


class _Bags:
    """Distinct buckets of texts with their shares, in two long arrays: nothing small is left behind in a worker's memory."""

    def __init__(self):
        self.ids, self.share, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.float32), [0]

    def add(self, text: bytes) -> None:
        parts = list(features(np.frombuffer(text, np.uint8), np.array([0, len(text)])))
        found, count = np.unique(np.concatenate([idx[ok] for idx, ok, _ in parts]), return_counts=True)
        a, b = self.ends[-1], self.ends[-1] + len(found)
        if b > len(self.ids):
            self.ids, self.share = (np.concatenate([x, np.zeros(max(len(x), len(found)), x.dtype)]) for x in (self.ids, self.share))
        self.ids[a:b], self.share[a:b] = found, count / max(1, count.sum())
        self.ends.append(b)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[k], self.ends[k + 1]
        return self.ids[a:b], self.share[a:b]


def fit(texts: Iterable[bytes], labels: np.ndarray, seed: int = 5) -> tuple[np.ndarray, float]:
    """Scores of the buckets and bias, after some epochs of SGD with a falling rate."""
    rng = np.random.default_rng(seed)
    bags = _Bags()
    for text in texts:
        bags.add(text)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    epochs = max(EPOCHS, -(-LEAST_STEPS // len(bags)))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            rate = RATE * (1 - done / steps)
            done += 1
            ids, share = bags[k]
            hidden = share @ vectors[ids]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[k])] -= 1
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= rate * 0.1 * p
            vectors[ids] -= rate * share[:, None] * back
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def logits(data: np.ndarray, offsets: np.ndarray, scores: np.ndarray, bias: float) -> np.ndarray:
    n = len(offsets) - 1
    total, count = np.zeros(n), np.zeros(n)
    for idx, ok, first in features(data, offsets):
        value = np.concatenate([[0], np.cumsum(np.where(ok, scores[idx], 0), dtype=np.float64)])
        seen = np.concatenate([[0], np.cumsum(ok)])
        total += value[first[1:]] - value[first[:-1]]
        count += seen[first[1:]] - seen[first[:-1]]
    return total / np.maximum(count, 1) + bias


def held_out(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: dict[int, int] | None = None) -> tuple[np.ndarray, float] | None:
    """Fit on at most max_train rows of each label, those with the least hashes of their ids outside the held-out part.

    None if one of the labels has no row. The ids are chosen from ``labels`` alone; their number is bounded, so they
    are broadcast, and the sample is the only text that one task sees together.
    """
    most = max_train or MAX_TRAIN
    usable = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("__y")).where(F.col("__id").isNotNull() & F.col("__y").isin(0, 1))
    usable = usable.groupBy("__id").agg(F.max("__y").alias("__y")).where(~held_out("__id"))
    order = F.xxhash64("__id", F.lit(11))
    picked = [usable.where(F.col("__y") == y).orderBy(order, "__id").limit(n) for y, n in most.items()]
    chosen = picked[0].unionByName(picked[1])
    sample = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text")).join(F.broadcast(chosen), "__id")

    def run(table):
        table = table.sort_by("__id")
        y = table.column("__y").to_numpy()
        if len(set(y.tolist())) < 2:
            return pa.table({"scores": pa.array([], pa.binary()), "bias": pa.array([], pa.float64())})
        scores, bias = fit(((t.as_py() or "").encode() for t in table.column("__text")), y)
        release_memory()
        return pa.table({"scores": pa.array([scores.astype(np.float32).tobytes()], pa.binary()), "bias": [bias]})

    rows = sample.withColumn("__g", F.lit(1)).groupBy("__g").applyInArrow(run, "scores binary, bias double").collect()
    return (np.frombuffer(rows[0].scores, np.float32), rows[0].bias) if rows else None


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, score): each row of ``docs`` as a struct, and its score (0 to 1, higher: label 1 likelier) for the whole text.

    Null and empty texts have the score of the bias alone; very long ones are averaged like any other. Without rows of
    both labels nothing can be learnt and every score is 1.0. An empty table stays empty; ids on several rows are scored
    one by one; a document with two labels counts as of quality 1. Columns of ``docs`` may have any name.
    """
    spark = docs.sparkSession
    model = train(docs, labels, id_col, text_col)
    if model is None:
        return boxed(docs, score=F.lit(1.0))
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        scores, bias = shared.value
        data, offsets = text_buffer(pa.Array.from_pandas(texts, type=pa.large_string()))
        z = np.concatenate([logits(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], scores, bias) for a, b in chunks(offsets)] or [np.zeros(0)])
        import pandas as pd

        release_memory()
        return pd.Series(1 / (1 + np.exp(-z)))

    return boxed(docs, score=score(F.col(text_col).cast("string")))


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= 0.7)."""
    rows = quality_scores(docs.select(id_col, text_col), labels, id_col, text_col)
    return rows.select(F.col(f"row.{id_col}").alias("doc_id"), held_out(f"row.{id_col}").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the classifier accepts, with their columns as they were, whatever their names.

    Whole texts are judged, null and empty ones by the bias alone; a score of exactly THRESHOLD is accepted. Repeated
    rows are judged one by one. An empty table stays empty; without rows of both labels every document is kept.
    """
    return quality_scores(docs, labels, id_col, text_col).where(F.col("score") >= THRESHOLD).select("row.*")


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
