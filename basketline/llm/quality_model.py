"""Supervised subword embeddings for document quality.

A document is the mean of learned vectors of its hashed words and of their character n-grams; a softmax layer turns
the mean into two class probabilities. Vectors and layer are trained by numpy stochastic gradient descent over a
sample of at most ``SAMPLE`` labelled documents (lowest hash of the id first; a documented bound, the only one).
As mean and layer are linear, each hash bucket then needs one number only, its vector's pull towards class 1, and a
whole text is scored from cached sums of its distinct words. The bucket table is ``BUCKETS`` floats, whatever the data.

A null or empty text has the mean 0 and gets the score of the layer's bias. A null label is not learnt from. Without any
label, every score is 0.5. Repeated rows are scored alike; an empty table gives an empty result; only text is an input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm.batches import TokenIds, column_of, pieces, row_sums, starts_of
from basketline.llm.tables import text_of

BUCKETS, DIM, SAMPLE, EPOCHS, RATE, SEED = 2**16, 16, 2000, 12, 0.5, 7
SHORTEST, LONGEST = 3, 5
#: Bytes of words that a task keeps, and characters that it takes at once.
KEPT_BYTES, CHARS = 40_000_000, 500_000


def held_out(column: str = "doc_id"):
    """True for the third of the ids that is never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams, with marks for begin and end."""
    marked = f"<{word}>"
    out = [zlib.crc32(f"w{word}".encode()) % BUCKETS]
    for n in range(SHORTEST, LONGEST + 1):
        out += [zlib.crc32(marked[i : i + n].encode()) % BUCKETS for i in range(len(marked) - n + 1)]
    return out


def _counted(text: str, known: dict) -> tuple[np.ndarray, np.ndarray]:
    counts: dict = {}
    for word in text.split():
        counts[word] = counts.get(word, 0) + 1
    ids, times = [], []
    for word, n in counts.items():
        own = known.get(word)
        if own is None:
            own = known[word] = features(word)
        ids += own
        times += [n] * len(own)
    sums = np.bincount(ids, times, BUCKETS) if ids else np.zeros(BUCKETS)
    at = np.flatnonzero(sums)
    return at, (sums[at] / max(sums.sum(), 1)).astype(np.float32)


def fit(rows: list[tuple[str, int]]) -> tuple[np.ndarray, float]:
    """Pull of each bucket and bias, from (text, label)."""
    rng, known = np.random.default_rng(SEED), {}
    data = [(*_counted(text or "", known), int(label)) for text, label in rows]
    if not data:
        return np.zeros(BUCKETS, np.float32), 0.0
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(data)):
            at, share, label = data[i]
            mean = share @ vectors[at] if len(at) else np.zeros(DIM, np.float32)
            odds = layer @ mean + bias
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[label] -= 1
            if len(at):
                # shares are small, so vectors move with the size of the mean restored
                vectors[at] -= rate * len(at) ** 0.5 * np.outer(share, layer.T @ p)
            layer -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
    return (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    chosen = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    rows = (
        docs.select(F.col("doc_id").alias("_id"), text_of().alias("_text"))
        .join(F.broadcast(chosen), "_id")  # at most ``sample`` rows of two numbers
        .orderBy(F.xxhash64("_id"), "_text")
        .limit(sample)
        .select("_text", "_quality")
        .collect()
    )
    return fit([tuple(r) for r in rows])


def scored(docs: DataFrame, model: tuple[np.ndarray, float], name: str = "score") -> DataFrame:
    """All columns of ``docs`` packed in ``row``, and the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pull, bias = shared.value
        known, sums, sizes = TokenIds(), np.zeros(0), np.zeros(0)
        for piece in pieces(batches, chars=CHARS):
            own = [(text or "").split() for text in column_of(piece, "text").to_pylist()]
            if known.size > KEPT_BYTES:
                known, sums, sizes = TokenIds(), np.zeros(0), np.zeros(0)
            ids, new = known.index([w for words in own for w in words])
            if new:
                buckets = [features(w) for w in new]
                lengths = np.fromiter(map(len, buckets), np.int64, len(buckets))
                flat = pull[np.fromiter((b for own_ in buckets for b in own_), np.int64, int(lengths.sum()))]
                sums = np.concatenate((sums, row_sums(flat.astype(np.float64), starts_of(lengths))))
                sizes = np.concatenate((sizes, lengths))
            at = starts_of(np.array([len(w) for w in own], np.int64))
            mean = row_sums(sums[ids], at) / np.maximum(row_sums(sizes[ids], at), 1)
            score = np.round(1 / (1 + np.exp(-np.clip(mean + bias, -500, 500))), 9)
            yield pa.record_batch([piece["row"], pa.array(score)], names=["row", name])

    schema = packed.select("row", F.lit(0.0).alias(name)).schema
    return packed.mapInArrow(run, schema)
