"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, of neighbouring words and of words one apart,
in ``2 ** BITS`` buckets, and a bias. Every coordinate has its own learning rate, and the L1 term keeps
coordinates without steady evidence at exactly zero, so what is broadcast for scoring is a short list of
weights.

Labels are learned from at most ``max_rows`` labelled rows (a fixed bound of this operator): all of them,
or where there are more, those whose hash of doc_id falls into the share that gives nine tenths of it. Their features are stored in
a table and stream ``EPOCHS`` times in a fixed order through one task, whose state has the fixed size of the
hash table: evidence adds up over all rows, and the model does not depend on how the rows are dealt. The rates
below were chosen by log loss and recall on every fourth training row, with the others to learn from.
Scoring reads every document once and shuffles nothing.

Defined cases: null or empty text has the bias as its only feature. A label that is null or neither 0
nor 1 is not used; a document with several labels is toxic if one says so, documents that share a
doc_id get the same label. Without labels every score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sublens.llm.batches import NOT_ALNUM, Words, mapped, mixed
from sublens.llm.scratch import written

BITS = 20
SIZE = 1 << BITS
MAX_ROWS = 20_000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 20.0, 0.1
_SALTS = [np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_TOP = np.uint64(64 - BITS)


def buckets(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For single words, neighbours and words one apart: index of the first word, and the bucket."""
    hashes, room = words.hashes(), words.room()
    out = []
    for reach, salt in enumerate(_SALTS):
        first = np.flatnonzero(room > reach)
        key = hashes[first] * salt
        if reach:
            key = key + hashes[first + reach] * np.uint64(0xD6E8FEB86659FD93)
        out.append((first, (mixed(key + salt) >> _TOP).astype(np.int32)))
    return out


def feature_lists(docs: DataFrame, keep: list[str]) -> DataFrame:
    def start():
        def run(texts: pa.Array) -> list:
            words = Words(texts, NOT_ALNUM)
            owner = np.repeat(np.arange(len(texts)), words.counts)
            found = buckets(words)
            pairs = np.unique(
                np.concatenate([owner[first].astype(np.int64) * SIZE + bucket for first, bucket in found])
            )
            counts = np.bincount(pairs // SIZE, minlength=len(texts))
            offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            return [pa.ListArray.from_arrays(offsets, pa.array((pairs % SIZE).astype(np.int32)))]

        return run

    return mapped(docs, {"features": T.ArrayType(T.IntegerType())}, start, keep)


def weights_of(z: np.ndarray, n: np.ndarray, l1: float = L1) -> np.ndarray:
    return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class State:
    """FTRL's z and n of every bucket; the last place is the bias, which has no L1 term."""

    def __init__(self):
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, SIZE)
        z, n = self.z[at], self.n[at]
        w = weights_of(z, n)
        w[-1] = weights_of(z[-1:], n[-1:], 0.0)[0]
        g = sigmoid(w.sum()) - label
        grown = n + g * g
        self.z[at] = z + g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown

    def model(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Bias, and buckets with their weights where these are not zero."""
        w = weights_of(self.z[:-1], self.n[:-1])
        at = np.flatnonzero(w)
        return float(weights_of(self.z[-1:], self.n[-1:], 0.0)[0]), at, w[at]


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int) -> DataFrame:
    """place, doc_id, label, features of the rows to learn from."""
    rows = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .filter(learn)
        .withColumn("place", F.xxhash64("doc_id"))
    )
    every = written(rows, "toxicity-labels")
    n = every.count()
    # a share of the hash range, so that nothing has to be sorted; nine tenths leave room for chance
    edge = 2**63 - 1 if n <= max_rows else int(2**64 * 0.9 * max_rows / n) - 2**63
    chosen = every.filter(F.col("place") <= edge)
    # at most max_rows rows of an id, a label and a hash
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return written(feature_lists(texts, ["doc_id", "label", "place"]), "toxicity-features")


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = State()
    for batch in batches:
        lists = batch.column(0)
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        for a, b, label in zip(offsets[:-1], offsets[1:], batch.column(1).to_pylist()):
            state.learn(flat[a:b], label)
    bias, at, w = state.model()
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, SIZE).astype(np.int32)), pa.array(np.append(w, bias))], ["bucket", "weight"]
    )


def trained(rows: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, and buckets with their weights: at most max_rows rows, read in order as a stream, EPOCHS times."""
    passes = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS)))).repartition(1)
    ordered = passes.sortWithinPartitions("epoch", "place", "doc_id").select("features", "label")
    weights = ordered.mapInArrow(_learned, "bucket int, weight double").toArrow()
    at, w = weights["bucket"].to_numpy(), weights["weight"].to_numpy()
    if not len(at):
        return 0.0, at, w
    return float(w[-1]), at[:-1], w[:-1]


def scored(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray], keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs with a score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        bias, at, w = shared.value
        table = np.zeros(SIZE)
        table[at] = w

        def run(texts: pa.Array) -> list:
            words = Words(texts, NOT_ALNUM)
            owner = np.repeat(np.arange(len(texts)), words.counts)
            pairs = []
            for first, bucket in buckets(words):
                hit = table[bucket] != 0
                pairs.append(owner[first[hit]].astype(np.int64) * SIZE + bucket[hit])
            pairs = np.unique(np.concatenate(pairs))
            return [sigmoid(bias + np.bincount(pairs // SIZE, table[pairs % SIZE], len(texts)))]

        return run

    return mapped(docs, {"score": T.DoubleType()}, start, keep)


def toxicity_model(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int = MAX_ROWS):
    return trained(labelled(docs, labels, learn, max_rows))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = toxicity_model(docs, labels, ~held_out())
    return scored(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
