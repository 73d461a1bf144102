"""Quality score: logistic regression over hashed word n-grams, fitted with follow-the-regularised-leader updates.

Tokens are runs of letters and digits (with everything beyond ASCII) and runs of punctuation. A document is the sparse
vector of its 1-grams and 2-grams, each hashed to one of 2**bits slots, with relative frequencies as values; a 2-gram of
one token twice has a slot of its own. A score is one sparse dot product, so scoring reads texts once and shuffles nothing.

Defined results: a null or empty text has no n-grams and gets the score of the bias alone; without labelled rows every
score is 0.5; long texts are read whole; repeated rows score alike; extra columns pass through `score`, and an input
column named `score` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from brimline.llm import text as X, training

#: Documents that a fit reads at most, passes over them, and slots of the weight vector.
SAMPLE_ROWS, EPOCHS, BITS = 6000, 4, 18
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
SCALE = 32.0
THRESHOLD = 0.3

_KIND = np.ones(256, np.uint8)
_KIND[list(X.SPACES)] = 0
_KIND[[i for i in range(128) if X.NOT_ALNUM[i] and not X.SPACE_TABLE[i]]] = 2


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of tokens and the offsets of texts in tokens."""
    data = X.LOWER[data]
    kind = _KIND[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    keep = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    return X.span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def slots(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams, and the number of the text of each. Slot 0 is left to the bias."""
    h, firsts = tokens(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    same = text[1:] == text[:-1]
    pair = X.mix(h[:-1] * np.uint64(3) + h[1:] * np.uint64(0x9E3779B97F4A7C15))
    pair[h[:-1] == h[1:]] = np.uint64(1)
    grams = np.concatenate([h, pair[same]])
    return (grams % np.uint64((1 << bits) - 1)).astype(np.int64) + 1, np.concatenate([text, text[1:][same]])


def fit_ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS,
             epochs: int = EPOCHS) -> np.ndarray:
    """Weights after `epochs` passes of per-coordinate FTRL-proximal updates; a vector is (slots, values)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(i):
        w = (np.sign(z[i]) * L1 - z[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where((np.abs(z[i]) <= L1) & (i > 0), 0.0, w)

    for _ in range(epochs):
        for (i, x), y in zip(vectors, labels):
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    return weights(np.arange(1 << bits))


def sparse(sample: DataFrame, bits: int) -> DataFrame:
    """(doc_id, label, slots, values) of sampled documents."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, value = [], []
            for _, data, offsets in X.chunks(batch.column("text")):
                slot, text = slots(data, offsets, bits)
                slot = slot[np.argsort(text, kind="stable")]
                last = np.cumsum(np.bincount(text, minlength=len(offsets) - 1))
                for part in np.split(slot, last[:-1]):
                    at, count = np.unique(part, return_counts=True)
                    where.append(np.concatenate([[0], at]))
                    value.append(np.concatenate([[1.0], SCALE * count / max(1, count.sum())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array(where, pa.list_(pa.int64())), pa.array(value, pa.list_(pa.float64()))],
                ["doc_id", "label", "slots", "values"])

    schema = T.StructType([sample.schema["doc_id"], T.StructField("label", T.IntegerType()),
                           T.StructField("slots", T.ArrayType(T.LongType())),
                           T.StructField("values", T.ArrayType(T.DoubleType()))])
    return sample.select("doc_id", "text", "label").mapInArrow(make, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights from at most `rows` labelled documents; the sequential updates run in one task on that bounded sample."""
    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        vectors = [(np.asarray(i), np.asarray(x)) for i, x in zip(
            table["slots"].to_pylist(), table["values"].to_pylist())]
        order = np.random.default_rng(7).permutation(len(vectors))
        w = fit_ftrl([vectors[i] for i in order], table["label"].to_numpy()[order], bits)
        return pa.table({"weights": pa.array([w.astype(np.float32).tobytes()], pa.binary())})

    sample = sparse(training.labelled_sample(docs, labels, label, rows), bits)
    made = sample.withColumn("all", F.lit(1)).groupBy("all").applyInArrow(learn, "weights binary").collect()
    return np.frombuffer(made[0]["weights"], np.float32) if made else np.zeros(1 << bits, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Adds `score`, the probability of label 1, to any table with a text column."""
    bits = len(weights).bit_length() - 1
    kept = [c for c in docs.columns if c != "score"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(0)]
            for _, data, offsets in X.chunks(batch.column(batch.schema.get_field_index("text"))):
                slot, text = slots(data, offsets, bits)
                n = len(offsets) - 1
                total = np.bincount(text, weights[slot], n)
                mean = total / np.maximum(1, np.bincount(text, minlength=n))
                out.append(1.0 / (1.0 + np.exp(-np.clip(weights[0] + SCALE * mean, -35, 35))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], [*kept, "score"])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("score", T.DoubleType())])
    return docs.select(*kept).mapInArrow(make, schema)
