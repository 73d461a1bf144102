"""Importance resampling towards a target distribution over hashed n-grams.

Features are all runs of 1 to 3 words; each falls in one of 10 000 buckets by its crc32. A bucket's gain is the logarithm of how much
commoner it is in the target texts than in the corpus, in thousandths, and a document's weight is the sum of its features' gains.
With Gumbel noise added, taking the highest scores draws documents without replacement in proportion to their weights' exponentials.

1. Gains are one array of a number for each bucket, so weights are sums over whole columns of text: the crc32 of a run follows
   from those of its words, because a crc is linear, and no run is ever written out.
2. A quantile sketch of the scores gives a bracket around the cutoff. Exact counts above and inside it prove that the cutoff lies in it, or
   it is widened and counted again.
3. Only the rows of the bracket are sorted, in ranges spread over tasks, to find the row at the cutoff. Rows up to it are the sample.

Equal scores are drawn by ascending doc_id, rows of one doc_id by a hash of their texts; of equal rows it does not matter which.

Defined results: a null or empty text has no words, no features and weight 0; a null doc_id counts as the empty text in the noise and comes
last among equal scores; repeated rows are weighed and drawn one by one; texts of any length are weighed whole; with an empty target
or corpus all gains follow the same formula with counts of 0; an empty table gives none; extra columns are kept, and one
that bears the name of an added one is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brimline.llm import text as X
from brimline.llm.shared import numbered
from brimline.sources.writers import materialize

BUCKETS, RUNS, SEED, PERCENT, LEAST_WORDS = 10_000, 3, 42, 5, 20
#: Accuracy of the quantile sketch, and by how many of its errors the bracket is wider than the cutoff's share on either side.
ACCURACY, MARGIN = 10_000, 4

#: Words of more bytes are rare; runs that hold one are written out.
LONG = 64
#: Words that are looked at at a time.
BLOCK = 1 << 17


def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The step table; byte [p, b]: a byte b with p zero bytes after it; shift [n, j, v]: v in byte j of a state, and n zero
    bytes after it; end [n]: what the usual first and last inversion add for n bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    zero = lambda x: step[x & 255] ^ (x >> 8)
    byte, shift, end = [step], [np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)], [
        np.full(1, 0xFFFFFFFF, np.uint32)]
    for _ in range(LONG):
        byte.append(zero(byte[-1]))
        shift.append(zero(shift[-1]))
    for _ in range(RUNS * (LONG + 1)):
        end.append(zero(end[-1]))
    return step, np.stack(byte), np.stack(shift), np.concatenate(end) ^ np.uint32(0xFFFFFFFF)


_STEP, _BYTE, _SHIFT, _END = _crc_tables()


def _shifted(state: np.ndarray, by: np.ndarray) -> np.ndarray:
    """States with so many zero bytes after them."""
    flat, at = _SHIFT.reshape(-1), by << 10
    return (flat[at + (state & 255)] ^ flat[at + 256 + ((state >> 8) & 255)] ^ flat[at + 512 + ((state >> 16) & 255)]
            ^ flat[at + 768 + (state >> 24)])


def _word_states(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The crc of each word without inversions: every byte's part follows from its distance to the end."""
    short = np.minimum(size, LONG)  # what comes out for a longer one is not used
    first = np.cumsum(short) - short
    nth = np.arange(short.sum()) - np.repeat(first, short)
    part = _BYTE[np.repeat(short - 1, short) - nth, data[np.repeat(starts, short) + nth]]
    return np.bitwise_xor.reduceat(part, first)


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of all runs of one to three words, part after part."""
    data = X.LOWER[data]
    starts, ends, firsts = X.words(data, offsets, X.NOT_ALNUM)
    for at in range(0, len(starts), BLOCK):
        upto = min(at + BLOCK, len(starts))
        s, e = starts[at : upto + RUNS - 1], ends[at : upto + RUNS - 1]
        size, n = e - s, upto - at
        word, text = _word_states(data, s, size), np.searchsorted(firsts, np.arange(at, at + len(s)), "right") - 1
        i, state, length, long = np.arange(n), word[:n], size[:n], size[:n] > LONG
        for run in range(1, RUNS + 1):
            if run > 1:  # the run before, a space and the next word
                last = i + run - 1
                there = np.flatnonzero(last < len(s))
                there = there[text[last[there]] == text[i[there]]]
                i, last, state = i[there], last[there], state[there]
                state = _shifted(_STEP[(state ^ 32) & 255] ^ (state >> 8), np.minimum(size[last], LONG)) ^ word[last]
                length, long = length[there] + 1 + size[last], long[there] | (size[last] > LONG)
            crc = state ^ _END[np.minimum(length, len(_END) - 1)]
            for j in np.flatnonzero(long).tolist():
                crc[j] = zlib.crc32(b" ".join(data[a:b].tobytes() for a, b in zip(s[i[j] : i[j] + run], e[i[j] : i[j] + run])))
            yield (crc % np.uint32(buckets)).astype(np.int64), text[i]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket. A task sends a row for each bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in X.chunks(batch.column(0)):
                for bucket, _ in features(data, offsets, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], ["bucket", "n"])

    found = docs.select("text").mapInArrow(count, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket; the driver gets a number for each."""
    counts = []
    for df in (docs, target):
        counts.append(np.zeros(buckets))
        for r in bucket_counts(df, buckets).collect():
            counts[-1][r["bucket"]] = r["n"]
    s, t = counts
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """Adds `n_words`, `n_features` and `weight` to any table with a text column."""
    added = ("n_words", "n_features", "weight")
    kept = [c for c in docs.columns if c not in added]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in X.chunks(batch.column(kept.index("text"))):
                n = len(offsets) - 1
                words, runs, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
                for k, (bucket, text) in enumerate(features(data, offsets, len(gain))):
                    found = np.bincount(text, minlength=n)
                    runs += found
                    words += found if k % RUNS == 0 else 0
                    weight += np.bincount(text, gain[bucket], n)
                yield pa.RecordBatch.from_arrays([
                    *batch.slice(row, n).columns, pa.array(words), pa.array(runs), pa.array(weight.astype(np.int64))], [*kept, *added])

    # Under plain names, as Spark looks names with dots up anew when it hands rows to Arrow.
    rows = docs.select(*[f"`{c}`" for c in kept]).toDF(*[f"_{i}" for i in range(len(kept))])
    return rows.mapInArrow(make, T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(c, T.LongType()) for c in added]]))


def noise(seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a digest of the seed and the doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _bracket(scores: DataFrame, k: int, n: int) -> tuple[int, int, int]:
    """Two scores that enclose the k-th highest of n, and how many are above both."""
    reach = MARGIN / ACCURACY
    while True:
        low, high = 1 - k / n - reach, 1 - k / n + reach
        a, b = scores.agg(F.percentile_approx("score", F.array(F.lit(max(low, 0.0)), F.lit(min(high, 1.0))), ACCURACY)).first()[0]
        above, inside = scores.agg(F.count_if(F.col("score") > b), F.count_if(F.col("score").between(a, b))).first()
        if above < k <= above + inside:
            return a, b, above
        reach = max(4 * reach, 1 / ACCURACY)  # at worst the whole range, which holds every score


def draw(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds `rank` (1, 2, ... from the highest score, null where not drawn) to a table with doc_id, n_words, score and text_hash.

    `percent` of a hundred rows with enough words are drawn. The table is read several times and should be stored.
    """
    enough = F.col("n_words") >= least_words
    n = rows.where(enough).count()
    k = percent * n // 100
    kept = [F.col(f"`{c}`") for c in rows.columns if c != "rank"]
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*kept, none)
    low, high, above = _bracket(rows.where(enough).select("score"), k, n)
    blank = F.lit(0).cast(rows.schema["doc_id"].dataType)
    order = [-F.col("score"), F.col("doc_id").isNull().cast("int"), F.coalesce("doc_id", blank), F.col("text_hash")]
    inside = rows.where(enough & F.col("score").between(low, high)).select(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    last = numbered(inside, [f"k{i}" for i in range(len(order))], "place").where(F.col("place") == k - above).first()
    taken = enough & (F.struct(*order) <= F.struct(*[F.lit(last[f"k{i}"]).cast(inside.schema[f"k{i}"].dataType) for i in range(len(order))]))
    ranked = numbered(rows.where(taken).select(*kept), order, "rank")
    # Rows equal to the one at the cutoff may be more than there is room for.
    return rows.where(~taken).select(*kept, none).union(ranked.select(*kept, F.when(F.col("rank") <= k, F.col("rank")).alias("rank")))


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds `n_words`, `n_features`, `weight`, `score` and `text_hash` to a table of documents; target has texts too."""
    found = weigh(docs, gains(docs, target))
    return found.withColumns({"score": F.col("weight") + noise(seed), "text_hash": F.xxhash64("text")})


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents with all their columns, `score` and `rank`."""
    return draw(materialize(scored(docs, target, seed)), percent, least_words).where("rank is not null").drop("text_hash")


def ranks(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each document; texts are not stored."""
    found = scored(docs.select("doc_id", "text"), target, seed).drop("text")
    return draw(materialize(found), percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")
