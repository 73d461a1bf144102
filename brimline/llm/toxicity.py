"""Toxicity score: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of two lexicons (a fixed one of insults, and one of words and word beginnings whose log odds are
learned from labelled documents), insults close to a second-person word, capitals, punctuation, and obfuscation (letters mixed
with digits or signs; insults that appear only after such signs are read as letters).

The bounded labelled sample is split by id into three parts: one for the learned lexicon, one for the trees, one for the
calibration, so that no part judges what it was fitted on.

Defined results: a null or empty text has features 0 and is scored like any other; without labelled rows every score is 0;
long texts are read whole; repeated rows score alike; extra columns pass through `score`, and input columns named
`score` or `features` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F, types as T

from brimline.llm import text as X, training
from brimline.sources.writers import materialize

#: Labelled documents that a fit reads at most; shares of the sample, in tenths, for lexicon and trees (the rest calibrates).
SAMPLE_ROWS, LEXICON_TENTHS, TREE_TENTHS = 12000, 4, 4
TREES, DEPTH, STEP = 20, 4, 0.2
THRESHOLD = 0.5
BITS, PREFIXES = 16, (4, 6, 8)
NEAR = 4

# Insults and second-person words.
INSULTS = (
    "arrogant", "bastard", "bastards", "clown", "clowns", "coward", "creep", "cretin", "crook", "degenerate", "disgrace",
    "disgusting", "dumb", "dumbass", "fool", "fools", "freak", "garbage", "hate", "idiot", "idiotic", "idiots", "ignorant",
    "imbecile", "jerk", "kill", "liar", "loser", "losers", "lunatic", "moron", "moronic", "morons", "nasty", "parasite",
    "pathetic", "pig", "rat", "repulsive", "rubbish", "scum", "scumbag", "shit", "sick", "stupid", "trash", "ugly", "useless",
    "vermin", "vile", "weak", "worthless", "wretch", "dumm", "idioten", "abschaum", "wertlos", "dreck", "verlierer", "trottel",
    "imbécile", "ordure", "nul", "débile", "crétin", "perdant", "clowns", "idiota", "estúpido", "basura", "escoria", "inútil",
    "perdedor", "payaso", "patético", "asqueroso",
)
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "tu", "toi", "te",
                 "ton", "ta", "vous", "votre", "usted", "ti", "tus")
#: Signs read as letters when a word is obfuscated.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_READ = X.LOWER.copy()
for _sign, _letter in LEET.items():
    _READ[ord(_sign)] = ord(_letter)
_NOT_LETTER = X.NOT_ALNUM | X.table_of(b"0123456789")
_LETTER = ~_NOT_LETTER
_UPPER = X.table_of(bytes(range(65, 91)))
_PUNCTUATION = X.NOT_ALNUM & ~X.SPACE_TABLE & ~X.table_of(bytes(range(32)))
_INNER = X.table_of(b"0123456789@$!*#")

FEATURES = (
    "log_words", "insults", "log_insults", "hidden_insults", "insults_near_you", "you", "capitals", "capital_words",
    "punctuation", "exclamations", "obfuscated",
    *(f"learned_{what}_{n}" for n in (*PREFIXES, "word") for what in ("mean", "strong", "top")))


def lexicon(entries: tuple[str, ...]) -> np.ndarray:
    data, offsets = X.utf8(pa.array(sorted(set(entries))))
    return np.sort(X.span_hashes(data, offsets[:-1], offsets[1:]))


def member(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def word_slots(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> list[np.ndarray]:
    """Slots in the learned lexicons: beginnings of each length in bytes (longer words only), then whole words; slot 0 is none."""
    out = []
    for n in PREFIXES:
        h = X.span_hashes(low, starts, np.minimum(starts + n, ends)) % np.uint64((1 << BITS) - 1)
        out.append(np.where(ends - starts > n, h.astype(np.int64) + 1, 0))
    return [*out, (whole % np.uint64((1 << BITS) - 1)).astype(np.int64) + 1]


def features(data: np.ndarray, offsets: np.ndarray, odds: np.ndarray, insults: np.ndarray, you: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; odds has a row of log odds by slot for each learned lexicon."""
    n = len(offsets) - 1
    low = X.LOWER[data]
    starts, ends, firsts = X.words(low, offsets, X.NOT_ALNUM)
    count = np.diff(firsts)
    text = np.repeat(np.arange(n), count)
    per_word = lambda x: np.bincount(text, x, n) / np.maximum(1, count)
    running = lambda members: np.concatenate([[0], np.cumsum(members[data])])
    between = lambda total, a, b: total[b] - total[a]

    whole = X.span_hashes(low, starts, ends)
    rude, other = member(whole, insults), member(whole, you)
    near = np.concatenate([[0], np.cumsum(other)])
    a = np.maximum(np.arange(len(text)) - NEAR, firsts[text])
    b = np.minimum(np.arange(len(text)) + NEAR + 1, firsts[text + 1])
    close = rude & (between(near, a, b) > 0)

    # A sign at the end of a word is punctuation.
    inside = np.zeros(len(data), bool)
    inside[:-1] = ~X.NOT_ALNUM[data[1:]]
    read = np.where(inside | ~X.NOT_ALNUM[data], _READ[data], data)
    rs, re_, rf = X.words(read, offsets, _NOT_LETTER)
    hidden = np.bincount(np.repeat(np.arange(n), np.diff(rf)), member(X.span_hashes(read, rs, re_), insults), n)
    rude_count = np.bincount(text, rude, n)

    letters, upper = running(_LETTER), running(_UPPER)
    size = np.maximum(1, np.diff(offsets))
    letter_count = between(letters, offsets[:-1], offsets[1:])
    shout = (between(upper, starts, ends) == ends - starts) & (ends - starts > 1)
    ss, se, sf = X.words(data, offsets)
    mixed = between(running(_INNER), np.minimum(ss + 1, se), np.maximum(ss + 1, se - 1)) > 0
    mixed &= between(letters, ss, se) > 0
    runs = np.diff(sf)
    columns = [
        np.log1p(count), per_word(rude), np.log1p(rude_count), np.maximum(0, hidden - rude_count) / np.maximum(1, count),
        per_word(close), per_word(other), between(upper, offsets[:-1], offsets[1:]) / np.maximum(1, letter_count),
        per_word(shout), between(running(_PUNCTUATION), offsets[:-1], offsets[1:]) / size,
        between(running(X.table_of(b"!")), offsets[:-1], offsets[1:]) / size,
        np.bincount(np.repeat(np.arange(n), runs), mixed, n) / np.maximum(1, runs)]
    for table, slot in zip(odds, word_slots(low, starts, ends, whole)):
        w = np.maximum(0, table[slot])
        top = np.zeros(n)
        np.maximum.at(top, text, w)
        columns += [per_word(w), per_word(w > 1.5), top]
    return np.stack(columns, axis=1)


def learn_odds(part: DataFrame) -> np.ndarray:
    """Log odds by slot from how many documents of either label hold a word of that slot; one array of fixed size a task."""
    size = (len(PREFIXES) + 1) << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size + 1), np.int64)
        for batch in batches:
            label = batch.column("label").to_numpy()
            for row, data, offsets in X.chunks(batch.column("text")):
                low = X.LOWER[data]
                starts, ends, firsts = X.words(low, offsets, X.NOT_ALNUM)
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
                for k, slot in enumerate(word_slots(low, starts, ends, X.span_hashes(low, starts, ends))):
                    pair = np.unique((text << BITS) | slot)
                    pair = pair[(pair & ((1 << BITS) - 1)) > 0]
                    y = label[row + (pair >> BITS)]
                    at = (k << BITS) + (pair & ((1 << BITS) - 1))
                    for side in (0, 1):
                        total[side, :size] += np.bincount(at[y == side], minlength=size)
                total[:, size] += np.bincount(label[row : row + len(offsets) - 1], minlength=2)
        for side in (0, 1):
            at = np.flatnonzero(total[side])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), side)), pa.array(at), pa.array(total[side, at])], ["label", "slot", "docs"])

    rows = part.select("text", "label").mapInArrow(count, "label long, slot long, docs long").groupBy("label", "slot").agg(
        F.sum("docs").alias("docs")).toPandas()
    total = np.zeros((2, size + 1))
    total[rows["label"].to_numpy(int), rows["slot"].to_numpy(int)] = rows["docs"]
    rate = (total[:, :size] + 0.5) / (total[:, size:] + 1)
    odds = np.where(total[:, :size].sum(0) >= 3, np.log(rate[1] / rate[0]), 0.0)
    return odds.reshape(len(PREFIXES) + 1, 1 << BITS).astype(np.float32)


def with_features(docs: DataFrame, odds: np.ndarray) -> DataFrame:
    """Adds `features`, an array in the order of FEATURES."""
    kept = [c for c in docs.columns if c not in ("features", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(odds)  # 4 tables of 2**BITS floats, whatever the input

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        insults, you = lexicon(INSULTS), lexicon(SECOND_PERSON)
        for batch in batches:
            out = [np.zeros((0, len(FEATURES)))]
            out += [features(d, o, shared.value, insults, you)
                    for _, d, o in X.chunks(batch.column(batch.schema.get_field_index("text")))]
            rows = np.concatenate(out)
            lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES), rows.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*kept, "features"])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("features", T.ArrayType(T.DoubleType()))])
    return docs.select(*kept).mapInArrow(make, schema)


class Model:
    """Learned lexicon, trees and calibration; None for the last two where labelled rows of either kind are missing."""

    def __init__(self, odds, trees=None, steps=None):
        self.odds, self.trees, self.steps = odds, trees, steps


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(10))
    sample = materialize(training.labelled_sample(docs, labels, label, rows).withColumn("part", part))
    odds = learn_odds(sample.where(F.col("part") < LEXICON_TENTHS))
    rest = materialize(with_features(sample.where(F.col("part") >= LEXICON_TENTHS), odds).select(
        "doc_id", "part", F.col("label").cast("double").alias("label"), "features").coalesce(2))
    rest = rest.withColumn("vector", array_to_vector("features"))
    trees = rest.where(F.col("part") < LEXICON_TENTHS + TREE_TENTHS)
    judge = rest.where(F.col("part") >= LEXICON_TENTHS + TREE_TENTHS)
    if trees.select("label").distinct().count() < 2 or judge.isEmpty():
        return Model(odds)
    made = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=48,
                         minInstancesPerNode=3, seed=7).fit(trees)
    raw = made.transform(judge).select("label", vector_to_array("probability")[1].alias("raw"))
    return Model(odds, made, IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds `score`, the calibrated probability of label 1, to any table with a text column."""
    if model.trees is None:
        return docs.drop("score", "features").withColumn("score", F.lit(0.0))
    kept = [c for c in docs.columns if c not in ("features", "score")]
    wide = with_features(docs, model.odds).select(F.struct(*kept).alias("kept"), array_to_vector("features").alias("vector"))
    raw = model.trees.transform(wide).select("kept", vector_to_array("probability")[1].alias("raw"))
    made = model.steps.setPredictionCol("calibrated").transform(raw)
    return made.select("kept.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "calibrated")).alias("score"))
