"""Language-model scores by cross-entropy difference.

Two bigram models of one form share one vocabulary, all words of the corpus: the background model counts all documents, the target
model those that are marked. A token's loss is minus the logarithm of its probability

    p(w | v) = (c(v, w) + PRIOR * p(w)) / (c(v) + PRIOR),    p(w) = (c(w) + 1) / (n + VOCABULARY),

and a document's score is the mean over its tokens of target loss minus background loss: the lower, the more it reads like the target.
A document's own counts are taken out of both models before it is scored, so none is judged by itself.

Counts are exact and cover all documents. Each block of documents (brimline.llm.blocks) sends its words and pairs once with its
counts, and gets back the counts of the corpus, so models are never gathered anywhere and their size may grow with the corpus.

Defined results: a null or empty text, or one without words, has no tokens and gets losses and score 0; without marked documents the target
model is uniform; rows with a repeated doc_id are marked alike and scored one by one; rows without a doc_id are never marked;
long texts are read whole; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brimline.llm import blocks as B, text as X

#: Weight of the unigram model in counts, and words that the mass of unseen ones is shared among.
PRIOR, VOCABULARY = 4.0, 1 << 20

#: Keys of the number of tokens and of the beginning of a text.
TOTAL, BEGIN = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)


SCORED = (("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()),
          ("score", pa.float64()))


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of words and of pairs of a word with the one before it, whether a word begins its text, and the offsets of texts."""
    words, firsts = X.all_word_hashes(table["text"], lower=True)
    begins = np.zeros(len(words), bool)
    begins[firsts[:-1][np.diff(firsts) > 0]] = True
    before = np.where(begins, BEGIN, np.roll(words, 1))
    return words, X.mix(before * np.uint64(3) + X.mix(words + np.uint64(0x9E3779B97F4A7C15))), begins, firsts


def _among(ids: pa.ChunkedArray, marked: np.ndarray) -> np.ndarray:
    there = ~ids.combine_chunks().is_null().to_numpy(zero_copy_only=False)
    return np.isin(ids.cast(pa.int64()).fill_null(0).to_numpy(), marked) & there


@dataclass(frozen=True)
class Counted:
    """A block's tokens, sorted once. Entries are all words, then all pairs, the number of tokens and the beginnings of texts."""
    keys: np.ndarray  # ascending distinct keys
    counts: np.ndarray  # of each key in all texts and in the marked ones
    of: np.ndarray  # the number of the key of each entry
    own: np.ndarray  # how often the text of an entry has its key
    begins: np.ndarray
    firsts: np.ndarray
    marked: np.ndarray  # whether each text is


def _count(table: pa.Table, marked: np.ndarray) -> Counted:
    words, pairs, begins, firsts = _tokens(table)
    here, n = _among(table["doc_id"], marked), np.diff(firsts)
    row = np.repeat(np.arange(len(n)), n)
    keys = np.concatenate([words, pairs, [TOTAL, BEGIN]])
    order = np.argsort(keys, kind="stable")  # so entries of one key stay in the order of the texts
    ranked = keys[order]
    new, group = B.groups(ranked)
    of = np.empty(len(keys), np.int64)
    of[order] = group
    rows = np.concatenate([row, row, [-1, -1]])[order]
    same = np.zeros(len(keys), bool)
    same[1:] = (group[1:] == group[:-1]) & (rows[1:] == rows[:-1])
    part = np.cumsum(~same) - 1
    own = np.empty(len(keys), np.int64)
    own[order] = np.bincount(part)[part]
    target = here[row]
    in_target = np.concatenate([target, target, [n[here].sum(), (n[here] > 0).sum()]]).astype(np.int64)
    in_all = np.concatenate([np.ones(2 * len(words), np.int64), [n.sum(), (n > 0).sum()]])
    counts = np.stack([np.add.reduceat(c[order], new) for c in (in_all, in_target)], axis=1).astype("<i4")
    return Counted(ranked[new], counts, of, own, begins, firsts, here)


def losses(c_pair, c_before, c_word, n) -> np.ndarray:
    """Minus the logarithm of p(w | v) from counts."""
    word = (c_word + 1) / (n + VOCABULARY)
    return -np.log((c_pair + PRIOR * word) / (c_before + PRIOR))


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of each document; target has the doc_ids of marked ones."""
    blocks, n, layout = B.with_blocks(docs)
    marked = B.place_ids(target.select("doc_id").where("doc_id is not null").distinct(), layout)

    def count(table: pa.Table, beside: pa.Table):
        found = _count(table, beside["doc_id"].cast(pa.int64()).to_numpy())
        return found.keys, found.counts

    def answer(keys, _, counts):
        """Counts of all other blocks, as two 64-bit numbers: 0 for most keys."""
        new, of = B.groups(keys)
        return np.add.reduceat(counts.astype("<i8"), new, axis=0)[of] - counts

    def ids_of(table: pa.Table) -> pa.Table:
        ids = table["doc_id"].cast(pa.int64()).to_numpy().astype("<i8")
        return pa.table({"block": table["block"][:1], "bucket": pa.array([-1], pa.int32()),
                         "answers": pa.array([ids.tobytes()], pa.binary())})

    def weigh(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({k: pa.array([], t) for k, t in SCORED})
        table = B.ordered(table)
        first, ids = answers.sort_by("bucket"), np.zeros(0, np.int64)
        if first["bucket"][0].as_py() < 0:
            first, ids = first.slice(1), np.frombuffer(first["answers"][0].as_py(), "<i8")
        found = _count(table, ids)
        counts, size = B.answers_of(first, "<i8", 2) + found.counts, np.diff(found.firsts)
        row, n = np.repeat(np.arange(table.num_rows), size), len(found.begins)
        word, pair, begin = found.of[:n], found.of[n : 2 * n], found.of[-1]
        before = np.where(found.begins, begin, np.roll(word, 1))
        # A text's own part of each count, in the background always and in the target if the text is marked.
        own_word, own_pair = found.own[:n], found.own[n : 2 * n]
        own_before = np.where(found.begins, 1, np.roll(own_word, 1))
        total, loss = counts[found.of[-2]], []
        for side, held in ((0, np.ones(table.num_rows, np.int64)), (1, found.marked.astype(np.int64))):
            part, of_side = held[row], counts[:, side]
            each = losses(of_side[pair] - own_pair * part, of_side[before] - own_before * part, of_side[word] - own_word * part,
                          (total[side] - size * held)[row])
            loss.append(np.bincount(row, each, table.num_rows) / np.maximum(1, size))
        return pa.table({"doc_id": table["doc_id"], "n_tokens": size.astype(np.int64), "target_loss": loss[1],
                         "background_loss": loss[0], "score": loss[1] - loss[0]})

    answers = B.ask(blocks, n, count, answer, side=marked).union(
        marked.groupBy("block").applyInArrow(ids_of, B.ANSWER))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        weigh, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
