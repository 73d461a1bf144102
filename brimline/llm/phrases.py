"""Removal of passages that an earlier document holds: repeated-phrase automata.

1. Every block of documents (brimline.llm.blocks) sends the hash of each of its windows of `size` words once and learns the
   first block that holds it, and whether another one does.
2. Blocks of first occurrences confirm recurring passages: runs of windows that recur later. Later documents cut out
   the runs of words whose windows are said to be repeated. Both are sent to the shard of the passage, equal runs of a block once.
3. A shard compiles an Aho-Corasick automaton over phrases of its passages. Phrases are consecutive pieces of (size + 1) // 2
   words, so that each window of a passage holds a whole one. The runs stream through the automaton, and each hit is
   extended word by word, so that only words that really are equal count.
4. The confirmed spans go back to the documents, and their words are removed.

A document without a window of another one is streamed through no automaton. A shard holds the passages of one block of first
occurrences. A passage that more than SENDERS blocks hold goes to several tasks, each with the runs of SENDERS blocks, so no task
grows with the number of copies, and a passage is copied no more often than its copies need.

Defined results: a null or empty text has no words; a text shorter than a window keeps all; rows without doc_id are judged
as if their doc_id were larger than every other, and rows with one doc_id do not shorten each other; extra columns are not read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brimline.llm import blocks as B, text as X

WINDOW = 13
#: Places of a phrase that a hit is compared with one by one.
FEW_PLACES = 32
#: Blocks whose runs of one passage meet in one task.
SENDERS = 64

PIECE = "shard int, part int, block int, row int, at long, words string, copies binary"
SPANS = "block int, spans binary"
LAST = np.iinfo(np.int64).max


def _ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].cast(pa.int64()).fill_null(LAST).to_numpy()


def _windows(table: pa.Table, size: int):
    """Hash, row and first word of all windows of an ordered block, and the number of words by row."""
    values, firsts = X.all_word_hashes(table["text"])
    return *X.windows(values, firsts, size), np.diff(firsts)


def _first(key: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct keys, the number of the first window that has each, and the number of each window's key."""
    order = np.argsort(key, kind="stable")
    new, of = B.groups(key[order])
    back = np.empty(len(key), np.int64)
    back[order] = of
    return key[order][new], order[new], back


def _text_words(texts: list) -> list[list[bytes]]:
    """Words of each text, as `text.words` cuts them: bytes.split() knows the same six spaces."""
    return [(t or "").encode().split() for t in texts]


def _runs(flag: np.ndarray, kind: np.ndarray, row: np.ndarray, at: np.ndarray):
    """First and last window of runs of flagged windows that follow each other in one row and have one kind."""
    chosen = np.flatnonzero(flag)
    if not len(chosen):
        return chosen, chosen
    cut = (np.diff(chosen) != 1) | (np.diff(row[chosen]) != 0) | (np.diff(kind[chosen]) != 0)
    begin = np.concatenate([[True], cut])
    return chosen[begin], chosen[np.concatenate([cut, [True]])]


def repeated_spans(docs: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The documents in blocks, and for each block the spans of words to remove as packed (row, start, end)."""
    blocks, n, layout = B.with_blocks(docs)
    heads = layout.heads()

    def keys(table: pa.Table):
        key, *_ = _windows(table, size)
        return np.unique(key), None

    def answer(key, block, _):
        """The first block with the key, the part of its shard that a posting belongs to, and the number of parts, 0 if no other
        block has the key."""
        new, of = B.groups(key)
        held = np.diff(np.append(new, len(key)))
        parts = np.where(held > 1, -(-held // SENDERS), 0)
        part = (np.arange(len(key)) - new[of]) // SENDERS
        return np.stack([block[new][of], part, parts[of]], axis=1).astype("<i4")

    def pieces(table: pa.Table, answers: pa.Table) -> pa.Table:
        """Rows for shards: recurring passages of this block (copies is null) and runs to be confirmed."""
        out = {k: [] for k in ("shard", "part", "row", "at", "words", "copies")}
        if not table.num_rows:
            return pa.table({**{k: pa.array([], pa.int32()) for k in ("shard", "part", "block", "row")},
                             "at": pa.array([], pa.int64()), "words": pa.array([], pa.string()),
                             "copies": pa.array([], pa.binary())})
        block = table["block"][0].as_py()
        table = B.ordered(table)
        ids = _ids(table)
        key, row, at, _ = _windows(table, size)
        held, first, of = _first(key, row, at)
        home, part_of, parts = B.answers_of(answers, "<i4", 3).T
        own = ids[row] == ids[row[first]][of]
        # Blocks before this one that share its only doc_id hold no earlier document.
        claimed = (home[of] < heads[block]) | ((home[of] == block) & ~own)
        # A passage has the first windows of this block that occur again, in another block or in a later document of it.
        again = (home == block) & ((parts > 0) | (np.bincount(of, ~own, len(held)) > 0))
        source = np.zeros(len(key), bool)
        source[first[again]] = True
        needed = np.unique(row[source | claimed])
        words = dict(zip(needed.tolist(), _text_words(table["text"].take(pa.array(needed)).to_pylist())))

        def add(shard, part, r, a, text, copies):
            for name, value in zip(out, (shard, part, r, a, text, copies)):
                out[name].append(value)

        for a, b in zip(*_runs(source, np.zeros(len(key), np.int8), row, at)):
            text = b" ".join(words[int(row[a])][at[a] : at[b] + size]).decode()
            for part in range(max(1, int(parts[of[a : b + 1]].max()))):
                add(block, part, int(row[a]), int(at[a]), text, None)
        runs: dict[tuple[int, int, str], list] = {}
        place = (home.astype(np.int64) << 32 | part_of)[of]
        for a, b in zip(*_runs(claimed, place, row, at)):
            text = b" ".join(words[int(row[a])][at[a] : at[b] + size]).decode()
            runs.setdefault((int(home[of[a]]), int(part_of[of[a]]), text), []).append((int(row[a]), int(at[a])))
        for (shard, part, text), copies in runs.items():
            add(shard, part, *copies[0], text, np.array(copies, "<i8").tobytes())
        kinds = {"shard": pa.int32(), "part": pa.int32(), "row": pa.int32(), "at": pa.int64(), "words": pa.string(),
                 "copies": pa.binary()}
        made = {k: pa.array(v, kinds[k]) for k, v in out.items()}
        made["block"] = pa.array(np.full(len(out["row"]), block, np.int32))
        return pa.table({k: made[k] for k in ("shard", "part", "block", "row", "at", "words", "copies")})

    def locate(table: pa.Table) -> pa.Table:
        """Spans of runs that equal a passage of the shard, for every copy of the run, by sending block."""
        rows = table.sort_by([("block", "ascending"), ("row", "ascending"), ("at", "ascending")]).to_pylist()
        finder = PhraseFinder([r["words"].split(" ") for r in rows if r["copies"] is None], size)
        found: dict[int, list[np.ndarray]] = {}
        for r in rows:
            if r["copies"] is not None and (spans := finder.spans(r["words"].split(" "))):
                copies = np.frombuffer(r["copies"], "<i8").reshape(-1, 2)
                for start, end in spans:
                    found.setdefault(r["block"], []).append(
                        np.stack([copies[:, 0], copies[:, 1] + start, copies[:, 1] + end], axis=1))
        return pa.table({"block": pa.array(list(found), pa.int32()), "spans": pa.array(
            [np.concatenate(x).astype("<i8").tobytes() for x in found.values()], pa.binary())})

    answers = B.ask(blocks, n, keys, answer)
    sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(pieces, PIECE)
    return blocks, sent.groupBy("shard", "part").applyInArrow(locate, SPANS)


class PhraseFinder:
    """An automaton over phrases of passages, and the extension of its hits to whole equal spans.

    A phrase that stands in few places is compared with each. One that stands in many is looked up with the words around it: of
    every window that holds it the finder knows one place, so a hit costs the same however common the phrase.
    """

    def __init__(self, passages: list[list[str]], size: int):
        self.size, self.passages = size, passages
        self.step = (size + 1) // 2
        self.automaton = ahocorasick.Automaton()
        for p, words in enumerate(passages):
            for at in range(0, len(words) - self.step + 1, self.step):
                phrase = f" {' '.join(words[at : at + self.step])} "
                if phrase in self.automaton:
                    self.automaton.get(phrase).append((p, at))
                else:
                    self.automaton.add_word(phrase, [(p, at)])
        if len(self.automaton):
            self.automaton.make_automaton()
        #: Places of windows by their hash, or the next free number after it; and the phrases whose windows are there.
        self.windows: dict[int, int] = {}
        self.known: set[int] = set()

    def _know(self, places: list[tuple[int, int]]) -> None:
        """Notes the windows that hold a common phrase, each unless an equal one is known; done when the phrase is first hit."""
        if id(places) in self.known:
            return
        self.known.add(id(places))
        for p, at in places:
            words = self.passages[p]
            for w in range(max(0, at + self.step - self.size), min(at, len(words) - self.size) + 1):
                key, there = self._find(words[w : w + self.size])
                if not there:
                    self.windows[key] = p << 32 | w

    def _find(self, window: list[str]) -> tuple[int, bool]:
        """The number under which a window stands, or would."""
        key = hash(" ".join(window))
        while (place := self.windows.get(key)) is not None:
            p, w = place >> 32, place & 0xFFFFFFFF
            if self.passages[p][w : w + self.size] == window:
                return key, True
            key += 1
        return key, False

    def _grown(self, words: list[str], a: int, b: int, p: int, shift: int) -> tuple[int, int]:
        """The longest span around words[a:b] that stands in the passage as it stands here, `shift` words further on."""
        passage = self.passages[p]
        while a > 0 and a + shift > 0 and words[a - 1] == passage[a - 1 + shift]:
            a -= 1
        while b < len(words) and b + shift < len(passage) and words[b] == passage[b + shift]:
            b += 1
        return a, b

    def spans(self, words: list[str]) -> list[tuple[int, int]]:
        """Spans of at least `size` words that stand in one passage as they stand here; together they hold every such window."""
        if not len(self.automaton):
            return []
        text = f" {' '.join(words)} "
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        reached: dict[tuple[int, int], int] = {}
        found, held = [], bytearray(len(words))  # windows that a span found in this way has
        for last, places in self.automaton.iter(text):
            end = int(np.searchsorted(starts, last))
            begin = end - self.step
            if len(places) > FEW_PLACES:
                self._know(places)
                for w in range(max(0, end - self.size), min(begin, len(words) - self.size) + 1):
                    if held[w]:
                        continue
                    key, there = self._find(words[w : w + self.size])
                    if there:
                        p, at = self.windows[key] >> 32, self.windows[key] & 0xFFFFFFFF
                        a, b = self._grown(words, w, w + self.size, p, at - w)
                        found.append((a, b))
                        held[a : b - self.size + 1] = b"\1" * (b - self.size + 1 - a)
                continue
            for p, at in places:
                line = (p, at - begin)
                if reached.get(line, -1) >= end:
                    continue
                a, b = self._grown(words, begin, end, *line)
                reached[line] = b
                if b - a >= self.size:
                    found.append((a, b))
        return found


def without_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, kept, n_words, n_removed): kept has the words that stay, joined by one space."""
    blocks, spans = repeated_spans(docs, size)

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        table = B.ordered(table)
        cut: dict[int, list] = {}
        for x in found["spans"].to_pylist():
            for row, start, end in np.frombuffer(x, "<i8").reshape(-1, 3).tolist():
                cut.setdefault(row, []).append((start, end))
        kept, n_words, n_removed = [], [], []
        for row, words in enumerate(_text_words(table["text"].to_pylist())):
            stay = words
            if row in cut:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, end in cut[row]:
                    gone[start] += 1
                    gone[end] -= 1
                stay = [w for w, g in zip(words, np.cumsum(gone)) if not g]
            kept.append(b" ".join(stay).decode())
            n_words.append(len(words))
            n_removed.append(len(words) - len(stay))
        return pa.table({"doc_id": table["doc_id"], "kept": pa.array(kept, pa.string()),
                         "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())})

    kind = dict(docs.dtypes)["doc_id"]
    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        finish, f"doc_id {kind}, kept string, n_words long, n_removed long")
