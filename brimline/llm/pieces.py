"""SentencePiece encoding and decoding by batched Viterbi in numpy.

Texts are cut into words where no piece can cross: before a space that follows a visible character. Distinct words of one length
advance together: at each character all substrings that end there are probed by hash among the sorted piece keys, the best
path over them is a vectorised maximum, and its last piece is the backpointer. Words are remembered between batches.

Which paths may compete depends on the model. In a unigram model any sequence of pieces may, and the sum of scores decides. In a BPE
model the ids are those that merging by score would give: a sequence is that result exactly if each piece is the result of its
own text and no two neighbours would be merged across their border. So a step only allows pieces that stand well next to
the last piece of the path before them (`Vocabulary.stands`); that leaves one path for each prefix, and the ids equal the
library's. Characters that are no piece become the pieces of their UTF-8 bytes.

Defined results: a null text has null ids, an empty one none; long texts and words are encoded whole; decoding gives the text back, but
for the character that stands for a space inside pieces, which becomes a space; repeated rows are encoded alike; extra columns
pass through, and input columns with the name of an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from brimline.llm import text as X
from brimline.llm.token_files import Numbers

SPACE = "▁"
#: Words that advance together, and rows that are read together.
BATCH_WORDS, BATCH_ROWS = 4096, 512
#: Bytes that a worker keeps of known words, what a word counts for besides its ids, and judged pairs of pieces that it keeps.
REMEMBERED, OVERHEAD, PAIRS = 96 << 20, 64, 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20
_encoders: dict[str, "Encoder"] = {}


class Vocabulary:
    """Pieces of a model as sorted keys, with their scores and, for BPE, the last merge of each."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.unknown = model.unk_id()
        self.score = np.array([model.get_score(i) for i in range(n)])
        self.scores = self.score.tolist()
        self.name = {names[i]: i for i in plain}
        self.longest = max(map(len, self.name))
        self.size = np.array([len(x) for x in names])
        # Decoded bytes of every id; control pieces have none.
        shown = [bytes([int(names[i][3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i)
                 else " ⁇ ".encode() if model.is_unknown(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_size = np.array([len(x) for x in shown])
        self.shown_first = np.cumsum(self.shown_size) - self.shown_size
        # Hash of a string c1 .. cm: sum of ci * BASE ** (m - i), one more than the code point.
        self.power = X.powers(2 * self.longest + 1, int(_BASE)).copy()
        self.hash = np.zeros(n, np.uint64)
        for name, i in self.name.items():
            h = 0
            for c in name:
                h = (h * int(_BASE) + ord(c) + 1) & X._MASK
            self.hash[i] = h
        order = np.array(plain)[np.argsort(self.hash[plain], kind="stable")]
        self.keys, self.ids = self.hash[order], order
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._bucket(self.keys)] = True
        self.bpe = self._is_bpe(model)
        if self.bpe:
            self._learn_merges(names, plain)
        self.digest = sha256(open(path, "rb").read()).hexdigest()

    def _is_bpe(self, model) -> bool:
        """Whether merging by score gives the library's pieces for texts of two pieces each."""
        names = list(self.name)[:: max(1, len(self.name) // 200)]
        return all(self.merge(SPACE + a + b)[0] == model.encode_as_pieces((a + b).replace(SPACE, " "))
                   for a, b in zip(names, reversed(names)))

    @staticmethod
    def _bucket(h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Id of the piece with each hash, or -1."""
        out = np.full(h.shape, -1, np.int64)
        maybe = np.flatnonzero(self.filter[self._bucket(h)])
        at = np.minimum(np.searchsorted(self.keys, h.ravel()[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == h.ravel()[maybe]
        out.ravel()[maybe[hit]] = self.ids[at[hit]]
        return out

    def merge(self, word: str) -> tuple[list[str], tuple[int, int]]:
        """Pieces of a word by merging the best pair, the first of equals, until none is left; and the sizes of the last merge."""
        parts, last = list(word), (0, 0)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.name.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.score[found] > best):
                    best, at = self.score[found], i
            if best is None:
                break
            last = (len(parts[at]), len(parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _learn_merges(self, names: list[str], plain: list[int]) -> None:
        """left and right: ids of the two parts of the last merge that makes a piece, -1 for a single character.

        A piece that merging never makes of its own text is not stable. A piece is odd if a merge inside it does not come
        after the merges of its parts, or a part is no piece; pairs with such a piece are judged by merging their text.
        """
        n = len(names)
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        self.stable, self.odd = np.zeros(n, bool), np.zeros(n, bool)
        for i in sorted(plain, key=lambda i: len(names[i])):
            word = names[i]
            parts, (a, _) = self.merge(word)
            self.stable[i] = len(parts) == 1
            if len(word) > 1 and self.stable[i]:
                l, r = self.name.get(word[:a], -1), self.name.get(word[a:], -1)
                self.left[i], self.right[i] = l, r
                self.odd[i] = min(l, r) < 0 or bool(self.odd[l] or self.odd[r]) or (
                    (len(word[:a]) > 1 and self.score[l] <= self.score[i]) or (len(word[a:]) > 1 and self.score[r] <= self.score[i]))
        self.text = names
        self.lefts, self.rights, self.odd_list = self.left.tolist(), self.right.tolist(), self.odd.tolist()
        self.judged: dict[tuple[int, int], bool] = {}

    def stands(self, q: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether merging the text of q and p gives just q and p.

        The merges that made both are undone from the last one back. At each state the pieces at the border, a and b, would have
        been merged if that comes before the merge that really came next (of equals, the one further left comes first).
        """
        out = np.ones(len(q), bool)
        odd = self.odd[q] | self.odd[p]
        for i in np.flatnonzero(odd):
            pair = (int(q[i]), int(p[i]))
            if pair not in self.judged:
                a, b = self.text[pair[0]], self.text[pair[1]]
                self.judged[pair] = self.merge(a + b)[0] == [a, b]
            out[i] = self.judged[pair]
        at = np.flatnonzero(~odd)
        a, b = q[at], p[at]
        limit, right_next = np.full(len(at), -np.inf), np.zeros(len(at), bool)
        while len(at):
            joined = self.probe(self.hash[a] * self.power[self.size[b]] + self.hash[b])
            score = np.where(joined >= 0, self.score[joined], -np.inf)
            wrong = (joined >= 0) & ((score > limit) | ((score == limit) & right_next))
            out[at[wrong]] = False
            made_a, made_b = self.left[a] >= 0, self.left[b] >= 0
            undo_b = made_b & (~made_a | (self.score[b] <= self.score[a]))
            go = ~wrong & (made_a | made_b)
            at, a, b, undo_b = at[go], a[go], b[go], undo_b[go]
            limit = np.where(undo_b, self.score[b], self.score[a])
            right_next = undo_b
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
        return out

    def stands_one(self, q: int, p: int) -> bool:
        """`stands` for one pair, from plain lists: where few are asked for at a time, arrays cost more than the steps."""
        if self.odd_list[q] or self.odd_list[p]:
            return bool(self.stands(np.array([q]), np.array([p]))[0])
        limit, right_next = -math.inf, False
        while True:
            joined = self.name.get(self.text[q] + self.text[p])
            if joined is not None:
                score = self.scores[joined]
                if score > limit or (score == limit and right_next):
                    return False
            made_q, made_p = self.lefts[q] >= 0, self.lefts[p] >= 0
            if not (made_q or made_p):
                return True
            right_next = made_p and (not made_q or self.scores[p] <= self.scores[q])
            if right_next:
                limit, p = self.scores[p], self.lefts[p]
            else:
                limit, q = self.scores[q], self.rights[q]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self):
        self.numbers, self.used, self.bytes = Numbers(), 0, 0
        self.first, self.size, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each."""
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for _, data, offsets in X.chunks(texts):
            sizes = np.diff(offsets)
            full = sizes > 0
            data = np.insert(data, offsets[:-1][full], 32)
            offsets = offsets + np.concatenate([[0], np.cumsum(full)])
            starts, ends = self.words(data, offsets)
            h = X.span_hashes(data, starts, ends)
            distinct, at, of = np.unique(h, return_index=True, return_inverse=True)
            if self.bytes > REMEMBERED:
                self.forget()
            place = self.numbers.find(distinct)
            new = np.flatnonzero(place < 0)
            if len(new):
                place[new] = self.learn(data, starts[at[new]], ends[at[new]], distinct[new])
            place = place[of]
            size, total = self.size[place], np.cumsum(self.size[place])
            ids.append(self.flat[np.repeat(self.first[place] - total + size, size) + np.arange(total[-1] if len(total) else 0)])
            counts.append(np.diff(np.concatenate([[0], total])[np.searchsorted(starts, offsets)]))
        return np.concatenate(ids), np.concatenate(counts)

    @staticmethod
    def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.zeros(len(data) + 1, bool)
        blank = data == 32
        if len(data) > 2:  # the sign for a space, in a text, is one too
            blank[2:] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        cut[1:-1] = (data[1:] == 32) & ~blank[:-1]
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        return edges[:-1], edges[1:]

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Numbers of new words, whose ids are put behind those of the known ones."""
        size = ends - starts
        total = np.cumsum(size)
        chosen = data[np.repeat(starts - total + size, size) + np.arange(total[-1])]
        points = np.frombuffer(chosen.tobytes().decode().encode("utf-32-le"), "<u4").copy()
        points[points == 32] = ord(SPACE)
        heads = np.concatenate([[0], np.cumsum((chosen & 0xC0) != 0x80)])
        first, length = heads[total - size], heads[total] - heads[total - size]
        found: list = [None] * len(h)
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            for part in range(0, len(rows), BATCH_WORDS):
                some = rows[part : part + BATCH_WORDS]
                words = points[first[some][:, None] + np.arange(n)]
                made = self.viterbi(words) if 32 * len(some) > n else [self.walk(w) for w in words]
                for i, x in zip(some.tolist(), made):
                    found[i] = x
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids, low = np.concatenate(found).astype(np.int32), self.numbers.n
        for name, n in (("first", low + len(h)), ("size", low + len(h)), ("flat", self.used + len(ids))):
            held = getattr(self, name)
            if n > len(held):  # room for as many again, so that a word is copied a few times at most
                setattr(self, name, np.concatenate([held, np.zeros(max(n, 2 * len(held)) - len(held), held.dtype)]))
        numbers = self.numbers.add(h)
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[numbers], self.size[numbers] = self.used + np.cumsum(counts) - counts, counts
        self.used += len(ids)
        self.bytes += OVERHEAD * len(h) + 8 * len(ids)
        return numbers

    def viterbi(self, words: np.ndarray) -> list[np.ndarray]:
        """Ids of words of one length, given as rows of code points."""
        v, (w, n) = self.v, words.shape
        prefix = np.zeros((w, n + 1), np.uint64)
        for i in range(n):
            prefix[:, i + 1] = prefix[:, i] * _BASE + words[:, i].astype(np.uint64) + np.uint64(1)
        last = np.full((w, n + 1), -1)  # the piece that ends here on the best path; -1: a character that is no piece
        back = np.ones((w, n + 1), np.int64)
        best = np.zeros((w, n + 1))
        for i in range(1, n + 1):
            lengths = np.arange(1, min(i, v.longest) + 1)
            ids = v.probe(np.ascontiguousarray(prefix[:, i : i + 1] - prefix[:, i - lengths] * v.power[lengths]))
            allowed = ids >= 0
            if v.bpe:
                allowed &= v.stable[ids]
                row, k = np.nonzero(allowed)
                before = i - lengths[k]
                q = np.where(before > 0, last[row, before], -1)
                check = np.flatnonzero(q >= 0)
                good = v.stands(q[check], ids[row[check], k[check]])
                allowed[row[check[~good]], k[check[~good]]] = False
            value = np.where(allowed, best[:, i - lengths] + v.score[ids], -np.inf)
            lone = ids[:, 0] < 0
            value[lone, 0] = best[lone, i - 1] - 1e12  # an unknown character, if nothing else ends here
            k = value.argmax(axis=1)
            every = np.arange(w)
            last[:, i], back[:, i], best[:, i] = ids[every, k], lengths[k], value[every, k]
        out = np.full((w, n), -2)
        at, free = np.full(w, n), np.full(w, n)
        while (live := np.flatnonzero(at > 0)).size:
            free[live] -= 1
            here = last[live, at[live]]
            out[live, free[live]] = np.where(here >= 0, here, -1)
            at[live] -= back[live, at[live]]
        rows, unknown = [], (out == -1).any(axis=1)
        for i in range(w):
            x = out[i, free[i] :]
            if unknown[i]:
                x = self.with_bytes(x, words[i])
            rows.append(x)
        return rows

    def walk(self, points: np.ndarray) -> np.ndarray:
        """Ids of one long word: the steps of `viterbi` one at a time, which is faster where few words share a length."""
        v, word = self.v, "".join(map(chr, points.tolist()))
        last, back, best = [-1] * (len(word) + 1), [1] * (len(word) + 1), [0.0] * (len(word) + 1)
        for i in range(1, len(word) + 1):
            top = -math.inf if word[i - 1] in v.name else best[i - 1] - 1e12
            for k in range(1, min(i, v.longest) + 1):
                p = v.name.get(word[i - k : i])
                if p is not None and (not v.bpe or self.fits(last[i - k] if i > k else -1, p)):
                    value = best[i - k] + v.scores[p]
                    if value > top:
                        top, last[i], back[i] = value, p, k
            best[i] = top
        out, i = [], len(word)
        while i > 0:
            out.append(last[i])
            i -= back[i]
        ids = np.array(out[::-1])
        return self.with_bytes(ids, points) if (ids < 0).any() else ids

    def fits(self, q: int, p: int) -> bool:
        """Whether p may follow q; q is -1 at the beginning and after a character that is no piece."""
        if q < 0 or not self.v.stable[p]:
            return bool(self.v.stable[p])
        known = self.pairs.get((q, p))
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[q, p] = self.v.stands_one(q, p)
        return known

    def with_bytes(self, ids: np.ndarray, points: np.ndarray) -> np.ndarray:
        at, out = 0, []
        for p in ids.tolist():
            if p >= 0:
                out.append(p)
                at += int(self.v.size[p])
            else:
                out += [self.v.byte_id.get(b, self.v.unknown) for b in chr(int(points[at])).encode()] if self.v.byte_id else [
                    self.v.unknown]
                at += 1
        return np.array(out)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of id sequences that lie one after the other."""
        v = self.v
        size = v.shown_size[ids]
        total = np.cumsum(size)
        flat = v.shown[np.repeat(v.shown_first[ids] - total + size, size) + np.arange(total[-1] if len(total) else 0)].tobytes()
        ends = np.concatenate([[0], total])[np.cumsum(counts)]
        starts = np.concatenate([[0], ends[:-1]])
        return [flat[a + (flat[a : a + 1] == b" ") : b].decode(errors="replace") for a, b in zip(starts.tolist(), ends.tolist())]


def encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.digest not in _encoders:
        _encoders[vocabulary.digest] = Encoder(vocabulary)
    return _encoders[vocabulary.digest]


def _map(docs: DataFrame, path: str, source: str, added: dict[str, T.DataType], work) -> DataFrame:
    """Adds columns that work(encoder, source column) gives for a run of rows."""
    kept = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))  # its size is the model's

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                column = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([*map(column, kept), *work(known, column(source))], [*kept, *added])

    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(c, kind) for c, kind in added.items()]])
    return docs.select(*dict.fromkeys([*kept, source])).mapInArrow(make, schema)


def _lists(flat: np.ndarray, counts: np.ndarray, nulls: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(nulls, False)) if nulls.any() else offsets,
                                    pa.array(flat.astype(np.int32)))


IDS = T.ArrayType(T.IntegerType())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of a text column."""
    def work(known: Encoder, texts: pa.Array) -> list[pa.Array]:
        return [_lists(*known.encode(texts), texts.is_null().to_numpy(zero_copy_only=False))]

    return _map(docs, path, text, {ids: IDS}, work)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the text of an id column; null ids give a null text, and null elements count as the unknown piece."""
    def work(known: Encoder, lists: pa.Array) -> list[pa.Array]:
        counts = lists.value_lengths().fill_null(0).to_numpy()
        flat = lists.flatten().fill_null(known.v.unknown).to_numpy()
        return [pa.array(known.decode(flat, counts), pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))]

    return _map(docs, path, ids, {text: T.StringType()}, work)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Adds to a table with a text column its ids, n_tokens, ids_sha256 (of the ids as joined text) and same: decoding gives
    the text back. One pass over the rows encodes and decodes."""
    def work(known: Encoder, texts: pa.Array) -> list[pa.Array]:
        ids, counts = known.encode(texts)
        back = pa.array(known.decode(ids, counts), pa.string())
        return [_lists(ids, counts, texts.is_null().to_numpy(zero_copy_only=False)),
                pc.fill_null(pc.equal(back, texts.cast(pa.string())), True)]

    made = _map(docs, path, "text", {"ids": IDS, "same": T.BooleanType()}, work)
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    return made.withColumns({"n_tokens": F.size(ids).cast("long"), "ids_sha256": F.sha2(F.array_join(ids, ","), 256)})
