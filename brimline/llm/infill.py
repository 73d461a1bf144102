"""Fill-in-middle transformation with content-defined chunks that are looked at once.

A text is cut after lines into prefix, middle and suffix, which are put in another order with sentinels between them, so that a model
learns to fill a gap from both sides. Where the cuts fall depends on a digest of the key alone.

Texts are cut into chunks where a rolling hash of the last 32 bytes has its upper bits zero, so equal passages of different texts have
equal chunks wherever they stand. A worker keeps a summary of each chunk it has met, found by its content (a dict of bytes, so equal
hashes are told apart): code points, where its lines end and how many code points lie before, and whether it holds a
sentinel. Sums of these counts over the chunks of a text give the number of lines, the chunk that a cut falls in, and the code points
before it; sentinels that cross the border of two chunks are looked for at the borders. What a worker remembers is bounded
by bytes, and forgetting changes no result.

Defined results: a null or empty text, and one that holds a sentinel, is plain, so its output is the text itself (a null text's is
empty); a null key counts as the empty text; repeated rows get equal results; texts of any length are cut whole; an empty table
gives none; an extra column that bears the name of an added one is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brimline.llm import text as X

SEED, RATE, SPM = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Bytes that the rolling hash covers, upper bits of it that are zero where a chunk ends, and bytes of a chunk at most.
WIDTH, BITS, LONGEST = 32, 9, 4096
#: Bytes of chunks that a worker remembers.
REMEMBERED = 32 << 20
#: What a chunk counts for besides its text.
OVERHEAD = 256

_GEAR = (X.mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_SECOND = X.table_of(b"PSM")
_memos: list["Memo"] = []


def rolling(data: np.ndarray) -> np.ndarray:
    """For each byte a hash of it and the 31 before it, in which a byte k places back is shifted by k bits."""
    h = _GEAR[data]
    step = 1
    while step < WIDTH:  # h covers `step` bytes
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def chunk_edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin, and the end of the data. The beginning of a text is an edge; the hash decides from its 33rd byte on."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:] = rolling(data) >> np.uint32(32 - BITS) == 0
    reach = np.minimum(np.diff(offsets), WIDTH)
    cut[np.repeat(offsets[:-1] - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())] = False
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    more = (np.diff(edges) - 1) // LONGEST
    if more.any():
        at = np.repeat(edges[:-1], more)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more) + 1
        edges = np.sort(np.concatenate([edges, at + nth * LONGEST]))
    return edges


def marked(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a sentinel begins at each place; the two bytes after it must be there."""
    return (data[starts] == 60) & _SECOND[data[starts + 1]] & (data[starts + 2] == 62)


class Memo:
    """Summaries of chunks by their content."""

    def __init__(self):
        self.forget()

    def forget(self):
        self.numbers: dict[bytes, int] = {}
        self.bytes, self.ends = 0, 0
        self.points, self.lines, self.first = (np.zeros(1024, np.int64) for _ in range(3))
        self.mark = np.zeros(1024, bool)
        #: For each end of a line in some chunk: the byte after it, and the code points up to there.
        self.end_byte, self.end_points = np.zeros(1024, np.int64), np.zeros(1024, np.int64)

    def _room(self, names: tuple[str, ...], n: int):
        for name in names:
            held = getattr(self, name)
            if n > len(held):
                setattr(self, name, np.concatenate([held, np.zeros(max(n, 2 * len(held)) - len(held), held.dtype)]))

    def learn(self, new: list[bytes]):
        """Adds the summaries of chunks that have the next numbers."""
        data = np.frombuffer(b"".join(new), np.uint8)
        size = np.fromiter(map(len, new), np.int64, len(new))
        edges = np.concatenate([[0], np.cumsum(size)])
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        line = np.flatnonzero(data == 10) + 1
        of = np.searchsorted(edges, line, "left") - 1
        lines = np.bincount(of, minlength=len(new))
        low, high = len(self.numbers) - len(new), len(self.numbers)
        self._room(("points", "lines", "first", "mark"), high)
        self._room(("end_byte", "end_points"), self.ends + len(line))
        self.points[low:high], self.lines[low:high] = np.diff(before[edges]), lines
        self.first[low:high] = self.ends + np.cumsum(lines) - lines
        self.end_byte[self.ends : self.ends + len(line)] = line - edges[of]
        self.end_points[self.ends : self.ends + len(line)] = before[line] - before[edges[of]]
        self.ends += len(line)
        starts = np.flatnonzero(data[:-2] == 60) if len(data) > 2 else np.zeros(0, np.int64)
        starts = starts[marked(data, starts)]
        chunk = np.searchsorted(edges, starts, "right") - 1
        self.mark[low:high] = np.bincount(chunk[starts + 3 <= edges[chunk + 1]], minlength=len(new)) > 0

    def numbers_of(self, raw: bytes, edges: list[int]) -> np.ndarray:
        """The number of each chunk; unknown ones are learnt."""
        if self.bytes > REMEMBERED:
            self.forget()
        known, new, out = self.numbers, [], []
        for start, end in zip(edges, edges[1:]):
            chunk = raw[start:end]
            n = known.get(chunk)
            if n is None:
                n = known[chunk] = len(known)
                new.append(chunk)
            out.append(n)
        if new:
            self.bytes += sum(map(len, new)) + OVERHEAD * len(new)
            self.learn(new)
        return np.array(out, np.int64)


class Lines:
    """Where the lines of texts end, from the summaries of their chunks."""

    def __init__(self, known: Memo, data: np.ndarray, offsets: np.ndarray, raw: bytes):
        edges = chunk_edges(data, offsets)
        self.known, self.edges, self.offsets = known, edges, offsets
        self.chunk = known.numbers_of(raw, edges.tolist())
        self.lines = np.concatenate([[0], np.cumsum(known.lines[self.chunk])])
        self.points = np.concatenate([[0], np.cumsum(known.points[self.chunk])])
        self.first = np.searchsorted(edges, offsets)
        # Sentinels inside chunks, and those that begin one or two bytes before a border inside a text.
        text = np.searchsorted(offsets, edges[:-1], "right") - 1
        found = known.mark[self.chunk]
        inner = np.flatnonzero(edges[:-1] != offsets[text])
        for back in (1, 2):
            start, end = edges[inner] - back, offsets[text[inner] + 1]
            here = inner[(start >= offsets[text[inner]]) & (start + 3 <= end)]
            found[here] |= marked(data, edges[here] - back)
        n = len(offsets) - 1
        self.marked = np.bincount(text[found], minlength=n)[:n] > 0
        size = np.diff(offsets)
        ended = np.diff(self.lines[self.first])
        open_end = np.zeros(n, bool)
        open_end[size > 0] = data[offsets[1:][size > 0] - 1] != 10
        self.n = ended + open_end

    def cut(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the byte after its first k lines, and the code points before it."""
        start, end = self.first[:-1], self.first[1:]
        byte, points = self.offsets[:-1].copy(), np.zeros(len(k), np.int64)
        whole = k == self.n
        byte[whole], points[whole] = self.offsets[1:][whole], (self.points[end] - self.points[start])[whole]
        row = np.flatnonzero((k > 0) & ~whole)
        nth = self.lines[start[row]] + k[row]  # among all ends of lines
        chunk = np.searchsorted(self.lines, nth, "left") - 1
        at = self.known.first[self.chunk[chunk]] + nth - self.lines[chunk] - 1
        byte[row] = self.edges[chunk] + self.known.end_byte[at]
        points[row] = self.points[chunk] + self.known.end_points[at] - self.points[start[row]]
        return byte, points


def memo() -> Memo:
    if not _memos:
        _memos.append(Memo())
    return _memos[0]


def draws(seed: int, key) -> tuple[int, ...]:
    """Four numbers below 2**32 from the digest of the seed and a key."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Adds `n_units` (lines), `form`, `prefix_chars`, `middle_chars` and `output` to a table with doc_id and text.

    `rate` of a hundred texts are transformed, `spm` of a hundred of these with the suffix before the prefix.
    """
    added = [T.StructField("n_units", T.LongType()), T.StructField("form", T.StringType()),
             T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
             T.StructField("output", T.StringType())]
    kept = [c for c in docs.columns if c not in {f.name for f in added}]
    names = [*kept, *[f.name for f in added]]

    def rearrange(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        raw, keys = data.tobytes(), batch.column(kept.index("doc_id")).to_pylist()
        lines = Lines(memo(), data, offsets, raw)
        h = np.array([draws(seed, k) for k in keys], np.int64).reshape(-1, 4)
        ends = np.sort(h[:, :2] % (lines.n + 1)[:, None], axis=1)
        (low, low_points), (high, high_points) = lines.cut(ends[:, 0]), lines.cut(ends[:, 1])
        plain = (np.diff(offsets) == 0) | lines.marked | (h[:, 2] % 100 >= rate)
        form = np.where(plain, "plain", np.where(h[:, 3] % 100 < spm, "spm", "psm"))
        p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
        out = []
        for kind, start, a, b, end in zip(form.tolist(), offsets.tolist(), low.tolist(), high.tolist(), offsets[1:].tolist()):
            if kind == "plain":
                out.append(raw[start:end])
            elif kind == "psm":
                out.append(b"".join((p, raw[start:a], s, raw[b:end], m, raw[a:b])))
            else:
                out.append(b"".join((s, raw[b:end], p, raw[start:a], m, raw[a:b])))
        return pa.RecordBatch.from_arrays([
            *batch.columns, pa.array(lines.n, pa.int64()), pa.array(form.tolist(), pa.string()),
            pa.array(low_points, pa.int64(), mask=plain), pa.array(high_points - low_points, pa.int64(), mask=plain),
            pa.array(out, pa.binary()).cast(pa.string())], names)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in X.chunks(batch.column(kept.index("text"))):
                yield rearrange(batch.slice(row, len(offsets) - 1), data, offsets)

    # Under plain names, as Spark looks names with dots up anew when it hands rows to Arrow.
    rows = docs.select(*[f"`{c}`" for c in kept]).toDF(*[f"_{i}" for i in range(len(kept))])
    return rows.mapInArrow(transform, T.StructType([*[docs.schema[c] for c in kept], *added]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: its sentinels are the only ones, as texts that hold some are plain."""
    part = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(part, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second)).otherwise(
        F.concat(second, middle, first))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the result of fill_in_middle: one row for each of its rows."""
    return found.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
