"""Questions about keys that many documents hold, asked once per block of documents.

Documents are dealt to blocks: consecutive ranges of doc_id with at most 5 MB of text each, or one longer text. A block sends every
key (a 64-bit hash) that its documents hold once, whatever the number of documents that hold it, so no key has more postings
than there are blocks: that is the aggregation before the shuffle that a hot key needs. Postings travel as packed arrays, one
row for each block and range of keys. The range's task answers each posting, and the answers go back to the block, which
reads its documents again from the same shuffle.

Blocks are ordered: every doc_id of a block is smaller than every one of the next, and rows without a doc_id come last. A doc_id
with more text than a block holds, or the rows without one, have blocks of their own, in the order of the texts.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brimline.sources.writers import materialize

BLOCK_BYTES = 5 << 20
LEAST_BLOCKS = 24
#: What a row counts for besides its text, and the characters of a text that are looked at first.
ROW_BYTES = 64
PREFIX = 256

KEY = ["nameless", "id", "void", "start"]
RANGE = pa.schema([("nameless", pa.bool_()), ("id", pa.int64()), ("void", pa.bool_()), ("start", pa.string()),
                   ("size", pa.int64()), ("n", pa.int64()), ("longest", pa.int32())])

POSTING = "bucket int, block int, keys binary, extra binary"
ANSWER = "block int, bucket int, answers binary"


@dataclass(frozen=True)
class Layout:
    """Where ranges of rows begin, by (no doc_id, doc_id, no text, beginning of the text), and how many blocks deal out each of them:
    several only for more equal rows than a block holds."""
    starts: list[tuple[bool, int, bool, str]]
    shares: list[int]

    @property
    def n(self) -> int:
        return max(1, sum(self.shares))

    def heads(self) -> np.ndarray:
        """For each block the first one with its first doc_id: itself, but for the further blocks of a doc_id that fills several."""
        out: list[int] = []
        for i, (start, share) in enumerate(zip(self.starts, self.shares)):
            own = len(out) if not i or start[:2] != self.starts[i - 1][:2] else out[-1]
            out += [own] * share
        return np.array(out or [0], np.int64)


def _keys(docs: DataFrame, length: int) -> DataFrame:
    """doc_id and text with the parts of a row's place in the order, with so many characters of the text."""
    return docs.select(
        "doc_id", "text", F.col("doc_id").isNull().alias("nameless"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        (F.col("text").isNull() if length else F.lit(False)).alias("void"),
        (F.coalesce(F.substring("text", 1, length), F.lit("")) if length else F.lit("")).alias("start"))


def _sums(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy(*KEY).agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.char_length("text"), F.lit(0))).alias("longest"))


def _merged(rows: Iterable[tuple], most: int, one_id: bool) -> Iterator[tuple]:
    """Ascending sums put together as far as they do not exceed `most` bytes; with one_id only those of one doc_id."""
    held = None
    for row in rows:
        if held and held[4] + row[4] <= most and (not one_id or held[:2] == row[:2]):
            held = (*held[:4], held[4] + row[4], held[5] + row[5], max(held[6], row[6]))
        else:
            if held:
                yield held
            held = row
    if held:
        yield held


def _ranges(sums: DataFrame, most: int, one_id: bool) -> list[tuple]:
    """Ranges of at most so many bytes, or with one key. Each task sends the driver about as many as there are blocks in its part."""
    def cut(batches):
        rows = (r for x in batches for r in zip(*(c.to_pylist() for c in x.columns)))
        out = list(_merged(rows, most, one_id))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(RANGE), RANGE)], schema=RANGE)

    found = sums.repartitionByRange(*KEY).sortWithinPartitions(*KEY).mapInArrow(cut, sums.schema).collect()
    return list(_merged(sorted(map(tuple, found)), most, one_id))


def split(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> Layout:
    """Ranges of equally many bytes, each row counted with ROW_BYTES more. A doc_id (or none) whose rows exceed a block is cut by the
    beginnings of its texts, as many characters as it takes, and equal rows that exceed one are dealt to several.

    The driver gets a row for each block.
    """
    docs = docs.select("doc_id", "text")
    sums = materialize(_sums(_keys(docs, 0)))
    size = sums.agg(F.sum("size")).first()[0] or 0
    most = math.ceil(size / max(LEAST_BLOCKS, math.ceil(size / block_bytes)))
    found, done, before, length = _ranges(sums, most, False), [], 0, PREFIX
    while found:
        again = []
        for r in found:
            if r[4] <= most or r[5] == 1:
                done.append((r[:4], 1))
            elif before and r[6] <= before:
                done.append((r[:4], math.ceil(r[4] / most)))
            else:
                again.append(r[:4])
        if not again:
            break
        chosen = docs.sparkSession.createDataFrame(again, "nameless boolean, id long, void boolean, start string")
        rows = _keys(docs, before).join(F.broadcast(chosen), KEY, "left_semi")
        found, before, length = _ranges(_sums(_keys(rows, length)), most, True), length, min(length * 16, 2**31 - 1)
    done.sort()
    starts = [k for k, _ in done]
    first = [not i or k[:2] != starts[i - 1][:2] for i, k in enumerate(starts)]
    return Layout([(*k[:2], False, "") if new else k for k, new in zip(starts, first)], [n for _, n in done])


def with_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int, Layout]:
    """(doc_id, text, block), the number of blocks and their layout."""
    layout = split(docs, block_bytes)
    return place(docs.select("doc_id", "text"), layout), layout.n, layout


def _search(starts: Column, n: int, key: Column) -> Column:
    """How many of n ascending starts are not above the key."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(starts, at + step - 1) <= key), at + step).otherwise(at)) if n else F.lit(0)


def _range_of(layout: Layout, void: Column, text: Column) -> Column:
    """The number of the range that a row with this text is in."""
    starts, bare = layout.starts[1:], F.col("doc_id").isNull()
    if not any(s[2] or s[3] for s in starts) and len(set(s[:2] for s in layout.starts)) == len(layout.starts):
        ids = [s[1] for s in starts if not s[0]]
        found = _search(F.split(F.lit(",".join(map(str, ids))), ",").cast("array<long>"), len(ids), F.col("doc_id").cast("long"))
        return F.when(bare, F.lit(len(starts))).otherwise(found)
    listed = F.from_json(F.lit(json.dumps([dict(zip(KEY, s)) for s in starts])),
                         "array<struct<nameless: boolean, id: long, void: boolean, start: string>>")
    return _search(listed, len(starts), F.struct(
        bare.alias("nameless"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), void.alias("void"),
        F.when(void, F.lit("")).otherwise(text).alias("start")))


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def place(rows: DataFrame, layout: Layout) -> DataFrame:
    """Adds the block of each row. Where equal rows are dealt to several blocks, by chance, the table is written first."""
    at = _range_of(layout, F.col("text").isNull(), F.col("text"))
    if layout.n == max(1, len(layout.shares)):
        return rows.select("*", at.cast("int").alias("block"))
    first = np.cumsum([0, *layout.shares[:-1]]).tolist()
    found = rows.withColumn("_range", at)
    block = F.get(_numbers(first), "_range") + F.floor(F.rand() * F.get(_numbers(layout.shares), "_range"))
    return materialize(found.select(*[F.col(f"`{c}`") for c in rows.columns], block.cast("int").alias("block")))


def place_ids(ids: DataFrame, layout: Layout) -> DataFrame:
    """Rows of doc_ids with each block that has rows of theirs."""
    low, high = _range_of(layout, F.lit(False), F.lit("")), _range_of(layout, F.lit(True), F.lit(""))
    ends = np.cumsum(layout.shares or [1])
    first = F.get(_numbers((ends - np.array(layout.shares or [1])).tolist()), low)
    return ids.select("*", F.explode(F.sequence(first, F.get(_numbers(ends.tolist()), high) - 1)).alias("block"))


def ordered(block: pa.Table) -> pa.Table:
    """The rows of a block in an order that every task finds alike: by doc_id, rows without one last, then by text."""
    return block.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()


def pack(numbers: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the byte planes of their steps; planes that are all zero are left out."""
    if not len(numbers):
        return b""
    steps = np.diff(numbers.astype(np.uint64), prepend=np.uint64(0))
    first, steps[0] = int(steps[0]), 0
    every = int(np.bitwise_or.reduce(steps))
    planes = [i for i in range(8) if every >> 8 * i & 255] or [0]
    return first.to_bytes(8, "little") + bytes([sum(1 << i for i in planes)]) + steps.astype("<u8").view(np.uint8).reshape(
        -1, 8)[:, planes].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    planes = [i for i in range(8) if data[8] >> i & 1]
    n = (len(data) - 9) // len(planes)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, planes] = np.frombuffer(data, np.uint8, offset=9).reshape(len(planes), n).T
    out = np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)
    return out + np.uint64(int.from_bytes(data[:8], "little"))


def planes(rows: np.ndarray) -> bytes:
    """The bytes of rows of numbers, plane by plane, so that small numbers compress well."""
    return np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1).T.tobytes()


def from_planes(data: bytes, dtype, n: int) -> np.ndarray:
    """n rows of numbers from their planes."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(dtype)


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the ranges of keys begin in ascending keys; the number of ranges plus one numbers."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def ask(blocks: DataFrame, buckets: int, keys: Callable, answer: Callable, side: DataFrame | None = None) -> DataFrame:
    """ANSWER rows, in which a block finds the answers to its keys in the order in which it sent them.

    keys(ordered table) gives ascending distinct keys and an array with one row of int32 values for each, or None.
    answer(keys, blocks, values) gets all postings of a range of keys by key, then block, and gives one row for each.
    With side, a table with blocks too, keys gets the rows of side for the block as well.
    """
    def send(table: pa.Table, beside: pa.Table | None = None) -> pa.Table:
        if not table.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int32()),
                             "keys": pa.array([], pa.binary()), "extra": pa.array([], pa.binary())})
        block = table["block"][0].as_py()
        held, extra = keys(ordered(table)) if beside is None else keys(ordered(table), beside)
        at = cuts(held, buckets)
        full = np.flatnonzero(np.diff(at))
        return pa.table({
            "bucket": pa.array(full.astype(np.int32)), "block": pa.array(np.full(len(full), block, np.int32)),
            "keys": pa.array([pack(held[at[i] : at[i + 1]]) for i in full], pa.binary()),
            "extra": pa.array([None if extra is None else planes(extra[at[i] : at[i + 1]]) for i in full], pa.binary())})

    def reply(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [unpack(x) for x in table["keys"].to_pylist()]
        all_keys, sizes = np.concatenate(parts), [len(x) for x in parts]
        order = np.argsort(all_keys, kind="stable")
        extra = None if table["extra"].null_count else np.concatenate(
            [from_planes(x, "<i4", n) for x, n in zip(table["extra"].to_pylist(), sizes)])[order]
        from_block = np.repeat(table["block"].to_numpy(), sizes)[order]
        got = answer(all_keys[order], from_block, extra)
        out = np.empty_like(got)
        out[order] = got
        ends = np.cumsum(sizes)
        return pa.table({
            "block": table["block"].combine_chunks(), "bucket": table["bucket"].combine_chunks(),
            "answers": pa.array([planes(out[e - n : e]) for e, n in zip(ends, sizes)], pa.binary())})

    if side is None:
        posted = blocks.groupBy("block").applyInArrow(lambda table: send(table), POSTING)
    else:
        posted = blocks.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(
            lambda table, beside: send(table, beside), POSTING)
    return posted.groupBy("bucket").applyInArrow(reply, ANSWER)


def answers_of(table: pa.Table, dtype, columns: int = 1) -> np.ndarray:
    """The answers to a block's keys, in their order: a row of numbers for each."""
    width = np.dtype(dtype).itemsize * columns
    return np.concatenate([np.zeros((0, columns), dtype), *[
        from_planes(x, dtype, len(x) // width) for x in table.sort_by("bucket")["answers"].to_pylist()]])


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ascending keys: where each distinct one begins, and the number of the distinct key of every entry."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1
