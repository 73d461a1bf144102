"""Token ids in binary shards with a minimal perfect hash index.

Documents are dealt to consecutive ranges of doc_id (brimline.llm.blocks), and one task writes the two files of a range:

* `N.ids`: the ids of its documents in ascending doc_id order, each with the end id, as raw little-endian numbers of 2 or 4 bytes;
* `N.idx`: a header, then the index: displacements of a minimal perfect hash, and for every slot a 32-bit fingerprint of its
  key, the first id and the number of ids.

A key is a doc_id and a copy number (0, 1, ... for repeated doc_ids). A lookup reads one displacement and one slot, whatever the
size of the shard; a key that is not there fails by its fingerprint, but for one in 2**32.

Files are written under another name and renamed, so a task that is run again leaves the same files. The range of a
key follows from the borders of the ranges, and the first id of a shard in the whole stream from the manifest.

Texts are cut before each single space that follows a visible character; the pre-tokenizer of a byte-level BPE cuts there too,
so pieces can be encoded apart, and equal ones once. The string of a special token in a text becomes that token, as in the library's
own call; pieces keep such strings whole, as they hold no space.

Defined results: a null or empty text has the end id only; rows without a doc_id come last, as copies of one key; repeated rows
are copies; texts of any length are encoded whole; extra columns are not read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from brimline.llm import blocks as B, text as X
from brimline.sources.writers import materialize, shared_folder

END_ID = 0
#: Bytes that a worker keeps of known pieces, and what a piece counts for besides its ids.
REMEMBERED, OVERHEAD = 160 << 20, 64
MAGIC = b"TOKSHRD1"
HEADER = struct.Struct("<8sQQQ")  # magic, bytes of an id, keys, displacements
LAST = np.iinfo(np.int64).max

# Tasks fill the cores; threads of the library inside each would only wait for each other.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_WHITE = X.table_of(X.SPACES)
_encoders: dict[str, "Encoder"] = {}


class Numbers:
    """Numbers 0, 1, ... of 64-bit hashes in the order in which they were added, for whole arrays at a time: a table of slots, at
    most half of them full, in which a hash stands in the first slot from its own one on that was free."""

    def __init__(self):
        self.n = 0
        self.hash, self.number = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int32)

    def _walk(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Entries that are looked for and the slots that each looks at next; send tells which entries go on."""
        at, mask = np.arange(len(h)), np.uint64(len(self.hash) - 1)
        slot = (h & mask).astype(np.int64)
        while len(at):
            on = yield at, slot
            at, slot = at[on], (slot[on] + 1) & int(mask)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1; 0 stands for an empty slot, so it is looked up as 1."""
        h, out = np.maximum(h, np.uint64(1)), np.full(len(h), -1, np.int64)
        walk, on = self._walk(h), None
        while True:
            try:
                at, slot = walk.send(on)
            except StopIteration:
                return out
            there = self.hash[slot]
            hit = there == h[at]
            out[at[hit]] = self.number[slot[hit]]
            on = ~hit & (there != 0)

    def add(self, h: np.ndarray) -> np.ndarray:
        """The numbers of distinct hashes that are not there yet."""
        h = np.maximum(h, np.uint64(1))
        numbers = np.arange(self.n, self.n + len(h))
        self.n += len(h)
        if 2 * self.n > len(self.hash):
            full = self.hash != 0
            old, size = (self.hash[full], self.number[full]), len(self.hash)
            while 2 * self.n > size:
                size *= 2
            self.hash, self.number = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._put(*old)
        self._put(h, numbers)
        return numbers

    def _put(self, h: np.ndarray, numbers: np.ndarray):
        walk, on = self._walk(h), None
        while True:
            try:
                at, slot = walk.send(on)
            except StopIteration:
                return
            free = self.hash[slot] == 0
            self.hash[slot[free]] = h[at[free]]  # of several for one slot the last one stays
            won = free & (self.hash[slot] == h[at])
            self.number[slot[won]] = numbers[at[won]]
            on = ~won


class Encoder:
    """Encodes whole columns of text, each distinct piece once; remembers pieces between calls, up to a bound."""

    def __init__(self, path: str):
        self.model = Tokenizer.from_file(path)
        self.width = 2 if self.model.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.forget()

    def forget(self):
        self.numbers = Numbers()
        self.used, self.bytes = 0, 0
        self.first, self.size, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, self.kind)

    @staticmethod
    def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of pieces in bytes."""
        cut = np.zeros(len(data) + 1, bool)
        visible = ~_WHITE[data]
        # White space beyond ASCII ends in C2 85, C2 A0, E1 9A 80, E2 8x xx or E3 80 80; no cut where one might.
        if len(data) > 2:
            visible[1:] &= ~((data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0)))
            visible[2:] &= ~((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3))
        cut[1:-1] = (data[1:] == 32) & visible[:-1]
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        return edges[:-1], edges[1:]

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each."""
        ids, counts = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)]
        for _, data, offsets in X.chunks(texts):
            starts, ends = self.pieces(data, offsets)
            h = X.span_hashes(data, starts, ends)
            of, distinct = pd.factorize(h)
            at = np.empty(len(distinct), np.int64)
            at[of[::-1]] = np.arange(len(h))[::-1]  # where each occurs first
            if self.bytes > REMEMBERED:
                self.forget()
            place = self.numbers.find(distinct)
            new = np.flatnonzero(place < 0)
            if len(new):
                place[new] = self.learn(data, starts[at[new]], ends[at[new]], distinct[new])
            place = place[of]
            size, first = self.size[place], self.first[place]
            total = np.cumsum(size)
            ids.append(self.flat[np.repeat(first - total + size, size) + np.arange(total[-1] if len(total) else 0)])
            before = np.concatenate([[0], total])[np.searchsorted(starts, offsets)]
            counts.append(np.diff(before))
        return np.concatenate(ids), np.concatenate(counts)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Numbers of new pieces, whose ids are put behind those of the known ones."""
        raw = data.tobytes()
        found = self.model.encode_batch_fast(
            [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())], add_special_tokens=False)
        lists = [e.ids for e in found]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        total, low = int(size.sum()), self.numbers.n
        for name, n in (("first", low + len(lists)), ("size", low + len(lists)), ("flat", self.used + total)):
            held = getattr(self, name)
            if n > len(held):  # room for as many again, so that a piece is copied a few times at most
                setattr(self, name, np.concatenate([held, np.zeros(max(n, 2 * len(held)) - len(held), held.dtype)]))
        numbers = self.numbers.add(h)
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(lists), self.kind, total)
        self.first[numbers], self.size[numbers] = self.used + np.cumsum(size) - size, size
        self.used += total
        self.bytes += OVERHEAD * len(lists) + 2 * self.kind.itemsize * total
        return numbers


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def key_hashes(ids: np.ndarray) -> np.ndarray:
    """A hash for each (doc_id, copy number) of ascending doc_ids."""
    new, of = B.groups(ids)
    copy = (np.arange(len(ids)) - new[of]).astype(np.uint64)
    return X.mix(X.mix(ids.astype(np.uint64)) + copy * np.uint64(0x9E3779B97F4A7C15))


def _slot(h: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    return (X.mix(h + displacement.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(n)).astype(np.int64)


def minimal_perfect_hash(h: np.ndarray) -> np.ndarray:
    """Displacements that send n distinct hashes to the slots 0 .. n - 1, each to one of its own.

    Keys meet in buckets of about four; larger buckets are placed first, by the smallest displacement that finds free slots for
    all of their keys, and buckets of one key name a slot that is left as a negative number.
    """
    n = len(h)
    displaced = np.zeros(max(1, -(-n // 4)), np.int64)
    bucket = (h % np.uint64(len(displaced))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=len(displaced))
    first = np.cumsum(size) - size
    taken = np.zeros(n, bool)
    by_size = np.argsort(-size, kind="stable")
    for b in by_size[: int((size > 1).sum())].tolist():
        keys, d = h[order[first[b] : first[b] + size[b]]], 0
        while True:
            tries = np.arange(d, d + 32)
            slots = np.sort(_slot(keys[None, :], tries[:, None], n), axis=1)
            good = np.flatnonzero(~taken[slots].any(1) & (slots[:, 1:] != slots[:, :-1]).all(1))
            if len(good):
                displaced[b] = tries[good[0]]
                taken[slots[good[0]]] = True
                break
            d += 32
    alone = np.flatnonzero(size == 1)
    displaced[alone] = -1 - np.flatnonzero(~taken)
    return displaced


def slots_of(h: np.ndarray, displaced: np.ndarray, n: int) -> np.ndarray:
    d = displaced[(h % np.uint64(len(displaced))).astype(np.int64)]
    return np.where(d < 0, -1 - d, _slot(h, np.maximum(d, 0), n))


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (X.mix(h ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype("<u4")


def _put(folder: str, name: str, *parts: bytes) -> None:
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    own = f"{base}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        for x in parts:
            out.write(x)
    store.move(own, f"{base}/{name}")


def write_shard(folder: str, shard: int, ids: np.ndarray, counts: np.ndarray, h: np.ndarray) -> None:
    """Files of one shard: the ids of all its keys, with their numbers in the order of the keys."""
    n, displaced = len(h), minimal_perfect_hash(h)
    slot = slots_of(h, displaced, n)
    marks, first, count = np.empty(n, "<u4"), np.empty(n, "<u8"), np.empty(n, "<u8")
    marks[slot], first[slot], count[slot] = fingerprints(h), np.cumsum(counts) - counts, counts
    _put(folder, f"{shard:010d}.ids", ids.tobytes())
    _put(folder, f"{shard:010d}.idx", HEADER.pack(MAGIC, ids.itemsize, n, len(displaced)),
         displaced.astype("<i8").tobytes(), first.tobytes(), count.tobytes(), marks.tobytes())


class Shard:
    """Keyed access to one shard. The index is read whole; ids are read by position."""

    def __init__(self, folder: str, shard: int):
        self.store, base = fs.FileSystem.from_uri(folder)
        self.path = f"{base}/{shard:010d}.ids"
        with self.store.open_input_file(f"{base}/{shard:010d}.idx") as f:
            data = f.read()
        magic, width, self.n, m = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError(f"{base}/{shard:010d}.idx is not an index of token ids")
        self.kind, at = np.dtype(f"<u{width}"), HEADER.size
        self.displaced = np.frombuffer(data, "<i8", m, at)
        self.first = np.frombuffer(data, "<u8", self.n, at + 8 * m)
        self.count = np.frombuffer(data, "<u8", self.n, at + 8 * (m + self.n))
        self.marks = np.frombuffer(data, "<u4", self.n, at + 8 * (m + 2 * self.n))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is there, its first id and its number of ids."""
        if not self.n:
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        slot = slots_of(h, self.displaced, self.n)
        there = self.marks[slot] == fingerprints(h)
        return there, np.where(there, self.first[slot], 0).astype(np.int64), np.where(there, self.count[slot], 0).astype(np.int64)

    def ids(self, first: int, count: int) -> np.ndarray:
        with self.store.open_input_file(self.path) as f:
            return np.frombuffer(f.read_at(count * self.kind.itemsize, first * self.kind.itemsize), self.kind)

    def all_ids(self) -> np.ndarray:
        with self.store.open_input_file(self.path) as f:
            return np.frombuffer(f.read(), self.kind)


def _doc_ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].cast(pa.int64()).fill_null(LAST).to_numpy()


def write_tokens(docs: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID) -> tuple[DataFrame, DataFrame, str]:
    """Write all documents; returns the keys (doc_id, block), the manifest (block, base, n_ids) and the folder."""
    folder = folder or shared_folder(docs.sparkSession)
    blocks, _, _ = B.with_blocks(docs)

    def write(table: pa.Table) -> pa.Table:
        shard, table = table["block"][0].as_py(), B.ordered(table)
        model = encoder(path)
        plain, counts = model.encode(table["text"])
        ids = np.insert(plain, np.cumsum(counts), end_id)
        write_shard(folder, shard, ids, counts + 1, key_hashes(_doc_ids(table)))
        return pa.table({"block": pa.array([shard], pa.int32()), "n_ids": pa.array([len(ids)], pa.int64())})

    shards = materialize(blocks.groupBy("block").applyInArrow(write, "block int, n_ids long"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    manifest = shards.select("block", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return blocks.select("doc_id", "block"), manifest, folder


def read_tokens(keys: DataFrame, manifest: DataFrame, folder: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every key, looked up in the files; with ids, also the ids themselves."""
    def read(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id").combine_chunks()  # nulls come last
        shard = Shard(folder, table["block"][0].as_py())
        there, first, count = shard.find(key_hashes(_doc_ids(table)))
        if not there.all():
            raise KeyError(f"{int((~there).sum())} keys are not in shard {table['block'][0].as_py()}")
        stream = shard.all_ids()
        parts = [stream[a : a + n] for a, n in zip(first.tolist(), count.tolist())]
        out = {"doc_id": table["doc_id"], "start": first + table["base"][0].as_py(), "n_tokens": count,
               "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in parts], pa.int64())}
        return pa.table(out | ({"ids": pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64()))} if ids else {}))

    kind = dict(keys.dtypes)["doc_id"]
    return keys.join(manifest.select("block", "base"), "block").groupBy("block").applyInArrow(
        read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
