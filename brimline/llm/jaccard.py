"""Near-duplicate documents: a size-aware heavy-light join on the Jaccard similarity of word shingles.

Two sets with similarity of at least 3/4 share a shingle among the rarest quarter of each (the prefix), counted over all
documents (brimline.llm.blocks), and at least c(s, t) = ceil(3 (s + t) / 7) shingles for sizes s and t.

* Light sets, up to a boundary size, enumerate all subsets of the fixed size c(s, t) for every size t they may link with; two
  light sets that link have such a subset in common, and few that do not.
* Heavy sets scan the inverted lists of their prefix, as far as the places of a shingle in both sets still allow a link.
  Shingles of one set only have no list. Light sets close to the
  boundary stand in the lists too, for links with heavy ones.
* The boundary comes from costs: the largest size up to which all subsets are fewer than the entries of the lists that the
  same sets would scan.

Equal sets are one node. A list never becomes all its pairs: in each round a few members of each list (hubs) are compared with the
members of other components, links merge components, and hubs leave their lists. Pairs of one component need no comparison,
so a list ends when its members have one component; every pair of different ones has been compared by then. Each
comparison counts the common shingles of the two whole sets.

Defined results: a null or empty text, or one without words, has the empty set and is linked with nothing; a text of fewer than
`size` words is one shingle; every row of a repeated doc_id gets a result; rows without a doc_id take part, and a component of
such rows alone has a null component_id; extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brimline.llm import blocks as B, text as X
from brimline.llm.shared import Scratch, free_shuffles

SIZE = 5
#: Counts are asked for by the upper 48 bits of a hash. Shingles that share them count together, which makes lists longer but
#: loses nothing: any order of shingles that all documents see alike will do.
UPPER = np.uint64(0xFFFFFFFFFFFF0000)
#: Sizes that can be light at most; turns in which the largest part of a list gives the hubs, after the first turn.
MOST_LIGHT = 16
LARGE_TURNS = 2

ROW = ("doc_id {kind}, at long, n_shingles long, set_id binary, scan long, prefix array<long>, places array<int>, "
       "shingles array<long>")


def _sets(block: pa.Table, size: int):
    """Distinct (row, shingle) pairs by shingle, of the first row of each distinct set; sizes and set ids of all rows."""
    values, firsts = X.all_word_hashes(block["text"], lower=True)
    key, row, _ = X.windows(values, firsts, size, short=True)
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (row[1:] == row[:-1])
    key, row = key[~same], row[~same]
    n = np.bincount(row, minlength=block.num_rows)
    digest = np.zeros((block.num_rows, 2), np.uint64)
    by_row = np.argsort(row.astype(np.uint16) if block.num_rows < 65536 else row, kind="stable")
    full = np.flatnonzero(n)
    if len(full):
        at = (np.cumsum(n) - n)[full]
        digest[full, 0] = np.add.reduceat(X.mix(key ^ np.uint64(0x5851F42D4C957F2D))[by_row], at)
        digest[full, 1] = np.add.reduceat(X.mix(key + np.uint64(0x14057B7EF767814F))[by_row], at)
    seen, first = set(), np.zeros(block.num_rows, bool)
    for i, d in enumerate(digest.tolist()):
        if n[i] and tuple(d) not in seen:
            seen.add(tuple(d))
            first[i] = True
    keep = first[row]
    return key[keep], row[keep], n, digest


def shingle_table(blocks: DataFrame, n: int, size: int) -> DataFrame:
    """ROW for each document: its set's size and id; for one row of each set and block, if shingles of its prefix recur, also those
    and all shingles, and how long the lists are that it scans. `at` orders rows by doc_id."""
    def keys(block: pa.Table):
        key, *_ = _sets(block, size)
        new, of = B.groups(key & UPPER)
        return (key & UPPER)[new], np.bincount(of, minlength=len(new)).astype("<i4")

    def answer(key, _, count):
        new, of = B.groups(key)
        return np.add.reduceat(count[:, 0].astype(np.int64), new)[of].clip(max=2**31 - 1).astype("<i4")

    def describe(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({}, schema=arrow)
        block = table["block"][0].as_py()
        table = B.ordered(table)
        key, row, n_shingles, digest = _sets(table, size)
        _, of = B.groups(key & UPPER)
        count = B.answers_of(answers, "<i4")[of, 0].astype(np.int64)
        rank = (count.clip(max=65535).astype(np.uint64) << np.uint64(48)) | (key >> np.uint64(16))
        order = np.argsort(rank, kind="stable")
        order = order[np.argsort(row[order].astype(np.uint16) if table.num_rows < 65536 else row[order], kind="stable")]
        held = np.bincount(row, minlength=table.num_rows)
        starts = np.cumsum(held) - held
        key, count = key[order].astype(np.int64), count[order]
        prefix, places, shingles = ([None] * table.num_rows for _ in range(3))
        scan = np.zeros(table.num_rows, np.int64)
        for i in np.flatnonzero(held):
            a, s = starts[i], held[i]
            rare = slice(a, a + s - (3 * s + 3) // 4 + 1)
            recurs = count[rare] > 1
            if recurs.any():
                prefix[i], scan[i] = key[rare][recurs], count[rare][recurs].sum()
                places[i] = np.flatnonzero(recurs)
                shingles[i] = key[a : a + s]
        ids = [d.tobytes() if m else None for d, m in zip(digest, n_shingles)]
        return pa.table({
            "doc_id": table["doc_id"], "at": (np.int64(block) << 32) + np.arange(table.num_rows),
            "n_shingles": n_shingles.astype(np.int64), "set_id": pa.array(ids, pa.binary()), "scan": scan,
            "prefix": pa.array(prefix, pa.list_(pa.int64())), "places": pa.array(places, pa.list_(pa.int32())), "shingles": pa.array(shingles, pa.list_(pa.int64()))})

    arrow = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
                       ("scan", pa.int64()), ("prefix", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())),
                       ("shingles", pa.list_(pa.int64()))])
    answers = B.ask(blocks, n, keys, answer)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(describe, ROW.format(kind="bigint"))


def need(s: int, t: int) -> int:
    """Shingles that sets of these sizes must share for a similarity of 3/4."""
    return -(-3 * (s + t) // 7)


def partners(s: int, most: int) -> range:
    """Sizes of light sets that a set of size s may link with."""
    return range((3 * s + 3) // 4, min(most, 4 * s // 3) + 1)


def subset_count(s: int, most: int) -> int:
    total = 0
    for t in partners(s, most):
        ways, c = 1, need(s, t)
        for i in range(c):
            ways = ways * (s - i) // (i + 1)
        total += ways if c <= s else 0
    return total


def boundary(sizes: dict[int, tuple[int, int]]) -> int:
    """Largest size up to which subsets cost less than lists; sizes gives for each size the number of sets and their list entries."""
    best = 0
    for most in range(1, MOST_LIGHT + 1):
        here = {s: v for s, v in sizes.items() if s <= most}
        if here and sum(n * subset_count(s, most) for s, (n, _) in here.items()) <= sum(scan for _, scan in here.values()):
            best = most
    return best


def _lists(nodes: DataFrame, most: int) -> DataFrame:
    """(key, node, size, place): entries of inverted lists of heavy sets, and of lists of subsets of light ones, with two nodes
    or more. place is the number of rarer shingles of the set."""
    def enumerate_subsets(batches):
        for batch in batches:
            keys, owner, sizes = [], [], []
            for node, s, shingles in zip(*(batch.column(c).to_pylist() for c in ("node", "size", "shingles"))):
                items = sorted(x & X._MASK for x in shingles)
                for t in partners(s, most):
                    c = need(s, t)
                    chosen = np.array(list(combinations(items, c)), np.uint64).reshape(-1, c)
                    ends = np.arange(1, len(chosen) + 1) * c
                    h = X.span_hashes(chosen.ravel(), ends - c, ends) if c <= s else np.zeros(0, np.uint64)
                    keys.append(X.mix(h + np.uint64(min(s, t) * 1000 + max(s, t))).astype(np.int64))
                    owner += [node] * len(h)
                    sizes += [s] * len(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *keys])), pa.array(owner, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(np.zeros(len(owner), np.int32))], ["key", "node", "size", "place"])

    heavy = nodes.where(F.col("size") >= (3 * (most + 1) + 3) // 4).select(
        "node", "size", F.inline(F.arrays_zip(F.col("prefix").alias("key"), F.col("places").alias("place")))).select(
        "key", "node", "size", "place")
    light = nodes.where(F.col("size") <= most).select("node", "size", "shingles").mapInArrow(
        enumerate_subsets, "key long, node long, size long, place int")
    entries = heavy.union(light)
    shared = entries.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("key")
    return entries.join(shared, "key")


def _merge(links: DataFrame, parts: DataFrame, scratch: Scratch) -> DataFrame:
    """parts (node, part) after joining the parts of linked nodes; the smallest node names a part."""
    a, b = parts.toDF("a", "pa"), parts.toDF("b", "pb")
    edges = links.join(a, "a").join(b, "b").where("pa <> pb").select("pa", "pb")
    edges = scratch.store(edges.union(edges.select("pb", "pa")).distinct())
    labels = edges.select(F.col("pa").alias("part")).distinct().withColumn("least", F.col("part"))
    while True:
        for _ in range(2):  # the least label of the neighbours, then the label of that label
            near = edges.join(labels.toDF("pb", "other"), "pb").groupBy(F.col("pa").alias("part")).agg(
                F.min("other").alias("other"))
            step = labels.join(near, "part").select("part", F.least("least", "other").alias("new"))
            labels = step.join(labels.toDF("new", "beyond"), "new").select("part", F.least("new", "beyond").alias("least"))
        labels = scratch.store(labels)
        ends = edges.join(labels.toDF("pa", "la"), "pa").join(labels.toDF("pb", "lb"), "pb")
        if ends.where("la <> lb").isEmpty():
            return parts.join(labels, "part", "left").select("node", F.coalesce("least", "part").alias("part"))


def _hubs(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """Entries of lists that still have several parts, with `part` and the largest part of the list."""
    now = lists.join(parts, "node")
    sizes = now.groupBy("key", "part").agg(F.count(F.lit(1)).alias("members"))
    top = sizes.groupBy("key").agg(F.max(F.struct("members", "part")).alias("top"), F.count(F.lit(1)).alias("parts"))
    return now.join(top.where("parts > 1").select("key", F.col("top.part").alias("large")), "key")


def _choose(now: DataFrame, turn: int) -> DataFrame:
    """The hubs of a turn: the first node of a list, then a few of its largest part, which most others join if they join any; then
    more and more of the other parts, until no list has several."""
    hub = F.min(F.struct("node", "size", "place", "part")).alias("hub")
    if turn == 0:
        found = now.groupBy("key").agg(hub)
    else:
        side = F.col("part") == F.col("large") if turn <= LARGE_TURNS else F.col("part") != F.col("large")
        found = now.where(side).groupBy("key", F.pmod(F.xxhash64("node"), F.lit(4**turn)).alias("deal")).agg(hub)
    return found.select("key", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "size", "place", "part")])


def compare(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets have a similarity of 3/4 or more."""
    sets = nodes.select("node", "shingles")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return both.where(7 * F.size(F.array_intersect("sa", "sb")) >= 3 * (F.size("sa") + F.size("sb"))).select("a", "b")


def node_parts(nodes: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """(node, part): the component of every node that shares a list with another one, named by its smallest node.

    A hub meets a member at a shingle only if they could share enough from there on: as many as need() says, of those
    that are not rarer in either set. A pair that links always passes at the rarest shingle that it shares.
    """
    lists = scratch.store(_lists(nodes, most))
    parts = lists.select("node").distinct().withColumn("part", F.col("node"))
    nodes = scratch.store(nodes.select("node", "shingles").join(parts.select("node"), "node", "left_semi"))
    tested, turn, old = None, 0, None
    while True:
        now = scratch.store(_hubs(lists, parts))
        if now.isEmpty():
            return parts
        hubs = _choose(now, turn)
        pairs = now.join(hubs, "key").where(
            "part <> hub_part and 4 * least(size, hub_size) >= 3 * greatest(size, hub_size) and "
            "7 * least(size - place, hub_size - hub_place) >= 3 * (size + hub_size)").select(
            F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b")).distinct()
        pairs = scratch.store(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        linked = scratch.store(compare(pairs, nodes))
        if not linked.isEmpty():
            parts = scratch.store(_merge(linked, parts, scratch))
        tested = pairs if tested is None else tested.union(pairs)
        lists = now.drop("part", "large").join(
            hubs.select("key", F.col("hub_node").alias("node")), ["key", "node"], "left_anti")
        scratch.drop(old)
        old, turn = now, turn + 1
        free_shuffles(nodes.sparkSession)


def near_duplicates(docs: DataFrame, size: int = SIZE, placed: tuple[DataFrame, int] | None = None) -> DataFrame:
    """(doc_id, at, n_shingles, part, component_id): part names the component, by the `at` of its first row. placed: the documents in
    blocks and the number of blocks, where they are known."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.store(shingle_table(*(placed or B.with_blocks(docs)[:2]), size))
    free_shuffles(docs.sparkSession)
    sets = rows.where("n_shingles > 0").groupBy("set_id").agg(F.min("at").alias("node"))
    nodes = rows.where("prefix is not null").join(sets.select("node"), F.col("at") == F.col("node"), "left_semi").select(
        F.col("at").alias("node"), F.col("n_shingles").alias("size"), "scan", "prefix", "places", "shingles")
    small = nodes.where(F.col("size") <= MOST_LIGHT).groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), F.sum("scan").alias("scan")).collect()
    parts = node_parts(nodes, boundary({r["size"]: (r["n"], r["scan"]) for r in small}), scratch)
    named = sets.join(parts, "node", "left").select("set_id", F.coalesce("part", "node").alias("part"))
    placed = rows.select("doc_id", "at", "n_shingles", "set_id").join(named, "set_id", "left").withColumn(
        "part", F.coalesce("part", "at"))
    first = placed.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return placed.join(first, "part").select("doc_id", "at", "n_shingles", "part", "component_id")


def unique_documents(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of docs without those that are near duplicates of a row before them; all columns stay."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    layout = B.split(docs)
    rows = docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias("others"))
    names, placed = rows.columns, B.place(rows, layout)
    first = near_duplicates(docs, size, (placed.select("doc_id", "text", "block"), layout.n)).where("at = part").select(
        F.shiftright("at", 32).cast("int").alias("block"), F.col("at").bitwiseAND(0xFFFFFFFF).alias("row"))

    def choose(table: pa.Table, kept: pa.Table) -> pa.Table:
        table = B.ordered(table) if table.num_rows else table
        return table.select(names).take(kept["row"])

    kept = placed.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(choose, placed.select(names).schema)
    return kept.select(*[F.col(c if c in names[:2] else f"others.{c}") for c in docs.columns])
