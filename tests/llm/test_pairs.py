"""Near duplicates, repeated passages and decontamination against brute force."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest

import odd
from brimline.llm import blocks, decontamination, jaccard, phrases, queries, text as X

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def order(row):
    return (row[0] is None, row[0] or 0, row[1] or "")


def shingles(text):
    w = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    """The smallest doc_id of the component of each row, rows in order."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            label[y] = x
    return [rows[top(i)][0] for i in range(len(rows))], [len(s) for s in sets], [top(i) == i for i in range(len(rows))]


def family(seed, n):
    """Copies of a few short and long texts with a word or two changed, so that many pairs are close to the limit."""
    pick, out = np.random.default_rng(seed), []
    for i in range(n):
        w = odd.prose(100 + i % 7, (6, 9, 12, 16, 60, 90, 140)[i % 7]).split()
        for _ in range(int(pick.integers(0, 3))):
            w[int(pick.integers(len(w)))] = f"new{int(pick.integers(5))}"
        out.append((i, " ".join(w), "en", "s", 0))
    return out


@pytest.mark.parametrize("source", ["odd", "family"])
def test_near_duplicates(spark, source):
    rows = sorted(odd.rows() if source == "odd" else family(1, 150), key=order)
    want, n, _ = brute_components(rows)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, odd.SCHEMA)).orderBy("at").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == [(r[0], k, c) for r, k, c in zip(rows, n, want)]


def test_one_row_of_each_component_stays(spark):
    rows = sorted(odd.rows(), key=order)
    _, _, first = brute_components(rows)
    got = jaccard.unique_documents(odd.clashing(spark))
    assert got.columns == odd.clashing(spark).columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=order) == [r[:2] for r, f in zip(rows, first) if f]


def test_light_and_heavy_sets_find_the_same(spark, monkeypatch):
    rows = [r for r in family(2, 140) if len(r[1].split()) < 20]
    want, _, _ = brute_components(rows)
    for most in (0, 5, 16):
        monkeypatch.setattr(jaccard, "boundary", lambda sizes: most)
        got = jaccard.near_duplicates(spark.createDataFrame(rows, odd.SCHEMA)).orderBy("at").collect()
        assert [r.component_id for r in got] == want


def test_boundary_follows_costs():
    assert jaccard.boundary({}) == 0
    assert jaccard.boundary({3: (10, 1)}) == 0
    assert jaccard.boundary({3: (10, 10**6), 16: (10**6, 1)}) == 15
    assert all(7 * jaccard.need(s, t) >= 3 * (s + t) > 7 * (jaccard.need(s, t) - 1) for s in range(1, 40) for t in range(1, 40))


def brute_repeats(rows):
    first, out = {}, []
    rank = lambda r: (r[0] is None, r[0] or 0)
    words = [(r[1] or "").encode().split() for r in rows]
    for r, w in zip(rows, words):
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), rank(r))
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < rank(r):
                gone[i : i + 13] = [True] * 13
        out.append((r[0], b" ".join(x for x, g in zip(w, gone) if not g).decode(), len(w), sum(gone)))
    return out


def passages(n):
    out = []
    for i in range(n):
        w = odd.prose(500 + i, 80).split()
        shared = odd.prose(900 + i % 5, 70).split()
        at = i * 7 % 60
        out.append((i, " ".join(w[:at] + shared[i % 9 : 30 + i % 40] + w[at:]), "en", "s", 0))
    return out


@pytest.mark.parametrize("senders", [1, 64])
def test_repeated_passages(spark, monkeypatch, senders):
    monkeypatch.setattr(phrases, "SENDERS", senders)
    for rows in (odd.rows(), passages(60)):
        rows = sorted(rows, key=order)
        got = phrases.without_repeats(spark.createDataFrame(rows, odd.SCHEMA)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute_repeats(rows), key=str)


def test_phrase_finder_reads_words_not_hashes():
    finder = phrases.PhraseFinder([odd.prose(1, 40).split()], 13)
    words = odd.prose(1, 40).split()
    assert finder.spans(["x"] + words[5:25]) == [(1, 21)]
    assert finder.spans(words[:12]) == [] and finder.spans(["x"] * 30) == []


def test_packed_numbers_and_blocks(spark):
    assert (blocks.unpack(blocks.pack(np.array([7 << 16, 7 << 40], np.uint64))) == [7 << 16, 7 << 40]).all()
    for n in (0, 1, 1000):
        x = np.sort(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        assert (blocks.unpack(blocks.pack(x)) == x).all()
    placed, n, _ = blocks.with_blocks(odd.documents(spark))
    got = sorted(((r.block, r.doc_id) for r in placed.collect()), key=lambda r: (r[1] is None, r[1] or 0))
    assert got == sorted(got, key=lambda r: r[0]) and got[-1][0] < n


def sizes_of(placed):
    out = {}
    for r in placed.collect():
        out.setdefault(r.block, []).append(len((r.text or "").encode()) + blocks.ROW_BYTES)
    return out


def test_blocks_hold_equally_many_bytes(spark):
    rows = [(i, odd.prose(i, 2000 if 500 <= i < 540 else 20)) for i in range(1000)]
    rows += [(2**62 + i, odd.prose(i, 2000)) for i in range(40)]  # as doubles these ids are one
    placed, n, _ = blocks.with_blocks(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = sizes_of(placed)
    most = -(-sum(map(sum, sizes.values())) // blocks.LEAST_BLOCKS)
    assert all(sum(x) <= most for x in sizes.values()) and n <= 2 * blocks.LEAST_BLOCKS
    got = sorted((r.doc_id, r.block) for r in placed.collect())
    assert [i for i, _ in got] == [i for i, _ in rows] and [b for _, b in got] == sorted(b for _, b in got)


def repeated():
    """Rows without a doc_id and of one doc_id that fill many blocks, among them equal texts, equal beginnings and no text."""
    out = [(i, odd.prose(500 + i, 30) + " " + odd.prose(900 + i % 5, 30), "en", "s", 0) for i in range(40)]
    for i in (None, 7):
        out += [(i, odd.prose(500 + n, 30) + " " + odd.prose(900 + n % 5, 30), "en", "s", 0) for n in range(20, 90)]
        out += [(i, odd.prose(3, 90) + f" {n:03d} " + odd.prose(n, 9), "en", "s", 0) for n in range(60)]
        out += [(i, odd.prose(4, 60), "en", "s", 0)] * 90
    return out


def test_blocks_of_repeated_ids(spark):
    rows = sorted(repeated() + [(None, None, "en", "s", 0)] * 2000, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    placed, n, layout = blocks.with_blocks(spark.createDataFrame(rows, odd.SCHEMA))
    sizes = sizes_of(placed)
    most = -(-sum(map(sum, sizes.values())) // blocks.LEAST_BLOCKS)
    assert max(map(sum, sizes.values())) < 1.5 * most  # equal rows are dealt by chance
    got = sorted((r.block, r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "") for r in placed.collect())
    assert [x[1:] for x in got] == [(r[0] is None, r[0] or 0, r[1] is None, r[1] or "") for r in rows] and got[-1][0] < n
    ids = {}
    for b, bare, i, *_ in got:
        ids.setdefault((bare, i), set()).add(b)
    heads = layout.heads()
    assert all({heads[b] for b in x} == {min(x)} for x in ids.values() if len(x) > 1)
    there = blocks.place_ids(spark.createDataFrame([(i,) for i in range(40)], "doc_id long"), layout).collect()
    assert {(r.doc_id, r.block) for r in there} >= {(i, b) for (bare, i), x in ids.items() if not bare for b in x}


def test_pairs_and_passages_of_repeated_ids(spark):
    rows = sorted(repeated(), key=order)
    docs = spark.createDataFrame(rows, odd.SCHEMA)
    assert max(blocks.split(docs).shares) > 1
    want, n, first = brute_components(rows)
    got = jaccard.near_duplicates(docs).orderBy("at").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == [(r[0], k, c) for r, k, c in zip(rows, n, want)]
    kept = jaccard.unique_documents(docs).collect()
    assert sorted([(r.doc_id, r.text) for r in kept], key=order) == [r[:2] for r, f in zip(rows, first) if f]
    got = phrases.without_repeats(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_repeats(rows), key=str)


def brute_hits(rows, items):
    words = lambda t: _words((t or "").translate(LOWER))
    windows = {}
    for item, t in items:
        w = words(t)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for r in rows:
        w, hit, found = words(r[1]), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def _words(text):
    import re
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text or "")


def test_decontamination(spark):
    items = [(1, odd.BENCH), (2, "short item"), (3, None), (4, ""), (5, "!!"), (2, "one"), (None, "three four"), (10, odd.prose(2, 400)),
             (6, "ÉTÉ Ñandú")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for docs in (odd.documents(spark), odd.clashing(spark)):
        got = decontamination.digest(decontamination.find(docs, bench)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute_hits(odd.rows(), items), key=str)
    kept = decontamination.remove(odd.clashing(spark), bench)
    want = [r[0] for r, h in zip(odd.rows(), brute_hits(odd.rows(), items)) if not h[-1]]
    assert kept.columns == odd.clashing(spark).columns
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == sorted(map(str, want))


def test_decontamination_without_items(spark):
    found = decontamination.find(odd.documents(spark), odd.nothing(spark, "item_id long, text string")).collect()
    assert len(found) == len(odd.rows()) and not any(r.n_hit or r.contaminated for r in found)


def test_empty_tables(spark):
    none, bench = odd.nothing(spark), odd.nothing(spark, "item_id long, text string")
    assert jaccard.near_duplicates(none).count() == jaccard.unique_documents(none).count() == 0
    assert phrases.without_repeats(none).count() == 0
    assert decontamination.find(none, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert decontamination.remove(none, bench).count() == 0


def test_word_hashes_depend_on_words_only():
    import pyarrow as pa
    a, at = X.all_word_hashes(pa.array(["b  a\tc", None, "", "a c"]))
    assert at.tolist() == [0, 3, 3, 3, 5] and a[1] == a[3] and a[2] == a[4] and len(set(a.tolist())) == 3


def test_queries_on_the_small_tables(spark, sf_dir):
    import pyarrow.parquet as pq
    rows = sorted([(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()])
    want, n, _ = brute_components(rows)
    got = queries.op7_jaccard(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(r[0], k, c) for r, k, c in zip(rows, n, want)]
    got = queries.op10_phrases(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == [
        (i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, k in brute_repeats(rows)]


@pytest.mark.parametrize("few", [0, 2, 8])
def test_phrases_in_many_places(monkeypatch, few):
    """Every window that some passage holds is covered, and no other word, however many places its phrases have."""
    monkeypatch.setattr(phrases, "FEW_PLACES", few)
    pick = random.Random(few)
    for size in (5, 13):
        common = [f"c{i}" for i in range(size)]
        passages = []
        for _ in range(60):
            own = [f"w{pick.randint(0, 40)}" for _ in range(pick.randint(size, 3 * size))]
            at = pick.randint(0, len(own))
            passages.append(own[:at] + common[: pick.randint(size // 2, size)] + own[at:])
        finder = phrases.PhraseFinder(passages, size)
        known = {tuple(p[i : i + size]) for p in passages for i in range(len(p) - size + 1)}
        for _ in range(150):
            a, b = pick.choice(passages), pick.choice(passages)
            run = a[pick.randint(0, 3) :] + b[: pick.randint(0, len(b))] + common
            want = {j for i in range(len(run) - size + 1) if tuple(run[i : i + size]) in known for j in range(i, i + size)}
            assert {j for s, e in finder.spans(run) for j in range(s, e)} == want


def test_work_grows_with_the_records(monkeypatch):
    """Records that share seven words, among themselves: twice as many are twice the work."""
    steps = []
    grown = phrases.PhraseFinder._grown
    monkeypatch.setattr(phrases.PhraseFinder, "_grown", lambda *a: steps.append(1) or grown(*a))
    for n in (500, 2000):
        records = [[f"a{i}", "the", "same", "seven", "words", "in", "every", "record", *[f"b{i}x{j}" for j in range(6)]] for i in range(n)]
        records = [r[1:] + [r[0]] for r in records]
        finder = phrases.PhraseFinder(records, 13)
        steps.clear()
        assert all(set(finder.spans(r)) == {(0, len(r))} for r in records)
        assert len(steps) <= 3 * n
