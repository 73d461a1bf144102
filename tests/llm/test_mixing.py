"""Mixing against plain Python: targets, rates from bisection, and copies that meet the targets."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import odd
from brimline.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string"


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets by source of {source: size}: shares by weight, what is above the limit is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, full = share * sum(sizes.values()), set()
    while True:
        rest = goal - sum(cap * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        out = {s: cap * sizes[s] if s in full else rest * weight[s] / total for s in names}
        over = {s for s in names if s not in full and out[s] > cap * sizes[s]}
        if not over:
            return out
        full |= over


def brute_rates(sizes, target, cap=2):
    """Rates of documents of one source, of sizes above 0, by bisection."""
    if target >= cap * sum(sizes):
        return [cap] * len(sizes)
    mean = sum(sizes) / len(sizes)
    rate = lambda t, s: cap / (1 + math.exp(min(700, max(-700, -t * s / mean))))
    low, high = -1e4, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(s * rate(mid, s) for s in sizes) < target else (low, mid)
    return [rate(low, s) for s in sizes]


def check(rows, got, weights=(5, 2, 1), share=1.5, cap=2):
    """rows: (doc_id, text, source); got: rows of mixing.rates."""
    total = Counter()
    for _, t, s in rows:
        total[s] += size_of(t)
    want = brute_targets(total, weights, share, cap)
    assert sorted(str((r.doc_id, r.source, r.size)) for r in got) == sorted(str((i, s, size_of(t))) for i, t, s in rows)
    by = defaultdict(list)
    for r in got:
        assert r.source_size == total[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert r.taken == r.copies * r.size and math.floor(r.rate) <= r.copies <= math.ceil(r.rate) and r.taken <= cap * r.size
        by[r.source].append(r)
    for s, found in by.items():
        full = sorted((r for r in found if r.size), key=lambda r: r.size)
        assert all(r.copies == 0 for r in found if not r.size)
        if full:
            rates = brute_rates([r.size for r in full], want[s], cap)
            assert all(math.isclose(r.rate, x, rel_tol=1e-4, abs_tol=1e-6) for r, x in zip(full, rates))
        missed = abs(sum(r.taken for r in found) - want[s])
        free = [r.size for r in found if r.rate % 1 > 1e-9]
        assert missed <= max(free, default=0) / 2 + 1, (s, missed)


def corpus(seed, n, sources):
    pick = random.Random(seed)
    names = [f"s{i}" for i in range(sources)]
    return [(i, odd.prose(i, min(4000, int(pick.paretovariate(1.1) * 8))), pick.choice(names)) for i in range(n)]


@pytest.mark.parametrize("weights, share, cap", [((5, 2, 1), 1.5, 2), ((1, 30), 1.0, 3)])
def test_mix_of_sources(spark, weights, share, cap):
    rows = corpus(1, 1200, 5)
    got = mixing.rates(spark.createDataFrame(rows, SCHEMA).repartition(5), weights, share, cap).collect()
    check(rows, got, weights, share, cap)
    if cap == 2:
        again = mixing.rates(spark.createDataFrame(rows, SCHEMA).repartition(3), weights, share, cap).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_hot_source_and_equal_rows(spark, monkeypatch):
    """A third of all rows are one row, so a source comes near its target only with some of them."""
    monkeypatch.setattr(mixing, "FEW", 8)
    rows = corpus(2, 600, 3) + [(9000, "w " * 40, "s1")] * 500 + [(9001, "x " * 25, "t")] * 200
    got = mixing.rates(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)
    assert len({r.copies for r in got if r.doc_id in (9000, 9001)}) > 1


def test_odd_rows(spark):
    docs = odd.clashing(spark).withColumns({c: F.lit(c) for c in ("u", "rate", "copies", "target", "mean", "tilt", "place", "cuts")})
    docs = docs.withColumn("a.b", F.lit(1))
    more = [(60, "\v a\fb\r\nc\x00d    ", "z"), (61, None, "no words"), (62, "", "no words"), (63, "a b c", None), (64, "a" * 9, "")]
    rows = [(r[0], r[1], r[3]) for r in odd.rows()] + more
    plain = spark.createDataFrame(rows, SCHEMA)
    check(rows, mixing.rates(plain).collect())
    taken = mixing.mixed(docs)
    assert set(taken.columns) == set(docs.columns) | {"source_size", "taken"}
    assert taken.where("copies < 1 or u <> 'u' or place <> 'place'").count() == 0 and taken.count() > 0
    assert mixing.rates(odd.nothing(spark)).count() == 0
    silent = spark.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)
    assert [(r.size, r.target, r.copies) for r in mixing.rates(silent).collect()] == [(0, 0.0, 0)] * 2


def test_query_on_given_tables(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    got = queries.op13_mixing(spark, sf_dir)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    made = mixing.rates(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    check(rows, made)
    assert sorted((r.doc_id, r.taken) for r in made) == sorted((r.doc_id, r.taken) for r in got.collect())
    plan = got._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
