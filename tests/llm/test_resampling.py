"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import odd
from brimline.llm import queries, resampling, shared, text as X

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORDS = ["a", "bb", "THE", "ñandú", "x" * 64, "y" * 65, "z" * 300, "日本", "42", "İ", "\U0001f600"]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def buckets(t):
    w = words(t)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5, least=20, seed=42):
    """(doc_id, n_features, weight, score, rank) of rows (doc_id, text), as text of each."""
    s, t = (Counter(b for x in texts for b in buckets(x)) for texts in ([x for _, x in docs], target))
    sums = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sums[0] + 10000) / ((s[b] + 1) * (sums[1] + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, x in docs:
        found = buckets(x)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, x])
    able = sorted((r for r in rows if len(words(r[5])) >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return rows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=12), min_size=1, max_size=5), st.sampled_from([" ", ", ", "\0"]),
       st.sampled_from([1, 3, 1 << 17]))
def test_buckets_of_runs(texts, space, block):
    texts = [space.join(t) for t in texts]
    data, offsets = X.utf8(pa.array(texts))
    kept, resampling.BLOCK = resampling.BLOCK, block
    got = [Counter() for _ in texts]
    for bucket, text in resampling.features(data, offsets):
        for b, i in zip(bucket.tolist(), text.tolist()):
            got[i][b] += 1
    resampling.BLOCK = kept
    assert got == [Counter(buckets(t)) for t in texts]


def same(found, want):
    return sorted(map(str, found)) == sorted(map(str, want))


@pytest.mark.parametrize("percent", [0, 5, 37, 100])
def test_odd_rows(spark, percent):
    docs = odd.clashing(spark).withColumns({"rank": F.lit("rank"), "weight": F.lit(1)}).withColumn("a.b", F.lit(2))
    target = spark.createDataFrame([(odd.BENCH,), (odd.prose(1, 30),), (None,), ("",)], "text string")
    texts = [r.text for r in target.collect()]
    got = [tuple(r) for r in resampling.ranks(docs, target, percent).collect()]
    want = brute([r[:2] for r in odd.rows()], texts, percent)
    assert same([r[:4] for r in got], [tuple(r[:4]) for r in want])
    drawn = lambda rows: sorted((r[4], r[3]) for r in rows if r[4])  # noqa: E731  equal rows may change places
    assert drawn(got) == drawn(want)
    whole = resampling.resample(docs, target, percent)
    assert set(whole.columns) == (set(docs.columns) | {"n_features", "score", "rank", "n_words"}) - {"text_hash"}
    assert sorted((r["rank"], r.score) for r in whole.collect()) == drawn(want)


def test_empty_tables(spark):
    none, docs = odd.nothing(spark), odd.documents(spark)
    assert resampling.ranks(none, docs).count() == 0
    got = [tuple(r)[:4] for r in resampling.ranks(docs, none).collect()]
    assert same(got, [tuple(r[:4]) for r in brute([r[:2] for r in odd.rows()], [])])


def test_cutoff_among_equal_scores(spark, monkeypatch):
    """Most rows share one score, so the cutoff lies among them, and a third are one row; a narrow bracket must be widened."""
    pick = random.Random(5)
    rows = [(i, 30, pick.choice([5, 5, 5, 9, 1, pick.randint(-50, 50)]), i % 7) for i in range(2000)] + [(7000, 30, 5, 1)] * 1000
    rows += [(None, 30, 5, j) for j in range(5)] + [(8000 + i, 3, 99, 0) for i in range(50)]
    pick.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, n_words int, score long, text_hash long")
    monkeypatch.setattr(resampling, "ACCURACY", 100)
    monkeypatch.setattr(resampling, "MARGIN", 0)
    for percent in (1, 30, 80, 99):
        got = resampling.draw(table, percent).collect()
        able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[2], r[0] is None, r[0] or 0, r[3]))
        k = percent * len(able) // 100
        assert [tuple(r)[:4] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == able[:k]
        assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, k + 1)) and len(got) == len(rows)


def test_numbers_of_rows(spark):
    df = spark.range(5000).selectExpr("id % 100 as a", "cast(null as string) as n").union(spark.sql("select 3L, 'x'"))
    got = shared.numbered(df, ["a", "n"], "place").collect()
    assert sorted(r.place for r in got) == list(range(1, 5002))
    assert [r.a for r in sorted(got, key=lambda r: r.place)] == sorted(r.a for r in got)
    assert shared.numbered(df.where("a < 0"), ["a"], "place").count() == 0


def test_query(spark, sf_dir):
    read = lambda n: pq.read_table(f"{sf_dir}/{n}.parquet").to_pylist()
    want = brute([(r["doc_id"], r["text"]) for r in read("documents")], [r["text"] for r in read("benchmark")])
    got = queries.op12_resampling(spark, sf_dir).collect()
    assert same([tuple(r) for r in got], [tuple(r[:5]) for r in want])
    assert np.sum([r["rank"] is not None for r in got]) > 5
