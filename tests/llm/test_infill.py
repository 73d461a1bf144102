"""Fill-in-middle against a plain form of the same rule."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import odd
from brimline.llm import infill, queries, text as X
from compare import differences, duck

PARTS = ["a", "é", "\n", "\n\n", "<", "<P", ">", "<S>", "<M>", "日本", "\U0001f600", " ", "line of words\n", "P>", "x" * 40]


def plain(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=60).map("".join), min_size=1, max_size=6), st.integers(1, 9))
def test_lines_and_cuts(texts, bits):
    data, offsets = X.utf8(pa.array(texts))
    kept, infill.BITS = infill.BITS, bits
    try:
        lines = infill.Lines(infill.Memo(), data, offsets, data.tobytes())
    finally:
        infill.BITS = kept
    units = [re.findall(r"[^\n]*\n|[^\n]+", t) for t in texts]
    assert lines.n.tolist() == list(map(len, units))
    assert lines.marked.tolist() == [any(x in t for x in ("<P>", "<S>", "<M>")) for t in texts]
    for share in (0, 0.3, 0.7, 1):
        k = (lines.n * share).astype(np.int64)
        byte, points = lines.cut(k)
        heads = ["".join(u[:i]) for u, i in zip(units, k.tolist())]
        assert points.tolist() == list(map(len, heads))
        assert (byte - offsets[:-1]).tolist() == [len(x.encode()) for x in heads]


def test_equal_passages_have_equal_chunks():
    passage = odd.prose(1, 2000)
    texts = [odd.prose(2, 300) + " " + passage, "é" + passage + odd.prose(3, 50), passage]
    data, offsets = X.utf8(pa.array(texts))
    raw, edges = data.tobytes(), infill.chunk_edges(data, offsets).tolist()
    chunks = [[raw[a:b] for a, b in zip(edges, edges[1:]) if offsets[i] <= a < offsets[i + 1]] for i in range(3)]
    assert max(map(len, sum(chunks, []))) <= infill.LONGEST and len(chunks[2]) > 10
    assert len(set(chunks[2][1:-1]) & set(chunks[0]) & set(chunks[1])) >= len(set(chunks[2][1:-1])) - 1
    known = infill.Memo()
    infill.Lines(known, data, offsets, raw)
    assert len(known.numbers) < sum(map(len, chunks)) - 15


@pytest.mark.parametrize("remembered", [0, 32 << 20])
def test_odd_rows(spark, monkeypatch, remembered):
    monkeypatch.setattr(infill, "REMEMBERED", remembered)
    docs = odd.clashing(spark).withColumns({"form": F.lit("form"), "output": F.lit(1)})
    more = [(50, "a\nb\r\nc <P> d\n", "en", "s", 1), (51, "\n" * 5000, "en", "s", 1), (52, "no end\n" * 3 + "tail", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, odd.SCHEMA), allowMissingColumns=True).withColumn("a.b", F.lit(2))
    for rate, spm in ((100, 50), (60, 0)):
        found = infill.fill_in_middle(docs, rate=rate, spm=spm)
        assert set(found.columns) == set(docs.columns) | {"n_units", "prefix_chars", "middle_chars"}
        back = found.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
        got = [(r.doc_id, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back]
        want = [(r[0], *plain(r[0], r[1], rate, spm)) for r in odd.rows() + more]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert all(r.back == (r.text or "") for r in back)
    assert infill.fill_in_middle(odd.nothing(spark)).count() == 0


def test_a_long_text(spark):
    lines = [odd.prose(i, 1 + i % 30) + "\n" for i in range(20000)]
    text = "".join(lines)
    assert len(text) > 1 << 20
    docs = spark.createDataFrame([(1, text), (2, "x" * 3_000_000), (3, text)], "doc_id long, text string")
    got = {r.doc_id: r for r in infill.fill_in_middle(docs).collect()}
    for i, t in ((1, text), (2, "x" * 3_000_000), (3, text)):
        r = got[i]
        assert (r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(i, t)


def test_query_matches_sql(spark, sf_dir):
    found, rows = differences(spark, duck(sf_dir), queries.op11_infill, queries.SQL["op11_infill"], sf_dir)
    assert not found, found
    assert rows > 0
