"""Classifiers, personal data, tokens, pieces, vectors and language models against brute force or round trips."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import odd
from brimline.llm import lm, pieces, pii, quality, queries, token_files, topk, toxicity, training
from compare import differences, duck

BPE, SP = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def tables(sf_dir):
    read = lambda n: pq.read_table(f"{sf_dir}/{n}.parquet").to_pylist()
    return {r["doc_id"]: r["text"] for r in read("documents")}, {r["doc_id"]: r for r in read("labels")}


# --- personal data ------------------------------------------------------------------------------


def brute_spans(t):
    out = [("email", *m.span()) for m in re.finditer(pii.BASE["email"], t)]
    for m in re.finditer(pii.BASE["ip"], t):
        out += [("ip", *m.span())] * all(int(x) <= 255 for x in m[0].split("."))
    for kind, fits in (("card", lambda d: 12 <= len(d) <= 19 and pii.luhn(d)), ("phone", lambda d: 9 <= len(d) <= 15)):
        out += [(kind, *m.span()) for m in re.finditer(pii.BASE[kind], t) if fits(re.sub("[^0-9]", "", m[0]))]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("a1@.-+ ()0259é٣%_\n"), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.spans_of(text, pii.automaton()) if s[0] in pii.BASE] == brute_spans(text)


def test_luhn_and_more_kinds():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    text = "see https://x.org/a?b=c. IBAN: DE4412345678; card 4111 1111-1111 1111, call +49 (30) 123456"
    assert [(k, text[a:b]) for k, a, b in pii.spans_of(text, pii.automaton())] == [
        ("url", "https://x.org/a?b=c"), ("account", "DE4412345678"), ("card", "4111 1111-1111 1111"),
        ("phone", "+49 (30) 123456")]
    assert pii.redact(text, pii.spans_of(text, pii.automaton())).startswith("see [URL]. IBAN: [ACCOUNT]; card [CARD]")


def test_pii_of_odd_rows(spark):
    got = pii.digest(pii.find_spans(odd.clashing(spark).drop("score"))).collect()
    want = []
    for r in odd.rows():
        spans = brute_spans(r[1] or "")
        n = Counter(k for k, *_ in spans)
        want.append((r[0], *(n[k] for k in pii.BASE), hashlib.sha256(pii.joined(spans).encode()).hexdigest()))
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted(want, key=str)
    assert pii.find_spans(odd.nothing(spark)).count() == 0


# --- classifiers --------------------------------------------------------------------------------


def labelled(n):
    """Half of the labels of either kind: junk marks for quality, insults for toxicity."""
    docs, labels = [], []
    for i in range(n):
        w = odd.prose(i, 60).split()
        bad, rude = i % 3 == 0, i % 4 == 0
        if rude:
            w[10:10] = ["you", "idiot"] * 2 + ["scum", "loser"]
        docs.append((i, " | ".join(w) if bad else " ".join(w), "en", "s", 0))
        labels.append((i, int(not bad), int(rude)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_classifiers_on_held_out_rows(spark):
    rows, marks = labelled(600)
    docs, labels = spark.createDataFrame(rows, odd.SCHEMA), spark.createDataFrame(marks, LABELS)
    held = {i for i, *_ in marks if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {r.doc_id for r in docs.where(training.held_out()).collect()} == held
    assert not held & {r.doc_id for r in training.labelled_sample(docs, labels, "toxic", 10**6).collect()}
    got = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert np.mean([(got[i] >= quality.THRESHOLD) == bool(q) for i, q, _ in marks if i in held]) > 0.97
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert np.mean([(got[i] >= toxicity.THRESHOLD) == bool(t) for i, _, t in marks if i in held]) > 0.97


def test_classifiers_on_odd_rows(spark):
    none = odd.nothing(spark, LABELS)
    docs = odd.clashing(spark)
    flat = quality.score(docs, quality.fit(docs, none))
    assert set(flat.columns) == set(docs.columns) and {r.score for r in flat.collect()} == {0.5}
    rows, marks = labelled(200)
    known = spark.createDataFrame(rows, odd.SCHEMA)
    marks = spark.createDataFrame(marks + [(None, 1, 1), (1, None, None), (5, 1, 0), (5, 0, 1)], LABELS)
    for module in (quality, toxicity):
        model = module.fit(known, marks)
        got = module.score(docs, model).collect()
        assert len(got) == len(odd.rows()) and all(0 <= r.score <= 1 for r in got)
        same = {}
        for r in got:
            same.setdefault(r.text or "", set()).add(round(r.score, 12))
        assert all(len(s) == 1 for s in same.values())
        assert module.score(odd.nothing(spark), model).count() == 0
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}


def test_toxicity_features():
    from brimline.llm import text as X
    texts = ["You IDIOT! y0u 1d1ot", "", "calm words", "idiot " + "word " * 10 + "you"]
    data, offsets = X.utf8(pa.array(texts))
    odds = np.zeros((len(toxicity.PREFIXES) + 1, 1 << toxicity.BITS), np.float32)
    f = dict(zip(toxicity.FEATURES, toxicity.features(
        data, offsets, odds, toxicity.lexicon(toxicity.INSULTS), toxicity.lexicon(toxicity.SECOND_PERSON)).T))
    assert f["insults"].tolist() == [1 / 4, 0, 0, 1 / 12] and f["insults_near_you"].tolist() == [1 / 4, 0, 0, 0]
    assert f["hidden_insults"].tolist() == [1 / 4, 0, 0, 0] and f["capital_words"].tolist() == [1 / 4, 0, 0, 0]
    assert f["obfuscated"].tolist() == [2 / 4, 0, 0, 0] and f["exclamations"][0] == 1 / 20 and f["log_words"][1] == 0


# --- tokens and pieces --------------------------------------------------------------------------


def brute_tokens(rows):
    model = Tokenizer.from_file(BPE)
    model.encode_special_tokens = True
    out, at = [], 0
    for doc_id, text in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


PARTS = ["a", "é", " ", "  ", "\n", "\t", " ", " ", "　", "'s", "1", "22", "!", "日", "\u0085", "<|endoftext|>", " the",
         "\U0001f600", "\x1c", "\r\n", "▁", "①"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), min_size=1, max_size=5))
def test_pieces_of_texts_encode_as_the_whole(texts):
    ids, counts = token_files.encoder(BPE).encode(pa.array(texts))
    want = [e.ids for e in token_files.encoder(BPE).model.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want))
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 20000])
def test_minimal_perfect_hash(n):
    h = token_files.key_hashes(np.arange(n) * 3 - 5)
    assert sorted(token_files.slots_of(h, token_files.minimal_perfect_hash(h), n).tolist() if n else []) == list(range(n))


def test_token_files(spark):
    docs = odd.clashing(spark)
    keys, manifest, folder = token_files.write_tokens(docs, BPE)
    got = token_files.read_tokens(keys, manifest, folder, ids=True).collect()
    rows = sorted([r[:2] for r in odd.rows()], key=lambda r: (r[0] is None, r[0] or 0, r[1] or "\U0010ffff"))
    assert sorted([tuple(r)[:4] for r in got], key=lambda r: r[1]) == brute_tokens(rows)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    shard = token_files.Shard(folder, manifest.orderBy("block").first()["block"])
    there, *_ = shard.find(token_files.key_hashes(np.arange(10**6, 10**6 + 100)))
    assert not there.any()
    none = token_files.write_tokens(odd.nothing(spark), BPE)
    assert token_files.read_tokens(*none).count() == 0


def test_token_query(spark, sf_dir, tables):
    got = queries.op9_token_files(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute_tokens(sorted(tables[0].items()))


def test_special_tokens_in_texts_as_the_library_has_them(spark):
    texts = ["a <|endoftext|> b", "no such string", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n<|endoftext|> z", None]
    model = Tokenizer.from_file(BPE)
    want = [model.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    assert want[0] == [64, 220, 50256, 275, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = token_files.read_tokens(*token_files.write_tokens(docs, BPE), ids=True).orderBy("doc_id").collect()
    assert [r.ids for r in got] == want
    assert [r.start for r in got] == [sum(map(len, want[:i])) for i in range(len(want))]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(SP)


def test_pieces_equal_the_library(vocabulary):
    pick, library = random.Random(1), sentencepiece.SentencePieceProcessor(model_file=SP)
    names = [n.replace("▁", " ") for n in vocabulary.name]
    texts = ["".join(pick.choice(kind) for _ in range(pick.randint(0, 20)))
             for kind in (PARTS, names, list("aeionrst "), list(" aa▁")) for _ in range(1500)] + [
                 "ab" * 3000, "é" * 700, "".join(pick.choice(names).strip() for _ in range(2000)), "①x日" * 400]
    known = pieces.Encoder(vocabulary)
    ids, counts = known.encode(pa.array(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == library.encode(texts)
    assert known.decode(ids, counts) == [t.replace("▁", " ") for t in texts]


def test_unigram_steps_take_the_best_sum(vocabulary, monkeypatch):
    monkeypatch.setattr(vocabulary, "bpe", False)
    known = pieces.Encoder(vocabulary)
    for word in ("▁other", "▁hereation", "xyzxyz"):
        best = [0.0] + [-math.inf] * len(word)
        for j in range(1, len(word) + 1):
            best[j] = max(best[i] + vocabulary.score[vocabulary.name[word[i:j]]] for i in range(j) if word[i:j] in vocabulary.name)
        got = known.viterbi(np.array([[ord(c) for c in word]]))[0]
        assert vocabulary.score[got].sum() == best[-1]


def test_round_trip_of_odd_rows(spark):
    docs = odd.clashing(spark)
    got = pieces.round_trip(docs, SP)
    library = sentencepiece.SentencePieceProcessor(model_file=SP)
    for r in got.collect():
        assert r.same and (r.ids or []) == library.encode(r.text or "") and r.n_tokens == len(r.ids or [])
    assert pieces.round_trip(odd.nothing(spark), SP).count() == 0


# --- vectors ------------------------------------------------------------------------------------


def brute_top(rows, k):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in vectors if i % 50 == 0}):
        best = sorted((-sum(a * b for a, b in zip(v, w)), j) for i, v in vectors if i == q
                      for j, w in vectors if j != q and len(w) == len(v))[:k]
        out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return out


def test_top_k(spark):
    pick = np.random.default_rng(3)
    rows = [(i, pick.normal(size=6).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(120)]  # ties
    rows += [(900, None), (901, [None] * 6), (902, [math.nan] + [0.0] * 5), (903, [math.inf] + [0.0] * 5), (None, rows[0][1]),
             (950, [1.0, 2.0]), (1000, [0.5, 0.5]), (1050, []), (1100, [1e6] * 3), (1101, [1e6 + 1] * 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (1, 5):
        vectors = topk.integer_vectors(table, 256)
        got = topk.top_k(vectors.where("id % 50 = 0"), vectors, k, pivots=8).collect()
        assert sorted(map(tuple, got)) == brute_top(rows, k)
    none = topk.integer_vectors(odd.nothing(spark, "vec_id long, embedding array<float>"), 256)
    assert topk.top_k(none, none, 5).count() == 0


def test_bounds_stop_early(monkeypatch):
    pick, seen = np.random.default_rng(1), []
    x = np.concatenate([np.floor(10 * pick.normal(size=(2000, 4))), np.floor(500 + 10 * pick.normal(size=(20, 4)))])
    x, q, pivots = x.astype(float), np.full(4, 500.0), x[[0, 5, 2005]].astype(float)
    plain = topk.products
    monkeypatch.setattr(topk, "products", lambda q, y: seen.append(len(y)) or plain(q, y))
    got = topk.best(-1, q, topk.distances(q[None], pivots)[0], np.arange(len(x)), x, topk.distances(x, pivots), (x * x).sum(1), 5)
    assert sorted(got, key=lambda c: (-c[0], c[1])) == sorted(
        ((int(s), i) for i, s in enumerate(x @ q)), key=lambda c: (-c[0], c[1]))[:5]
    assert sum(seen) < len(x) / 4


# --- language models ----------------------------------------------------------------------------


def brute_scores(rows, marked):
    words = [(r[1] or "").translate(LOWER).encode().split() for r in rows]

    def count(chosen):
        one, two = Counter(), Counter()
        for w in chosen:
            one.update(w)
            one[None] += bool(w)
            two.update(zip([None, *w], w))
        return one, two, sum(map(len, chosen))

    models = [(count([w for r, w in zip(rows, words) if r[0] in marked]), True), (count(words), False)]
    out = []
    for r, w in zip(rows, words):
        one, two, losses = Counter(w), Counter(zip([None, *w], w)), []
        one[None] = 1
        for (ones, twos, n), only in models:
            h = r[0] in marked or not only
            loss = 0.0
            for v, x in zip([None, *w], w):
                p = (ones[x] - h * one[x] + 1) / (n - h * len(w) + lm.VOCABULARY)
                loss -= math.log((twos[v, x] - h * two[v, x] + lm.PRIOR * p) / (ones[v] - h * one[v] + lm.PRIOR))
            losses.append(loss / max(1, len(w)))
        out.append((r[0], len(w), *(round(x, 9) for x in (*losses, losses[0] - losses[1]))))
    return sorted(out, key=str)


@pytest.mark.parametrize("marked", [{0, 2, 9, 25}, set()])
def test_language_model_scores(spark, marked):
    ids = spark.createDataFrame([(i,) for i in marked] + [(None,)], "doc_id long")
    got = lm.score(odd.clashing(spark), ids).collect()
    flat = sorted([(r[0], r[1], *(round(x, 9) for x in r[2:])) for r in map(tuple, got)], key=str)
    assert [f[:2] for f in flat] == [w[:2] for w in brute_scores(odd.rows(), marked)]
    assert np.allclose(*[[f[2:] for f in x] for x in (flat, brute_scores(odd.rows(), marked))], atol=1e-7)
    assert lm.score(odd.nothing(spark), ids).count() == 0


def test_tokens_and_scores_of_repeated_ids(spark):
    from test_pairs import order, repeated
    rows = sorted(repeated(), key=order)
    docs = spark.createDataFrame(rows, odd.SCHEMA)
    got = token_files.read_tokens(*token_files.write_tokens(docs, BPE)).orderBy("start").collect()
    assert [tuple(r) for r in got] == brute_tokens([r[:2] for r in rows])
    ids = spark.createDataFrame([(i,) for i in (2, 7, 30)], "doc_id long")
    flat = sorted([(r[0], r[1], *(round(x, 9) for x in r[2:])) for r in map(tuple, lm.score(docs, ids).collect())], key=str)
    want = brute_scores(rows, {2, 7, 30})
    assert [f[:2] for f in flat] == [w[:2] for w in want]
    assert np.allclose(*[[f[2:] for f in x] for x in (flat, want)], atol=1e-7)


# --- SQL and the pipeline -----------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    found, rows = differences(spark, duck(sf_dir), queries.QUERIES[name], queries.SQL[name], sf_dir)
    assert not found and rows > 0


def test_pipeline_stages(spark, sf_dir, tables):
    import corpus_pipeline
    from test_pairs import brute_components, brute_hits
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    docs = read("documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = sorted([(r.doc_id, r.text) for r in docs.collect()])
        out = stage(spark, docs, sf_dir).cache()
        after = {r.doc_id: r for r in out.collect()}
        if name == "toxicity":
            model = toxicity.fit(docs, read("labels"))
            scores = toxicity.score(docs, model).collect()
            assert set(after) == {r.doc_id for r in scores if r.score < toxicity.THRESHOLD} and len(after) > 0.8 * len(before)
        if name == "near_duplicates":
            assert set(after) == {d for (d, _), first in zip(before, brute_components(before)[2]) if first}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in read("benchmark").collect()]
            assert set(after) == {d for d, *_, bad in brute_hits(before, items) if not bad}
        if name == "pii":
            anchors = pii.automaton()
            assert {d: r.text for d, r in after.items()} == {d: pii.redact(t, pii.spans_of(t, anchors)) for d, t in before}
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "sentencepiece":
            library = sentencepiece.SentencePieceProcessor(model_file=SP)
            assert {d: r.ids for d, r in after.items()} == {d: library.encode(t) for d, t in before}
        else:
            assert out.columns == columns
            docs = out


@pytest.mark.parametrize("size", [1, 7, 5000])
def test_numbers_of_hashes(size):
    pick, known, table = np.random.default_rng(size), {}, token_files.Numbers()
    for _ in range(12):
        h = np.unique(pick.integers(0, 20000, size).astype(np.uint64) * np.uint64(4096))  # many share their first slot
        found = table.find(h)
        assert found.tolist() == [known.get(max(x, 1), -1) for x in h.tolist()]
        new = h[found < 0]
        for x, i in zip(new.tolist(), table.add(new).tolist()):
            known[max(x, 1)] = i
    assert sorted(known.values()) == list(range(table.n)) and 2 * table.n <= len(table.hash)


def test_encoder_forgets_by_bytes(monkeypatch):
    """Texts without spaces are one piece each, so their number says little about what is kept."""
    monkeypatch.setattr(token_files, "REMEMBERED", 1 << 20)
    model, known = Tokenizer.from_file(BPE), token_files.Encoder(BPE)
    pick = random.Random(4)
    for _ in range(6):
        texts = ["".join(pick.choice("日本語文字abc") for _ in range(3000)) for _ in range(40)]
        ids, counts = known.encode(pa.array(texts))
        assert np.split(ids, np.cumsum(counts)[:-1])[7].tolist() == model.encode(texts[7], add_special_tokens=False).ids
        held = sum(x.nbytes for x in (known.flat, known.first, known.size, known.numbers.hash, known.numbers.number))
        assert held < (6 << 20)


def test_pairs_one_at_a_time(vocabulary):
    pick = np.random.default_rng(8)
    stable = np.flatnonzero(vocabulary.stable)
    q, p = pick.choice(stable, 4000), pick.choice(stable, 4000)
    assert [vocabulary.stands_one(a, b) for a, b in zip(q.tolist(), p.tolist())] == vocabulary.stands(q, p).tolist()


def test_long_random_words(vocabulary):
    """Words such as base64: each in about the time of its length, and none is kept for long."""
    pick, known = random.Random(9), pieces.Encoder(vocabulary)
    texts = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/") for _ in range(n)) for n in (300, 3000, 100_000)]
    library = sentencepiece.SentencePieceProcessor(model_file=SP)
    begin = time.process_time()
    ids, counts = known.encode(pa.array(texts))
    assert time.process_time() - begin < 10
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in parts[:2]] == library.encode(texts[:2])
    assert known.decode(ids, counts) == texts


def test_words_are_forgotten_by_bytes(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 1 << 20)
    pick, known = random.Random(4), pieces.Encoder(vocabulary)
    for _ in range(5):
        known.encode(pa.array(["".join(pick.choice("日本語文字abc") for _ in range(1500)) for _ in range(40)]))
        assert sum(x.nbytes for x in (known.flat, known.first, known.size, known.numbers.hash, known.numbers.number)) < (8 << 20)


def test_a_labelled_id_counts_once(spark):
    """However many rows bear it, with equal texts or others."""
    docs = spark.createDataFrame([(1, "one"), (1, "one"), (1, "uno"), (1, None), (2, "two"), (3, "three")] + [(4, "four")] * 500,
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in (1, 2, 3, 4)] + [(1, 0, 0)], LABELS)
    got = training.labelled_sample(docs, labels, "quality", 100).collect()
    want = [i for i in (1, 2, 3, 4) if zlib.crc32(str(i).encode()) % 5]
    assert sorted((r.doc_id, r.label) for r in got) == [(i, i % 2) for i in want]
    assert {r.text for r in got if r.doc_id == 4} <= {"four"}


@pytest.mark.parametrize("table", ["odd", "empty", "nulls"])
def test_pipeline_on_odd_tables(spark, tmp_path, table):
    """Nulls in any column, empty and long texts, equal rows, repeated ids, a table of nulls only and an empty one: each stage
    gives rows of the columns of documents, and rows it does not reject stay as they are."""
    import corpus_pipeline
    docs = {"odd": odd.documents(spark), "empty": odd.nothing(spark),
            "nulls": spark.createDataFrame([(None,) * 5] * 3, odd.SCHEMA)}[table]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in (13, 19))) for i in range(28)] + [(None, 1, 1), (3, None, None)], LABELS).write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, odd.BENCH), (2, None), (3, "")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), {"odd": 34, "empty": 0, "nulls": 3}[table]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "sentencepiece":
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / name))
            out = spark.read.parquet(str(tmp_path / name))
        n = out.count()
        assert n <= left and (n == left or name in ("toxicity", "near_duplicates", "decontamination"))
        docs, left = out, n
    got = docs.collect()
    assert all(r.same for r in got) and (table == "empty") == (not got)
    if table == "empty":
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
