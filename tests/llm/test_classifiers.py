"""The two classifiers against plain forms of their methods."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

import odd
from brimline.llm import quality, text as X, toxicity
from test_texts import LABELS, labelled


def test_ftrl_against_a_plain_form():
    """One coordinate at a time, in dicts: z and n of each slot, weights from both."""
    pick = np.random.default_rng(3)
    vectors, labels = [], []
    for _ in range(300):
        at = np.concatenate([[0], np.unique(pick.integers(1, 64, 12))])
        x = np.concatenate([[1.0], pick.random(len(at) - 1)])
        vectors.append((at, x))
        labels.append(int(x[at % 2 == 0].sum() > x[at % 2 == 1].sum() + 0.5))
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= quality.L1 and i > 0:
            return 0.0
        return (math.copysign(quality.L1, z[i]) * (z[i] != 0) - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(3):
        for (at, x), y in zip(vectors, labels):
            w = [weight(i) for i in at.tolist()]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x.tolist()))))
            for i, wi, xi in zip(at.tolist(), w, x.tolist()):
                g = (p - y) * xi
                step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - step * wi
                n[i] += g * g
    got = quality.fit_ftrl(vectors, np.array(labels), bits=6, epochs=3)
    np.testing.assert_allclose(got, [weight(i) for i in range(64)], rtol=1e-9, atol=1e-12)


def test_quality_score_is_a_sparse_dot_product(spark):
    """Tokens are words and runs of punctuation; every n-gram adds its weight, and the mean is scaled."""
    texts = ["One two, TWO three!! one", "", "a", None, "x x x x", odd.prose(2, 400)]
    bits = 8
    weights = np.random.default_rng(1).normal(size=1 << bits)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    for i, t in enumerate(texts):
        data, offsets = X.utf8(pa.array([t or ""]))
        h, _ = quality.tokens(data, offsets)
        parts = [p for p in re.findall(r"[a-z0-9]+|[^a-z0-9\s]+", (t or "").lower())]
        assert len(h) == len(parts) and len(set(h.tolist())) == len(set(parts))
        slot, _ = quality.slots(data, offsets, bits)
        assert len(slot) == len(parts) + max(0, len(parts) - 1)
        mean = sum(weights[j] for j in slot.tolist()) / max(1, len(slot))
        assert math.isclose(got[i], 1 / (1 + math.exp(-(weights[0] + quality.SCALE * mean))), rel_tol=1e-9)


def walk(node, x):
    """The prediction of a tree's leaf for a vector."""
    while node.subtreeDepth() > 0:
        split = node.split()
        node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
    return node.prediction()


def test_toxicity_score_from_its_trees_and_steps(spark):
    rows, marks = labelled(500)
    docs, labels = spark.createDataFrame(rows, odd.SCHEMA), spark.createDataFrame(marks, LABELS)
    model = toxicity.fit(docs, labels)
    some = docs.where("doc_id < 60").union(spark.createDataFrame([(900, "", None, None, 0), (901, "YOU idiot!!", None, None, 0)], odd.SCHEMA))
    features = {r.doc_id: r.features for r in toxicity.with_features(some, model.odds).collect()}
    roots = [(w, t._call_java("rootNode")) for w, t in zip(model.trees.treeWeights, model.trees.trees)]
    edges, steps = np.array(model.steps.boundaries), np.array(model.steps.predictions)
    assert (np.diff(steps) >= 0).all()
    seen = set()
    for r in toxicity.score(some, model).collect():
        margin = sum(w * walk(root, features[r.doc_id]) for w, root in roots)
        want = float(np.interp(1 / (1 + math.exp(-2 * margin)), edges, steps))
        assert math.isclose(r.score, min(1.0, max(0.0, want)), abs_tol=1e-9)
        seen.add(round(r.score, 6))
    assert len(seen) > 1
