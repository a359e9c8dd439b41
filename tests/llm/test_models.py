"""Held-out accuracy, exact chain sums, the sampled distribution, and the pipeline against its parts."""

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quoin.llm import crf, lattice, trie
from quoin.llm.language_id import language_id
from quoin.llm.quality_classifier import score_quality
from quoin.llm.vocabulary import vocabulary

SF = "/root/testdata/sf0.01"
MODEL = "piece_bpe_32k.model"


def test_marginals_are_exact():
    r = np.random.default_rng(0)
    x, first = r.normal(size=(7, 3)), np.array([0, 4, 4, 7])
    f = crf.Field(r.normal(size=3), r.normal(size=(2, 2)))
    p, _, whole = f.marginals(x, first)
    want, total = np.zeros(7), 0.0
    for a, b in ((0, 4), (4, 7)):
        z = 0.0
        for y in itertools.product((0, 1), repeat=b - a):
            q = np.exp(sum(x[a + i] @ f.w * y[i] for i in range(b - a)) + sum(f.step[y[i], y[i + 1]] for i in range(b - a - 1)))
            z += q
            want[a:b] += q * np.array(y)
        want[a:b] /= z
        total += np.log(z)
    assert np.allclose(p, want) and np.isclose(whole, total)


def test_lines_of_texts():
    _, weight, first = crf.line_features(pa.array(["a b\nC!", "", None, "\n\nx | y"]))
    assert first.tolist() == [0, 2, 3, 4, 7] and weight.tolist() == [4, 3, 1, 1, 1, 1, 6]


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = score_quality(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_held_out_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = language_id(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95


def test_segmentations_follow_the_lattice():
    """Shares of sampled segmentations of one word against enumeration."""
    v, text = vocabulary(MODEL), "there"
    word, n = "▁" + text, len(text) + 1
    weight = {}
    for cuts in itertools.product((0, 1), repeat=n - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], n]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        if all(p in v.ids for p in parts):
            weight[tuple(v.ids[p] for p in parts)] = np.exp(-sum(np.log1p(1 + v.ranks[p]) for p in parts))
    total = sum(weight.values())
    ids, at = lattice.sample([text] * 20000, np.arange(20000, dtype=np.uint64), lattice.pieces(MODEL, 1.0))
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:]))
    assert set(seen) <= set(weight)
    for k, w in weight.items():
        assert abs(seen[k] / 20000 - w / total) < 0.02


def test_prefix_tree_finds_every_link():
    r = np.random.default_rng(1)
    sets = []
    for _ in range(12):
        base = r.choice(400, 40, replace=False)
        for _ in range(6):
            s = set(base.tolist())
            for _ in range(int(r.integers(0, 8))):
                s.discard(int(r.choice(base)))
                s.add(int(r.integers(400, 2000)))
            sets.append(sorted(s))
    entries = trie.ranked([np.array(s) for s in sets], [len(s) for s in sets])
    union = trie.Union(len(sets))
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = set(sets[a]), set(sets[b])
        if 100 * len(x & y) >= 80 * len(x | y):
            union.join(a, b)
    got = trie.Union(len(sets))
    half = list(range(0, len(sets), 2)), list(range(1, len(sets), 2))
    for left, right in ((half[0], half[0]), (half[1], half[1]), half):
        for a, b in trie.join(entries, left, right, 80):
            x, y = set(sets[a]), set(sets[b])
            assert 100 * len(x & y) >= 80 * len(x | y)
            got.join(a, b)
    assert [got.find(i) for i in range(len(sets))] == [union.find(i) for i in range(len(sets))]


def test_pipeline(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in c.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        docs = out.checkpoint()
    assert docs.where(F.col("text") == "").count() == 0
