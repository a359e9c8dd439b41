"""Links of the n-gram join, counted one by one."""

import random

import duckdb
import numpy as np
import pytest

from quoin.llm import oracle, queries, trie
from quoin.llm.ngram_join import ngram_join

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("piece", [1 << 19, 60])
def test_links_are_counted(spark, piece):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*words[:i], "x", *words[i + 1 :]])) for i in range(0, 40, 8)] + [(50, " ".join(words)), (51, " ".join(words)), (51, " ".join(words).upper()), (52, "a b c"), (53, "A b c"), (54, None), (None, " ".join(words)), (55, "")]
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))})
    want = [(d, sum(j != i and bool(s) and 100 * len(s & o) >= 80 * len(s | o) for j, o in enumerate(sets))) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_links) for r in ngram_join(docs, piece_tokens=piece, with_links=True).collect()]
    assert max(n for _, n in want) > 5 and sorted(got, key=str) == sorted(want, key=str)


def test_links_equal_the_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = queries.op7_ngram_links(spark, SF).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    assert sorted(tuple(r) for r in got) == sorted(c.sql(oracle.OP7_NGRAM_LINKS).fetchall())


@pytest.mark.parametrize("piece", [1 << 18, 300])
def test_components_equal_the_sql(spark, piece):
    """Also with clusters cut into many pieces, pivots and components of several pieces."""
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = ngram_join(spark.read.parquet(f"{SF}/documents.parquet"), piece_tokens=piece).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in got) == sorted(c.sql(oracle.OP7_NGRAM_JOIN).fetchall())


@pytest.mark.parametrize("seed", [0, 1])
def test_pieces_lose_no_group(spark, seed):
    """Chains of near copies that share pieces with others, in a cluster of many pieces."""
    r = random.Random(seed)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for g in range(6):
        own = [f"g{g}w{i}" for i in range(40)]
        for _ in range(25):
            t = [*own, *common] if g % 2 else [*common, *own]
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = f"x{r.randrange(10**9)}"
            rows.append((len(rows), " ".join(t)))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    got = {x.doc_id: x.component_id for x in ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), piece_tokens=1000).collect()}
    assert [got[i] for i in range(len(rows))] == group


def test_bounds_prune():
    """Searching compares a small part of the members that plain intersections would."""
    r = np.random.default_rng(0)
    sets = []
    for _ in range(20):
        base = r.integers(0, 1 << 60, 200)
        for _ in range(10):
            sets.append(np.unique(np.where(r.random(200) < 0.15, r.integers(0, 1 << 60, 200), base)))
    entries = trie.ranked(sets, [len(s) for s in sets])
    forest, walked = trie.build(entries, list(range(len(sets))), 80), [1]
    found = {(q, i) for q in range(len(sets)) for i in trie.search(forest, entries, q, 80, None, walked)}
    plain = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert found == plain and walked[0] < 0.1 * sum(map(len, sets)) * len(sets)
