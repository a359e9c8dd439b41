"""Operators against plain versions that share nothing with them, on small texts."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from quoin.llm import crf, fingerprint, language_id, lattice, quality_classifier
from quoin.llm import textkernel as tk
from quoin.llm.fingerprint import fingerprints, plan
from quoin.llm.quality_rules import quality_rules

M64 = (1 << 64) - 1


def scrambled(x, seed):
    """Multiply and xor-shift rounds in plain integers."""
    x = (x + 0x9E3779B97F4A7C15 * (seed + 1)) & M64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def plain_chunks(data):
    """Byte by byte: boundaries by the last 16 bytes' gear values."""
    gear = [scrambled(b, 23) >> 32 for b in range(256)]
    out, at = [], 0
    while at < len(data):
        end = at
        while True:
            end += 1
            h = 0
            if end == len(data) or end - at >= 192:
                break
            if end - at < 16:
                continue
            for b in data[end - 16 : end]:
                h = (h * 2 + gear[b]) & 0xFFFFFFFF
            if h >> 24 == 0 and end - at < 48 or h >> 28 == 0 and end - at >= 48:
                break
        out.append(data[at:end])
        at = end
    return out


def texts(n, seed=5):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghiöü", k=r.randint(1, 9))) for _ in range(60)]
    return ["", "x", *(" ".join(r.choices(words, k=r.randint(5, 400))) for _ in range(n))]


def test_boundaries_are_those_of_a_plain_chunker():
    given = [t.encode() for t in texts(12)]
    values, at = fingerprint.chunks(given)
    for i, t in enumerate(given):
        want = plain_chunks(t)
        assert b"".join(want) == t
        assert sorted(int(v) & 0xFFFF for v in values[at[i] : at[i + 1]]) == sorted(map(len, set(want)))


def test_fingerprint_rows(spark):
    """Likenesses as plain sets of chunks give them; the next document and the edit worked out by hand."""
    given = texts(14)
    ids = list(range(0, 2 * len(given), 2))
    docs = spark.createDataFrame(list(zip(ids, given)), "doc_id long, text string").repartition(5)
    rows = {r.doc_id: r for r in fingerprints(docs, block_bytes=700).collect()}
    like = lambda a, b: 1.0 if not a and not b else 0.0 if not a or not b else sum(map(len, a & b)) / sum(map(len, a))
    for i, (d, t) in enumerate(zip(ids, given)):
        after = given[(i + 1) % len(given)]
        keep, lost = t[: len(t) - len(t) // 2], len(t) // 2
        changed = keep + "".join(itertools.islice(after, lost))
        own, edit, following = (set(plain_chunks(x.encode())) for x in (t, changed, after))
        r = rows[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.near_edited == pytest.approx(like(own, edit)) and r.near_next == pytest.approx(like(own, following))
        assert len(r.fingerprint) == 16 * len(own) and len(r.edited_fingerprint) == 16 * len(edit)


def test_one_id_of_many_rows(spark):
    """Rows of one id, and rows without one, are several blocks; the order by id and hash has no gap."""
    r = random.Random(1)
    rows = [(i if i % 3 == 0 else 7 if i % 3 == 1 else None, f"{r.random()} " * r.randint(1, 30)) for i in range(120)]
    one = fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), block_bytes=500).collect()
    two = fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), block_bytes=10**6).collect()
    assert sorted(one, key=str) == sorted(two, key=str) and len(one) == len(rows)


def test_plan_of_blocks():
    first, parts, n = plan([(0, 50, True), (1, 60, False), (2, 30, False), (3, 250, True), (5, 10, False)], 6, 100)
    assert first.tolist() == [0, 1, 1, 2, 0, 5] and parts.tolist() == [1, 1, 1, 3, 1, 1] and n == 6


def test_votes_one_by_one():
    """Family by the greatest margin, then each pair's vote; ties by the sum of margins, then by name."""
    groups, width, seen = [["aa", "bb", "cc"], ["dd", "ee"]], (1 << language_id.BITS) + 1, set()
    given = [t for t in texts(20) if t]
    for seed in range(6):
        r = np.random.default_rng(seed)
        pairs = {p: r.normal(size=width).astype(np.float32) for g in groups for p in itertools.combinations(g, 2)}
        model = language_id.Model(groups, r.normal(size=(2, width)).astype(np.float32), pairs)
        for t, name, s in zip(given, *model.predict(given)):
            x = np.append(language_id.trigrams([t])[0], np.float32(1))
            g = groups[int(np.argmax([float(w @ x) for w in model.family]))]
            votes, sums = dict.fromkeys(g, 0), dict.fromkeys(g, 0.0)
            for (a, b), w in pairs.items():
                if a in g:
                    m = float(w @ x)
                    votes[a if m >= 0 else b] += 1
                    sums[a] += m
                    sums[b] -= m
            assert name == max(g, key=lambda n: (votes[n], sums[n])) and 0 <= s <= 1
            seen.add(name)
    assert len(seen) > 2


def test_trigrams_are_counted():
    t = "ÄB ab\n\tab  x"
    raw = f" {t.lower()} ".encode()
    raw = bytes(32 if b < 33 else b for b in raw)
    want = np.zeros(1 << language_id.BITS)
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        want[((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - language_id.BITS)] += 1
    want = np.sqrt(want) / np.sqrt(want.sum())
    assert np.allclose(language_id.trigrams([t])[0], want, atol=1e-6)


def test_document_scores_by_enumeration():
    """A document's share of good text from all labellings of its lines."""
    r = np.random.default_rng(2)
    model = quality_classifier.Model(crf.Field(r.normal(size=crf.WIDTH) / 3, r.normal(size=(2, 2))), 2.5, -1.0)
    given = ["Good line here.\n### || $$\n\nlast one", "", "one line", "a\nb\nc c c c\nD!\n%%%"]
    got = model.scores(pa.array(given, pa.large_string()))
    for t, s in zip(given, got):
        x, weight, _ = crf.line_features(pa.array([t], pa.large_string()))
        lines = t.split("\n")
        assert weight.tolist() == [len(x.encode()) + 1 for x in lines]
        total, bad = 0.0, np.zeros(len(lines))
        for y in itertools.product((0, 1), repeat=len(lines)):
            p = np.exp(sum(x[i] @ model.field.w * y[i] for i in range(len(lines))) + sum(model.field.step[a, b] for a, b in zip(y, y[1:])))
            total += p
            bad += p * np.array(y)
        share = (weight * (1 - bad / total)).sum() / weight.sum()
        assert s == pytest.approx(1 / (1 + np.exp(-(-1.0 + 2.5 * share))))


def test_long_chains_are_the_same(monkeypatch):
    r = np.random.default_rng(3)
    x, first = r.normal(size=(90, 4)), np.array([0, 40, 41, 90])
    f = crf.Field(r.normal(size=4), r.normal(size=(2, 2)))
    whole = f.marginals(x, first)
    monkeypatch.setattr(crf, "LONG", 7)
    for a, b in zip(whole, f.marginals(x, first)):
        assert np.allclose(a, b)


def test_long_words_are_cut_alike(monkeypatch):
    """A word's pieces don't depend on how it is worked through, nor on the words around it."""
    p = lattice.pieces("piece_bpe_32k.model", 1.0)
    r = random.Random(0)
    words = ["".join(r.choices("abcdefg", k=n)) for n in (1, 5, 300, 700, 2000)]
    key = np.array([9], dtype=np.uint64)
    alone = [lattice.sample([w], key, p)[0].tolist() for w in words]
    monkeypatch.setattr(lattice, "BLOCK", 64)
    monkeypatch.setattr(lattice, "FEW", 0)
    lattice._memo.clear()
    ids, at = lattice.sample(words, np.repeat(key, len(words)), p)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == alone


@pytest.fixture(scope="module")
def sources(spark):
    """Two sources of unlike texts, a third of 49 rows, and one of 50."""
    r = random.Random(8)
    rows = []
    for source, n, long, sign, twice in (("a", 200, 4, 0.02, 0.05), ("b", 200, 9, 0.3, 0.3), ("few", 49, 4, 0.02, 0.05), ("enough", 50, 14, 0.02, 0.05)):
        for i in range(n):
            lines = []
            for _ in range(12):
                if lines and r.random() < twice:
                    lines.append(r.choice(lines))
                else:
                    lines.append(" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=max(2, round(r.gauss(long, 1))))) + ("#" if r.random() < sign else "") for _ in range(8)))
            rows.append((len(rows), "\n".join(lines), "en", source))
    rows.append((9999, "### " * 60 + " ".join(f"w{i}" for i in range(200)), "en", "a"))
    return quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)).collect()


def test_fences_adapt(sources):
    by = {r.source: r for r in sources}
    for m in ("symbols_high", "word_length_high", "word_length_low", "dup_lines_high", "repeats_high"):
        assert by["a"][m] != by["b"][m]
    assert by["b"].symbols_high > 3 * by["a"].symbols_high


def test_small_groups_use_their_language(sources):
    by = {r.source: r for r in sources}
    assert by["few"].word_length_high != by["a"].word_length_high and by["few"].word_length_high > 10  # that of all four sources
    assert by["enough"].word_length_low > 10


def test_odd_documents_go(sources):
    kept = {r.doc_id: r.kept for r in sources}
    assert not kept[9999] and sum(kept.values()) > 0.9 * sum(not r.base_failed for r in sources)


def test_a_value_on_the_fence_is_kept(sources):
    for r in sources:
        inside = all(r[f"{m}_high"] is None or r[m] <= r[f"{m}_high"] for m in ("symbols", "word_length", "dup_lines", "repeats")) and r.word_length >= r.word_length_low
        assert r.kept == (inside and not r.base_failed)


def test_parts_bound_rows():
    batch = pa.record_batch([pa.array(["a"] * 10)], names=["t"])
    assert [p.num_rows for p in tk.parts(batch, 0, rows=4)] == [4, 4, 2]
