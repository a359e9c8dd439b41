"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns, and empty tables."""

import hashlib
import re
from collections import Counter

import pyarrow as pa
import pytest

from quoin.llm.fingerprint import containment, chunks, edited, fingerprints
from quoin.llm.language_id import language_id
from quoin.llm.line_dedup import line_dedup
from quoin.llm.ngram_join import ngram_join
from quoin.llm.quality_classifier import score_quality
from quoin.llm.quality_rules import quality_rules
from quoin.llm.sentencepiece_sampling import decode, encode
from quoin.llm.source_mix import mix_sources
from quoin.llm.substring_dedup import substring_dedup
from quoin.llm.textkernel import parts
from quoin.llm.token_count import token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(120))
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE.replace("w60", "xx"), "fr", None), (4, None, None, None), (5, "", "en", "b"), (6, "   \n\t", "en", "b"), (7, "short text", "de", "b"), (7, "short text", "de", "b"),
    (None, "Same Line\nother é", "en", "a"), (9, "same line\n\n" + " ".join(f"v{i % 50}" for i in range(200)), "en", "c"), (10, "SHORT text", "de", "b"), (11, "x" * 5000, "fr", "c"), (12, "a\x1cb▁ c\u0085d", "fr", "c"), (13, "\n".join(["same line"] * 3), "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_lines string, size string, k string, score string, block int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "extra", "extra", "extra", "extra", 1) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(1, 14)], "doc_id long, quality int, toxic int")


def test_empty_tables(spark, none, labels):
    for f in (substring_dedup, line_dedup, quality_rules, language_id, mix_sources, ngram_join, fingerprints, token_counts, encode):
        assert f(none).count() == 0, f.__name__
    assert score_quality(none, labels).count() == 0


def test_substring_dedup(docs):
    size = 10
    words = [WORD.findall(t or "") for _, t, *_ in ROWS]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    want = []
    for (d, *_), w in zip(ROWS, words):
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring_dedup(docs, size, with_text=True, block_bytes=300).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in substring_dedup(docs, size).collect():
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed


@pytest.mark.parametrize("batches,buckets", [(None, None), (1, 2), (3, 2), (7, 3)])
def test_line_dedup(docs, batches, buckets):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip("\t\n\x0b\x0c\r "))
    count = Counter(k for _, t, *_ in ROWS for k in {key(x) for x in (t or "").split("\n")})
    want = []
    for d, t, *_ in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and count[key(x)] >= 3)]
        want.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = [(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in line_dedup(docs, 3, 1, batches, buckets).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quality_rules(docs):
    rows = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert rows[4].n_words == 0 and rows[4].base_failed and not rows[4].kept
    assert rows[9].n_repeat_words == 200 and rows[9].base_failed
    assert rows[13].n_dup_lines == 2 and rows[11].word_chars == 5000
    assert not rows[1].base_failed and rows[1].kept


def test_language_id(docs):
    rows = language_id(docs).collect()
    assert len(rows) == len(ROWS)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {4, 5, 6} <= und and 1 not in und
    assert all(0 <= r.score <= 1 for r in rows)


def test_mix_sources(docs):
    rows = mix_sources(docs, bucket_rows=2).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for got in by.values():
        assert sum(r.taken for r in got) == int(got[0].target) and sum(r.size for r in got) == got[0].source_size
    again = mix_sources(docs.repartition(5), bucket_rows=7).collect()
    assert sorted((str(r.doc_id), r.taken) for r in rows) == sorted((str(r.doc_id), r.taken) for r in again)


def test_quality_classifier(docs, labels):
    rows = score_quality(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["score"] == 0.5 for r in score_quality(docs, labels.where("false")).collect())


@pytest.mark.parametrize("piece", [1 << 19, 40])
def test_ngram_join(docs, piece):
    fold = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")]
    sets = []
    for _, t, *_ in ROWS:
        w = fold(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    group = list(range(len(ROWS)))
    for i in range(len(ROWS)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {g: min((ROWS[i][0] for i in range(len(ROWS)) if group[i] == g and ROWS[i][0] is not None), default=None) for g in group}
    want = [(r[0], len(s), least[g] if s else r[0]) for r, s, g in zip(ROWS, sets, group)]
    got = [tuple(r) for r in ngram_join(docs, piece_tokens=piece).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_fingerprints(docs):
    rows = fingerprints(docs, block_bytes=400).collect()
    assert len(rows) == len(ROWS)
    order = sorted(((r[0], r[1] or "") for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = sorted((str(d), len(t), hashlib.sha256(edited(t, order[(i + 1) % len(order)][1]).encode()).hexdigest()) for i, (d, t) in enumerate(order))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in rows) == want
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] and prints[4] == prints[5] == "" and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_chunks_resist_shifts():
    import random

    text = "".join(random.Random(3).choices("abcdefgh ", k=20000)).encode()
    values, at = chunks([text, b"inserted " + text])
    assert containment(values[at[0] : at[1]], values[at[1] : at[2]]) > 0.95


def test_token_counts_equal_the_library(docs):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((str(d), len((t or "").encode()), len(sp.encode(t or ""))) for d, t, *_ in ROWS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts(docs).collect()) == want


def test_sampled_pieces(docs):
    one, two = encode(docs, seed=1).collect(), encode(docs.repartition(7), seed=1).collect()
    assert all(r.lossless for r in one) and sorted((str(r.doc_id), r.ids_sha256) for r in one) == sorted((str(r.doc_id), r.ids_sha256) for r in two)
    assert sorted(r.ids_sha256 for r in one) != sorted(r.ids_sha256 for r in encode(docs, seed=2).collect())
    back = decode(encode(docs, seed=1)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(d), t or "") for d, t, *_ in ROWS)


@pytest.mark.parametrize("most", [1, 5, 1000])
@pytest.mark.parametrize("texts", [[], [None] * 3, [None, "", "ab", None, "x" * 100, "ééé", "a b"]])
def test_parts_keep_every_row(texts, most):
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    for rows in (batch, batch.slice(len(texts) // 2)):
        assert [x for part in parts(rows, 0, most) for x in part.to_pylist()] == rows.to_pylist()
