"""The pipeline against plain Python, columns that clash with results, and texts of megabytes."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as c
from quoin.llm import lattice
from quoin.llm.fingerprint import fingerprints
from quoin.llm.language_id import language_id
from quoin.llm.line_dedup import line_dedup
from quoin.llm.ngram_join import ngram_join
from quoin.llm.quality_classifier import fit, score_quality, training_sample
from quoin.llm.quality_rules import quality_rules
from quoin.llm.sentencepiece_sampling import encode
from quoin.llm.source_mix import mix_sources
from quoin.llm.substring_dedup import substring_dedup
from quoin.llm.token_count import token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = "\t\n\x0b\x0c\r "
lower = lambda t: "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t)


def plain_lines(rows):
    key = lambda x: lower(x.strip(BLANKS))
    n = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    texts = ["\n".join(x for x in (r[1] or "").split("\n") if not key(x) or n[key(x)] < 10) for r in rows]
    return [(r[0], t, r[2], r[3], len(t)) for r, t in zip(rows, texts)]


def plain_groups(rows):
    sets = []
    for r in rows:
        w = WORD.findall(lower(r[1]))
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for i, r in enumerate(rows):
        rank = (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())
        if sets[i] and (group[i] not in first or rank < first[group[i]][0]):
            first[group[i]] = (rank, r)
    return [r for _, r in first.values()] + [r for r, s in zip(rows, sets) if not s]


def plain_mix(rows):
    size = [len(WORD.findall(r[1])) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {n: sum(k for r, k in zip(rows, size) if r[3] == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(size), set(names)
    while open_:
        unit = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if unit * weight[n] >= 2 * total[n]}
        if not full:
            target |= {n: unit * weight[n] for n in open_}
            break
        for n in full:
            target[n] = 2 * total[n]
            left -= target[n]
        open_ -= full
    out = []
    for n in names:
        own = sorted(((hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1]}".encode()).hexdigest(), k, r) for r, k in zip(rows, size) if r[3] == n), key=lambda x: x[:2])
        whole = int(target[n]) // total[n] if total[n] else 0
        rest, before = int(target[n]) - whole * total[n], 0
        for _, k, r in own:
            taken = whole * k + max(0, min(k, rest - before))
            before += k
            out += [r] * (int(taken / k + 0.5) if k else 0)
    return out


def plain_pieces(spark, rows):
    p = lattice.pieces("piece_bpe_32k.model", 1.0)
    keys = {r["i"]: r["k"] for r in spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "i int, doc_id long, text string").selectExpr("i", "xxhash64(0, case when doc_id is not null then cast(doc_id as string) else concat('#', coalesce(text, '')) end) k").collect()}
    out = []
    for i, r in enumerate(rows):
        ids, _ = lattice.sample([r[1]], np.array([keys[i]], dtype=np.int64).view(np.uint64), p)
        out.append((r[0], len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), True))
    return out


def corpus(seed=3):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghijklmnoprstu", k=r.randint(2, 8))) for _ in range(400)]
    sentence = lambda: " ".join(r.choices(words, k=r.randint(6, 14))).capitalize() + "."
    junk = lambda: " ".join("".join(r.choices("#*$%|<>&!09", k=r.randint(1, 5))) for _ in range(12))
    rows = []
    for i in range(90):
        bad = i % 6 == 0
        lines = [junk() if bad else sentence() for _ in range(r.randint(2, 8))]
        if i % 3 == 0:
            lines.insert(1, "  SHARED Footer line  " if i % 2 else "shared footer line")
        rows.append((i, "\n".join(lines), ["en", "fr", None][i % 3], ["a", "b", "c", None][i % 4], 0))
    for i in (10, 11, 13):
        near = rows[i][1].split(" ")
        near[-1] = "other"
        rows += [(200 + i, rows[i][1], "en", "b", 0), (300 + i, rows[i][1] + " " + " ".join(near[:1]), "en", "a", 0), rows[i], (None, rows[i][1], "en", "a", 0)]
    rows += [(400, None, "en", "a", 0), (401, "", "en", "b", 0), (401, "", "en", "b", 0), (None, None, None, None, 0), (402, "shared footer line", "fr", "c", 0), (None, sentence(), "en", "b", 0), (None, "x y z", None, None, 0)]
    labels = [(i, int(i % 6 > 0), 0) for i in range(90)]
    return rows, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rows, labels = corpus()
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", score string, _name int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_run_equals_plain_python(spark, written):
    folder, rows = written
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = fit(*training_sample(docs, labels))
    good = [r for r in rows if model.scores(pa.array([r[1] or ""], pa.large_string()))[0] >= 0.5]
    assert 0 < len(good) < len(rows)
    lines = plain_lines(good)
    assert sum("\n" in (r[1] or "") for r in good) and any(a[1] != b[1] for a, b in zip(good, lines) if a[1] is not None)
    groups = plain_groups(lines)
    assert len(groups) < len(lines)
    want = plain_pieces(spark, plain_mix(groups))
    got = [tuple(r) for r in c.run(spark, folder).select("doc_id", "n_pieces", "ids_sha256", "lossless").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_copies_keep_one_of_each_group(spark, written):
    _, rows = written
    given = [(r[0], r[1] or "", *r[2:]) for r in rows]
    out = [tuple(r) for r in c.near_copies(spark, spark.createDataFrame(given, SCHEMA), "").collect()]
    assert Counter((r[0], r[1]) for r in out) == Counter((r[0], r[1]) for r in plain_groups(given))


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0


def test_names_that_clash(spark):
    names = ["_id", "_of", "_s", "_b", "_name", "_gone", "Size", "Held_Out", "N_Lines", "Score", "Kept_Text", "_key", "_bucket", "TAKEN", "_copies", "h1", "batch"]
    docs = spark.createDataFrame([(i, f"line {i % 2}\nmore {i}", "s", *["own"] * len(names)) for i in range(6)], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    for out, made in ((line_dedup(docs, 3), {"kept_text", "n_lines", "n_dropped"}), (mix_sources(docs), {"size", "source_size", "target", "taken"}), (score_quality(docs, labels), {"held_out", "score", "predicted"})):
        assert len({n.lower() for n in out.columns}) == len(out.columns) and made <= set(out.columns)
        rows = out.collect()
        assert len(rows) == 6
        assert all(r[n] == "own" for r in rows for n in names if n.lower() not in made)


def test_texts_of_megabytes(spark):
    r = random.Random(1)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(1, 9))) for _ in range(3000)]
    long = "\n".join(" ".join(r.choices(words, k=8)) for _ in range(30000))
    rows = [(1, long, "en", "a"), (2, long[: len(long) // 2] + " changed", "en", "a"), (3, "z" * 1_000_000, "fr", "b"), (4, "short", "fr", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    sizes = {d: len(WORD.findall(t)) for d, t, *_ in rows}
    one = {r.doc_id: r for r in substring_dedup(docs).collect()}
    assert {d: r.n_words for d, r in one.items()} == sizes and one[2].n_removed > 0.9 * sizes[2] and one[4].n_removed == 0
    assert {r.doc_id: r.n_lines for r in line_dedup(docs).select("doc_id", "n_lines").collect()} == {1: 30000, 2: rows[1][1].count("\n") + 1, 3: 1, 4: 1}
    assert {r.doc_id: r.n_words for r in quality_rules(docs).collect()} == sizes
    assert len(language_id(docs).collect()) == 4
    assert {r.doc_id: r["size"] for r in mix_sources(docs).collect()} == sizes
    assert all(0 <= r["score"] <= 1 for r in score_quality(docs, spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")).collect())
    assert {r.doc_id: r.component_id for r in ngram_join(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert {r.doc_id: r.n_chars for r in fingerprints(docs).select("doc_id", "n_chars").collect()} == {d: len(t) for d, t, *_ in rows}
    assert {r.doc_id: r.n_bytes for r in token_counts(docs).collect()} == {d: len(t.encode()) for d, t, *_ in rows}
    assert all(r.lossless for r in encode(docs, with_ids=False).collect())
