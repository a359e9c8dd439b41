"""Substring dedup: words covered by a word window that occurs more than once in the corpus go."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from . import textkernel as tk
from .shared import blocks_for, digest, text_bytes
from .textkernel import U

RESULT = "k binary, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,stop:long>>, kept_text string"
#: Bytes of text in a block; a block is the unit of Python memory.
BLOCK_BYTES = 6 << 20
EXACT = -1


def _windows(texts: pa.Array, copies: np.ndarray, size: int) -> tuple[tk.Words, np.ndarray, np.ndarray]:
    """Words, the word numbers at which windows begin, and the windows' hashes."""
    w = tk.words(texts)
    starts, text = tk.window_starts(w.first, size)
    return w, starts, tk.windows(w.hashes, size)[starts] if len(starts) else np.zeros(0, dtype=U)


def _twice(w: tk.Words, starts: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Places in starts that belong to texts with more than one copy."""
    return np.flatnonzero((copies > 1)[np.searchsorted(w.first, starts, side="right") - 1]) if len(starts) else starts


def _second(w: tk.Words, starts: np.ndarray, size: int) -> np.ndarray:
    return (tk.windows(w.hashes, size, 1)[starts] >> U(32)).astype(np.uint32) if len(starts) else np.zeros(0, dtype=np.uint32)


def _candidates(w, starts, hashes, copies, size, slices, replies):
    """Sorted distinct windows estimated repeated: both hashes, and how often the block holds each (2: twice or more)."""
    maybe = np.flatnonzero(sketch.estimates(_weighted(w, starts, hashes, copies), slices, replies)[: len(hashes)] > 1)
    order = maybe[np.argsort(hashes[maybe], kind="stable")]
    a = hashes[order]
    at = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, dtype=np.int64)
    weight = np.ones(len(hashes), dtype=np.int64)
    weight[_twice(w, starts, copies)] = 2
    held = np.add.reduceat(weight[order], at) if len(a) else np.zeros(0, dtype=np.int64)
    return a[at], _second(w, starts, size)[order[at]] if len(a) else np.zeros(0, dtype=np.uint32), np.minimum(held, 2)


def _weighted(w, starts, hashes, copies):
    """The hashes, and those of texts with copies once more, so that their counts reach two."""
    return np.concatenate((hashes, hashes[_twice(w, starts, copies)]))


def _exact_ask(block: int, a: np.ndarray, b: np.ndarray, held: np.ndarray, owners: int) -> list[tuple[int, int, int, bytes]]:
    owner = ((a >> U(32)) * U(owners) >> U(32)).astype(np.int64)
    cut = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(a)])) if len(a) else [0]
    return [(block, EXACT, int(owner[i]), a[i:j].tobytes() + b[i:j].tobytes() + held[i:j].astype(np.uint8).tobytes()) for i, j in zip(cut[:-1], cut[1:])]


def _exact_merge(table: pa.Table) -> pa.Table:
    """Groups windows by all 96 bits of their hashes; a block learns which of its own occur twice or more."""
    blocks, owner = table.column("block").to_pylist(), table.column("slice")[0].as_py()
    parts = []
    for payload in table.column("payload"):
        p = payload.as_py()
        n = len(p) // 13
        parts.append((np.frombuffer(p, dtype="<u8", count=n), np.frombuffer(p, dtype="<u4", count=n, offset=8 * n), np.frombuffer(p, dtype=np.uint8, offset=12 * n)))
    a, b, held = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    at = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    total = np.add.reduceat(held[order].astype(np.int64), at)
    repeated = np.empty(len(a), dtype=bool)
    repeated[order] = np.repeat(total > 1, np.diff(np.append(at, len(a))))
    cut = np.cumsum([0] + [len(x) for x, _, _ in parts])
    return sketch.messages([(k, EXACT, owner, np.packbits(repeated[i:j]).tobytes() + bytes([(j - i) % 8])) for k, i, j in zip(blocks, cut[:-1].tolist(), cut[1:].tolist())])


def _bits(payload: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(payload, dtype=np.uint8, count=len(payload) - 1))
    return bits[: len(bits) - (8 - payload[-1]) % 8]


def kept_texts(w: tk.Words, keep: np.ndarray) -> list[bytes]:
    """Each text's kept words, joined by one space."""
    s, e = w.starts[keep], w.ends[keep]
    to = np.cumsum(e - s + 1)
    begin = to - (e - s + 1)
    out = np.full(int(to[-1]) if len(to) else 0, 32, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[to - 1] = False
    out[inside] = w.data[np.repeat(s - begin, e - s) + np.flatnonzero(inside)]
    ends = np.concatenate(([0], to))[np.concatenate(([0], np.cumsum(keep)))[w.first]]
    raw = out.tobytes()
    return [raw[i : max(i, j - 1)] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]


def substring_dedup(docs: DataFrame, window: int = 35, with_text: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Removes every word covered by a window of `window` words that also starts anywhere else.

    Returns (doc_id, n_words, n_removed, kept_sha256, spans, kept_text), one row for each row of
    docs; spans are the removed runs of words [start, stop), kept_text is null unless with_text.

    Two passes: partial count-min sketches of all window hashes are merged (`sketch`), and only
    windows whose estimate is two or more are grouped, by 96 bits of hash made of the words' 64-bit
    hashes: two windows that differ are taken as one only if those 96 bits agree, or if they differ
    in words of equal hash only. The estimate is never too low, so none is lost. Exact
    copies are folded first and count as often as they occur. A row whose text occurs once in
    docs and a row whose text is repeated are treated alike; the judgement is on the input.

    Null and empty texts: no words, the hash of the empty string. Texts shorter than the window:
    nothing removed. A text of any length is read whole, in a block with little else if it is longer
    than block_bytes. Repeated rows and null ids: each row has a result. An empty table gives an empty
    one. Other columns, of whatever name, are ignored.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    spark, size = docs.sparkSession, window
    total = text_bytes(docs)
    blocks, slices = blocks_for(spark, total, block_bytes), sketch.slices_for(total // 6)
    texts = sketch.distinct_texts(docs, blocks)

    def first(table: pa.Table) -> pa.Table:
        _, copies, text = sketch.unfold(table)
        w, starts, hashes = _windows(text, copies, size)
        return sketch.messages(sketch.ask(table.column("block")[0].as_py(), _weighted(w, starts, hashes, copies), slices))

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return sketch.messages([])
        _, copies, text = sketch.unfold(left)
        w, starts, hashes = _windows(text, copies, size)
        replies = list(zip(right.column("row").to_pylist(), right.column("slice").to_pylist(), right.column("payload").to_pylist()))
        return sketch.messages(_exact_ask(left.column("block")[0].as_py(), *_candidates(w, starts, hashes, copies, size, slices, replies), blocks))

    def last(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, copies, text = sketch.unfold(left)
        w, starts, hashes = _windows(text, copies, size)
        replies = list(zip(right.column("row").to_pylist(), right.column("slice").to_pylist(), right.column("payload").to_pylist()))
        exact = sorted((s, p) for r, s, p in replies if r == EXACT)
        gone = np.zeros(len(w.starts), dtype=bool)
        if exact:
            a, _, _ = _candidates(w, starts, hashes, copies, size, slices, [x for x in replies if x[0] != EXACT])
            repeated = np.concatenate([_bits(p) for _, p in exact])
            mine = a[repeated > 0]
            gone = tk.covered(starts[tk.lookup(mine, np.ones(len(mine), dtype=np.uint8), hashes) > 0], size, len(w.starts))
        kept = kept_texts(w, ~gone)
        edges = np.diff(gone.astype(np.int8), prepend=0, append=0)
        heads = w.first[:-1][w.counts() > 0]
        runs_from, runs_to = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        cuts = heads[(heads > 0) & gone[heads] & gone[heads - 1]] if len(heads) else heads  # a run ends with its text
        runs_from, runs_to = np.sort(np.append(runs_from, cuts)), np.sort(np.append(runs_to, cuts))
        of = np.searchsorted(runs_from, w.first)
        base = np.repeat(w.first[:-1], np.diff(of))
        spans = pa.StructArray.from_arrays([pa.array(runs_from - base, pa.int64()), pa.array(runs_to - base, pa.int64())], names=["start", "stop"])
        removed = np.concatenate(([0], np.cumsum(gone)))
        return pa.table({
            "k": pa.array(keys, pa.binary()),
            "n_words": pa.array(w.counts(), pa.int64()),
            "n_removed": pa.array(removed[w.first[1:]] - removed[w.first[:-1]], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            "spans": pa.ListArray.from_arrays(pa.array(of, pa.int32()), spans),
            "kept_text": pa.array([x.decode() for x in kept], pa.string()) if with_text else pa.nulls(len(keys), pa.string()),
        })

    by_block = lambda df: df.groupBy("block")
    rough = by_block(texts).applyInArrow(first, sketch.MESSAGE).groupBy("row", "slice").applyInArrow(sketch.merge, sketch.MESSAGE)
    exact = by_block(texts).cogroup(by_block(rough)).applyInArrow(second, sketch.MESSAGE).groupBy("slice").applyInArrow(_exact_merge, sketch.MESSAGE)
    result = by_block(texts).cogroup(by_block(rough.unionByName(exact))).applyInArrow(last, RESULT)
    return docs.select("doc_id", digest(F.col("text")).alias("k")).join(result, "k").drop("k")
