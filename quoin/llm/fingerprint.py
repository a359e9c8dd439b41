"""Document fingerprints from content-defined chunks."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import blocks_for, text_bytes
from .textkernel import U

#: A chunk's least, usual and largest bytes. The gear hash spans LEAST bytes, so it never reaches behind a chunk.
LEAST, USUAL, MOST = 16, 48, 192
#: Zero bits that end a chunk before and after its usual size.
STRICT, LOOSE = 8, 4
BLOCK_BYTES = 12 << 20
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

_GEAR = (tk.mix(np.arange(256, dtype=U), 23) >> U(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the sum of the last 16 bytes' random values, doubled for each byte since."""
    h = _GEAR.take(data)
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): for each text the sorted distinct chunks, each 48 bits of digest and 16 of length."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    h = gear(data) if len(data) else np.zeros(0, np.uint32)
    strict = (np.flatnonzero(h >> np.uint32(32 - STRICT) == 0) + 1).tolist()
    loose = (np.flatnonzero(h >> np.uint32(32 - LOOSE) == 0) + 1).tolist()
    strict.append(len(data) + MOST)
    loose.append(len(data) + MOST)
    starts, of, at, i, j = [], [], 0, 0, 0
    for n, t in enumerate(texts):
        end = at + len(t)
        while at < end:
            starts.append(at)
            of.append(n)
            i = bisect_left(strict, at + LEAST, i)
            cut = strict[i]
            if cut >= at + USUAL:
                j = bisect_left(loose, at + USUAL, j)
                cut = min(loose[j], at + MOST)
            at = min(cut, end)
    begin, text = np.array(starts, dtype=np.int64), np.array(of, dtype=np.int64)
    stop = np.append(begin[1:], len(data)) if len(begin) else begin
    w = tk.Words(data, begin, stop, np.zeros(1, np.int64), None)
    values = (tk.word_hashes(w) & ~U(0xFFFF)) | (stop - begin).astype(U)
    edge = np.searchsorted(text, np.arange(len(texts) + 1))
    sets = [np.sort(values[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    sets = [x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x for x in sets]
    return (np.concatenate(sets) if sets else values), np.cumsum([0] + [len(x) for x in sets])


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The bytes of a's distinct chunks that are chunks of b, as a share of all; two empty sets are alike."""
    if not len(a):
        return 1.0 if not len(b) else 0.0
    weight = (a & U(0xFFFF)).astype(np.int64)
    place = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    return float(weight[b[place] == a].sum() / weight.sum()) if len(b) else 0.0


def edited(text: str, after: str) -> str:
    """text, its last half replaced by as many code points of the next document's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


#: Ranges of ids, for each block, whose bytes are summed up before they are put together to blocks.
FINE = 4
#: Most blocks whose first rows are broadcast, some 60 bytes each.
MOST_HEADS = 100_000


def _bounds(docs: DataFrame, ranges: int) -> np.ndarray:
    """Values of doc_id that split the rows into about `ranges` ranges; an id that fills a whole range gets one of its own."""
    at = [i / ranges for i in range(1, ranges)]
    found = np.sort(docs.select(F.col("doc_id").cast("double").alias("d")).where("d is not null").approxQuantile("d", at, 0.5 / ranges)) if at else np.zeros(0)
    full = found[1:][found[1:] == found[:-1]] if len(found) else found
    return np.unique(np.concatenate((found, np.nextafter(full, np.inf))))


def _range_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """0 for null ids, then the ranges of ids in order."""
    x = ids.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    return np.where(np.isnan(x), 0, 1 + np.searchsorted(bounds, x, side="right"))


def plan(stats: list[tuple[int, int, bool]], ranges: int, block_bytes: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first block, parts) of each range, and the number of blocks, from (range, bytes, whether it holds one id only).

    Ranges that follow each other share a block until it is full. A range of one id with more bytes is
    several blocks, by the hash of the text.
    """
    first, parts, block, held = np.zeros(ranges, dtype=np.int64), np.ones(ranges, dtype=np.int64), 0, 0
    for r, size, one in sorted(stats):
        n = -(-size // block_bytes) if one else 1
        if held and (n > 1 or held + size > block_bytes):
            block, held = block + 1, 0
        first[r], parts[r] = block, max(1, n)
        held += max(1, size)
        if n > 1:
            block, held = block + n, 0
    return first, parts, block + 1


def fingerprints(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of docs: its fingerprint, that of its edited text, and likenesses.

    Gear-hash boundaries cut a text into chunks, with a stricter mask before the usual size and a
    looser one after it, so an edit moves only the boundaries near it. A fingerprint is the sorted
    distinct chunks, each as 48 bits of digest and 16 of length in hex; likeness is containment:
    the share of a fingerprint's bytes that the other has too.

    The next document is the next in ascending doc_id (null first; equal ids by a hash of the text,
    then by the text); the first follows the last. Texts are dealt once, to blocks of about
    block_bytes: ranges of doc_id, and for an id that fills more than one, ranges of that hash. The
    driver holds a bound and a sum for each range, `FINE` for a block. Each block's first text is
    also sent to the block before it.

    A row's text is read whole, however long: a text over block_bytes is a block with little else. A
    null text is empty. Empty texts have empty fingerprints. A single document is its own next one.
    Repeated rows each have a row, and an empty table gives an empty one. Other columns, of whatever
    name, are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = text_bytes(rows)
    blocks = blocks_for(spark, total, block_bytes)
    bounds = _bounds(rows, FINE * blocks)

    def ranged(batches):
        for batch in batches:
            yield pa.record_batch([pa.array(_range_of(batch.column(0), bounds), pa.int32()), *batch.columns], names=["r", "doc_id", "size"])

    sums = rows.select("doc_id", F.octet_length("text").cast("long").alias("size")).mapInArrow(ranged, "r int, doc_id long, size long")
    stats = [(s.r, s.size, s.one) for s in sums.groupBy("r").agg(F.sum("size").alias("size"), F.min("doc_id").eqNullSafe(F.max("doc_id")).alias("one")).collect()]
    first, parts, blocks = plan(stats, len(bounds) + 2, -(-total // blocks) + 1)

    def block_of(batches):
        for batch in batches:
            r, h = _range_of(batch.column(0), bounds), batch.column(1).to_numpy(zero_copy_only=False).view(U) ^ U(1 << 63)
            block = first[r] + ((h >> U(32)) * parts[r].astype(U) >> U(32)).astype(np.int64)
            yield pa.record_batch([pa.array(block, pa.int32()), *batch.columns], names=["block", *batch.schema.names])

    keyed = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    dealt = keyed.mapInArrow(block_of, "block int, doc_id long, h long, text string")
    heads = keyed.select("doc_id", "h").mapInArrow(block_of, "block int, doc_id long, h long").groupBy("block").agg(F.min(F.struct("doc_id", "h")).alias("s"))
    heads = heads.select(F.col("block").alias("b"), F.col("s.doc_id").alias("id"), F.col("s.h").alias("hash"), F.coalesce(F.lag("block").over(W.orderBy("block")), F.max("block").over(W.partitionBy())).alias("previous"))
    same = (F.col("block") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash"))
    head = dealt.join(F.broadcast(heads) if blocks <= MOST_HEADS else heads, same).groupBy("previous").agg(F.min("text").alias("text"))
    every = dealt.select("block", F.lit(False).alias("head"), "doc_id", "h", "text").unionByName(head.select(F.col("previous").alias("block"), F.lit(True).alias("head"), F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("h"), "text"))

    def work(table: pa.Table) -> pa.Table:
        tk.lean()
        found = list(zip(*(table.column(c).to_pylist() for c in ("head", "doc_id", "h", "text"))))
        own = sorted((r[1:] for r in found if not r[0]), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        texts = [t for *_, t in own] + [t for head, *_, t in found if head]
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw_changed = [t.encode("utf-8", "surrogatepass") for t in changed]
        values, at = chunks(raw + raw_changed)
        get = lambda i: values[at[i] : at[i + 1]]
        n, name = len(own), lambda x: x.astype(">u8").tobytes().hex()
        return pa.table({
            "doc_id": pa.array([r[0] for r in own], pa.int64()),
            "n_chars": pa.array([len(r[2]) for r in own], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in raw_changed], pa.string()),
            "fingerprint": pa.array([name(get(i)) for i in range(n)], pa.string()),
            "edited_fingerprint": pa.array([name(get(n + 1 + i)) for i in range(n)], pa.string()),
            "near_edited": pa.array([containment(get(i), get(n + 1 + i)) for i in range(n)], pa.float64()),
            "near_next": pa.array([containment(get(i), get(i + 1)) for i in range(n)], pa.float64()),
        })

    return every.groupBy("block").applyInArrow(work, RESULT)
