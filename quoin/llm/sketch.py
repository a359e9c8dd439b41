"""A count-min sketch of the whole corpus that is never gathered in one place.

Texts are dealt into blocks. Every block sends, for each slice of the sketch, the sorted cells its
hashes fall on (gap-coded, about ten bits a hash) to the task that owns that slice; the owner adds up
the partial sketches of all blocks and sends each block the totals of just its own cells. So no task
holds more than one slice (2**SLICE_BITS counters) or one block, nothing is broadcast or collected,
and the sketch grows with the corpus at a constant load, so its rate of false repeats stays the same
at any size. A total never falls below the true count.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .textkernel import U

SLICE_BITS = 22
#: Sketch rows, and cells in each row for every hash expected.
DEPTH = 2
CELLS_PER_HASH = 4
CAP = 255

TEXTS = "block int, k binary, n int, text string"
MESSAGE = "block int, row int, slice int, payload binary"
_MESSAGE = pa.schema([("block", pa.int32()), ("row", pa.int32()), ("slice", pa.int32()), ("payload", pa.binary())])


def slices_for(hashes: int) -> int:
    """Slices of a sketch row that is to take so many hashes."""
    return max(1, -(-CELLS_PER_HASH * hashes // (1 << SLICE_BITS)))


def distinct_texts(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, k, n, text) for every text of docs, copies folded within each input partition.

    k is the MD5 of the text; the block follows from k, so copies of a text from all partitions
    meet in one block (see `unfold`). A group of copies sends at most two rows from each input
    partition. Rows with null text are copies seen again: n counts them. A null text is read as
    empty.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk.lean()
        seen: dict[bytes, int] = {}
        block = lambda k: int.from_bytes(k[:4], "big") * blocks >> 32
        schema = pa.schema([("block", pa.int32()), ("k", pa.binary()), ("n", pa.int32()), ("text", pa.string())])
        for batch in batches:
            data, offsets = tk.buffer(batch.column(0))
            view, keys, rows = memoryview(data), [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                k = hashlib.md5(view[a:b]).digest()
                if k in seen:
                    seen[k] += 1
                else:
                    seen[k] = 0
                    keys.append(k)
                    rows.append(i)
            if keys:
                text = batch.column(0).take(pa.array(rows)).cast(pa.string()).fill_null("")
                yield pa.record_batch([pa.array([block(k) for k in keys], pa.int32()), pa.array(keys, pa.binary()), pa.array([1] * len(keys), pa.int32()), text], schema=schema)
        again = [(k, n) for k, n in seen.items() if n]
        if again:
            yield pa.record_batch([pa.array([block(k) for k, _ in again], pa.int32()), pa.array([k for k, _ in again], pa.binary()), pa.array([n for _, n in again], pa.int32()), pa.nulls(len(again), pa.string())], schema=schema)

    return docs.select(F.col("text").cast("string")).mapInArrow(fold, TEXTS)


def unfold(table: pa.Table) -> tuple[list[bytes], np.ndarray, pa.Array]:
    """Distinct texts of a block: their keys, the copies of each, and the texts, in the order of the keys."""
    tk.lean()
    keys, counts = table.column("k").to_pylist(), table.column("n").to_pylist()
    valid = table.column("text").is_valid().to_pylist()
    total: dict[bytes, int] = {}
    place: dict[bytes, int] = {}
    for i, k in enumerate(keys):
        total[k] = total.get(k, 0) + counts[i]
        if valid[i]:
            place.setdefault(k, i)
    order = sorted(place)
    text = table.column("text").take(pa.array([place[k] for k in order], pa.int64())).cast(pa.large_string())
    return order, np.array([total[k] for k in order], dtype=np.int64), text


def pack(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct 32-bit cells as gaps, the low bytes plain and the rest deflated, with their counts."""
    gaps = np.diff(cells.astype(np.uint32), prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4)
    rest = zlib.compress(gaps[:, 1:].T.tobytes() + counts.astype(np.uint8).tobytes(), 1)
    return struct.pack("<I", len(cells)) + gaps[:, 0].tobytes() + rest


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = struct.unpack_from("<I", payload)[0]
    rest = np.frombuffer(zlib.decompress(payload[4 + n :]), dtype=np.uint8)
    gaps = np.empty((n, 4), dtype=np.uint8)
    gaps[:, 0] = np.frombuffer(payload, dtype=np.uint8, count=n, offset=4)
    gaps[:, 1:] = rest[: 3 * n].reshape(3, n).T
    return np.cumsum(gaps.view("<u4").ravel(), dtype=np.uint32), rest[3 * n :]


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MESSAGE)], schema=_MESSAGE)


def cells(hashes: np.ndarray, row: int, slices: int) -> np.ndarray:
    """The cell of each hash in a sketch row: its slice, then SLICE_BITS bits within the slice."""
    x = tk.mix(hashes, 101 + row)
    return (((x >> U(32)) * U(slices)) >> U(32)) << U(SLICE_BITS) | (x & U((1 << SLICE_BITS) - 1))


def ask(block: int, hashes: np.ndarray, slices: int) -> list[tuple[int, int, int, bytes]]:
    """A block's partial sketch, cut into one message for each slice that it touches."""
    out = []
    for row in range(DEPTH):
        at, counts = tk.tally(cells(hashes, row, slices))
        owner = (at >> U(SLICE_BITS)).astype(np.int64)
        cut = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(at)])) if len(at) else [0]
        for a, b in zip(cut[:-1], cut[1:]):
            out.append((block, row, int(owner[a]), pack((at[a:b] & U((1 << SLICE_BITS) - 1)).astype(np.uint32), np.minimum(counts[a:b], CAP))))
    return out


def merge(table: pa.Table) -> pa.Table:
    """Adds up the partial sketches of one slice; each block gets the totals of its own cells back."""
    tk.lean()
    total = np.zeros(1 << SLICE_BITS, dtype=np.uint32)
    blocks, row, owner = table.column("block").to_pylist(), table.column("row")[0].as_py(), table.column("slice")[0].as_py()
    asked = []
    for payload in table.column("payload"):
        at, counts = unpack(payload.as_py())
        total[at] += counts  # cells are distinct within a message
        asked.append(at)
    np.minimum(total, CAP, out=total)
    return messages([(b, row, owner, zlib.compress(total[at].astype(np.uint8).tobytes(), 1)) for b, at in zip(blocks, asked)])


def estimates(hashes: np.ndarray, slices: int, replies: list[tuple[int, int, bytes]]) -> np.ndarray:
    """For each hash an upper bound of its count in the corpus, capped at CAP; 0 stands for a bound of 1."""
    out, left = np.zeros(len(hashes), dtype=np.uint8), np.arange(len(hashes))
    for row in range(DEPTH):
        mine = sorted((s, p) for r, s, p in replies if r == row)
        totals = np.frombuffer(b"".join(zlib.decompress(p) for _, p in mine), dtype=np.uint8)
        every = cells(hashes, row, slices)
        at, _ = tk.tally(every)
        more = totals > 1
        found = tk.lookup(at[more], totals[more], every[left])
        found = found if not row else np.minimum(found, out[left])
        out[left] = found
        left = left[found > 0]
    return out
