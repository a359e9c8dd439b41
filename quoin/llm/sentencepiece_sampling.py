"""SentencePiece encoding with sampled segmentations, and lossless decoding."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lattice
from . import textkernel as tk

#: Bytes of text that are segmented at once; a longer text is by itself.
CHUNK = 1 << 19


def row_keys(docs: DataFrame, seed: int):
    """A 64-bit key for each row: of its doc_id, or of its text where the id is null."""
    return F.xxhash64(F.lit(seed), F.when(F.col("doc_id").isNotNull(), F.col("doc_id").cast("string")).otherwise(F.concat(F.lit("#"), F.coalesce("text", F.lit("")))))


def encode(docs: DataFrame, seed: int = 0, alpha: float = 1.0, model: str = "piece_bpe_32k.model", with_ids: bool = True) -> DataFrame:
    """(doc_id, n_pieces, ids, ids_sha256, lossless) for each row of docs, in one pass without a shuffle.

    Each text's segmentation is drawn from the lattice of the model's pieces by forward filtering
    and backward sampling. The draw depends on seed, doc_id and text alone, not on partitions or
    batches, so reruns agree. ids_sha256 is of the ids as little-endian 32-bit integers; lossless
    says that decoding the ids gave the text back. ids is null unless with_ids.

    Null and empty texts have no pieces and decode to the empty text. Texts of any length are cut
    whole, about CHUNK bytes at a time, and a word of any length takes a time that grows with it.
    Rows without an id are keyed by their text. Repeated rows get the same segmentation. An empty
    table gives an empty one; other columns, of whatever name, are ignored. The model file is read on
    the driver; tasks are sent its pieces as arrays.
    """
    p = lattice.pieces(model, alpha)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk.lean()
        for part in (part for batch in batches for part in tk.parts(batch, 1, CHUNK)):
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids, offsets = lattice.sample(texts, part.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), p)
            back = lattice.decode(ids, offsets, p)
            raw, edge = ids.astype("<i4").tobytes(), (offsets * 4).tolist()
            yield pa.record_batch(
                [part.column(0), pa.array(np.diff(offsets), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())) if with_ids else pa.nulls(len(texts), pa.list_(pa.int32())),
                 pa.array([hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(edge[:-1], edge[1:])], pa.string()), pa.array([x == t.encode("utf-8", "surrogatepass") for x, t in zip(back, texts)], pa.bool_())],
                names=["doc_id", "n_pieces", "ids", "ids_sha256", "lossless"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), row_keys(docs, seed).alias("key")).mapInArrow(cut, "doc_id long, n_pieces long, ids array<int>, ids_sha256 string, lossless boolean")


def decode(encoded: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null and empty ids give the empty text."""
    p = lattice.pieces(model, 1.0)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(x or [], dtype=np.int32) for x in batch.column(1).to_pylist()]
            offsets = np.cumsum([0] + [len(x) for x in rows])
            texts = lattice.decode(np.concatenate(rows) if rows else np.zeros(0, np.int32), offsets, p)
            yield pa.record_batch([batch.column(0), pa.array([x.decode("utf-8", "replace") for x in texts], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(join, "doc_id long, text string")
