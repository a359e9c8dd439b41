"""N-gram Jaccard join: groups of documents whose word shingles overlap, by prefix trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch, trie
from . import textkernel as tk
from .components import components
from .shared import blocks_for, digest, settle, text_bytes
from .textkernel import U

BLOCK_BYTES = 6 << 20
#: Shingles that one task holds as prefix trees, about; larger clusters are joined piece by piece.
PIECE_TOKENS = 1 << 18
SETS = "k binary, n_shingles long, tokens binary"


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles; a text of fewer words is one shingle."""
    w = tk.words(texts, lower=True)
    every = tk.windows(w.hashes, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= size:
            x = np.sort(every[a : b - size + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        else:
            out.append(tk.windows(w.hashes[a:b], b - a, 100 + b - a) if b > a else np.zeros(0, dtype=U))
    return out


def ngram_join(docs: DataFrame, size: int = 5, percent: int = 80, block_bytes: int = BLOCK_BYTES, piece_tokens: int = PIECE_TOKENS, with_links: bool = False, with_keys: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs, and n_links, its linked other rows, if with_links.

    with_keys adds text_md5, which names the row's text, and component, a number for each component
    that is never null, also where all its ids are.

    Two documents link when 100 * shared shingles >= percent * all their shingles; component_id is
    the least doc_id reachable by links. No component loses a link that it needs, and n_links counts every link:

    1. Copies of a text are folded. The corpus sketch bounds every shingle's document count from
       above; a set with fewer than percent % of its shingles seen elsewhere links with nothing.
    2. The other sets are ordered globally, rarest shingle first by that bound, then by hash. Linked
       sets share a shingle of their prefixes (the first size - ceil(percent % of size) + 1), so the
       components of "shares a prefix shingle" hold every link.
    3. In each such cluster the sets form prefix trees; each set is searched with shared partial
       overlaps and remaining-length bounds (`trie`). A cluster over piece_tokens shingles is cut into
       pieces (`_links`). Tasks return spanning links only, never all pairs; components of those links
       are the result. For n_links a task checks all candidates and returns one sum for each set;
       copies of a text count each.

    Null texts and texts without words have no shingles and link with nothing, not even each other.
    Texts of any length are cut into shingles whole; a set larger than a piece is a piece. Repeated
    rows link by their equal text. A null doc_id is never the least one. An empty table gives an empty
    one. Other columns, of whatever name, are ignored. Sets are compared by 64-bit shingle hashes, texts named by 64 bits of their MD5 in links.
    """
    if not 0 < percent <= 100 or size < 1:
        raise ValueError("percent must be in 1..100 and size at least 1")
    spark = docs.sparkSession
    total = text_bytes(docs)
    blocks, slices = blocks_for(spark, total, block_bytes), sketch.slices_for(total // 6)
    texts = sketch.distinct_texts(docs, blocks)
    prefix = lambda n: n - -(-percent * n // 100) + 1

    def first(table: pa.Table) -> pa.Table:
        _, _, text = sketch.unfold(table)
        sets = shingle_sets(text, size)
        return sketch.messages(sketch.ask(table.column("block")[0].as_py(), np.concatenate(sets) if sets else np.zeros(0, dtype=U), slices))

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, _, text = sketch.unfold(left)
        sets = shingle_sets(text, size)
        replies = list(zip(right.column("row").to_pylist(), right.column("slice").to_pylist(), right.column("payload").to_pylist()))
        bounds = sketch.estimates(np.concatenate(sets) if sets else np.zeros(0, dtype=U), slices, replies)
        cut = np.cumsum([0] + [len(x) for x in sets])
        shared = np.concatenate(([0], np.cumsum(bounds > 1)))[cut]
        tokens: list[bytes | None] = []
        for i, x in enumerate(sets):
            if len(x) and 100 * (shared[i + 1] - shared[i]) >= percent * len(x):
                bound = bounds[cut[i] : cut[i + 1]]
                x, bound = x[bound > 1], bound[bound > 1]
                tokens.append(x[np.argsort(bound, kind="stable")].tobytes())
            else:
                tokens.append(None)
        return pa.table({"k": pa.array(keys, pa.binary()), "n_shingles": pa.array([len(x) for x in sets], pa.int64()), "tokens": pa.array(tokens, pa.binary())})

    def prefixes(batches):
        schema = pa.schema([("token", pa.int64()), ("node", pa.int64())])
        for batch in batches:
            out, nodes = [], []
            for n, raw, node in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                x = np.frombuffer(raw.as_py(), dtype="<i8")
                x = x[: max(0, prefix(n) - (n - len(x)))]  # shingles seen nowhere else come first and match nothing
                out.append(x)
                nodes.append(np.full(len(x), node, dtype=np.int64))
            yield pa.record_batch([pa.array(np.concatenate(out)), pa.array(np.concatenate(nodes))], schema=schema)

    by_block = lambda df: df.groupBy("block")
    rough = by_block(texts).applyInArrow(first, sketch.MESSAGE).groupBy("row", "slice").applyInArrow(sketch.merge, sketch.MESSAGE)
    sets = settle(by_block(texts).cogroup(by_block(rough)).applyInArrow(second, SETS).withColumn("node", F.xxhash64("k")), "shingle-sets")
    near = sets.where("tokens is not null")
    shared = near.select("n_shingles", "tokens", "node").mapInArrow(prefixes, "token long, node long")
    hubs = shared.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").drop("last")
    clusters = components(shared.join(hubs, "token").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    placed = settle(near.select("node", "n_shingles", F.octet_length("tokens").cast("long").alias("bytes")).join(clusters, "node").withColumnRenamed("root", "cluster"), "clusters")
    keyed = docs.select("doc_id", digest(F.col("text")).alias("k"))
    ids = keyed.groupBy("k").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    given = near.join(ids, "k") if with_links else near.withColumn("copies", F.lit(1).cast("long"))
    links = _links(placed, given.select("node", "tokens", "copies"), percent, 8 * piece_tokens, with_links)
    roots = components(links.select("a", "b"))

    named = sets.select("k", "n_shingles", "node").join(ids, "k").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = named.join(least, "root")
    more = []
    if with_links:
        sums = links.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        result = result.join(sums, "node", "left").withColumn("n_links", F.when(F.col("n_shingles") == 0, 0).otherwise(F.col("copies") - 1 + F.coalesce("n", F.lit(0))).cast("long"))
        more = ["n_links"]
    if with_keys:
        result, more = result.withColumn("text_md5", F.col("k")).withColumnRenamed("root", "component"), [*more, "text_md5", "component"]
    result = result.select("k", "n_shingles", "component_id", *more)
    return keyed.join(result, "k").select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *more)


#: Rows of the tasks that look for links: sets by cluster, and on which sides of the join they stand.
_TASK = ("task", "cluster", "node", "n_shingles", "known", "is_left", "is_right")


def _links(placed: DataFrame, given: DataFrame, percent: int, most: int, with_links: bool) -> DataFrame:
    """Links (a, b, n) that connect the sets of each cluster; with_links, also (a, a, n): the n linked copies of a.

    Clusters of up to `most` bytes of members share tasks of about that many bytes. Larger ones are
    cut into pieces by hash:

    1. Each piece is joined with itself and with the cluster's pivots, about most / 4 bytes of its sets
       that all pieces have in common, so the bulk of a group of near copies becomes one component.
    2. What is left are links between components. A component of `most` bytes or more has pieces of its
       own, which need not be joined with each other; the others share pieces. Two pieces meet only if
       their sizes allow a link.

    So a large group costs as much as it has pieces, times the pieces of other components near it.
    with_links every piece meets every other, as there every link counts.
    """
    spark = placed.sparkSession
    weight = placed.groupBy("cluster").agg(F.sum("bytes").alias("all"))
    sized = settle(placed.join(weight, "cluster"), "clusters-sized")
    both = {"known": F.lit(None).cast("long"), "is_left": F.lit(True), "is_right": F.lit(True)}
    part = lambda size: F.greatest(F.ceil(size / F.lit(float(most))).cast("int"), F.lit(1))
    piece = lambda n: F.pmod(F.xxhash64(F.lit(1), "node"), n).cast("int")

    small = sized.where(F.col("all") <= most)
    total = small.agg(F.sum("bytes")).first()[0] or 0
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // most))
    tasks = small.withColumns({"task": F.struct(F.pmod(F.xxhash64("cluster"), F.lit(bins)).alias("at"), F.lit(0).alias("i"), F.lit(0).alias("j")), **both}).select(*_TASK)
    found = _joined(tasks, given, percent, with_links)
    large = sized.where(F.col("all") > most).withColumn("n", part(F.col("all"))).withColumn("i", piece(F.col("n")))
    if not large.head(1):
        return settle(found, "links")
    if with_links:
        other = large.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        low, high = F.least("i", "o"), F.greatest("i", "o")
        tasks = other.withColumns({"task": F.struct(F.col("cluster").alias("at"), low.alias("i"), high.alias("j")), "known": F.lit(None).cast("long"), "is_left": F.col("i") == low, "is_right": F.col("i") == high})
        return settle(found.unionByName(_joined(tasks.select(*_TASK), given, percent, True)), "links")

    pivot = F.pmod(F.xxhash64(F.lit(2), "node"), F.lit(1 << 20)) < F.lit(float(most << 18)) / F.col("all")
    at = F.explode(F.when(pivot, F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.array("i")))
    tasks = large.withColumn("to", at).withColumns({"task": F.struct(F.col("cluster").alias("at"), F.col("to").alias("i"), F.col("to").alias("j")), **both})
    links = settle(found.unionByName(_joined(tasks.select(*_TASK), given, percent, False)), "links")
    joined = large.drop("n", "i").join(components(links.select("a", "b")), "node", "left").withColumn("known", F.coalesce("root", "node")).drop("root")
    apart = joined.groupBy("cluster").agg(F.min("known").alias("first"), F.max("known").alias("last")).where("first <> last").select("cluster")
    joined = settle(joined.join(apart, "cluster", "left_semi"), "components-left")
    if not joined.head(1):
        return links
    parts = joined.groupBy("cluster", "known").agg(F.sum("bytes").alias("own")).withColumn("owner", F.when(F.col("own") >= most, F.col("known")))
    rest = parts.groupBy("cluster", "owner").agg(F.sum("own").alias("own")).withColumn("n", part(F.col("own")))
    owners = joined.join(parts.select("cluster", "known", "owner"), ["cluster", "known"])
    owners = owners.join(rest.select(F.col("cluster").alias("c"), F.col("owner").alias("o"), "n"), (F.col("cluster") == F.col("c")) & F.col("owner").eqNullSafe(F.col("o"))).drop("c", "o").withColumn("i", piece(F.col("n")))
    owners = settle(owners.select("cluster", "node", "n_shingles", "known", "owner", "i"), "pieces")
    pieces = owners.groupBy("cluster", "owner", "i").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    name = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("owner", "i", "low", "high")]
    a, b = rest.select("cluster", F.col("owner").alias("owner_a")), rest.select("cluster", F.col("owner").alias("owner_b"))
    pairs = a.join(b, "cluster").where("owner_a is null or owner_a < owner_b")  # null: the shared pieces, also with each other
    for side in "ab":
        mine = pieces.select(F.col("cluster").alias("c"), *name(side)).withColumnRenamed(f"owner_{side}", "o")
        pairs = pairs.join(mine, (F.col("cluster") == F.col("c")) & F.col(f"owner_{side}").eqNullSafe(F.col("o"))).drop("c", "o")
    alone = F.col("owner_a").isNull() & F.col("owner_b").isNull()
    pairs = pairs.where((~alone | (F.col("i_a") <= F.col("i_b"))) & (100 * F.col("high_a") >= percent * F.col("low_b")) & (100 * F.col("high_b") >= percent * F.col("low_a")))
    pairs = pairs.withColumn("same", alone & (F.col("i_a") == F.col("i_b"))).withColumn("task", F.struct(F.xxhash64("cluster", F.coalesce("owner_a", F.lit(0)), F.coalesce("owner_b", F.lit(0))).alias("at"), F.col("i_a").alias("i"), F.col("i_b").alias("j")))
    goes = pairs.select("task", "cluster", F.explode(F.when(F.col("same"), F.array(F.struct(F.col("owner_a").alias("o"), F.col("i_a").alias("p"), F.lit(True).alias("is_left"), F.lit(True).alias("is_right")))).otherwise(
        F.array(F.struct(F.col("owner_a").alias("o"), F.col("i_a").alias("p"), F.lit(True).alias("is_left"), F.lit(False).alias("is_right")), F.struct(F.col("owner_b").alias("o"), F.col("i_b").alias("p"), F.lit(False).alias("is_left"), F.lit(True).alias("is_right"))))).alias("s"))
    goes = goes.select("task", F.col("cluster").alias("c"), "s.*")
    tasks = owners.join(goes, (F.col("cluster") == F.col("c")) & F.col("owner").eqNullSafe(F.col("o")) & (F.col("i") == F.col("p"))).select(*_TASK)
    return links.unionByName(_joined(tasks, given, percent, False))


def _joined(tasks: DataFrame, given: DataFrame, percent: int, with_links: bool) -> DataFrame:
    """Links of the sets in each task: those of a cluster on the right with those on the left, by prefix trees."""

    def work(table: pa.Table) -> pa.Table:
        tk.lean()
        by_cluster: dict[int, list[tuple]] = {}
        for row in zip(*(table.column(c).to_pylist() for c in ("cluster", "node", "n_shingles", "known", "is_left", "is_right", "tokens", "copies"))):
            by_cluster.setdefault(row[0], []).append(row)
        a, b, n = [], [], []
        for rows in by_cluster.values():
            rows.sort(key=lambda r: (r[2], r[1]))
            entries = trie.ranked([np.frombuffer(r[6], dtype="<i8") for r in rows], [r[2] for r in rows])
            left, right = [i for i, r in enumerate(rows) if r[4]], [i for i, r in enumerate(rows) if r[5]]
            links, sums = trie.count(entries, [r[7] for r in rows], left, right, percent) if with_links else (trie.join(entries, left, right, percent, [r[3] for r in rows]), [])
            a += [rows[x][1] for x, _ in links] + [rows[x][1] for x, many in enumerate(sums) if many]
            b += [rows[y][1] for _, y in links] + [rows[x][1] for x, many in enumerate(sums) if many]
            n += [0] * len(links) + [many for many in sums if many]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    full = tasks.join(given, "node")
    return full.groupBy("task").applyInArrow(work, "a long, b long, n long")
