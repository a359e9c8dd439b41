"""Line dedup with levelled sorted runs of line hashes; DataFrame functions only."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import BLANKS, fresh, scratch_path, settle, text_bytes, without

#: Bytes of text in a batch, about, and most batches of one call; more text makes larger batches.
BATCH_BYTES, MOST_BATCHES = 256 << 20, 16
#: Most repeated line hashes that are broadcast, 16 bytes each; more are joined by a shuffle.
MOST_BROADCAST = 200_000
RUN = "h1 long, h2 long, n long"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_keys(text: Column) -> Column:
    """The key of each line: the line without blanks at its ends, A-Z in lower case."""
    bare = F.transform(lines(text), lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.transform(bare, lambda x: F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(F.translate(x, _UPPER, _LOWER)))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Within, Spark takes a bucket of a single file as sorted, as it was written, and doesn't sort it again."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)


@dataclass
class LineRuns:
    """Sorted runs of (h1, h2, n): line hashes and the documents seen with them, in levels.

    add() merge-anti-joins a batch with the runs and adds what is left as a run of level 0; when a
    level has two runs they are merged into one of the next level, so a line hash is rewritten once
    for each level, and there are no more runs than levels. A run is a table in the shared folder,
    bucketed and sorted by hash with one file for each bucket: joins and merges of runs neither
    shuffle nor sort. drop() takes the tables out of the session's catalog.
    """

    spark: SparkSession
    min_docs: int
    buckets: int
    levels: list[str | None] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)

    def write(self, df: DataFrame, *parts: str) -> str:
        """df as a table whose rows are in buckets, and folders of `parts`; returns its name."""
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables.append(name)
        out = df.write.format("parquet").option("path", scratch_path(self.spark, name)).bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        with _sorted_scans(self.spark):
            (out.partitionBy(*parts) if parts else out).saveAsTable(name)
        return name

    def _merged(self, a: str, b: str) -> DataFrame:
        other = self.spark.table(b).withColumnRenamed("n", "m")
        both = self.spark.table(a).join(other.hint("merge"), ["h1", "h2"], "full_outer")
        return both.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

    def _put(self, run: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append(None)
        if self.levels[level] is None:
            self.levels[level] = run
        else:
            old, self.levels[level] = self.levels[level], None
            self._put(self.write(self._merged(old, run)), level + 1)

    def add(self, batch: DataFrame) -> None:
        """Adds the (h1, h2, n) of a batch, but for hashes that a run has in min_docs documents already: they are decided."""
        for run in filter(None, self.levels):
            decided = self.spark.table(run).where(F.col("n") >= self.min_docs).select("h1", "h2")
            batch = batch.join(decided.hint("merge"), ["h1", "h2"], "left_anti")
        self._put(self.write(batch.select("h1", "h2", "n")), 0)

    def repeated(self) -> DataFrame:
        """(h1, h2) of the hashes in at least min_docs documents, by a merge of the runs, the smallest first."""
        left = [run for run in self.levels if run]
        if not left:
            return self.spark.createDataFrame([], RUN).select("h1", "h2")
        while len(left) > 1:
            left = [self.write(self._merged(left[0], left[1])), *left[2:]]
        return settle(self.spark.table(left[0]).where(F.col("n") >= self.min_docs).select("h1", "h2"), "repeated-lines")

    def drop(self) -> None:
        for name in self.tables:
            self.spark.sql(f"drop table if exists {name}")
        self.tables, self.levels = [], []


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int | None = None, buckets: int | None = None) -> DataFrame:
    """docs with kept_text, n_lines and n_dropped: lines whose key is in at least min_docs documents go.

    A line's key is the line without blanks at its ends, in ASCII lower case; keys shorter than
    min_chars code points stay. Every row of docs is a document, so repeated rows count as often
    as they occur. Documents come in `batches` (by a hash of id and text; of about BATCH_BYTES), each
    added to `LineRuns`; the result doesn't depend on how many. Null and empty texts are one empty
    line; a text of any length is split whole. An empty table gives an empty one. All columns of docs
    are kept; a column that is named like a result, in whatever case, is replaced.

    Lines are counted by 128 bits of hash after map-side aggregation, so a line that fills a third
    of the corpus is one row for each input partition; that is the only shuffle of lines. The hashes
    that repeat are then looked up in each document's lines: by a broadcast if there are no more than
    MOST_BROADCAST, else by a join that Spark may split at hot lines. The numbers of lines to drop go
    back to their document; texts are shuffled once.
    """
    own = without(docs, "kept_text", "n_lines", "n_dropped")
    docs = docs.select(own)
    spark = docs.sparkSession
    name, gone, of_id, of_name = fresh(docs, "name", "gone", "id", "of")
    named = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    hashed = lambda keys: F.transform(keys, lambda x: F.when(F.char_length(x) >= min_chars, _hashes(x)))
    keys = line_keys(F.col("text"))

    n = batches or min(MOST_BATCHES, max(2, -(-text_bytes(docs) // BATCH_BYTES)))
    seen = named.select(F.pmod(F.col(name), F.lit(n)).cast("int").alias("batch"), F.explode(hashed(F.array_distinct(keys))).alias("h")).where("h is not null")
    counts = seen.groupBy("h.h1", "h.h2").agg(*[F.count(F.when(F.col("batch") == b, 1)).alias(f"n{b}") for b in range(n)])
    rows = counts.select("h1", "h2", F.explode(F.array(*[F.struct(F.lit(b).alias("batch"), F.col(f"n{b}").alias("n")) for b in range(n)])).alias("c")).select("h1", "h2", "c.n", "c.batch").where("n > 0")
    runs = LineRuns(spark, min_docs, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        written = runs.write(rows, "batch")
        for b in range(n):
            runs.add(spark.table(written).where(F.col("batch") == b).select("h1", "h2", "n"))
        repeated = runs.repeated()
    finally:
        runs.drop()
    if repeated.count() <= MOST_BROADCAST:
        repeated = F.broadcast(repeated)

    placed = named.select(F.col("doc_id").alias(of_id), F.col(name).alias(of_name), F.posexplode(hashed(keys)).alias("at", "h")).select(of_id, of_name, "at", "h.h1", "h.h2").where("h1 is not null")
    marks = placed.join(repeated, ["h1", "h2"], "left_semi").groupBy(of_id, of_name).agg(F.collect_set("at").alias(gone))
    marked = named.join(marks, F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(name) == F.col(of_name)), "left")
    every = lines(F.col("text"))
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(gone)), lambda i: F.get(every, i)), "\n")
    return marked.select(
        *own,
        F.when(F.col(gone).isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept_text"),
        F.size(every).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )
