"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import BLANKS, fresh, without

#: Rows of one prefix-sum bucket, about.
BUCKET_ROWS = 4_000
RESULTS = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, epochs: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Sources by code point, null last, take the weights in turn and share `share` of all sizes. A
    target stops at epochs * source_size; the excess goes to the others by weight until none is
    above. As the share of a unit of weight only rises, sources stop in the order of source_size /
    weight: one pass over that order finds who stops. There is one row for each source, so these
    windows hold the number of sources, not of documents.
    """
    number = W.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    w = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(number) - 1, F.lit(len(weights))) + 1).cast("int")))
    w = w.withColumn("most", F.col("source_size") * F.lit(float(epochs)))
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_need = W.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    w = w.withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
    w = w.withColumn("left", F.col("budget") - F.coalesce(F.sum("most").over(by_need), F.lit(0e0)))
    w = w.withColumn("weights_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_need), F.lit(0e0)))
    w = w.withColumn("rate", F.col("left") / F.col("weights_left"))
    w = w.withColumn("stops", F.col("rate") * F.col("weight") >= F.col("most"))
    free = F.when(~F.col("stops"), F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("rate").alias("rate")))
    level = F.min(free).over(whole)["rate"]
    return w.withColumn("target", F.when(F.col("stops"), F.col("most")).otherwise(F.col("weight") * level)).select("source", "source_size", "target")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs with size, source_size, target and taken: how many words the mix takes of each document.

    Each source's documents stand in the order of a hash-random key, the MD5 of id and text. Equal
    ranges of the key are buckets of about bucket_rows rows; bucket totals are summed up first, then
    rows within their bucket, so no task sorts a whole source. With target = whole epochs + rest,
    every document is taken once for each epoch, and once more as far as the prefix sum of sizes
    stays within the rest; the document on the cut is taken in part. So a source's words come
    to floor(target), and none exceeds `epochs` times its size.

    Rows with null or empty text have size 0 and are not taken; a text of any length is counted
    whole. Null sources are one source, the last. Rows equal in id, text and source are equal in
    order too; which copy lies on the cut doesn't change the result as a set of rows. An empty table
    gives an empty one. All columns of docs are kept; a column that is named like a result, in
    whatever case, is replaced.
    """
    own = without(docs, *RESULTS)
    key, bucket, before, sum_before, of_source, of_bucket = fresh(docs, "key", "bucket", "before", "sum_before", "source", "of_bucket")
    size, source_size, target, source = fresh(docs, "size", "source_size", "target", "of")  # no column of docs is named so
    sized = docs.select(*own, F.col("source").alias(source), word_count(F.col("text")).alias(size), F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary")).alias(key))
    rows = docs.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    buckets = max(1, -(-int(rows) // bucket_rows))
    sized = sized.withColumn(bucket, F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(buckets), 32))
    sums = sized.groupBy(F.col(source).alias("source"), F.col(bucket).alias("bucket")).agg(F.sum(size).alias("size"))
    goal = targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs)
    goal = goal.select(F.col("source").alias(of_source), F.col("source_size").alias(source_size), F.col("target").alias(target))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("source", F.col("bucket").alias(of_bucket), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias(before))
    side = offsets.join(goal, F.col("source").eqNullSafe(F.col(of_source))).drop("source")
    inner = W.partitionBy(source, bucket).orderBy(key, size).rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn(sum_before, F.coalesce(F.sum(size).over(inner), F.lit(0)))
    placed = placed.join(side, F.col(source).eqNullSafe(F.col(of_source)) & (F.col(bucket) == F.col(of_bucket)))
    whole = F.when(F.col(source_size) > 0, F.floor(F.floor(target) / F.col(source_size))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(target).cast("long") - whole * F.col(source_size)
    part = F.greatest(F.lit(0), F.least(F.col(size), rest - F.col(before) - F.col(sum_before)))
    taken = (whole * F.col(size) + part).cast("long")
    return placed.select(*own, F.col(size).alias("size"), F.col(source_size).alias("source_size"), F.col(target).alias("target"), taken.alias("taken"))


def materialise(mixed: DataFrame, epochs: int = 2) -> DataFrame:
    """The rows of a mix, each as often as it is taken: taken / size, half up, so whole texts only."""
    copies, copy = fresh(mixed, "copies", "copy")
    n = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + F.lit(0.5e0))).otherwise(F.lit(0)).cast("int")
    twice = mixed.where(n > 0).withColumn(copies, n)
    return twice.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*without(mixed, *RESULTS))
