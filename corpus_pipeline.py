"""A corpus from raw documents to pieces: five stages, each written as Parquet and read again by the next.

1. quality classifier: documents predicted to be of label 0 go.
2. line dedup: lines in ten documents or more go; a document without a line left stays, empty.
3. n-gram Jaccard join: of each group of near copies the document of least id stays.
4. mixing sources: documents are repeated or left out until each source meets its target; a document
   is taken as often as its share of words says, half up, so texts stay whole.
5. SentencePiece: every row with its sampled pieces.

All but the last return the columns of documents, whatever others there are; n_chars follows the text.
Null and empty texts are one empty line: they are scored, have no lines to lose, are in no group, and
are not taken by the mix, as they have no words. Texts of any length are read whole. Null ids, sources
and languages are values of their own; the row kept of a group has a null id only if all its rows do.
Repeated rows are documents of their own until stage 3, which keeps one. Ties in the mix are settled by
a hash of id and text. An empty table, or one of which nothing is kept, gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoin.llm.line_dedup import line_dedup
from quoin.llm.ngram_join import ngram_join
from quoin.llm.quality_classifier import score_quality
from quoin.llm.sentencepiece_sampling import encode
from quoin.llm.shared import BLANKS, digest, scratch_path
from quoin.llm.source_mix import materialise, mix_sources

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted label is 1."""
    return score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents share."""
    kept = line_dedup(docs, min_docs=10, min_chars=1).withColumn("text", F.col("kept_text"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: of the least id, null last, then of the least digest of the text; rows without a word all stay.

    Rows are known by id and digest, as ids may be null or shared. The join deals them by that name,
    and repeated rows of one name are then found where they lie.
    """
    name = lambda doc_id, md5: F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.hex(md5))
    groups = ngram_join(docs, size=5, percent=80, with_keys=True).where("n_shingles > 0").groupBy("component")
    first = groups.agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_md5").alias("md5"))).alias("f")).select(name("f.id", F.col("f.md5")).alias("_kept"))
    worded = F.coalesce(F.col("text").rlike(f"[^{BLANKS}]"), F.lit(False))
    named = docs.select(*COLUMNS).withColumn("_name", name("doc_id", digest(F.col("text"))))
    kept = named.where(worded).join(first, F.col("_name") == F.col("_kept"), "left_semi").dropDuplicates(["_name"])
    return kept.unionByName(named.where(~worded)).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return materialise(mix_sources(docs, weights=(5, 2, 1), share=1.5, epochs=2)).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's sampled piece ids, with their digest and whether they decode to the text."""
    return encode(docs, with_ids=True)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("source mixing", mixed), ("SentencePiece", pieces)]

#: The classifier and the sampled pieces are not SQL; tests compare columns, row counts and lossless only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to the documents of sf_dir, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
