"""Session helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space of the word and line contracts, `[\x20\x09-\x0D]`.
BLANKS = "\t\n\x0b\x0c\r "


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Where it is unset, a local master may do with one of this machine's own; on a cluster executors
    would not see it, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quoin-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a cut in the lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def without(docs: DataFrame, *names: str) -> list[str]:
    """The columns of docs but for those named, in whatever case, as Spark does not tell cases apart."""
    gone = {n.lower() for n in names}
    return [c for c in docs.columns if c.lower() not in gone]


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """A name like each of those given that no column of docs has, in whatever case."""
    pad = "_" * (1 + max(map(len, docs.columns), default=0))
    return [f"_{n}{pad}" for n in names]


def digest(text: Column) -> Column:
    """16 bytes that name a text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one pass that reads only the text column and returns one number."""
    return int(docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0)


def blocks_for(spark: SparkSession, total_bytes: int, block_bytes: int) -> int:
    """How many blocks of about block_bytes hold total_bytes; no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // block_bytes), 1)
