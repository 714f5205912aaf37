"""DataFrame helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.session import scratch_path


#: Rows with equal id and equal text get equal results, so this pair finds a row again.
KEY = ["doc_id", "text_hash"]
#: A staged side may be broadcast up to this many bytes, as counted before the join; beyond it both sides are shuffled.
BROADCAST_BYTES = 32 << 20


#: Spark's setting to remove the shuffle files of a job when the job has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    What follows reads the files, so a lost executor costs no earlier work,
    and the shuffle files behind the table are removed at once.
    """
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in staged:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_hash(text: Column) -> Column:
    """A 64-bit name of a text; null is empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def attach(docs: DataFrame, side: DataFrame, how: str = "left") -> DataFrame:
    """Join a staged ``side`` (one row a key) to the documents by KEY, null ids included.

    Both sides are shuffled by key at every size, so that what is measured on
    small tables holds for large ones.
    """
    s = side.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                    *[c for c in side.columns if c not in KEY])
    on = docs["doc_id"].eqNullSafe(s["_id"]) & (docs["text_hash"] == s["_hash"])
    return docs.join(s, on, how).drop("_id", "_hash")
