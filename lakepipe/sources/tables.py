"""Table sinks and table operations over Parquet folders.

Tables are folders of Parquet files (optionally registered in the session
catalog).  A v2 table format can replace these functions where present; the
callers only depend on the function signatures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.session import scratch_path


def _clustered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Cluster rows by the partition columns before a partitioned write.

    REBALANCE (not a plain hash repartition): AQE splits a partition value
    holding a large share of the rows into advisory-size tasks and coalesces
    small ones, so files are neither tiny nor written by one overloaded task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def create_or_replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A5: full replace of a table folder."""
    w = _clustered(df, partition_by).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append result rows (they come from a distributed aggregate)."""
    w = _clustered(df, partition_by).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def file_marks(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of a file, or of the files of a table folder: they tell whether it has changed."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing will read again."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from the staged files, not from
    the sources) and allows overwriting the table the rows were read from.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in staged:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete_folder(df.sparkSession, folder)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str,
                 partition_by: list[str] | None = None) -> None:
    """CREATE DATABASE / TABLE IF NOT EXISTS ... USING parquet."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{path}'")


def insert_values(spark: SparkSession, name: str, rows: list[tuple]) -> None:
    """INSERT INTO ... VALUES (for smoke tables)."""
    def lit(v):
        return "NULL" if v is None else (str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'")
    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    spark.sql(f"INSERT INTO {name} VALUES {values}")


def as_of(bronze: DataFrame, loaded_before=None, max_version: int | None = None) -> DataFrame:
    """The rows as of a time (filters push to the scan).

    A table that keeps replaced rows (``replaced_at``) gives those that were
    current then, also if a later delivery replaced them.
    """
    out = bronze
    if loaded_before is not None:
        time = F.lit(loaded_before).cast("timestamp_ntz")
        out = out.where(F.col("loaded_at") <= time)
        if "replaced_at" in out.columns:
            out = out.where(F.col("replaced_at").isNull() | (F.col("replaced_at") > time))
    if "replaced_at" in out.columns:
        out = out.drop("replaced_at") if loaded_before is not None else out.where(F.col("replaced_at").isNull()).drop("replaced_at")
    if max_version is not None:
        out = out.where(F.col("submission_version") <= max_version)
    return out


def oldest(df: DataFrame, order_col: str, n: int = 1) -> DataFrame:
    """ORDER BY ... LIMIT n (planned as TakeOrderedAndProject, a top-k)."""
    return df.orderBy(F.col(order_col).asc()).limit(n)


def write_reports(reports: DataFrame, path: str) -> None:
    """A10: validation reports as JSON lines (one object per submission).

    Not partitioned by submission: that would make one folder per 7-row file.
    """
    reports.write.mode("append").json(path)
