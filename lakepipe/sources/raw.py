"""Raw-zone scans (A1-A3): submission files and their manifests, one row per file.

Every pending file of the landing / raw folder is read in one distributed
scan; nothing is parsed on the driver.  Invalid UTF-8 becomes a rejected row
instead of a crash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.schemas import MANIFEST

MANIFEST_SUFFIX = ".manifest.json"


# Files above this size are not read as one row (a binary row is capped at 2 GB
# and would sit in one task): they take the splittable path.
LARGE_FILE_BYTES = 256 * 1024 * 1024


# Hadoop's names of object-store schemes, by those of the Arrow file systems that hash large files.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _binary(spark: SparkSession, root) -> DataFrame:
    """All files but manifests, whatever their names: what is no submission needs a verdict too (B1)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .where(~F.col("path").endswith(MANIFEST_SUFFIX)))


def _described(files: DataFrame) -> list:
    """``file_path`` is the path as Spark's metadata encodes it, the same for every reader."""
    return [F.col("path"), F.col("_metadata.file_path").alias("file_path"),
            F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("length").alias("bytes"),
            F.col("modificationTime").cast("timestamp_ntz").alias("modified_at")]


def list_files(spark: SparkSession, root) -> DataFrame:
    """Listing of a folder without its manifests; no file is opened."""
    files = _binary(spark, root)
    return files.select(*_described(files))


def scan_files(spark: SparkSession, root, max_bytes: int | None = None) -> DataFrame:
    """list_files plus sha256, utf8_ok, content (NULL when not UTF-8).

    With ``max_bytes`` only files up to that size are read (the length filter
    is pushed into the binary-file scan, so larger files' bytes are not read).
    """
    raw = _binary(spark, root)
    if max_bytes is not None:
        raw = raw.where(F.col("length") <= max_bytes)
    as_text = F.col("content").cast("string")
    return raw.select(
        *_described(raw), F.sha2(F.col("content"), 256).alias("sha256"), F.is_valid_utf8(as_text).alias("utf8_ok"),
        F.when(F.is_valid_utf8(as_text), as_text).alias("content"))


def _sha256_chunks(file_system, schemes):
    def run(batches):
        """SHA-256 of whole files read in 8 MB chunks, and whether they begin with a byte-order mark."""
        import hashlib

        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            sums, marks = [], []
            for path in pdf["file_path"]:
                scheme, _, rest = path.partition(":")
                found, p = fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{rest}")
                h, mark = hashlib.sha256(), None
                with (file_system or found).open_input_stream(p) as stream:
                    while chunk := stream.read(8 << 20):
                        mark = chunk[:3] == b"\xef\xbb\xbf" if mark is None else mark
                        h.update(chunk)
                sums.append(h.hexdigest())
                marks.append(bool(mark))
            yield pd.DataFrame({"file_path": pdf["file_path"], "sha256": sums, "bom": marks})
    return run


def scan_large_files(spark: SparkSession, root, min_bytes: int = LARGE_FILE_BYTES, file_system=None) -> DataFrame:
    """list_files of large files plus sha256 and bom, without loading them into rows.

    The checksum is one sequential read per file (inherent to SHA-256) in
    bounded memory; files hash in parallel across tasks.  ``file_system``: an
    Arrow file system to read with, where the address alone is not enough
    (credentials, endpoints).
    """
    meta = list_files(spark, root).where(F.col("bytes") > min_bytes)
    sha = meta.select("file_path").repartition("file_path").mapInPandas(
        _sha256_chunks(file_system, ARROW_SCHEMES), "file_path string, sha256 string, bom boolean")
    return meta.join(sha, "file_path")


def manifest_paths(spark: SparkSession, root: str, files: DataFrame) -> list[str]:
    """Paths of the manifests that lie beside the files (``path``); the folder is listed, no manifest is opened."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", f"*{MANIFEST_SUFFIX}").load(root).select("path"))
    beside = files.select(F.concat("path", F.lit(MANIFEST_SUFFIX)).alias("path"))
    return [r["path"] for r in listed.join(beside, "path", "left_semi").collect()]


def scan_manifests(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """data_path (the encoded path of the file the manifest describes), manifest struct, manifest_text."""
    m = (spark.read.option("wholetext", True).option("recursiveFileLookup", "true")
         .option("pathGlobFilter", f"*{MANIFEST_SUFFIX}").text(root)
         .withColumn("mpath", F.col("_metadata.file_path")))
    return m.select(
        F.expr(f"substring(mpath, 1, length(mpath) - {len(MANIFEST_SUFFIX)})").alias("data_path"),
        F.from_json("value", MANIFEST).alias("manifest"),
        F.col("value").alias("manifest_text"))


def files_with_manifests(spark: SparkSession, root: str, large_bytes: int | None = None, paths: list[str] | None = None,
                         file_system=None) -> DataFrame:
    """Files left-joined to their manifests (B2: missing manifest -> NULL).

    ``paths``: only these files of the folder.  With ``large_bytes`` files
    above it come without ``content`` (``large`` = true, ``utf8_ok`` NULL) and
    are validated by the splittable path.
    """
    where = root if paths is None else paths
    files = scan_files(spark, where, large_bytes).withColumns({"large": F.lit(False), "bom": F.lit(None).cast("boolean")})
    if large_bytes is not None:
        big = scan_large_files(spark, where, large_bytes, file_system).withColumns({
            "utf8_ok": F.lit(None).cast("boolean"), "content": F.lit(None).cast("string"), "large": F.lit(True)})
        files = files.unionByName(big)
    # with paths, only the manifests beside them are opened
    beside = None if paths is None else manifest_paths(spark, root, spark.createDataFrame([(p,) for p in paths], "path string"))
    mans = scan_manifests(spark, root if beside is None else beside) if beside or paths is None else \
        spark.createDataFrame([], T.StructType([T.StructField("data_path", T.StringType()), T.StructField("manifest", MANIFEST),
                                                T.StructField("manifest_text", T.StringType())]))
    return files.join(mans, files.file_path == mans.data_path, "left").drop("data_path")
