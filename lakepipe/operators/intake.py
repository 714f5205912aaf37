"""Submission intake (B1-B7): one decision row per arriving file, all files at once.

Verdict order: file-name contract -> manifest present -> checksum ->
duplicate content -> version conflict -> RECEIVED.

Duplicates and version conflicts are found with aggregates ("first file per
sha / per name") joined back, not with a window per key: a single content
hash copied a million times is pre-aggregated map-side, and the join back is
split by AQE's skew handling instead of sorting the hot key in one task.

Semantics (documented decisions):
* the first file (received_at, path) with a given sha among the files that
  pass B1-B3 is the candidate; later copies are DUPLICATE (nothing written);
* among candidates, the first per (institution, return, period, version) is
  RECEIVED, later ones VERSION_CONFLICT (decided before landing anything);
* a ``ledger`` of earlier submissions (sha256, institution_id, return_type,
  reporting_period, version) makes earlier runs count as "already received".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.columns import raw_key, submission_id

# Capture groups: institution, return type, period, version.
NAME_RE = r"^(FI[0-9]{3})_(LCR)_([0-9]{4}-[0-9]{2})_v([0-9]+)\.csv$"
NAME_KEY = ["institution_id", "return_type", "reporting_period", "version"]


def parse_names(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """B1 + B6: name contract and derived keys (NULL keys when the name is invalid)."""
    n = F.col(name_col)
    # a version beyond 32 bits is no version: that file is rejected, the others go on
    ok = n.rlike(NAME_RE) & F.regexp_extract(n, NAME_RE, 4).try_cast("int").isNotNull()
    g = lambda i: F.when(ok, F.regexp_extract(n, NAME_RE, i))
    out = (files.withColumn("name_ok", ok)
           .withColumn("institution_id", g(1))
           .withColumn("return_type", g(2))
           .withColumn("reporting_period", g(3))
           .withColumn("version", g(4).try_cast("int")))
    return (out.withColumn("submission_id", F.when(ok, submission_id(
                "institution_id", "return_type", "reporting_period", "version")))
               .withColumn("raw_key", F.when(ok, raw_key(
                "institution_id", "return_type", "reporting_period", "version", name_col))))


def checksums(files: DataFrame) -> DataFrame:
    """B2 + B3: manifest present, sha256 of the bytes equals the manifest's."""
    m = F.col("manifest")
    return (files.withColumn("manifest_ok", m.isNotNull())
                 .withColumn("manifest_sha256", m["sha256"])
                 .withColumn("checksum_ok", m.isNotNull() & (F.col("sha256") == m["sha256"])))


def _first_of(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Per key: the first file by (received_at, path) -- a partial aggregate, no window."""
    return (df.groupBy(*keys)
            .agg(F.min(F.struct("received_at", "path", "file_name")).alias(f"__first_{label}")))


def decide(files: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Verdict per file: RECEIVED, REJECTED, DUPLICATE or VERSION_CONFLICT.

    ``files`` needs: path, file_name, sha256, received_at, manifest (struct
    with sha256, may be NULL).  Two key joins attach "first file per sha" and
    "first candidate per name" to every file; no join back by path.
    """
    f = checksums(parse_names(files))
    valid = F.col("name_ok") & F.col("manifest_ok") & F.col("checksum_ok")
    me = F.struct("received_at", "path", "file_name")
    first_sha = _first_of(f.where(valid), ["sha256"], "sha")
    if ledger is not None:
        seen = ledger.select("sha256").distinct().withColumn("__seen_sha", F.lit(True))
        first_sha = first_sha.join(seen, "sha256", "full")
    else:
        first_sha = first_sha.withColumn("__seen_sha", F.lit(None).cast("boolean"))
    f = f.join(first_sha, "sha256", "left")
    is_first_sha = me == F.col("__first_sha")
    dup = valid & (~is_first_sha | F.coalesce(F.col("__seen_sha"), F.lit(False)))
    f = f.withColumn("__dup", dup).withColumn("__cand", valid & ~dup)
    first_name = _first_of(f.where("__cand"), NAME_KEY, "name")
    if ledger is not None:
        taken = ledger.select(*NAME_KEY).distinct().withColumn("__seen_name", F.lit(True))
        first_name = first_name.join(taken, NAME_KEY, "full")
    else:
        first_name = first_name.withColumn("__seen_name", F.lit(None).cast("boolean"))
    f = f.join(first_name, NAME_KEY, "left")
    conflict = F.col("__cand") & ((me != F.col("__first_name"))
                                  | F.coalesce(F.col("__seen_name"), F.lit(False)))
    verdict = (F.when(~valid, F.lit("REJECTED")).when(F.col("__dup"), F.lit("DUPLICATE"))
               .when(conflict, F.lit("VERSION_CONFLICT")).otherwise(F.lit("RECEIVED")))
    reason = (F.when(~F.col("name_ok"), F.lit("file name does not match the contract pattern"))
              .when(~F.col("manifest_ok"), F.lit("manifest missing"))
              .when(~F.col("checksum_ok"), F.lit("SHA-256 does not match manifest"))
              .when(F.col("__dup"), F.lit("identical file already received"))
              .when(conflict, F.lit("version already received")))
    # duplicate_of_file: the earlier copy in this batch (NULL when it is in the ledger)
    dup_of = F.when(F.col("__dup") & ~is_first_sha, F.col("__first_sha.file_name"))
    return (f.withColumn("verdict", verdict).withColumn("reason", reason)
             .withColumn("duplicate_of_file", dup_of)
             .drop("__first_sha", "__seen_sha", "__dup", "__cand", "__first_name", "__seen_name"))


def receipts(decided: DataFrame) -> DataFrame:
    """Receipt JSON of every RECEIVED file (B7); ``raw_uri`` names the file that arrived, as lineage in Bronze does."""
    r = decided.where(F.col("verdict") == "RECEIVED")
    return r.select("submission_id", F.to_json(F.struct(
        "submission_id", F.lit("RECEIVED").alias("status"),
        F.col("path").alias("raw_uri"),
        "sha256", F.col("received_at").cast("string").alias("received_at"))).alias("receipt"))
