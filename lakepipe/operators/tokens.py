"""Keyed tokens for identifiers (L9): HMAC-SHA-256, key versions, token table, rotation.

A token is ``<key version>.<hmac of the id>``.  Without the key it cannot be
found by trying ids, and the version tells which key made it.  The keys come
from the session (``spark.lakepipe.token.keys``, which Spark's default
redaction hides); expressions take them from a one-row relation by a scalar
subquery, so no plan text and no event log shows them.

NULL ids have NULL tokens; an empty id has a token like any other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``<version>:<hex>`` pairs, comma-separated; the highest version is the current one.
KEYS_CONF = "spark.lakepipe.token.keys"
#: Block size of SHA-256 and the two pad bytes of HMAC (fixed values of the standard).
BLOCK, INNER, OUTER = 64, 0x36, 0x5C


def session_keys(spark: SparkSession) -> dict[int, bytes]:
    """The keys that the session was given; without any an error, never a default."""
    text = spark.conf.get(KEYS_CONF, None)
    if not text:
        raise ValueError(f"{KEYS_CONF} is not set: tokens need a key")
    pairs = [p.split(":") for p in text.split(",")]
    return {int(version): bytes.fromhex(key.strip()) for version, key in pairs}


def pads(key: bytes) -> tuple[bytes, bytes]:
    """What the key adds to the inner and to the outer hash."""
    block = (hashlib.sha256(key).digest() if len(key) > BLOCK else key).ljust(BLOCK, b"\0")
    return bytes(b ^ INNER for b in block), bytes(b ^ OUTER for b in block)


class Tokens:
    """The tokens under a set of keys."""

    def __init__(self, spark: SparkSession, keys: dict[int, bytes] | None = None):
        self.keys = session_keys(spark) if keys is None else keys
        if not self.keys or not all(self.keys.values()):
            raise ValueError("tokens need a key for every version")
        self.current = max(self.keys)
        self._pads = {v: spark.createDataFrame([pads(k)], "inner binary, outer binary").coalesce(1)
                      for v, k in self.keys.items()}

    def of(self, column: str | Column, version: int | None = None) -> Column:
        """The token of an id, under the current key or that of an earlier version."""
        version = self.current if version is None else version
        pad, text = self._pads[version], (F.col(column) if isinstance(column, str) else column).cast("string")
        inner = F.sha2(F.concat(pad.select("inner").scalar(), F.encode(text, "UTF-8")), 256)
        return F.concat(F.lit(f"{version}."), F.sha2(F.concat(pad.select("outer").scalar(), F.unhex(inner)), 256))

    def replace(self, df: DataFrame, columns: list[str], derived: dict[str, str] | None = None) -> DataFrame:
        """Replace ids by tokens, also where another column starts with one.

        ``derived``: column -> the id column that its values start with (such as
        submission_id -> institution_id); that part becomes the token too, and a
        value that does not start with its id becomes a token as a whole.
        """
        tokens = {c: self.of(c) for c in columns}
        rest = {d: F.when(F.startswith(F.col(d), F.col(c)), F.concat(tokens[c], F.substr(F.col(d), F.length(c) + 1)))
                .otherwise(self.of(d)) for d, c in (derived or {}).items()}
        return df.withColumns(tokens | rest)

    def table(self, ids: DataFrame, column: str, version: int | None = None) -> DataFrame:
        """The token table, for those who may turn tokens back: key_version, token, id; one row an id."""
        version = self.current if version is None else version
        known = ids.select(F.col(column).cast("string").alias("id")).where("id IS NOT NULL").distinct()
        return known.select(F.lit(version).alias("key_version"), self.of("id", version).alias("token"), "id")

    def rotation(self, table: DataFrame) -> DataFrame:
        """Old and new token of every id of a token table of earlier keys: old_token, new_token."""
        return table.where(F.col("key_version") != self.current).select(
            F.col("token").alias("old_token"), self.of("id").alias("new_token"))


def rotate(df: DataFrame, column: str, rotation: DataFrame) -> DataFrame:
    """Replace a column's old tokens by the new ones, without the ids; other values stay as they are."""
    known = rotation.select(F.col("old_token").alias("__old"), F.col("new_token").alias("__new"))
    return (df.join(known, F.col(column) == F.col("__old"), "left")
            .withColumn(column, F.coalesce("__new", column)).drop("__old", "__new"))


def reveal(df: DataFrame, column: str, table: DataFrame, name: str = "id") -> DataFrame:
    """Add the ids of a column's tokens from the token table; NULL for what is no token of it."""
    known = table.select(F.col("token").alias("__token"), F.col("id").alias(name))
    return df.join(known, F.col(column) == F.col("__token"), "left").drop("__token")
