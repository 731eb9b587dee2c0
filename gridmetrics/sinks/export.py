"""Results as key and JSON value, the form a key-value store takes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = ":"
DIGEST = "digest"


def to_key_json(df: DataFrame, keys: Sequence[str], prefix: str | None = None) -> DataFrame:
    """``key`` from the key columns (and a prefix), ``value`` as a JSON object of the others.

    Different key columns give different keys: a separator or backslash in a value is escaped by a
    backslash, and NULL is a backslash and N.
    """

    def escaped(value: Column) -> Column:
        return F.regexp_replace(value.cast("string"), r"([\\:])", r"\\$1")

    parts = [F.coalesce(escaped(F.col(key)), F.lit("\\N")) for key in keys]
    if prefix is not None:
        parts.insert(0, escaped(F.lit(prefix)))
    rest = [name for name in df.columns if name not in keys]
    return df.select(
        F.concat_ws(SEPARATOR, *parts).alias("key"),
        F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("value"),
    )


def key_json_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a key-value store has to do to get from one export to the next: key, ``change`` and ``value``.

    ``change`` is added, changed or dropped; the value is the new one, NULL for a dropped key. Keys with an
    equal value are left out. Values are compared by a digest, so ``before`` may be an earlier export or
    what ``key_digests`` kept of it. A NULL key is a key like any other, and so is a NULL value. A
    key that stands several times in one export counts once, with the value of the greatest digest.
    """
    old = before if DIGEST in before.columns else key_digests(before)
    old = old.groupBy("key").agg(F.max(DIGEST).alias("_old"))
    old = old.select(F.col("key").alias("_key"), "_old", F.lit(True).alias("_was"))
    new = after.select("key", F.struct(_digest().alias(DIGEST), F.col("value")).alias("_new"))
    new = new.groupBy("key").agg(F.max("_new").alias("_new")).withColumn("_is", F.lit(True))
    both = new.join(old, F.col("key").eqNullSafe(F.col("_key")), "full_outer")
    change = (
        F.when(F.col("_was").isNull(), "added")
        .when(F.col("_is").isNull(), "dropped")
        .when(F.col(f"_new.{DIGEST}") != F.col("_old"), "changed")
    )
    key = F.when(F.col("_is"), F.col("key")).otherwise(F.col("_key")).alias("key")
    changes = both.select(key, change.alias("change"), F.col("_new.value").alias("value"))
    return changes.where("change is not null")


def _digest() -> Column:
    return F.coalesce(F.sha2("value", 256), F.lit(""))


def key_digests(export: DataFrame) -> DataFrame:
    """What has to be kept of an export to find the next changes: the key and a digest of its value."""
    return export.select("key", _digest().alias(DIGEST))
