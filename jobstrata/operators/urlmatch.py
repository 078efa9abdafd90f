"""Matching addresses without a theta join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.functions.urls import url_match_keys


def known_urls(rows: DataFrame, stored: DataFrame, url: str = "url", stored_url: str = "url", *, anti: bool = False) -> DataFrame:
    """Rows whose address matches a stored one (or, with ``anti``, none).

    "Equal, or equal keys" becomes equality of exploded keys, so the join is a
    hash join however large both sides are, and a key shared by a third of all
    stored rows is one row after ``distinct``.
    """
    keys = stored.select(F.explode(url_match_keys(F.col(stored_url))).alias("_key")).distinct()
    own = rows.withColumn("_keys", url_match_keys(F.col(url)))
    exact = own.withColumn("_u", F.get("_keys", F.lit(0))).withColumn("_i", F.get("_keys", F.lit(1)))
    hit_u = keys.where(F.col("_key").startswith("u:")).select(F.col("_key").alias("_hu"))
    hit_i = keys.where(F.col("_key").startswith("i:")).select(F.col("_key").alias("_hi"))
    found = exact.join(hit_u, F.col("_u") == F.col("_hu"), "left").join(hit_i, F.col("_i") == F.col("_hi"), "left")
    matched = F.col("_hu").isNotNull() | F.col("_hi").isNotNull()
    return found.where(~matched if anti else matched).select(*rows.columns)
