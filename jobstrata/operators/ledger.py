"""Keyed tables: exclusions, upserts, restored texts and edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.functions.text import blank_to_null, filled, strip


def without(rows: DataFrame, *keys: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key stands in none of the key tables (never ``NOT IN``, which nulls upset)."""
    for k in keys:
        rows = rows.join(k.select(key).distinct(), key, "left_anti")
    return rows


def flagged(rows: DataFrame, ids: DataFrame, name: str = "excluded", key: str = "id") -> DataFrame:
    """Add whether the key stands in the list; nulls do not."""
    marks = ids.select(F.col(key).alias("_k")).where("_k is not null").distinct()
    return rows.join(marks, rows[key] == marks["_k"], "left").withColumn(name, F.col("_k").isNotNull()).drop("_k")


def upsert(stored: DataFrame, rows: DataFrame, key: str = "id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` replace stored rows of their key; columns in ``keep`` that they lack stay as stored."""
    kept = [c for c in keep if c not in rows.columns]
    if kept:
        old = stored.groupBy(F.col(key).alias("_k")).agg(*[F.max(c).alias(c) for c in kept])
        rows = rows.join(old, rows[key] == old["_k"], "left").drop("_k")
    return stored.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True).select(*stored.columns)


def restore_text(rows: DataFrame, texts: DataFrame, key: str = "id", text: str = "raw_text") -> DataFrame:
    """Fill blank texts from ``texts(id, raw_text)``; among several for a key the greatest stands."""
    old = texts.where(filled(F.col(text))).groupBy(key).agg(F.max(text).alias("_old")).withColumnRenamed(key, "_k")
    return (
        rows.join(old, rows[key] == old["_k"], "left")
        .withColumn(text, F.coalesce(blank_to_null(F.col(text)), "_old", F.col(text)))
        .select(*rows.columns)
    )


def keep_known(rows: DataFrame, stored: DataFrame, columns: dict[str, str | None], key: str = "id") -> DataFrame:
    """Columns of ``rows`` taken from the stored row of the key, else the default given.

    Of several stored rows of a key the greatest values stand; rows are never multiplied.
    """
    old = stored.groupBy(F.col(key).alias("_k")).agg(*[F.max(c).alias(f"_{c}") for c in columns])
    joined = rows.join(old, rows[key] == old["_k"], "left")
    for c, default in columns.items():
        joined = joined.withColumn(c, F.coalesce(f"_{c}", F.lit(default)))
    return joined.drop("_k", *[f"_{c}" for c in columns])


def apply_edits(rows: DataFrame, edits: DataFrame, column: str, key: str = "id") -> DataFrame:
    """Set ``column`` where an edit of the key is present; an edit may set it blank or null.

    Of several edits of a key the greatest value stands; rows are never multiplied.
    """
    e = edits.groupBy(F.col(key).alias("_k")).agg(F.max(column).alias("_new"), F.lit(True).alias("_has"))
    value = F.when(F.col("_has"), F.col("_new")).otherwise(F.col(column))
    return rows.join(e, rows[key].cast("string") == e["_k"].cast("string"), "left").withColumn(column, value).select(*rows.columns)


def append_exclusions(stored: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """Exclusions not listed yet, after the stored ones; the first of a repeated key counts."""
    fresh = without(rows.where(filled(F.col(key))), stored, key=key)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c) for c in rows.columns]))
    return stored.unionByName(fresh.withColumn("_r", rank).where("_r = 1").drop("_r"), allowMissingColumns=True).select(*stored.columns)


def stripped_ids(rows: DataFrame, key: str = "id") -> DataFrame:
    return rows.select(strip(F.col(key)).alias(key)).where(filled(F.col(key))).distinct()
