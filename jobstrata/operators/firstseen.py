"""First sightings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.functions.text import filled


def first_sighting(rows: DataFrame, keys: tuple[str, ...] = ("id",), order: tuple[str, ...] = ("seq", "pos")) -> DataFrame:
    """The first row of each key in the given order; rows with a null or blank key drop out.

    Filter before calling: a row that doesn't qualify is no sighting.  The rank
    is limited before the shuffle as well, so a hot key sends one row a task.
    """
    own = rows
    for k in keys:
        own = own.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return own.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def unseen(rows: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key isn't stored yet; nulls among the stored keys are harmless."""
    return rows.join(stored.select(key).where(filled(F.col(key))).distinct(), key, "left_anti")


def insert_if_absent(stored: DataFrame, rows: DataFrame, key: str = "id", order: tuple[str, ...] = ("seq", "pos")) -> DataFrame:
    """Stored rows and the first sightings of new keys; stored rows never change."""
    fresh = unseen(first_sighting(rows, (key,), order), stored, key).select(*stored.columns)
    return stored.unionByName(fresh)


def counts_per_snapshot(rows: DataFrame, classes: dict[str, str], by: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Rows of each snapshot, in all and by named SQL condition."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("rows"), *[F.count_if(F.expr(cond)).alias(name) for name, cond in classes.items()]
    )
