"""Snapshot history: the manifest of commits and the JSON payload of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.operators.workqueue import ranked
from jobstrata.schemas import POSTING


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``sha, payload`` from files named by commit (``<sha>.json``), one whole file a row."""
    files = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(path)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    return files.select(name.alias("sha"), F.col("value").alias("payload"))


def with_payload(manifest: DataFrame, payloads: DataFrame) -> DataFrame:
    """Manifest rows with their payload; null where the file is missing."""
    return manifest.join(payloads, "sha", "left")


def parse_payload(history: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``postings`` (array of structs) and ``parse_ok``.

    Only one top-level JSON array of objects is accepted; anything else gives a
    null array and ``parse_ok`` false.  Wrongly typed fields become null.
    """
    text = F.regexp_replace(F.col(payload), r"(?U)^[\s\ufeff]+|\s+$", "")
    parsed = F.from_json(text, F.lit(f"array<{POSTING.simpleString()}>"), {"mode": "PERMISSIVE"})
    fine = F.coalesce(text.rlike(r"(?s)^\[.*\]$"), F.lit(False)) & parsed.isNotNull()
    return history.withColumn("postings", F.when(fine, parsed)).withColumn("parse_ok", fine)


def explode_postings(history: DataFrame) -> DataFrame:
    """One row per posting: the history's columns, ``pos`` and the posting's fields."""
    keep = [c for c in history.columns if c not in ("payload", "postings", "parse_ok")]
    return history.select(*keep, F.posexplode("postings").alias("pos", "p")).where("p is not null").select(*keep, "pos", "p.*")


def recent(manifest: DataFrame, n: int) -> DataFrame:
    """The last ``n`` commits, oldest first."""
    return manifest.orderBy(F.desc("seq")).limit(n).orderBy("seq")


def stride(manifest: DataFrame, step: int) -> DataFrame:
    """First and last commit and every ``step``-th between, chosen before any payload is read."""
    last = manifest.agg(F.max("seq").alias("_last"))
    return manifest.join(F.broadcast(last), F.expr("true")).where(
        (F.col("seq") % step == 0) | (F.col("seq") == F.col("_last"))
    ).drop("_last")


def chunks(pending: DataFrame, size: int) -> DataFrame:
    """Add ``chunk``: blocks of ``size`` commits in order."""
    return ranked(pending, "_n", "seq").withColumn("chunk", F.floor(F.col("_n") / size).cast("long")).drop("_n")
