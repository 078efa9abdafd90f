"""The full history build: first sightings of every qualifying posting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.functions.text import norm_sha
from jobstrata.operators.firstseen import first_sighting, insert_if_absent
from jobstrata.operators.ledger import without
from jobstrata.operators.predicates import full_row, is_nyc, is_remote, with_id
from jobstrata.schemas import JOBS_FULL, strings
from jobstrata.session import materialize
from jobstrata.sources.snapshots import explode_postings, parse_payload, stride, with_payload


def empty_jobs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], strings(JOBS_FULL))


def pending_commits(manifest: DataFrame, done: DataFrame, step: int = 1) -> DataFrame:
    """Sampled commits that aren't done; only their payloads are ever read."""
    named = done.select(norm_sha(F.col("sha")).alias("sha")).where("sha is not null")
    return without(stride(manifest, step), named, key="sha")


def sightings(history: DataFrame) -> dict[str, DataFrame]:
    """First sightings ``nyc_jobs`` and ``remote_jobs`` of parsed snapshots.

    Each class filters before it ranks: a posting first seen elsewhere isn't
    sighted until it qualifies, and one may be in both tables.
    """
    rows = full_row(with_id(explode_postings(history)))
    return {
        "nyc_jobs": first_sighting(rows.where(is_nyc(F.col("locations")))),
        "remote_jobs": first_sighting(rows.where(is_remote(F.col("locations")))),
    }


def full_build(
    manifest: DataFrame, payloads: DataFrame, stored: dict[str, DataFrame], done: DataFrame, *, step: int = 10, faithful: bool = False
) -> dict[str, DataFrame]:
    """New ``nyc_jobs``, ``remote_jobs`` and ``done_commits``.

    A commit whose payload is missing or broken isn't marked done and comes up
    again; with ``faithful`` it is marked all the same.
    """
    history = materialize(parse_payload(with_payload(pending_commits(manifest, done, step), payloads)).drop("payload"), "history")
    fresh = sightings(history)
    marked = history if faithful else history.where("parse_ok")
    return {
        **{name: insert_if_absent(stored[name], rows) for name, rows in fresh.items()},
        "done_commits": done.select("sha").unionByName(marked.select("sha")).distinct(),
    }
