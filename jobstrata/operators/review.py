"""Review of archived records: measures, filters and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.functions.text import filled


def unclassified() -> Column:
    return ~filled(F.col("category"))


def kpis(details: DataFrame) -> DataFrame:
    """Total, unclassified, failed archives, failed or blocked scrapes and archived records, in one pass.

    ``excluded`` is a boolean column; ``scrape_status`` may be missing.
    """
    d = details if "scrape_status" in details.columns else details.withColumn("scrape_status", F.lit(""))
    return d.agg(
        F.count("*").alias("total"),
        F.count_if(unclassified() & ~F.col("excluded")).alias("unclassified"),
        F.count_if(F.col("archive_status") == "failed").alias("archive_failed"),
        F.count_if(F.col("scrape_status").isin("failed", "blocked")).alias("scrape_issues"),
        F.count_if(filled(F.col("archive_url"))).alias("archived"),
    )


def search(text: str, columns: tuple[str, ...] = ("company_name", "title")) -> Column:
    """Case-insensitive regular expression in any column; blank text finds all, null matches nothing."""
    if not text.strip():
        return F.lit(True)
    # The tasks' own pattern language refuses a broken pattern before any task starts.
    SparkSession.active()._jvm.java.util.regex.Pattern.compile(f"(?i){text}")
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).rlike(f"(?i){text}"), F.lit(False))
    return hit


def review(details: DataFrame, *, exclusion: str = "hide", category: str = "All", archive: str = "All", text: str = "") -> DataFrame:
    """Records that pass the filters.

    ``exclusion``: hide, all or only; ``category``: All, Unclassified or a
    value; ``archive``: All or a value.
    """
    out = details
    if exclusion == "hide":
        out = out.where(~F.col("excluded"))
    elif exclusion == "only":
        out = out.where("excluded")
    if category == "Unclassified":
        out = out.where(unclassified())
    elif category != "All":
        out = out.where(F.col("category") == category)
    if archive != "All":
        out = out.where(F.col("archive_status") == archive)
    return out.where(search(text))


def failed_tail(details: DataFrame, n: int, *order: str) -> DataFrame:
    """The last ``n`` failures, in order."""
    back = [F.desc(c) for c in order]
    return details.where(F.col("archive_status") == "failed").orderBy(*back).limit(n).orderBy(*order)


#: Columns of a list of failures, and of the list of exclusions as it is handed out.
FAILURE = ("id", "company_name", "title", "job_url", "archive_status", "first_seen_date")


def failures(details: DataFrame, *states: str, column: str = "archive_status") -> DataFrame:
    """Records in one of the states, reduced to what a list of failures shows."""
    found = details if column in details.columns else details.withColumn(column, F.lit(""))
    return found.where(F.col(column).isin(*states)).select(*[c for c in FAILURE if c in details.columns])


def download(flagged_details: DataFrame) -> DataFrame:
    """The records as they are handed out: without the flag that review added."""
    return flagged_details.drop("excluded")


def exclusions_download(exclusions: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The exclusions as they are handed out, missing columns blank."""
    return exclusions.select(*[(F.coalesce(c, F.lit("")) if c in exclusions.columns else F.lit("")).alias(c) for c in columns])
