"""Predicates and projections on postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.functions.text import filled, strip

# What a location must contain to be in New York City (the longer names contain the first).
NYC = ("new york", "nyc")
REMOTE = "remote"


def _listed(locations: Column) -> Column:
    return F.coalesce(locations, F.array().cast("array<string>"))


def any_contains(items: Column, words: tuple[str, ...]) -> Column:
    """Whether any item contains any of the lower-case words; false for null and empty lists."""
    def hit(x: Column) -> Column:
        low = F.lower(x)
        found = low.contains(words[0])
        for w in words[1:]:
            found = found | low.contains(w)
        return F.coalesce(found, F.lit(False))

    return F.exists(_listed(items), hit)


def all_contain(items: Column, word: str) -> Column:
    """Whether there are items and each contains the word; false for null and empty lists."""
    own = _listed(items)
    return (F.size(own) > 0) & F.forall(own, lambda x: F.coalesce(F.lower(x).contains(word), F.lit(False)))


def is_nyc(locations: Column) -> Column:
    return any_contains(locations, NYC)


def is_remote(locations: Column) -> Column:
    return all_contain(locations, REMOTE)


def full_row(postings: DataFrame) -> DataFrame:
    """Projection of the full build: raw texts, terms as JSON, the posting's own source, the commit."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return postings.select(
        "seq", "pos", "id", blank("company_name"), blank("title"),
        F.to_json(_listed(F.col("terms"))).alias("terms"), blank("date_posted"),
        F.col("commit_date").alias("first_seen_date"), blank("url"), blank("source"), F.col("sha").alias("first_seen_commit"), "locations",
    )


def update_row(postings: DataFrame, source: str) -> DataFrame:
    """Projection of the incremental run: stripped names, joined terms, a constant source."""
    return postings.select(
        "seq", "pos", "id", strip(F.coalesce("company_name", F.lit(""))).alias("company_name"),
        strip(F.coalesce("title", F.lit(""))).alias("title"), F.array_join(_listed(F.col("terms")), " | ").alias("recruiting_season"),
        F.coalesce("date_posted", F.lit("")).alias("date_posted"), F.col("commit_date").alias("first_seen_date"),
        F.coalesce("url", F.lit("")).alias("url"), F.lit(source).alias("source"), "locations",
    )


def with_id(rows: DataFrame) -> DataFrame:
    return rows.where(filled(F.col("id")))


def at_or_above(rows: DataFrame, date: str, mark: Column | str) -> DataFrame:
    """Rows whose text date isn't below the mark; a blank mark lets all pass."""
    return rows.where(F.coalesce(F.col(date), F.lit("")) >= mark)


def lacks_text(details: DataFrame) -> DataFrame:
    """Archived records without a text."""
    return details.where(filled(F.col("archive_url")) & ~F.coalesce(F.col("raw_text").rlike(r"(?U)\S"), F.lit(False)))
