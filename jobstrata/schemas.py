"""Column lists and types of the posting tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column orders of the stored tables.
JOBS_FULL = ("id", "company_name", "title", "terms", "date_posted", "first_seen_date", "url", "source", "first_seen_commit")
JOBS_CSV_7 = ("company_name", "title", "recruiting_season", "date_posted", "first_seen_date", "url", "id")
JOBS_CSV_8 = (*JOBS_CSV_7, "source")
JOB_DETAILS = (
    "id", "company_name", "title", "job_url", "archive_url", "archive_source", "archive_status", "category", "class_year",
    "degree_enrollment", "additional_skills", "language_requirements", "date_archived", "status", "source", "first_seen_date",
)
EXCLUDED_JOBS = ("id", "company_name", "reason", "blocked_title", "blocked_company", "blocked_date", "job_url", "archive_url")
PENDING_ARCHIVE = ("id", "company_name", "title", "job_url", "first_seen_date", "archive_attempts")
DETAILS_TEXT = ("id", "raw_text")

POSTING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("locations", T.ArrayType(T.StringType())),
    T.StructField("terms", T.ArrayType(T.StringType())),
    T.StructField("date_posted", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
])


def strings(columns: tuple[str, ...]) -> T.StructType:
    """All-text schema: ids keep their leading zeros, nothing is inferred."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
