"""The tables of the incremental run as versioned files below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.schemas import DETAILS_TEXT, EXCLUDED_JOBS, JOB_DETAILS, JOBS_CSV_8, PENDING_ARCHIVE, strings
from jobstrata.sources.files import numbered, queue_rows, read_csv, read_jsonl
from jobstrata.sources.sinks import latest_version, newest_first, write_csv, write_jsonl

#: Tables of the run and their columns.
TABLES = {
    "nyc_jobs": JOBS_CSV_8, "remote_jobs": JOBS_CSV_8, "job_details": JOB_DETAILS, "pending_archive": PENDING_ARCHIVE, "excluded_jobs": EXCLUDED_JOBS,
}


def load_state(spark: SparkSession, home: str) -> dict[str, DataFrame]:
    """The newest version of every table; what isn't there is an empty table."""
    def path(name: str) -> str:
        return latest_version(spark, f"{home}/{name}") or f"{home}/{name}/none"

    state = {name: read_csv(spark, path(name), columns) for name, columns in TABLES.items()}
    state["pending_archive"] = queue_rows(numbered(state["pending_archive"]))
    state["job_details_text"] = read_jsonl(spark, path("job_details_text"), DETAILS_TEXT)
    return state


def save_run(state: dict[str, DataFrame], home: str) -> dict[str, str]:
    """Write what a run changed, each table as a new version; the paths written.

    Job tables are written if rows came or went, the exclusions only if rows
    went, the queue always, and details with their texts if there are any and
    rows came or archiving ran.
    """
    report = state["report"].first()
    came, went = report.new_nyc + report.new_remote > 0, report.removed > 0
    out = {}
    if came or went:
        for name in ("nyc_jobs", "remote_jobs"):
            out[name] = write_csv(newest_first(state[name].select(*JOBS_CSV_8), "first_seen_date", "id"), f"{home}/{name}")
    if went:
        out["excluded_jobs"] = write_csv(newest_first(state["excluded_jobs"].select(*EXCLUDED_JOBS), "blocked_date", "id"), f"{home}/excluded_jobs")
    out["pending_archive"] = write_csv(state["pending_archive"].orderBy("pos").select(*PENDING_ARCHIVE), f"{home}/pending_archive")
    if (came or report.archive) and not state["job_details"].isEmpty():
        out.update(save_details(state["job_details"], state["job_details_text"], home))
    return out


def save_details(details: DataFrame, texts: DataFrame, home: str) -> dict[str, str]:
    """Details as CSV, newest first, and their texts as JSON lines."""
    return {
        "job_details": write_csv(newest_first(details.select(*JOB_DETAILS), "first_seen_date", "id"), f"{home}/job_details"),
        "job_details_text": write_jsonl(texts.select(*DETAILS_TEXT), f"{home}/job_details_text"),
    }


def outcomes_table(spark: SparkSession, path: str | None) -> DataFrame:
    """What fetching found, as JSON lines; no path is an empty table."""
    columns = ("id", "archive_source", "archive_status", "archive_url", "raw_text")
    found = read_jsonl(spark, path, columns) if path else spark.createDataFrame([], strings(columns))
    return found.where(F.col("id").isNotNull())
