"""Command line: full build, incremental update and text backfill over files.

    python -m jobstrata.run build    --snapshots DIR --manifest CSV --home DIR [--step 10]
    python -m jobstrata.run update   --snapshots DIR --manifest CSV --home DIR [--commits 5] [--skip-archive] [--outcomes JSONL]
    python -m jobstrata.run backfill --home DIR --fetched JSONL [--batch-size 10]

The manifest is a CSV of ``seq, sha, commit_date``, the snapshots are files
named ``<sha>.json``.  What the network gives (pages, archives) comes in as
files, so the commands run wherever Spark does.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.plans.build import empty_jobs, full_build
from jobstrata.plans.store import load_state, outcomes_table, save_run
from jobstrata.plans.update import backfill, update
from jobstrata.schemas import DETAILS_TEXT, JOBS_FULL
from jobstrata.session import build_session, materialize
from jobstrata.sources.files import read_csv, read_jsonl
from jobstrata.sources.sinks import job_export, latest_version, next_version, sql_dump, write_csv, write_jsonl, write_lines
from jobstrata.sources.snapshots import read_payloads


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ("seq", "sha", "commit_date")).withColumn("seq", F.col("seq").try_cast("long")).where("seq is not null")


def _stored(spark: SparkSession, home: str, name: str, empty: DataFrame) -> DataFrame:
    path = latest_version(spark, f"{home}/{name}")
    return spark.read.schema(empty.schema).parquet(path) if path else empty


def build(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Take the sampled commits that aren't done; export CSV and SQL text."""
    tables = {t: _stored(spark, args.home, t, empty_jobs(spark)) for t in ("nyc_jobs", "remote_jobs")}
    done = _stored(spark, args.home, "done_commits", spark.createDataFrame([], "sha string"))
    new = full_build(_manifest(spark, args.manifest), read_payloads(spark, args.snapshots), tables, done, step=args.step, faithful=args.faithful)
    new = {name: materialize(df, name) for name, df in new.items()}
    for name in ("nyc_jobs", "remote_jobs"):
        write_csv(job_export(new[name]), f"{args.home}/export/{name}")
    day = args.now[:10]
    write_lines(sql_dump({t: new[t] for t in tables}, JOBS_FULL, "job postings", day), f"{args.home}/export/sql")
    # The list of done commits comes last: a run that dies before is simply repeated.
    for name in ("nyc_jobs", "remote_jobs", "done_commits"):
        new[name].write.parquet(next_version(spark, f"{args.home}/{name}"))
    return {name: df.count() for name, df in new.items()}


def run_update(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    new = update(
        load_state(spark, args.home), _manifest(spark, args.manifest), read_payloads(spark, args.snapshots), outcomes_table(spark, args.outcomes),
        commits=min(args.commits, 100), source=args.source, now=args.now, archive=not args.skip_archive, faithful=args.faithful,
    )
    save_run(new, args.home)
    return new["report"].first().asDict()


def run_backfill(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    state = load_state(spark, args.home)
    out = backfill(state["job_details"], state["job_details_text"], read_jsonl(spark, args.fetched, DETAILS_TEXT), args.batch_size)
    write_jsonl(out["texts"], f"{args.home}/job_details_text")
    return out["counts"].first().asDict()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    parser = argparse.ArgumentParser(prog="jobstrata.run", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, does in (("build", build), ("update", run_update), ("backfill", run_backfill)):
        p = commands.add_parser(name)
        p.set_defaults(does=does)
        p.add_argument("--home", required=True)
        p.add_argument("--master")
        p.add_argument("--now", default=now, help="the clock, for repeatable runs")
        if name != "backfill":
            p.add_argument("--snapshots", required=True)
            p.add_argument("--manifest", required=True)
            p.add_argument("--faithful", action="store_true")
        if name == "build":
            p.add_argument("--step", type=int, default=10)
        elif name == "update":
            p.add_argument("--commits", type=int, default=5)
            p.add_argument("--skip-archive", action="store_true")
            p.add_argument("--outcomes")
            p.add_argument("--source", default="listing")
        else:
            p.add_argument("--fetched", required=True)
            p.add_argument("--batch-size", type=int, default=10)
    args = parser.parse_args(argv)
    spark = spark or build_session("jobstrata", args.master)
    counts = args.does(spark, args)
    print(", ".join(f"{k} {v}" for k, v in counts.items()))
    return counts


if __name__ == "__main__":
    main()
