"""The incremental run: recent commits, queue, details and exclusions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.functions.text import filled
from jobstrata.functions.urls import url_match_keys
from jobstrata.operators.firstseen import first_sighting, unseen
from jobstrata.operators.ledger import keep_known, restore_text, stripped_ids, upsert, without
from jobstrata.operators.predicates import is_nyc, is_remote, update_row, with_id
from jobstrata.operators.urlmatch import known_urls
from jobstrata.operators.workqueue import PER_RUN, enqueue, fold_mark, greedy_urls, head, high_water, rest, retried
from jobstrata.schemas import DETAILS_TEXT, strings
from jobstrata.session import materialize
from jobstrata.sources.sinks import text_rows
from jobstrata.sources.snapshots import explode_postings, parse_payload, recent, with_payload

#: States after which an item isn't tried again; failed ones leave the queue by their number of attempts.
FINAL = ("success",)
#: What a record has that no one has looked at.
UNREVIEWED = "unreviewed"


def purge_queue(queue: DataFrame, details: DataFrame, excluded: DataFrame, *, faithful: bool = False) -> DataFrame:
    """Queue without excluded items and without those that are finished.

    With ``faithful`` every item that has a details row counts as finished,
    even one that is only waiting.
    """
    finished = details if faithful else details.where(F.col("archive_status").isin(*FINAL))
    return without(queue, finished, excluded)


def archived(details: DataFrame, queue: DataFrame, outcomes: DataFrame, *, source: str, now: str, faithful: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Details, queue and new ``id, raw_text`` after the head of the queue was tried.

    Each item tried gets its outcome, failed ones at every attempt; what a
    reviewer may have set stays, and has its usual value where the record is
    new.  With ``faithful`` the columns an archive run doesn't know are blanked.
    """
    batch = materialize(head(queue, PER_RUN, "pos"), "batch")
    found = outcomes.groupBy(F.col("id").alias("_o")).agg(
        F.min_by(F.struct("archive_source", "archive_status", "archive_url", "raw_text"), F.col("archive_status") != "success").alias("_got")
    )
    got = batch.join(found, F.col("id") == F.col("_o"), "left").withColumn("_ok", F.coalesce(F.col("_got.archive_status") == "success", F.lit(False)))
    tried = materialize(got.select(
        "id", "company_name", "title", "job_url", F.col("first_seen_date").alias("_seen"),
        F.when(F.col("_ok"), F.coalesce("_got.archive_url", F.lit(""))).otherwise("").alias("archive_url"),
        F.when(F.col("_ok"), F.col("_got.archive_source")).otherwise("none").alias("archive_source"),
        F.when(F.col("_ok"), "success").otherwise("failed").alias("archive_status"), F.lit(now).alias("date_archived"),
        F.when(F.col("_ok"), F.col("_got.raw_text")).alias("raw_text"),
    ), "tried")
    rows = keep_known(tried, details, {"category": "", "status": UNREVIEWED, "source": source})
    rows = keep_known(rows, details, {"first_seen_date": None}).withColumn("first_seen_date", F.coalesce("first_seen_date", "_seen"))
    rows = rows.drop("_seen", "raw_text")
    others = tuple(c for c in details.columns if c not in rows.columns)
    details = upsert(details, rows, keep=() if faithful else others).na.fill("")
    queue = retried(rest(queue, tried.where("archive_status = 'success'"), "id"), tried.where("archive_status = 'failed'"))
    return details, queue.withColumn("archive_attempts", F.col("archive_attempts").cast("string")), tried.where(F.col("raw_text").rlike(r"(?U)\S")).select("id", "raw_text")


def kept_texts(details: DataFrame, texts: DataFrame, fresh: DataFrame, *, faithful: bool = False) -> DataFrame:
    """``id, raw_text`` of archived records: the new text, else the one kept so far.

    A record read live has no archive address; its text is kept all the same,
    but with ``faithful``.
    """
    whole = restore_text(details.select("id", "archive_url", "archive_status").join(fresh, "id", "left"), texts)
    held = whole if faithful else whole.withColumn("archive_url", F.when(F.col("archive_status") == "success", "live").otherwise(F.col("archive_url")))
    return text_rows(held)


def update(state: dict[str, DataFrame], manifest: DataFrame, payloads: DataFrame, outcomes: DataFrame, *, commits: int = 5,
           source: str = "listing", now: str = "", archive: bool = True, faithful: bool = False, known_first: bool = False) -> dict[str, DataFrame]:
    """One run: the next version of every table in ``state``, and its ``report``.

    ``state`` holds nyc_jobs, remote_jobs (eight columns), job_details,
    pending_archive (with ``pos``), excluded_jobs, and may hold
    job_details_text (``id, raw_text``); ``outcomes`` holds what fetching
    found: ``id, archive_source, archive_status, archive_url, raw_text``.
    ``now`` is the clock.  With ``known_first`` an item whose address is known
    isn't queued at all; else it is, and only gets no record ahead of the archive.
    ``report`` is one row of counts: what is written depends on it (see
    :func:`jobstrata.plans.store.save_run`).
    """
    spark = manifest.sparkSession
    excluded = stripped_ids(state["excluded_jobs"])
    nyc, remote = (without(state[t], excluded) for t in ("nyc_jobs", "remote_jobs"))
    details = state["job_details"]
    texts = state["job_details_text"] if "job_details_text" in state else spark.createDataFrame([], strings(DETAILS_TEXT))
    queue = purge_queue(state["pending_archive"], details, excluded, faithful=faithful)

    history = parse_payload(with_payload(recent(manifest, commits), payloads)).drop("payload")
    rows = materialize(without(with_id(update_row(explode_postings(history), source)), excluded), "rows")
    new_nyc = unseen(first_sighting(rows.where(is_nyc(F.col("locations")))), nyc)
    new_remote = unseen(first_sighting(rows.where(is_remote(F.col("locations")))), remote)

    # A posting new to both tables at once is one event.
    events = without(new_nyc.unionByName(new_remote).dropDuplicates(["seq", "pos"]), details, queue)
    mark = high_water(details).first()["mark"]
    ordered = events.withColumn("at", F.col("seq") * F.lit(1 << 31) + F.col("pos"))
    admitted = fold_mark(ordered.drop("locations"), "at", "first_seen_date", "id", mark)
    items = materialize(admitted.select("id", "company_name", "title", F.col("url").alias("job_url"), "first_seen_date", "at"), "admitted")
    # Items whose address is known, or taken earlier in this run, get no row ahead of the archive.
    fresh = known_urls(items, details, "job_url", "job_url", anti=True).withColumn("keys", url_match_keys(F.col("job_url")))
    fresh = materialize(greedy_urls(fresh, "at", "keys").drop("keys"), "fresh")
    queue = enqueue(queue, (fresh if known_first else items).withColumn("archive_attempts", F.lit("0")), ("at",))
    ahead = fresh.select(
        "id", "company_name", "title", "job_url", "first_seen_date", F.lit("pending").alias("archive_status"),
        F.lit("").alias("archive_source"), F.lit(UNREVIEWED).alias("status"), F.lit(source).alias("source"),
    )
    details = upsert(details, ahead).na.fill("")

    found = spark.createDataFrame([], strings(DETAILS_TEXT))
    if archive:
        details, queue, found = archived(details, queue, outcomes, source=source, now=now, faithful=faithful)

    def grown(stored: DataFrame, new: DataFrame) -> DataFrame:
        return stored.unionByName(new.select(*stored.columns))

    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    before = state["nyc_jobs"].select("id").unionByName(state["remote_jobs"].select("id"))
    report = total(new_nyc, "new_nyc")
    for df, name in (
        (new_remote, "new_remote"), (before.join(excluded, "id", "left_semi"), "removed"), (history.where("not parse_ok"), "errors"), (queue, "queued"),
    ):
        report = report.crossJoin(total(df, name))  # one row each
    report = report.withColumn("archive", F.lit(archive))
    out = {
        "nyc_jobs": grown(nyc, new_nyc), "remote_jobs": grown(remote, new_remote), "job_details": details, "pending_archive": queue,
        "job_details_text": kept_texts(details, texts, found, faithful=faithful), "report": report,
    }
    # Each version is written before the next run builds on it.
    return {**{name: materialize(df, name) for name, df in out.items()}, "excluded_jobs": state["excluded_jobs"]}


def backfill(details: DataFrame, texts: DataFrame, fetched: DataFrame, size: int = 10) -> dict[str, DataFrame]:
    """Texts for archived records that have none, ``size`` a run.

    Gives the new text table, the batch, and how many were filled and remain.
    """
    known = texts.where(F.col("raw_text").rlike(r"(?U)\S")).select("id")
    missing = without(details.where(filled(F.col("archive_url"))).select("id", "archive_url"), known)
    batch = missing.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy("archive_url"))).where("_r = 1").drop("_r")
    batch = materialize(head(batch, size, "id"), "batch")
    filled_ = batch.join(fetched, "id").where(F.col("raw_text").rlike(r"(?U)\S")).select("id", "raw_text")
    counts = missing.agg(F.count_distinct("id").alias("missing")).join(filled_.agg(F.count("*").alias("filled")), F.expr("true")).select(
        "filled", (F.col("missing") - F.col("filled")).alias("remaining")
    )
    return {"texts": upsert(texts.select("id", "raw_text"), filled_), "batch": batch, "counts": counts}
