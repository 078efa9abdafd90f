"""Queries of the reference's operators on the stored tables, each with its SQL.

Where a table lacks an operator's input (locations, HTML, fetch results), a
projection of another table stands in for it, written alike in both languages.
Every query runs over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.functions.html import visible_text
from jobstrata.functions.text import filled, norm_sha, sql_literal, strip
from jobstrata.functions.urls import url_job_key, url_match_keys
from jobstrata.operators import ledger, predicates, review, workqueue
from jobstrata.operators.firstseen import counts_per_snapshot, first_sighting, unseen
from jobstrata.operators.urlmatch import known_urls
from jobstrata.plans.build import pending_commits
from jobstrata.plans.update import backfill
from jobstrata.schemas import JOBS_FULL
from jobstrata.session import scratch_path
from jobstrata.sources.files import excluded_ids, last_wins, read_csv, read_jsonl
from jobstrata.sources.sinks import insert_statements, job_export, newest_first, seasons, sql_dump, text_rows, write_csv, write_jsonl
from jobstrata.sources.snapshots import chunks, explode_postings, parse_payload, recent, stride
from jobstrata.sources.tables import job_rows, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _jobs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    nyc = table(spark, folder, "nyc_jobs").select(F.lit("nyc").alias("tbl"), *columns)
    return nyc.unionByName(table(spark, folder, "remote_jobs").select(F.lit("remote").alias("tbl"), *columns))


_BOTH = """(SELECT 'nyc' AS tbl, * FROM nyc_jobs UNION ALL SELECT 'remote' AS tbl, * FROM remote_jobs)"""


@_query(f"""
SELECT tbl, id, row_id, seq FROM (
  SELECT j.tbl, j.id, j.row_id, m.seq, row_number() OVER (PARTITION BY j.tbl, j.id ORDER BY m.seq, j.row_id) AS r
  FROM {_BOTH} j JOIN manifest m ON m.sha = j.first_seen_commit WHERE j.id IS NOT NULL AND j.id <> ''
) WHERE r = 1""")
def first_sighting_(spark: SparkSession, folder: str) -> DataFrame:
    rows = _jobs(spark, folder, "id", "row_id", "first_seen_commit")
    placed = rows.join(table(spark, folder, "manifest").select("sha", "seq"), F.col("first_seen_commit") == F.col("sha"))
    return first_sighting(placed.select("tbl", "id", "row_id", "seq"), ("tbl", "id"), ("seq", "row_id"))


QUERIES["first_sighting"], SQL["first_sighting"] = QUERIES.pop("first_sighting_"), SQL.pop("first_sighting_")

_LINES = "string_split(text, chr(10))"


@_query(f"""
SELECT doc_id FROM documents
WHERE len(list_filter({_LINES}, lambda x: contains(lower(x), 'new york') OR contains(lower(x), 'queens'))) > 0""")
def any_line_keyword(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.split(F.col("text"), "\n")
    return table(spark, folder, "documents").where(predicates.any_contains(lines, ("new york", "queens"))).select("doc_id")


@_query(f"""
SELECT doc_id FROM documents
WHERE text IS NOT NULL AND len(list_filter({_LINES}, lambda x: NOT contains(lower(x), 'e'))) = 0""")
def all_lines_keyword(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where(predicates.all_contain(F.split(F.col("text"), "\n"), "e")).select("doc_id")


@_query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


@_query(f"""
SELECT row_id, CAST(pos - 1 AS BIGINT) AS pos, term FROM (
  SELECT row_id, unnest(l) AS term, unnest(range(1, len(l) + 1)) AS pos FROM (
    SELECT row_id, CAST(CASE WHEN json_valid(terms) AND terms LIKE '[%]' THEN terms ELSE '[]' END AS VARCHAR[]) AS l FROM {_BOTH} WHERE terms IS NOT NULL))""")
def terms_exploded(spark: SparkSession, folder: str) -> DataFrame:
    terms = F.from_json("terms", F.lit("array<string>"))
    own = job_rows(spark, folder, "row_id", "terms").where(F.col("terms").rlike(r"(?s)^\[.*\]$"))
    out = own.select("row_id", F.posexplode(terms).alias("pos", "term"))
    return out.select("row_id", F.col("pos").cast("long").alias("pos"), "term")


@_query(f"""
SELECT row_id, CASE WHEN json_valid(terms) AND terms LIKE '[%]' THEN array_to_string(CAST(terms AS VARCHAR[]), ' | ') ELSE terms END AS recruiting_season
FROM {_BOTH}""")
def season_join(spark: SparkSession, folder: str) -> DataFrame:
    return job_rows(spark, folder, "row_id", "terms").select("row_id", seasons(F.col("terms")).alias("recruiting_season"))


@_query("""
SELECT row_id FROM remote_jobs r WHERE id IS NOT NULL AND id <> '' AND NOT EXISTS (SELECT 1 FROM nyc_jobs n WHERE n.id = r.id)""")
def first_seen_new_only(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "remote_jobs").select("id", "row_id").where(filled(F.col("id")))
    return unseen(rows, table(spark, folder, "nyc_jobs")).select("row_id")


@_query("SELECT seq, sha FROM manifest WHERE seq % 10 = 0 OR seq = (SELECT max(seq) FROM manifest)")
def stride_sample(spark: SparkSession, folder: str) -> DataFrame:
    return stride(table(spark, folder, "manifest"), 10).select("seq", "sha")


@_query("""
SELECT seq, sha FROM manifest WHERE (seq % 3 = 0 OR seq = (SELECT max(seq) FROM manifest))
AND NOT EXISTS (SELECT 1 FROM done_commits d WHERE lower(regexp_replace(d.sha, '\\s+', '', 'g')) = manifest.sha)""")
def pending_after_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    return pending_commits(table(spark, folder, "manifest"), table(spark, folder, "done_commits"), 3).select("seq", "sha")


@_query("SELECT seq, sha FROM manifest ORDER BY seq DESC LIMIT 5")
def recent_commits(spark: SparkSession, folder: str) -> DataFrame:
    return recent(table(spark, folder, "manifest"), 5).select("seq", "sha")


_OUT = r"(SELECT DISTINCT regexp_replace(id, '^\s+|\s+$', '', 'g') AS id FROM excluded_jobs WHERE regexp_replace(id, '^\s+|\s+$', '', 'g') <> '')"


@_query(f"SELECT detail_id FROM job_details d WHERE NOT EXISTS (SELECT 1 FROM {_OUT} x WHERE x.id = d.id)")
def exclude_ids(spark: SparkSession, folder: str) -> DataFrame:
    out = excluded_ids(table(spark, folder, "excluded_jobs"))
    return ledger.without(table(spark, folder, "job_details").select("id", "detail_id"), out).select("detail_id")


@_query(f"SELECT count(*) AS removed FROM {_BOTH} j WHERE EXISTS (SELECT 1 FROM {_OUT} x WHERE x.id = j.id)")
def removed_rows(spark: SparkSession, folder: str) -> DataFrame:
    out = excluded_ids(table(spark, folder, "excluded_jobs"))
    return job_rows(spark, folder, "id").join(out, "id", "left_semi").agg(F.count("*").alias("removed"))


@_query("SELECT detail_id, EXISTS (SELECT 1 FROM excluded_jobs x WHERE x.id = d.id) AS excluded FROM job_details d")
def excluded_flag(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.flagged(table(spark, folder, "job_details").select("id", "detail_id"), table(spark, folder, "excluded_jobs")).select("detail_id", "excluded")


def _key_sql(url: str) -> str:
    """The job key in SQL, its patterns written for DuckDB."""
    h = "[0-9a-f]"
    found = [
        f"regexp_extract({url}, '{h}{{8}}-{h}{{4}}-{h}{{4}}-{h}{{4}}-{h}{{12}}', 0, 'i')",
        f"regexp_extract({url}, '/job(s|)/([0-9]{{7,}})', 2, 'i')",
        f"regexp_extract({url}, '/([0-9]{{15,}})', 1)",
        f"regexp_extract({url}, '/jobs/([0-9]{{4,}})/job', 1, 'i')",
        f"regexp_extract({url}, '/([0-9]{{8,}})$', 1)",
        f"regexp_extract({url}, '/(JR[0-9]+)', 1, 'i')",
        f"regexp_extract({url}, '/(R-[0-9]+)', 1, 'i')",
        f"regexp_extract({url}, '/(REQ(-|_)[0-9A-Za-z_]+)', 1, 'i')",
        f"regexp_extract({url}, 'search/([0-9]{{10,}})', 1, 'i')",
    ]
    rules = ", ".join(f"nullif({x}, '')" for x in found)
    path = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({url}, '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//[^/?#]*', ''), '[?#].*$', ''), ';[^/]*$', '')"
    bare = f"rtrim({path}, '/')"
    return f"CASE WHEN {url} IS NULL OR {url} = '' THEN NULL ELSE coalesce({rules}, CASE WHEN {bare} = '' THEN {url} ELSE string_split({bare}, '/')[-1] END) END"


# One address for each rule, beside those of the tables.
_RULE_URLS = (
    "https://x.example/a/0A1b2c3d-1111-2222-3333-444455556666/apply", "https://x.example/job/1234567-abc", "https://x.example/p/123456789012345/q",
    "https://x.example/jobs/1234/job", "https://x.example/JOBS/7654321/x", "https://x.example/p/12345678", "https://x.example/en/jr123/x",
    "https://x.example/R-123", "https://x.example/en/r-4567?x=1", "https://x.example/REQ-ab", "https://x.example/req_77c/d",
    "https://x.example/search/1234567890x", "https://x.example/a/apply/", "https://x.example/a/b;p=1?q=2#f", "https://x.example", "mailto:me", "",
)
_RULED = ", ".join(f"({n}, '{u}')" for n, u in enumerate(_RULE_URLS))


@_query(f"SELECT n, {_key_sql('url')} AS job_key FROM (VALUES {_RULED}) v(n, url)")
def url_rule_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.createDataFrame(list(enumerate(_RULE_URLS)), "n int, url string")
    return rows.select("n", url_job_key(F.col("url")).alias("job_key"))


@_query(f"SELECT row_id, {_key_sql('url')} AS job_key FROM {_BOTH}")
def url_job_keys(spark: SparkSession, folder: str) -> DataFrame:
    return job_rows(spark, folder, "row_id", "url").select("row_id", url_job_key(F.col("url")).alias("job_key"))


@_query(f"""
WITH k AS (SELECT DISTINCT rtrim(job_url, '/') AS u, CASE WHEN length({_key_sql('job_url')}) >= 4 THEN {_key_sql('job_url')} END AS i FROM job_details WHERE job_url <> ''),
r AS (SELECT row_id, rtrim(url, '/') AS u, CASE WHEN length({_key_sql('url')}) >= 4 THEN {_key_sql('url')} END AS i FROM {_BOTH} WHERE url <> '')
SELECT row_id FROM r WHERE u IN (SELECT u FROM k WHERE u IS NOT NULL) OR i IN (SELECT i FROM k WHERE i IS NOT NULL)""")
def url_known(spark: SparkSession, folder: str) -> DataFrame:
    return known_urls(job_rows(spark, folder, "row_id", "url"), table(spark, folder, "job_details"), "url", "job_url").select("row_id")


_SPACE = r"[\s\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@_query(rf"""
SELECT detail_id, coalesce(array_to_string(list_filter(list_transform(string_split(raw_text, chr(10)), lambda x: regexp_replace(x, '^{_SPACE}+|{_SPACE}+$', '', 'g')),
  lambda x: x <> ''), chr(10)), '') AS shown FROM job_details""")
def visible_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Each text is written as a page, a paragraph a line, between hidden elements; what is shown is the text."""
    escaped = F.replace(F.replace(F.col("raw_text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(
        F.lit("<html><head><title>hidden</title></head><NAV>menu<p>more</nav><p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><p>")),
        F.lit("</p><!-- note --><script>if (a < 1) { b(); }</script><footer>end<iframe/></footer></html>"),
    )
    return table(spark, folder, "job_details").select("detail_id", page.alias("page")).select("detail_id", visible_text("page").alias("shown"))


@_query(f"""
WITH RECURSIVE r AS (
  SELECT row_number() OVER (ORDER BY row_id) AS n, row_id, list_filter(['u:' || rtrim(url, '/'), CASE WHEN length(k) >= 4 THEN 'i:' || k END], lambda x: x IS NOT NULL) AS keys
  FROM (SELECT row_id, url, {_key_sql('url')} AS k FROM {_BOTH} WHERE url <> '')
), w(k, n) USING KEY (k) AS (
  SELECT '', CAST(0 AS BIGINT)
  UNION
  SELECT * FROM (
    SELECT '' AS k, w.n + 1 AS n FROM w WHERE w.k = '' AND w.n < (SELECT count(*) FROM r)
    UNION ALL
    SELECT unnest(r.keys), r.n FROM w JOIN r ON w.k = '' AND r.n = w.n + 1 WHERE NOT EXISTS (SELECT 1 FROM recurring.w t WHERE t.k = r.keys[1] OR t.k = r.keys[2]))
)
SELECT row_id FROM r JOIN w ON w.k = r.keys[1] AND w.n = r.n UNION ALL SELECT row_id FROM {_BOTH} WHERE coalesce(url, '') = ''""")
def greedy_new_urls(spark: SparkSession, folder: str) -> DataFrame:
    rows = job_rows(spark, folder, "row_id", "url").withColumn("keys", url_match_keys(F.col("url")))
    return workqueue.greedy_urls(rows.select("row_id", "keys"), "row_id", "keys").select("row_id")


@_query(f"""
SELECT row_id FROM {_BOTH} WHERE coalesce(first_seen_date, '') >= (SELECT coalesce(max(first_seen_date), '') FROM job_details WHERE archive_status = 'failed')""")
def high_water(spark: SparkSession, folder: str) -> DataFrame:
    mark = workqueue.high_water(table(spark, folder, "job_details").where("archive_status = 'failed'"))
    rows = job_rows(spark, folder, "row_id", "first_seen_date").join(F.broadcast(mark), F.expr("true"))
    return predicates.at_or_above(rows, "first_seen_date", F.col("mark")).select("row_id")


_MARK = "CAST((event_id * 7919) % 100000 AS VARCHAR)"


@_query(f"""
SELECT event_id, coalesce(max(lpad({_MARK}, 6, '0')) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS mark FROM events""")
def running_mark(spark: SparkSession, folder: str) -> DataFrame:
    date = F.lpad((F.col("event_id") * 7919 % 100000).cast("string"), 6, "0")
    rows = table(spark, folder, "events").select("event_id", date.alias("d"))
    return workqueue.running_mark(rows, "event_id", "d").select("event_id", "mark")


@_query(f"""
WITH RECURSIVE e AS (SELECT event_id, lpad({_MARK}, 6, '0') AS d, CAST(user_id AS VARCHAR) AS u FROM events),
w(event_id, d, taken) AS (
  SELECT CAST(-1 AS BIGINT), '', CAST([] AS VARCHAR[])
  UNION ALL
  SELECT x.event_id, x.d, list_append(x.taken, x.u) FROM (
    SELECT e.event_id, e.d, e.u, w.taken, row_number() OVER (ORDER BY e.event_id) AS n
    FROM w JOIN e ON e.event_id > w.event_id AND e.d >= w.d WHERE NOT list_contains(w.taken, e.u)) x WHERE x.n = 1
)
SELECT event_id FROM w WHERE event_id >= 0""")
def fold_mark(spark: SparkSession, folder: str) -> DataFrame:
    date = F.lpad((F.col("event_id") * 7919 % 100000).cast("string"), 6, "0")
    rows = table(spark, folder, "events").select("event_id", date.alias("d"), F.col("user_id").cast("string").alias("u"))
    return workqueue.fold_mark(rows, "event_id", "d", "u").select("event_id")


@_query("SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def queue_head(spark: SparkSession, folder: str) -> DataFrame:
    return workqueue.head(table(spark, folder, "orders"), workqueue.PER_RUN, "o_orderdate", "o_orderkey").select("o_orderkey")


@_query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5)")
def queue_rest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    done = workqueue.head(orders, workqueue.PER_RUN, "o_orderdate", "o_orderkey")
    return workqueue.rest(orders, done, "o_orderkey").select("o_orderkey")


@_query("""
SELECT id, CAST(CASE WHEN e > 0 THEN e + 1 ELSE 0 END AS BIGINT) AS attempts FROM (
  SELECT CAST(user_id AS VARCHAR) || strftime(ts, '-%Y-%m-%d') AS id, count(*) FILTER (WHERE event_type = 'error') AS e FROM events GROUP BY 1)
WHERE CASE WHEN e > 0 THEN e + 1 ELSE 0 END < 3""")
def retry_counter(spark: SparkSession, folder: str) -> DataFrame:
    """Items are a user's days; those with errors failed once more than they had errors."""
    events = table(spark, folder, "events").withColumn("id", F.concat(F.col("user_id").cast("string"), F.date_format("ts", "-yyyy-MM-dd")))
    queue = events.groupBy("id").agg(F.count_if(F.col("event_type") == "error").cast("string").alias("archive_attempts"))
    failed = events.where("event_type = 'error'").select("id")
    return workqueue.retried(queue, failed).select("id", F.col("archive_attempts").cast("long").alias("attempts"))


@_query("""
SELECT detail_id,
  CASE WHEN archive_source = 'live' THEN 'live' WHEN archive_url LIKE '%0' THEN 'first' WHEN archive_url LIKE '%5' THEN 'second' ELSE 'none' END AS archive_source,
  CASE WHEN archive_source = 'live' OR archive_url LIKE '%0' OR archive_url LIKE '%5' THEN 'success' ELSE 'failed' END AS archive_status,
  CASE WHEN coalesce(archive_source, '') <> 'live' AND (archive_url LIKE '%0' OR archive_url LIKE '%5') THEN archive_url ELSE '' END AS archive_url
FROM job_details""")
def first_success(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("archive_url")
    tried = [("live", F.col("archive_source") == "live", F.lit("")), ("first", url.endswith("0"), url), ("second", url.endswith("5"), url)]
    return table(spark, folder, "job_details").select("detail_id", workqueue.first_success(tried).alias("r")).select("detail_id", "r.*")


@_query("""
SELECT id, arg_max(status, detail_id) AS status, arg_max(archive_status, detail_id) AS archive_status, min(detail_id) AS pos
FROM job_details WHERE id <> '' GROUP BY id""")
def upsert_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    return last_wins(table(spark, folder, "job_details").select("id", "status", "archive_status", F.col("detail_id").alias("pos")))


@_query("""
SELECT d.detail_id, CASE WHEN d.raw_text IS NULL OR d.raw_text = '' THEN coalesce(o.t, d.raw_text) ELSE d.raw_text END AS raw_text
FROM job_details d LEFT JOIN (SELECT id, max(raw_text) AS t FROM job_details WHERE raw_text <> '' GROUP BY id) o ON o.id = d.id""")
def restore_text(spark: SparkSession, folder: str) -> DataFrame:
    details = table(spark, folder, "job_details").select("id", "detail_id", "raw_text")
    return ledger.restore_text(details, details).select("detail_id", "raw_text")


_FLAG = "EXISTS (SELECT 1 FROM excluded_jobs x WHERE x.id = d.id)"


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.flagged(table(spark, folder, "job_details"), table(spark, folder, "excluded_jobs"))


@_query(f"""
SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(category, '') = '' AND NOT {_FLAG}) AS unclassified,
  count(*) FILTER (WHERE archive_status = 'failed') AS archive_failed, CAST(0 AS BIGINT) AS scrape_issues,
  count(*) FILTER (WHERE archive_url <> '') AS archived FROM job_details d""")
def review_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return review.kpis(_flagged(spark, folder))


@_query(f"""
SELECT detail_id FROM job_details d WHERE NOT {_FLAG} AND archive_status = 'success' AND coalesce(category, '') = ''
AND (coalesce(regexp_matches(company_name, '(?i)health|law'), false) OR coalesce(regexp_matches(title, '(?i)health|law'), false))""")
def review_filter(spark: SparkSession, folder: str) -> DataFrame:
    return review.review(_flagged(spark, folder), exclusion="hide", category="Unclassified", archive="success", text="health|law").select("detail_id")


@_query(f"SELECT detail_id FROM job_details d WHERE {_FLAG} AND category = 'Other'")
def review_only_excluded(spark: SparkSession, folder: str) -> DataFrame:
    return review.review(_flagged(spark, folder), exclusion="only", category="Other").select("detail_id")


@_query("SELECT detail_id, CASE WHEN detail_id % 7 = 0 THEN '' WHEN detail_id % 7 = 1 THEN 'Other' ELSE category END AS category FROM job_details")
def apply_category_edits(spark: SparkSession, folder: str) -> DataFrame:
    details = table(spark, folder, "job_details").select("detail_id", "category")
    edits = details.where("detail_id % 7 in (0, 1)").select("detail_id", F.when(F.col("detail_id") % 7 == 0, "").otherwise("Other").alias("category"))
    return ledger.apply_edits(details, edits, "category", "detail_id")


@_query("""
SELECT id, reason FROM excluded_jobs UNION ALL
SELECT id, min(archive_status) FROM job_details d WHERE id <> '' AND archive_status = 'failed' AND NOT EXISTS (SELECT 1 FROM excluded_jobs x WHERE x.id = d.id) GROUP BY id""")
def append_exclusions(spark: SparkSession, folder: str) -> DataFrame:
    failed = table(spark, folder, "job_details").where("archive_status = 'failed'").select("id", F.col("archive_status").alias("reason"))
    return ledger.append_exclusions(table(spark, folder, "excluded_jobs").select("id", "reason"), failed)


@_query("SELECT seq, coalesce(n, 0) AS rows, coalesce(blank, 0) AS blank FROM manifest JOIN (SELECT first_seen_commit AS sha, count(*) AS n, count(*) FILTER (WHERE coalesce(url, '') = '') AS blank FROM nyc_jobs GROUP BY 1) USING (sha)")
def per_snapshot_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "nyc_jobs").select("first_seen_commit", "url")
    placed = rows.join(table(spark, folder, "manifest"), F.col("first_seen_commit") == F.col("sha"))
    return counts_per_snapshot(placed, {"blank": "coalesce(url, '') = ''"})


@_query("""
SELECT company_name, title, CASE WHEN json_valid(terms) AND terms LIKE '[%]' THEN array_to_string(CAST(terms AS VARCHAR[]), ' | ') ELSE terms END AS recruiting_season,
  date_posted, first_seen_date, url, id, row_number() OVER (ORDER BY first_seen_date NULLS FIRST, company_name NULLS FIRST, title NULLS FIRST, id NULLS FIRST, row_id) - 1 AS n FROM remote_jobs""")
def export_order(spark: SparkSession, folder: str) -> DataFrame:
    """Rows alike in the whole order come in order of arrival, so that their place is defined."""
    return workqueue.positions(job_export(table(spark, folder, "remote_jobs"), "row_id"), "n")


@_query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey) - 1 AS n FROM orders")
def stable_desc(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return workqueue.positions(newest_first(rows, "day", "o_orderkey"), "n")


@_query("""
SELECT 'INSERT INTO details VALUES (' || concat_ws(', ', coalesce('''' || replace(id, '''', '''''') || '''', 'NULL'), coalesce('''' || replace(company_name, '''', '''''') || '''', 'NULL'),
  coalesce('''' || replace(raw_text, '''', '''''') || '''', 'NULL')) || ');' AS line FROM job_details""")
def sql_literals(spark: SparkSession, folder: str) -> DataFrame:
    return insert_statements(table(spark, folder, "job_details"), "details", ("id", "company_name", "raw_text"))


@_query("SELECT p_partkey, '''' || replace(p_name, '''', '''''') || '''' AS literal FROM part")
def part_literals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", sql_literal(F.col("p_name")).alias("literal"))


@_query(r"SELECT detail_id FROM job_details WHERE archive_url <> '' AND NOT regexp_matches(coalesce(raw_text, ''), '\S') ORDER BY detail_id LIMIT 10")
def backfill_batch(spark: SparkSession, folder: str) -> DataFrame:
    return workqueue.head(predicates.lacks_text(table(spark, folder, "job_details")), 10, "detail_id").select("detail_id")


@_query(r"SELECT id, raw_text FROM job_details WHERE archive_url <> '' AND regexp_matches(raw_text, '\S')")
def archived_texts(spark: SparkSession, folder: str) -> DataFrame:
    return text_rows(table(spark, folder, "job_details"))


@_query("SELECT detail_id FROM job_details WHERE archive_status = 'failed' ORDER BY first_seen_date DESC NULLS LAST, detail_id DESC LIMIT 5")
def failed_tail(spark: SparkSession, folder: str) -> DataFrame:
    return review.failed_tail(table(spark, folder, "job_details"), 5, "first_seen_date", "detail_id").select("detail_id")


@_query(f"SELECT tbl, count(*) AS rows, count(DISTINCT id) AS ids FROM {_BOTH} GROUP BY tbl")
def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _jobs(spark, folder, "id").groupBy("tbl").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids"))


@_query(r"SELECT DISTINCT lower(regexp_replace(sha, '\s+', '', 'g')) AS sha FROM done_commits WHERE regexp_matches(sha, '\S')")
def done_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "done_commits").select(norm_sha(F.col("sha")).alias("sha")).where("sha is not null").distinct()


@_query(r"SELECT doc_id, regexp_replace(company_name, '^\s+|\s+$', '', 'g') AS company_name FROM documents")
def stripped_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", strip(F.col("company_name")).alias("company_name"))


@_query("SELECT row_id, CAST(0 AS BIGINT) AS pos, id, title, url FROM remote_jobs WHERE row_id % 7 <> 0")
def payload_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written as one-element payloads, every seventh cut short and so refused."""
    text = F.concat(F.lit(" ["), F.to_json(F.struct("id", "title", "url")), F.when(F.col("row_id") % 7 == 0, "").otherwise("]\n"))
    parsed = parse_payload(table(spark, folder, "remote_jobs").select("row_id", text.alias("payload")))
    return explode_postings(parsed).select("row_id", F.col("pos").cast("long").alias("pos"), "id", "title", "url")


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nyc_jobs").where(F.col("terms").rlike(r"(?s)^\[.*\]$")).select(
        F.col("row_id").alias("seq"), F.lit(0).alias("pos"), "id", "company_name", "title", F.array("source").alias("locations"),
        F.from_json("terms", F.lit("array<string>")).alias("terms"), "date_posted", "url", "source",
        F.col("first_seen_date").alias("commit_date"), F.col("first_seen_commit").alias("sha"),
    )


_LISTED = "nyc_jobs WHERE json_valid(terms) AND terms LIKE '[%]'"


@_query(f"""
SELECT row_id AS seq, id, coalesce(company_name, '') AS company_name, coalesce(title, '') AS title, CAST(to_json(CAST(terms AS VARCHAR[])) AS VARCHAR) AS terms,
  coalesce(date_posted, '') AS date_posted, first_seen_date, coalesce(url, '') AS url, coalesce(source, '') AS source, first_seen_commit FROM {_LISTED}""")
def full_rows(spark: SparkSession, folder: str) -> DataFrame:
    return predicates.full_row(_postings(spark, folder)).drop("pos", "locations")


@_query(rf"""
SELECT row_id AS seq, id, regexp_replace(coalesce(company_name, ''), '^{_SPACE}+|{_SPACE}+$', '', 'g') AS company_name,
  regexp_replace(coalesce(title, ''), '^{_SPACE}+|{_SPACE}+$', '', 'g') AS title, array_to_string(CAST(terms AS VARCHAR[]), ' | ') AS recruiting_season,
  coalesce(date_posted, '') AS date_posted, first_seen_date, coalesce(url, '') AS url, 'listing' AS source FROM {_LISTED}""")
def update_rows(spark: SparkSession, folder: str) -> DataFrame:
    return predicates.update_row(_postings(spark, folder), "listing").drop("pos", "locations")


@_query("""
SELECT row_id, contains(lower(source), 'new york') OR contains(lower(source), 'nyc') OR contains(lower(title), 'new york') OR contains(lower(title), 'nyc') AS nyc,
  contains(lower(source), 'remote') AND contains(lower(title), 'remote') AS remote
FROM (SELECT row_id, coalesce(source, '') AS source, coalesce(title, '') AS title FROM nyc_jobs)""")
def location_classes(spark: SparkSession, folder: str) -> DataFrame:
    places = F.array("source", "title")
    return table(spark, folder, "nyc_jobs").select("row_id", predicates.is_nyc(places).alias("nyc"), predicates.is_remote(places).alias("remote"))


@_query("""
SELECT CASE WHEN p_partkey % 2 = 0 THEN p_partkey ELSE p_partkey + 1000000 END AS id, upper(p_name) AS p_name, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS p_brand
FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey % 6 <> 0""")
def upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Every third part comes anew, half of them under a new key; the brand isn't delivered and stays."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand")
    rows = part.where("id % 3 = 0").select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + 1000000).alias("id"), F.upper("p_name").alias("p_name"))
    return ledger.upsert(part, rows, keep=("p_brand",))


@_query("""
SELECT d.detail_id, coalesce(k.category, 'none') AS category FROM job_details d
LEFT JOIN (SELECT id, max(category) AS category FROM job_details WHERE archive_status = 'success' GROUP BY id) k ON k.id = d.id""")
def keep_known(spark: SparkSession, folder: str) -> DataFrame:
    details = table(spark, folder, "job_details")
    return ledger.keep_known(details.select("detail_id", "id"), details.where("archive_status = 'success'"), {"category": "none"}).select("detail_id", "category")


@_query("""
SELECT s_name AS id, s_suppkey AS pos FROM supplier
UNION ALL SELECT c_name, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_acctbal, c_custkey) FROM customer""")
def enqueue(spark: SparkSession, folder: str) -> DataFrame:
    queue = table(spark, folder, "supplier").select(F.col("s_name").alias("id"), F.col("s_suppkey").alias("pos"))
    rows = table(spark, folder, "customer").select(F.col("c_name").alias("id"), "c_acctbal", "c_custkey")
    return workqueue.enqueue(queue, rows, ("c_acctbal", "c_custkey"))


@_query("SELECT seq, CAST(floor((row_number() OVER (ORDER BY seq) - 1) / 40) AS BIGINT) AS chunk FROM manifest")
def commit_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunks(table(spark, folder, "manifest").select("seq"), 40)


@_query("SELECT id, company_name, title, job_url, archive_status, first_seen_date FROM job_details WHERE archive_status = 'failed' OR archive_status = 'pending'")
def failure_list(spark: SparkSession, folder: str) -> DataFrame:
    return review.failures(table(spark, folder, "job_details"), "failed", "pending")


@_query("SELECT detail_id, id, category FROM job_details")
def details_download(spark: SparkSession, folder: str) -> DataFrame:
    return review.download(_flagged(spark, folder).select("detail_id", "id", "category", "excluded"))


_NINE = ("id", "company_name", "reason", "blocked_title", "blocked_company", "blocked_date", "job_url", "archive_url", "note")


@_query("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _NINE[:-1]) + ", '' AS note FROM excluded_jobs")
def exclusions_download(spark: SparkSession, folder: str) -> DataFrame:
    return review.exclusions_download(table(spark, folder, "excluded_jobs"), _NINE)


@_query("SELECT doc_id, coalesce(text, '') AS text, coalesce(title, '') AS title FROM documents")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "title")
    path = write_csv(rows, scratch_path(spark, "csv"))
    return read_csv(spark, path, ("doc_id", "text", "title")).withColumn("doc_id", F.col("doc_id").cast("long"))


@_query("SELECT doc_id, text FROM documents")
def jsonl_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    path = write_jsonl(rows, scratch_path(spark, "jsonl"))
    return read_jsonl(spark, path, ("doc_id", "text")).withColumn("doc_id", F.col("doc_id").cast("long"))


_QUOTED = ", ".join(f"coalesce('''' || replace({c}, '''', '''''') || '''', 'NULL')" for c in JOBS_FULL)


@_query(f"""
SELECT 0 AS part, '-- postings' AS line UNION ALL SELECT 1, '-- Generated: 2025-01-01' UNION ALL SELECT 2, 'BEGIN TRANSACTION;'
UNION ALL SELECT 3, 'CREATE TABLE remote_jobs (id TEXT PRIMARY KEY, {', '.join(f'{c} TEXT' for c in JOBS_FULL[1:])});'
UNION ALL SELECT 4, 'INSERT INTO remote_jobs VALUES (' || concat_ws(', ', {_QUOTED}) || ');' FROM remote_jobs
UNION ALL SELECT 5, '-- ' || format('{{:,}}', count(*)) || ' rows in remote_jobs' FROM remote_jobs UNION ALL SELECT 6, 'COMMIT;'""")
def sql_dump_lines(spark: SparkSession, folder: str) -> DataFrame:
    return sql_dump({"remote_jobs": table(spark, folder, "remote_jobs")}, JOBS_FULL, "postings", "2025-01-01").select("part", "line")


@_query(r"""
WITH have AS (SELECT id FROM job_details WHERE archive_url <> '' AND regexp_matches(raw_text, '\S')),
missing AS (SELECT DISTINCT id FROM job_details WHERE archive_url <> '' AND id IS NOT NULL AND id NOT IN (SELECT id FROM have WHERE id IS NOT NULL)),
batch AS (SELECT id FROM missing ORDER BY id LIMIT 10),
got AS (SELECT id FROM batch WHERE id IN (SELECT job_id FROM documents WHERE regexp_matches(text, '\S')))
SELECT (SELECT count(*) FROM got) AS filled, (SELECT count(*) FROM missing) - (SELECT count(*) FROM got) AS remaining""")
def backfill_counts(spark: SparkSession, folder: str) -> DataFrame:
    details = table(spark, folder, "job_details").where("id is not null")
    fetched = table(spark, folder, "documents").groupBy(F.col("job_id").alias("id")).agg(F.max("text").alias("raw_text"))
    return backfill(details.select("id", "archive_url"), text_rows(details), fetched)["counts"]
