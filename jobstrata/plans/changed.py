"""The query of the incremental operator, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobstrata.operators.incremental import next_run, taken
from jobstrata.session import scratch_path
from jobstrata.sources.tables import table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """``row_id`` of each row the next run takes.  An empty table gives no row."""
    home = scratch_path(spark, "next-run")
    next_run(spark, f"{folder.rstrip('/')}/nyc_jobs.parquet", table(spark, folder, "manifest"), table(spark, folder, "done_commits"), home)
    return taken(spark, home)


_BLANK = r"[\s\x{00a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"

P2_SQL = rf"""
WITH done AS (
  SELECT DISTINCT lower(regexp_replace(sha, '{_BLANK}+', '', 'g')) AS d FROM done_commits
), finished AS (
  SELECT min(m.sha) AS sha FROM manifest m JOIN done ON length(d) >= 10 AND starts_with(lower(m.sha), d)
  GROUP BY d HAVING count(*) = 1
), r AS (
  SELECT row_id,
    nullif(lower(regexp_replace(id, '^(?:{_BLANK}|[{{}}])+|(?:{_BLANK}|[{{}}])+$', '', 'g')), '') AS k,
    [coalesce(company_name, ''), coalesce(title, ''), coalesce(terms, ''), coalesce(date_posted, ''), coalesce(url, '')] AS v,
    nullif(lower(regexp_replace(first_seen_commit, '{_BLANK}+', '', 'g')), '') AS c,
    regexp_replace(trim(first_seen_date), ' UTC$', 'Z') AS t
  FROM nyc_jobs
), placed AS (
  SELECT r.row_id, r.k, r.v, coalesce(a.sha, b.sha) AS sha, coalesce(a.seq, b.seq) AS seq
  FROM r LEFT JOIN manifest a ON a.sha = r.c
  LEFT JOIN manifest b ON r.c IS NULL AND epoch_us(try_cast(b.commit_date AS TIMESTAMPTZ)) = epoch_us(try_cast(r.t AS TIMESTAMPTZ))
), w AS (
  SELECT *, lag(v) OVER (PARTITION BY k ORDER BY seq, row_id) AS p FROM placed WHERE k IS NOT NULL
)
SELECT row_id FROM w WHERE (p IS NULL OR p <> v) AND sha NOT IN (SELECT sha FROM finished)
"""
