"""Checking new batches for duplicates against everything accepted before.

Records are one posting if they share an identity: the id, or the posting
their URL leads to.  A record so has two bands of one feature each, and the
minimum hash over a band's only feature is that feature's hash: a band key is a
128-bit hash of the identity, and equal keys are equal identities, so there is
no similarity below 1 left to verify.  (Similar requisition numbers are
different postings; shingles of them would only add candidates.)

The keys are stored in an index of hash buckets, sorted inside.  A batch is
laid out in the same buckets, so that it alone is moved and the history stays
where it is; a small batch reads only the buckets and row groups its keys can
be in.  Of each key the record accepted first is kept, of each batch the keys
it was the first to have are appended.  Postings that a later record ties are
merged in a map of its own, which holds tied records only.  The records
themselves are never read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.functions.text import norm_id
from jobstrata.llm.addresses import posting_key, url_parts
from jobstrata.operators.components import components
from jobstrata.session import delete_path, list_names, materialize, path_exists, release, scratch_path
from jobstrata.sources.buckets import BucketStore
from jobstrata.sources.tables import job_rows

#: Up to so many identities of a batch are sent along with the scan of the
#: index, which then reads only what can hold them (the rows found are the same).
PROBE = 4000
#: Batches that the query feeds one after the other.
BATCHES = 3

_PLACES = "row_id long, a long, b long"
_TIES = "node long, root long"


def identities(rows: DataFrame, *keep: str) -> DataFrame:
    """``row_id, key`` (and ``keep``): up to two rows for each of ``rows(row_id, id, url)``.

    A blank id or URL, or one of a careers page in general, gives no identity.
    """
    parts = url_parts(rows.select("row_id", "id", "url", *keep), "url")
    own = F.concat(F.lit("i "), norm_id(F.col("id")))
    led = F.concat(F.lit("u "), posting_key(F.col("_host"), F.col("_path"), F.col("_query")))
    flat = parts.select("row_id", *keep, F.explode(F.array_compact(F.array(own, led))).alias("_token"))
    return flat.select("row_id", *keep, F.unhex(F.md5(F.encode("_token", "UTF-8"))).alias("key"))


class History:
    """Index of the identities of all accepted records, below one folder.

    Batches are numbered; a batch that is accepted again replaces its own
    output, so a run that was broken off can be repeated.  The number of
    buckets is set when the first batch comes (the session's shuffle
    partitions, if it isn't given) and stays.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None) -> None:
        self.spark, self.folder = spark, folder
        self.index = BucketStore(spark, f"{folder}/index", "key binary, first_row_id long", buckets)

    def _parts(self, what: str, below: int | None = None) -> list[str]:
        home = f"{self.folder}/{what}"
        names = [n for n in list_names(self.spark, home) if n.startswith("batch=") and (below is None or int(n[6:]) < below)]
        return [f"{home}/{n}" for n in names if path_exists(self.spark, f"{home}/{n}/_SUCCESS")]

    def accept(self, batch: int, rows: DataFrame) -> DataFrame:
        """Take in one batch of ``row_id, id, url``; see :meth:`accept_identities`."""
        mine = materialize(identities(rows), "identities")
        out = self.accept_identities(batch, mine)
        release(mine)
        return out

    def accept_identities(self, batch: int, mine: DataFrame) -> DataFrame:
        """Take in one batch of stored ``row_id, key``; ``row_id, a, b`` of its rows.

        ``a`` and ``b`` are the smallest and largest of the rows that were the
        first to have an identity of the row (often the row itself).
        """
        own = mine.groupBy("key").agg(F.min("row_id").alias("_own"))
        with self.index.table(batch) as stored:
            if mine.count() <= PROBE:
                stored = stored.where(F.col("key").isin([r.key for r in mine.select("key").distinct().collect()]))
            met = own.hint("shuffle_hash").join(stored, "key", "left")
            firsts = met.select("key", F.coalesce("first_row_id", "_own").alias("first_row_id"), F.col("first_row_id").isNull().cast("int").alias("live"))
            home = self.index.write(batch, firsts)
        firsts = self.spark.read.schema("key binary, first_row_id long").parquet(home)
        places = mine.join(firsts, "key").groupBy("row_id").agg(F.min("first_row_id").alias("a"), F.max("first_row_id").alias("b"))
        out = f"{self.folder}/accepted/batch={batch:06d}"
        places.write.mode("overwrite").parquet(out)
        placed = self.spark.read.schema(_PLACES).parquet(out)
        self._tie(batch, placed.where("a != b").select("a", "b"))
        return placed

    def ties(self, below: int | None = None) -> DataFrame:
        """``node, root``: records that were first apart from ``root`` and are tied to it by a later one."""
        parts = self._parts("ties", below)
        return self.spark.read.schema(_TIES).parquet(parts[-1]) if parts else self.spark.createDataFrame([], _TIES)

    def _tie(self, batch: int, pairs: DataFrame) -> None:
        """Merge what the batch's ``a, b`` tie into the map as it was before the batch."""
        old = self.ties(batch)
        a, b = (old.select(F.col("node").alias(f"_{x}"), F.col("root").alias(f"_r{x}")) for x in "ab")
        now = pairs.distinct().join(a, F.col("a") == F.col("_a"), "left").join(b, F.col("b") == F.col("_b"), "left")
        merged = components(now.select(F.coalesce("_ra", "a").alias("u"), F.coalesce("_rb", "b").alias("v")))
        moved = old.join(merged.select(F.col("node").alias("_n"), F.col("root").alias("_r")), F.col("root") == F.col("_n"), "left")
        new = moved.select("node", F.coalesce("_r", "root").alias("root")).unionByName(merged)
        new.write.mode("overwrite").parquet(f"{self.folder}/ties/batch={batch:06d}")
        release(merged)

    def compact(self, upto: int) -> None:
        """Merge the index of the batches up to ``upto``, which then can't be accepted again."""
        self.index.compact(upto)

    def accepted(self) -> DataFrame:
        parts = self._parts("accepted")
        return self.spark.read.schema(_PLACES).parquet(*parts) if parts else self.spark.createDataFrame([], _PLACES)

    def repeats(self) -> DataFrame:
        """``first_row_id, row_id`` of every row that isn't the first of its posting."""
        return (
            self.accepted().select("row_id", "a").join(self.ties(), F.col("a") == F.col("node"), "left")
            .select(F.coalesce("root", "a").alias("first_row_id"), "row_id").where("first_row_id != row_id")
        )


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = job_rows(spark, folder, "row_id", "id", "url")
    span = rows.agg(F.min("row_id"), F.max("row_id")).first()
    history = History(spark, scratch_path(spark, "history"))
    if span[0] is None:
        return history.repeats()
    width = (span[1] - span[0]) // BATCHES + 1
    # Addresses are read once, and the identities laid out by batch.
    arrived = scratch_path(spark, "arrived")
    identities(rows.withColumn("batch", F.expr(f"(row_id - {span[0]}) div {width}")), "batch").write.partitionBy("batch").parquet(arrived)
    for k in range(BATCHES):
        if path_exists(spark, f"{arrived}/batch={k}"):
            history.accept_identities(k, spark.read.schema("row_id long, key binary").parquet(f"{arrived}/batch={k}"))
    delete_path(spark, arrived)
    return history.repeats()


def _sql() -> str:
    """The same rows in SQL: addresses read alike, smallest rows spread over shared identities until nothing changes."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(8203)"
    uuid = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    number = "(?:req[-_]?|jr[-_]?|r[-_]|job[-_]?)?[0-9]{4,}"
    target = r"(?i)^(?:https?:)?//[^/?#]+/[^?#]*\?(?:[^#]*&)?[^=&#]+=((?:https?(?:%3a|:))?(?:%2f|/){2}[^&#]+)"
    steps = [
        f"a0 AS (SELECT row_id, nullif(lower(trim(id, {blank} || '{{}}')), '') AS i, coalesce(trim(url, {blank}), '') AS u "
        "FROM (SELECT row_id, id, url FROM nyc_jobs UNION ALL SELECT row_id, id, url FROM remote_jobs))"
    ]
    for k in range(3):
        got = f"regexp_extract(u, '{target}', 1)"
        steps.append(f"a{k + 1} AS (SELECT row_id, i, CASE WHEN {got} <> '' THEN url_decode({got}) ELSE u END AS u FROM a{k})")
    steps += [
        f"b AS (SELECT row_id, i, lower(trim(url_decode(url_decode(u)), {blank})) AS u FROM a3)",
        "c AS (SELECT row_id, i, split_part(regexp_replace(u, '^(?:https?:)?//', ''), '#', 1) AS u FROM b)",
        r"d AS (SELECT row_id, i, regexp_extract(u, '^(?:www\.)?([^/?#:;]+)', 1) AS host, "
        r"regexp_replace(rtrim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), ';[^/?]*', '', 'g'), "
        r"'/{2,}', '/', 'g'), '/[a-z]{2}(?:-[a-z]{2})?/', '/', 'g'), '/'), '/apply$', '') AS path, "
        r"trim(regexp_replace(regexp_extract(u, '\?(.*)$', 1), "
        r"'(?:^|&)(?:utm_\w+|gh_src|fbid|fbclid|gclid|trk|ref|src|source|lang|locale|page|c|mc_\w+|sessionid)=[^&]*', '', 'g'), '&?/') AS query FROM c)",
        f"e AS (SELECT *, regexp_extract(query, '(?:^|&)[^=&]*=({uuid}|{number})(?:&|$)', 1) AS asked, regexp_extract(path, '_({number})$', 1) AS named, "
        f"regexp_extract(path, '/(?:{uuid}|{number})(?:/[a-z]+)?$') AS closing FROM d)",
        "f AS (SELECT row_id, i, CASE WHEN asked <> '' THEN concat_ws(' ', host, split_part(ltrim(path, '/'), '/', 1), asked) WHEN named <> '' THEN concat_ws(' ', host, named) "
        "WHEN closing <> '' THEN concat_ws(' ', host, left(path, length(path) - length(closing)), split_part(ltrim(closing, '/'), '/', 1)) END AS p FROM e)",
        "g AS (SELECT row_id, 'i' || i AS k FROM f WHERE i IS NOT NULL UNION ALL SELECT row_id, 'u' || p FROM f WHERE p IS NOT NULL)",
        "l(row_id, l) USING KEY (row_id) AS (SELECT DISTINCT row_id, row_id FROM g UNION "
        "SELECT g.row_id, min(m.m) FROM g JOIN (SELECT g.k, min(c.l) AS m FROM g JOIN recurring.l c USING (row_id) GROUP BY g.k) m USING (k) "
        "JOIN recurring.l c ON c.row_id = g.row_id GROUP BY g.row_id HAVING min(m.m) < min(c.l))",
    ]
    return f"WITH RECURSIVE {', '.join(steps)} SELECT l AS first_row_id, row_id FROM l WHERE l <> row_id"


P1_SQL = _sql()
