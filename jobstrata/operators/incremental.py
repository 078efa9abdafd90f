"""Processing only new or changed input, exactly once.

A *unit* is whatever arrives as a whole; here it is a file.  A manifest table
records every unit that a finished run has taken, with its size and checksum
and the number of the run.  A run

1. lists the input,
2. anti-joins the listing against the manifest,
3. writes the result under a batch identifier that follows from the pending
   units alone, so that a repeated run overwrites its own output,
4. commits the units to the manifest as the last step.

A run that dies before step 4 leaves nothing that readers can see, because
:func:`read_batches` takes only batches whose manifest entry is complete; the
next run finds the same pending units and the same identifier.  A unit that
changed is taken anew, and what earlier runs made of it is dropped.

:func:`next_run` keeps a state table of what it has read (key, position, hash
of the record), so that rows of new files find the rows before them without
the older files being read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobstrata.functions.text import instant, norm_id, norm_sha
from jobstrata.session import list_names, materialize, path_exists
from jobstrata.sources.buckets import BucketStore

UNIT_SCHEMA = "unit string, size long, checksum long"
MANIFEST_SCHEMA = UNIT_SCHEMA + ", batch string, run long"
#: Rows of one record are compared in blocks of at most this many row ids.
BLOCK = 1 << 16


def _path(c: Column) -> Column:
    """One spelling of a file's path: without escapes, local ones with a single slash."""
    plain = F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    return F.regexp_replace(plain, r"^file:/+", "file:/")


def list_files(spark: SparkSession, path: str, *, content: bool = True, glob: str = "*") -> DataFrame:
    """``unit, size, checksum`` of each file below ``path``.

    With ``content`` the checksum is a hash of the bytes; without it, of size
    and modification time, which reads no data.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )
    checksum = F.xxhash64("content") if content else F.xxhash64("length", "modificationTime")
    return files.select(F.regexp_replace("path", r"^file:/+", "file:/").alias("unit"), F.col("length").alias("size"), checksum.alias("checksum"))


def pending_units(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Units of ``listing`` that the manifest doesn't hold with this size and checksum.

    A manifest row without size or checksum (kept by hand) matches by name.
    Repeated or null manifest rows are harmless; null units never match.
    """
    seen = manifest.select(
        F.col("unit").alias("_u"), F.col("size").alias("_s"), F.col("checksum").alias("_c")
    ).distinct()
    same = (
        (listing["unit"] == seen["_u"])
        & (seen["_s"].isNull() | (seen["_s"] == listing["size"]))
        & (seen["_c"].isNull() | (seen["_c"] == listing["checksum"]))
    )
    return listing.join(seen, same, "left_anti")


def batch_id(pending: DataFrame) -> str | None:
    """Identifier that depends only on the pending units; None if there are none."""
    row = pending.agg(
        F.count("*").alias("n"),
        F.expr("bit_xor(xxhash64(unit, size, checksum))").alias("x"),
    ).first()
    return f"{row.n:x}-{row.x & (2**64 - 1):016x}" if row.n else None


def _finished(spark: SparkSession, manifest: str) -> list[str]:
    return [
        f"{manifest}/{b}" for b in list_names(spark, manifest)
        if b.startswith("batch=") and path_exists(spark, f"{manifest}/{b}/_SUCCESS")
    ]


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Committed units; a batch without its success marker isn't committed."""
    done = _finished(spark, manifest)
    if not done:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(*done)


def superseded(units: DataFrame) -> DataFrame:
    """``batch, unit`` of manifest rows whose unit a later run has taken again."""
    last = units.groupBy("unit").agg(F.max("run").alias("_last"))
    return units.join(last, "unit").where("run < _last").select("batch", "unit").distinct()


def read_batches(spark: SparkSession, out: str, manifest: str, schema: str) -> DataFrame:
    """Output of all committed batches, and of no other.

    Where the output has a column ``unit``, rows of a unit that a later run
    has taken again are left out.
    """
    done = [(d, f"{out}/{d.rsplit('/', 1)[1]}") for d in _finished(spark, manifest)]
    paths = [o for _, o in done if path_exists(spark, o)]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*paths)
    if "unit" in rows.columns:
        named = spark.read.schema(f"{schema}, batch string").option("basePath", out).parquet(*paths)
        rows = named.join(superseded(read_manifest(spark, manifest)), ["batch", "unit"], "left_anti").select(*rows.columns)
    return rows


def run_incremental(
    spark: SparkSession,
    listing: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    out: str,
    manifest: str,
    *,
    also_done: DataFrame | None = None,
) -> str | None:
    """One run: ``process(pending)`` is written under the batch identifier, then committed.

    ``also_done`` adds manifest rows kept elsewhere.  Returns the batch
    identifier, or None if there was nothing to do.
    """
    known = read_manifest(spark, manifest)
    if also_done is not None:
        known = known.unionByName(also_done, allowMissingColumns=True)
    pending = materialize(pending_units(listing, known), "pending")
    batch = batch_id(pending)
    if batch is None:
        return None
    process(pending).write.mode("overwrite").parquet(f"{out}/batch={batch}")
    taken = pending.select("unit", "size", "checksum").withColumn("batch", F.lit(batch)).withColumn("run", F.lit(run_number(spark, manifest)).cast("long"))
    taken.coalesce(1).write.mode("overwrite").parquet(f"{manifest}/batch={batch}")
    return batch


def run_number(spark: SparkSession, manifest: str) -> int:
    """Number of the run that comes next."""
    return len(_finished(spark, manifest))


def resolve_shas(done: DataFrame, history: DataFrame) -> DataFrame:
    """Full names of the commits that a hand-kept list names.

    ``done(sha)`` may repeat a name, shorten it to no fewer than ten digits,
    change its letter case or surround it with white space; blanks and names
    of other branches resolve to nothing, and so does a short name that fits
    several commits.  ``history(sha)`` holds the full names.
    """
    short = done.select(norm_sha(F.col("sha")).alias("_d")).where(F.length("_d") >= 10).distinct()
    full = history.select(norm_sha(F.col("sha")).alias("unit")).where("unit is not null").distinct()
    hit = full.join(
        short,
        (F.substring("unit", 1, 10) == F.substring("_d", 1, 10)) & F.expr("startswith(unit, _d)"),
    )
    return (
        hit.groupBy("_d").agg(F.min("unit").alias("unit"), F.count("*").alias("n"))
        .where("n = 1").select("unit").distinct()
    )


def attach_commit(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Add ``_unit`` (commit name) and ``_seq`` to each row.

    The name is ``first_seen_commit``; where that is blank, the commit whose
    date is the same instant as ``first_seen_date``.  Commits missing from the
    history keep their name and sort last.  Two commits at one instant: the
    earlier ``seq`` stands.
    """
    h = history.select(
        norm_sha(F.col("sha")).alias("_hs"), F.col("seq").alias("_hq"), instant(F.col("commit_date")).alias("_ht")
    )
    by_name = h.groupBy("_hs").agg(F.min("_hq").alias("_q1"))
    by_time = h.where("_ht is not null").groupBy("_ht").agg(
        F.min_by("_hs", "_hq").alias("_s2"), F.min("_hq").alias("_q2")
    )
    named = rows.withColumn("_c", norm_sha(F.col("first_seen_commit"))).withColumn(
        "_t", F.when(F.col("_c").isNull(), instant(F.col("first_seen_date")))
    )
    return (
        named.join(by_name, named["_c"] == by_name["_hs"], "left")
        .join(by_time, named["_t"] == by_time["_ht"], "left")
        .withColumn("_unit", F.coalesce("_c", "_s2"))
        .withColumn("_seq", F.coalesce("_q1", "_q2", F.lit((1 << 62))))
        .drop("_hs", "_q1", "_ht", "_s2", "_q2", "_c", "_t")
    )


def changed_rows(rows: DataFrame, key: Column, order: tuple[str, str], state: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """``row_id, seq`` (and ``keep``) of rows that open their record or differ from the row before.

    ``key`` null drops the row.  Rows of a record lie in order of ``order``
    (a coarse position and a unique long).  A record may hold any share of all
    rows: neighbours are compared inside blocks of at most :data:`BLOCK` ids,
    and then the blocks' ends with each other, so no task gets a whole hot
    record.
    """
    seq, rid = order
    slim = rows.withColumn("_key", key).where("_key is not null").select(
        F.col("_key").alias("k"), F.col(seq).alias("s"), F.col(rid).alias("r"), state.alias("v"), F.struct(F.lit(0), *keep).alias("x")
    )
    slim = slim.withColumn("b", F.floor(F.col("r") / BLOCK)).repartition("k", "s", "b")
    inside = Window.partitionBy("k", "s", "b").orderBy("r")
    marked = slim.withColumn("p", F.lag(F.struct("v")).over(inside))
    later = marked.where("p is not null and p.v != v").select("r", "s", "x")
    ends = slim.groupBy("k", "s", "b").agg(
        F.min("r").alias("r"), F.min_by("v", "r").alias("first"), F.max_by("v", "r").alias("last"), F.min_by("x", "r").alias("x")
    )
    between = Window.partitionBy("k").orderBy("s", "b")
    opening = ends.withColumn("p", F.lag("last").over(between)).where("p is null or p != first").select("r", "s", "x")
    return opening.unionByName(later).select(F.col("r").alias(rid), F.col("s").alias(seq), *[F.col(f"x.{c}").alias(c) for c in keep])


#: Columns whose change makes a record changed.
TRACKED = ("company_name", "title", "terms", "date_posted", "url")


def posting_state(columns: tuple[str, ...] = TRACKED) -> Column:
    """Hash of the tracked columns as stored; null and the empty text are equal."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


#: Columns of the state table: the record, its rows' positions and hashes, the file they came in.
STATE = "key binary, seq long, commit string, row_id long, state long, file string, run long"


def placed_rows(rows: DataFrame, history: DataFrame) -> DataFrame:
    """``key, seq, commit, row_id, state, file`` of job rows with an id (and a column ``file``)."""
    at = attach_commit(rows, history).withColumn("_id", norm_id(F.col("id"))).where("_id is not null")
    return at.select(
        F.unhex(F.md5(F.encode("_id", "UTF-8"))).alias("key"), F.col("_seq").alias("seq"), F.col("_unit").alias("commit"),
        "row_id", posting_state().alias("state"), "file",
    )


def next_run(spark: SparkSession, path: str, history: DataFrame, done: DataFrame, home: str, *, content: bool = False) -> str | None:
    """Take the new and changed files below ``path``; the batch identifier, or None.

    Written are ``row_id, unit`` of those of their rows that add or change a
    posting record and whose commit isn't done (read them by :func:`taken`).
    ``history`` is ``seq, sha, commit_date``; ``done`` is the hand-kept ``sha``
    list.  Rows of done commits are taken into the state, so that later rows
    can be told from them.  Rows without an id are in no record, rows of no
    known commit belong to no run.
    """
    out, manifest = f"{home}/out", f"{home}/manifest"
    units = read_manifest(spark, manifest)
    run = run_number(spark, manifest)
    store = BucketStore(spark, f"{home}/state", STATE)

    def process(pending: DataFrame) -> DataFrame:
        # The file source keeps this list on the driver as well.
        files = [r.unit for r in pending.select("unit").collect()]
        rows = spark.read.parquet(*files).withColumn("file", _path(F.col("_metadata.file_path")))
        mine = materialize(placed_rows(rows, history).withColumn("run", F.lit(run).cast("long")), "placed")
        both = mine.withColumn("old", F.lit(False))
        with store.table(run) as known:
            if run:
                # Only the keys of the new rows are moved, not the state.
                keys = mine.groupBy("key").agg(F.first("run").alias("_any"))
                before = keys.join(known, "key").drop("_any")
                gone = superseded(units).join(units.select("batch", "unit", "run").distinct(), ["batch", "unit"]).select(F.col("unit").alias("file"), "run")
                before = before.join(gone, ["file", "run"], "left_anti").join(pending.select(F.col("unit").alias("file")), "file", "left_anti")
                both = both.unionByName(materialize(before.withColumn("old", F.lit(True)), "before"))
            store.write(run, mine.repartition(store.buckets, "key").withColumn("live", F.lit(1)))
        fresh = changed_rows(
            both.withColumn("at", F.struct("seq", "commit")), F.col("key"), ("at", "row_id"), F.col("state"), ("old", "file")
        ).where("not old").select("row_id", F.col("at.commit").alias("commit"), F.col("file").alias("unit"))
        finished = resolve_shas(done, history).select(F.col("unit").alias("commit"))
        return fresh.where("commit is not null").join(finished, "commit", "left_anti").select("row_id", "unit")

    listing = list_files(spark, path, content=content, glob="*.parquet")
    return run_incremental(spark, listing, process, out, manifest)


def taken(spark: SparkSession, home: str) -> DataFrame:
    """``row_id`` of the rows that the finished runs below ``home`` took, each once."""
    return read_batches(spark, f"{home}/out", f"{home}/manifest", "row_id long, unit string").select("row_id")
