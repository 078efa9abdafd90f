"""The work queue: high-water mark, enqueueing, first success, retries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.functions.text import filled
from jobstrata.operators.components import components
from jobstrata.session import materialize, release

#: Rows that share one prefix maximum.
CHUNK = 1 << 16
#: Rounds of joins before what is left of greedy matching is walked.
ROUNDS = 12
#: Work taken per run, and attempts until an item is dropped.
PER_RUN, ATTEMPTS = 5, 3


def high_water(details: DataFrame, date: str = "first_seen_date") -> DataFrame:
    """``mark``: the greatest text date, ``""`` for an empty table."""
    return details.agg(F.coalesce(F.max(date), F.lit("")).alias("mark"))


def running_mark(rows: DataFrame, order: str, date: str, floor: Column | str = "") -> DataFrame:
    """Add ``mark`` (the greatest date before the row, at least ``floor``) and ``passes``.

    ``order`` is a unique long.  Maxima are taken inside blocks of CHUNK orders
    and over the blocks' maxima, so no task sees all rows.  With dates that
    don't fall, the passing rows are those the sequential rule admits.
    """
    blocked = rows.withColumn("_b", F.floor(F.col(order) / CHUNK))
    tops = blocked.groupBy("_b").agg(F.max(date).alias("_top")).withColumn(
        "_before", F.max("_top").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_b", "_before")
    inside = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    base = F.lit(floor) if isinstance(floor, str) else floor
    return (
        blocked.withColumn("_in", F.max(date).over(inside)).join(tops, "_b")
        .withColumn("mark", F.greatest(F.coalesce("_in", base), F.coalesce("_before", base), base))
        .withColumn("passes", F.col(date) >= F.col("mark")).drop("_b", "_in", "_before")
    )


def fold_mark(rows: DataFrame, order: str, date: str, key: str, floor: str = "") -> DataFrame:
    """Rows that the sequential rule admits, for dates in any order.

    A row is admitted if its key isn't yet and its date isn't below the mark,
    which then rises to it.  ``order`` is a unique long.

    No serial pass is needed.  A row that is the first of its key among those
    still possible lifts the mark to its date at least, admitted or not; so
    what lies below the running maximum of such rows is impossible and drops
    out.  Once nothing more drops out, the admitted rows are just those first
    ones.  Dates that don't fall need one round; each round is a pre-aggregated
    grouping and the block maxima of :func:`running_mark`.
    """
    able = rows.where(F.coalesce(F.col(date), F.lit("")) >= floor).where(filled(F.col(key).cast("string")))
    left = materialize(able.select(F.col(order).alias("_o"), F.coalesce(date, F.lit("")).alias("_d"), F.col(key).alias("_k")), "marks")
    n = left.count()
    while n:
        firsts = left.groupBy("_k").agg(F.min("_o").alias("_o")).select("_o", F.lit(True).alias("_first"))
        placed = left.join(firsts, "_o", "left").withColumn("_lifts", F.when(F.col("_first"), F.col("_d")))
        marked = running_mark(placed, "_o", "_lifts", floor).where(F.col("_d") >= F.col("mark"))
        before, left = left, materialize(marked.select("_o", "_d", "_k"), "marks")
        release(before)
        last, n = n, left.count()
        if n == last:
            break
    admitted = left.groupBy("_k").agg(F.min("_o").alias("_o")).select("_o")
    return able.join(admitted, able[order] == admitted["_o"], "left_semi")


def greedy_urls(rows: DataFrame, order: str, keys: str) -> DataFrame:
    """Rows kept in order so that none shares a match key with a row kept before it.

    ``order`` is a unique long, ``keys`` holds the rows' match keys (array of
    text).  Greedy because matching isn't transitive; rows without keys are
    kept.  In rounds of joins: a row that is the first undecided one of each of
    its keys is kept, and the undecided rows that share a key with it drop out.
    Of a hot key all rows but one drop out in one round.  What more than
    ROUNDS rounds would take (long chains that alternate between keys) is
    walked in order, a component of tied rows at a time.
    """
    left = materialize(rows.select(F.col(order).alias("_o"), F.explode(F.array_distinct(keys)).alias("_key")), "undecided")
    kept: list[DataFrame] = []
    for _ in range(ROUNDS):
        if left.isEmpty():
            break
        lead = left.groupBy("_key").agg(F.min("_o").alias("_lead"))
        led = materialize(left.join(lead, "_key"), "led")
        first = led.groupBy("_o").agg(F.every(F.col("_o") == F.col("_lead")).alias("_all")).where("_all").select("_o")
        kept.append(materialize(first, "kept"))
        # Every key of a kept row has it as its lead.
        gone = led.join(kept[-1].withColumnRenamed("_o", "_lead"), "_lead", "left_semi").select("_o").distinct()
        before, left = left, materialize(left.join(gone, "_o", "left_anti"), "undecided")
        release(before, led)
    if not left.isEmpty():
        kept.append(_walked(left))
    taken = rows.where(F.size(F.coalesce(keys, F.array().cast("array<string>"))) == 0)
    for part in kept:
        taken = taken.unionByName(rows.join(part, rows[order] == part["_o"], "left_semi"))
    return taken


def _walked(tied: DataFrame) -> DataFrame:
    """``_o`` of the rows kept among ``_o, _key``, each component streamed in order by one task."""
    hubs = tied.groupBy("_key").agg(F.min("_o").alias("_hub"))
    roots = components(tied.join(hubs, "_key"), "_o", "_hub").select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    placed = tied.join(roots, tied["_o"] == roots["_node"], "left").select("_o", "_key", F.coalesce("_root", "_o").alias("_root"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root, row, own, taken = None, None, [], set()
        for b in batches:
            kept = []
            for r, o, k in zip(b["_root"], b["_o"], b["_key"]):
                if o != row:
                    if row is not None and not taken.intersection(own):
                        taken.update(own)
                        kept.append(row)
                    row, own = o, []
                if r != root:
                    root, taken = r, set()
                own.append(k)
            yield pd.DataFrame({"_o": pd.Series(kept, dtype="int64")})
        if row is not None and not taken.intersection(own):
            yield pd.DataFrame({"_o": pd.Series([row], dtype="int64")})

    return placed.repartition("_root").sortWithinPartitions("_root", "_o").mapInPandas(walk, "_o long")


def positions(rows: DataFrame, name: str) -> DataFrame:
    """Add the place of each row in the order ``rows`` has now, from 0 and without gaps, as ``name``.

    Rows are counted per partition, so no task sees all of them.
    """
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    laid = materialize(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", at), "ranked")
    # One row a partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return laid.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def ranked(rows: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """Add the position of each row in ``order`` as ``name``; rows are spread by ranges of the order."""
    return positions(rows.orderBy(*order), name)


def enqueue(queue: DataFrame, rows: DataFrame, order: tuple[str, ...] = ("seq", "pos")) -> DataFrame:
    """New items after the queue's last position, in their own order."""
    last = queue.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("_last"))  # one row
    fresh = ranked(rows, "_n", *order).crossJoin(F.broadcast(last))
    return queue.unionByName(
        fresh.withColumn("pos", F.col("_last") + F.col("_n") + 1).select(*[c for c in queue.columns if c in fresh.columns or c == "pos"]),
        allowMissingColumns=True,
    )


def head(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in order (a limit is what this operator is for)."""
    return rows.orderBy(*order).limit(n)


def rest(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def first_success(attempts: list[tuple[str, Column, Column]]) -> Column:
    """Struct ``archive_source, archive_status, archive_url`` of the first attempt that succeeded.

    ``attempts`` are name, success and address in order of trial; none
    succeeding gives ``none`` and ``failed``.  A live success has no address.
    """
    out = F.struct(F.lit("none").alias("archive_source"), F.lit("failed").alias("archive_status"), F.lit("").alias("archive_url"))
    for name, ok, address in reversed(attempts):
        got = F.struct(F.lit(name).alias("archive_source"), F.lit("success").alias("archive_status"), F.coalesce(address, F.lit("")).alias("archive_url"))
        out = F.when(F.coalesce(ok, F.lit(False)), got).otherwise(out)
    return out


def retried(queue: DataFrame, failed: DataFrame, key: str = "id", most: int = ATTEMPTS) -> DataFrame:
    """One more attempt for each failed item; items at ``most`` attempts leave the queue."""
    marks = failed.select(F.col(key).alias("_k")).distinct()
    tried = F.coalesce(F.col("archive_attempts").try_cast("int"), F.lit(0)) + F.col("_k").isNotNull().cast("int")
    return (
        queue.join(marks, queue[key] == marks["_k"], "left").withColumn("archive_attempts", tried).drop("_k")
        .where(F.col("archive_attempts") < most)
    )

