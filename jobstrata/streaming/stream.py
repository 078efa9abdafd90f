"""First sightings from a stream of snapshot files.

The file source's checkpoint takes the place of the list of done commits: each
file is processed once.  Every micro-batch calls the batch functions and writes
under its own batch number, so a repeated batch replaces its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobstrata.operators.firstseen import unseen
from jobstrata.plans.build import empty_jobs, sightings
from jobstrata.schemas import JOBS_FULL, strings
from jobstrata.session import list_names, materialize, path_exists
from jobstrata.sources.buckets import BucketStore
from jobstrata.sources.snapshots import parse_payload

TABLES = ("nyc_jobs", "remote_jobs")


def stored_jobs(spark: SparkSession, home: str, table: str, before: int | None = None) -> DataFrame:
    """Sightings of the batches written so far (of those below ``before``)."""
    names = [n for n in list_names(spark, f"{home}/{table}") if n.startswith("batch=")]
    names = [n for n in names if before is None or int(n[6:]) < before]
    paths = [p for p in (f"{home}/{table}/{n}" for n in names) if path_exists(spark, f"{p}/_SUCCESS")]
    return spark.read.schema(strings(JOBS_FULL)).parquet(*paths) if paths else empty_jobs(spark)


def take_batch(snapshots: DataFrame, number: int, home: str, manifest: DataFrame) -> None:
    """One micro-batch of ``sha, payload``, ordered inside by the manifest.

    The ids sighted before lie in buckets, so only the batch's own are moved.
    """
    spark = snapshots.sparkSession
    history = materialize(parse_payload(manifest.join(snapshots, "sha")).drop("payload"), "stream-history")
    for name, rows in sightings(history).items():
        ids = BucketStore(spark, f"{home}/{name}-ids", "key string")
        with ids.table(number) as known:
            unseen(rows, known.withColumnRenamed("key", "id")).select(*JOBS_FULL).write.mode("overwrite").parquet(f"{home}/{name}/batch={number:012d}")
        taken = spark.read.schema(strings(JOBS_FULL)).parquet(f"{home}/{name}/batch={number:012d}")
        ids.write(number, taken.select(F.col("id").alias("key"), F.lit(1).alias("live")).repartition(ids.buckets, "key"))


def sighting_stream(spark: SparkSession, snapshots: str, manifest: DataFrame, home: str, *, files: int = 40) -> StreamingQuery:
    """Process all snapshot files that aren't yet, ``files`` a micro-batch, then stop."""
    stream = (
        spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files)
        .option("pathGlobFilter", "*.json").load(snapshots)
        .select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("sha"), F.col("value").alias("payload"))
    )
    return (
        stream.writeStream.foreachBatch(lambda df, n: take_batch(df, n, home, manifest))
        .option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start()
    )
