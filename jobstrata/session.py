"""Session helpers: the shared scratch folder and materialised stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "jobstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults (UTC, adaptive execution).

    Keyword names use ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only where the session leaves it unset and runs on this machine alone
    (``local`` masters, as in tests) is a folder of this machine taken, and then
    also set as the checkpoint folder.  On a cluster the setting is required.
    """
    said = spark.sparkContext.getConf().get(_SETTING)
    if said:
        return said.rstrip("/")
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return str(own.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="jobstrata-")
    spark.sparkContext.setCheckpointDir(folder)
    return str(spark.sparkContext._jsc.sc().getCheckpointDir().get()).rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the session ends."""
    path = f"{shared_dir(spark)}/jobstrata/{name}-{uuid.uuid4().hex}"
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below ``path`` (empty if it is missing)."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, survives the loss of executors, and gives the planner true
    sizes.  The columnar copy is smaller than a checkpoint of rows.
    """
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    out = df.sparkSession.read.schema(schema).parquet(path)
    out._scratch = path
    return out


def release(*stages: DataFrame) -> None:
    """Delete the files of materialised stages that nothing reads any more."""
    for df in stages:
        path = getattr(df, "_scratch", None)
        if path:
            delete_path(df.sparkSession, path)
