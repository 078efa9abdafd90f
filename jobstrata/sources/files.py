"""CSV and JSON-lines readers of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.functions.text import filled, strip
from jobstrata.operators.workqueue import ranked
from jobstrata.schemas import strings
from jobstrata.session import path_exists


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """CSV with doubled quotes and embedded line ends; all text, missing is ``""``.

    The file's own header decides which columns it has: known columns it lacks
    come out blank, unknown ones are dropped.  A missing file is an empty table.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], strings(columns))
    raw = spark.read.options(
        header=True, multiLine=True, escape='"', inferSchema=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return raw.select(
        *[(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in raw.columns else F.lit("")).alias(c) for c in columns]
    )


def numbered(df: DataFrame, column: str = "pos") -> DataFrame:
    """Add the reading order of a file's rows as ``column`` (increasing, with gaps)."""
    return df.withColumn(column, F.monotonically_increasing_id())


def last_wins(rows: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    """One row per key: the last row's values at the first row's position.  Blank keys drop out."""
    own = rows.where(filled(F.col(key)))
    others = [c for c in rows.columns if c not in (key, pos)]
    return own.groupBy(key).agg(
        F.max_by(F.struct(*others), pos).alias("_row"), F.min(pos).alias(pos)
    ).select(key, *[F.col(f"_row.{c}").alias(c) for c in others], pos)


def excluded_ids(exclusions: DataFrame) -> DataFrame:
    """Distinct stripped ids of an exclusion list, without blanks."""
    return exclusions.select(strip(F.col("id")).alias("id")).where(filled(F.col("id"))).distinct()


def read_jsonl(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """JSON lines; blank and malformed lines are skipped, a missing file is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], strings(columns))
    return spark.read.schema(strings(columns)).option("mode", "DROPMALFORMED").json(path)


def queue_rows(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """Work queue rows with an id, in stored order."""
    return rows.where(filled(F.col("id"))).orderBy(pos)


def reindexed(rows: DataFrame, pos: str = "pos", start: int = 0) -> DataFrame:
    """Positions without gaps, in the order of the stored ones."""
    return ranked(rows.withColumnRenamed(pos, "_was"), pos, "_was").drop("_was").withColumn(pos, F.col(pos) + start)
