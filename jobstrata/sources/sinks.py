"""Writers: CSV, JSON lines and SQL text, each to a new versioned folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.functions.text import filled, sql_literal
from jobstrata.session import list_names, path_exists

_CSV = {
    "header": "true", "escape": '"', "emptyValue": "", "nullValue": "", "lineSep": "\r\n",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def seasons(terms: Column) -> Column:
    """``terms`` JSON list joined by ``" | "``; the raw text where it isn't a list of texts."""
    parsed = F.from_json(terms, F.lit("array<string>"))
    listed = F.trim(terms).rlike(r"(?s)^\[.*\]$") & parsed.isNotNull() & ~F.exists(F.coalesce(parsed, F.array().cast("array<string>")), lambda x: x.isNull())
    return F.when(F.coalesce(listed, F.lit(False)), F.array_join(parsed, " | ")).otherwise(terms)


def job_export(jobs: DataFrame, *ties: str) -> DataFrame:
    """The seven-column export, by first sighting, company, title (and id and ``ties``, which settle the rest)."""
    return jobs.orderBy("first_seen_date", "company_name", "title", "id", *ties).select(
        "company_name", "title", seasons(F.col("terms")).alias("recruiting_season"), "date_posted", "first_seen_date", "url", "id"
    )


def newest_first(rows: DataFrame, by: str, pos: str) -> DataFrame:
    """Descending by a text date, ties in stored order."""
    return rows.orderBy(F.desc(by), F.asc(pos))


def text_rows(details: DataFrame) -> DataFrame:
    """``id, raw_text`` of archived records with a text."""
    return details.where(filled(F.col("archive_url")) & F.col("raw_text").rlike(r"(?U)\S")).select("id", "raw_text")


def insert_statements(rows: DataFrame, name: str, columns: tuple[str, ...]) -> DataFrame:
    """``line``: one INSERT per row, with every value as a text literal."""
    values = F.concat_ws(", ", *[sql_literal(F.col(c)) for c in columns])
    return rows.select(F.concat(F.lit(f"INSERT INTO {name} VALUES ("), values, F.lit(");")).alias("line"))


def table_ddl(name: str, columns: tuple[str, ...]) -> str:
    """The statement that creates a stored table: all text, ``id`` its key."""
    return f"CREATE TABLE {name} ({', '.join(f'{c} TEXT PRIMARY KEY' if c == 'id' else f'{c} TEXT' for c in columns)});"


def sql_dump(tables: dict[str, DataFrame], columns: tuple[str, ...], title: str, day: str) -> DataFrame:
    """``part, pos, line`` of a SQL text that rebuilds the tables; write it ordered by ``part, pos``.

    The rows of a table have no order of their own; ``pos`` (a hash) spreads
    them over as many tasks as needed.  ``day`` is given, not taken from the clock.
    """
    spark = next(iter(tables.values())).sparkSession
    schema = "part int, pos long, line string"

    def said(*lines: tuple[int, str]) -> DataFrame:
        return spark.createDataFrame([(at, 0, line) for at, line in lines], schema)

    out = said((0, f"-- {title}"), (1, f"-- Generated: {day}"), (2, "BEGIN TRANSACTION;"))
    at = 3
    for name, rows in tables.items():
        body = insert_statements(rows, name, columns).select(F.lit(at + 1).alias("part"), F.xxhash64("line").alias("pos"), "line")
        count = rows.agg(F.concat(F.lit("-- "), F.format_number(F.count("*"), 0), F.lit(f" rows in {name}")).alias("line"))
        out = out.unionByName(said((at, table_ddl(name, columns)))).unionByName(body).unionByName(
            count.select(F.lit(at + 2).alias("part"), F.lit(0).cast("long").alias("pos"), "line")
        )
        at += 3
    return out.unionByName(said((at, "COMMIT;")))


def next_version(spark: SparkSession, home: str) -> str:
    """A folder that isn't there yet: state is never overwritten while it may be read."""
    taken = [int(n[1:]) for n in list_names(spark, home) if n[:1] == "v" and n[1:].isdigit()]
    return f"{home}/v{max(taken, default=0) + 1:06d}"


def latest_version(spark: SparkSession, home: str) -> str | None:
    """The newest finished version."""
    done = [n for n in list_names(spark, home) if n[:1] == "v" and path_exists(spark, f"{home}/{n}/_SUCCESS")]
    return f"{home}/{max(done)}" if done else None


def write_csv(rows: DataFrame, home: str) -> str:
    """CSV in a new version below ``home``; an empty table is a file with the header only."""
    path = next_version(rows.sparkSession, home)
    rows.write.options(**_CSV).csv(path)
    return path


def write_jsonl(rows: DataFrame, home: str) -> str:
    path = next_version(rows.sparkSession, home)
    rows.write.json(path)
    return path


def write_lines(lines: DataFrame, home: str) -> str:
    path = next_version(lines.sparkSession, home)
    lines.orderBy("part", "pos").select("line").write.text(path)
    return path
