"""A stored table of keyed rows that grows batch by batch and is joined without being moved.

Rows lie in hash buckets of their key, sorted inside, each batch in a folder of
its own with a success marker.  A join on the key moves only the other side.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.session import delete_path, list_names, path_exists


class BucketStore:
    """``columns`` is the schema as DDL and holds ``key``.

    The number of buckets is set when the first batch is written (the session's
    shuffle partitions, if it isn't given) and stays.  A batch that is written
    again replaces itself.  Rows are written with ``live`` 0 or 1: those with 0
    belong to their batch only and aren't seen through :meth:`table`.
    """

    def __init__(self, spark: SparkSession, home: str, columns: str, buckets: int | None = None) -> None:
        self.spark, self.columns = spark, columns
        laid = [n for n in list_names(spark, home) if n.startswith("buckets=")]
        self.buckets = int(laid[0][8:]) if laid else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.home = f"{home}/buckets={self.buckets}"

    def _done(self, kind: str) -> dict[int, str]:
        names = [n for n in list_names(self.spark, self.home) if n.startswith(f"{kind}=")]
        return {int(n.split("=")[1]): f"{self.home}/{n}" for n in names if path_exists(self.spark, f"{self.home}/{n}/_SUCCESS")}

    def parts(self, below: int) -> list[str]:
        """Folders that hold the batches before ``below``."""
        merged = {n: p for n, p in self._done("merged").items() if n < below}
        top = max(merged, default=-1)
        later = [p for n, p in sorted(self._done("batch").items()) if top < n < below]
        return [merged[top], *later] if merged else later

    @contextmanager
    def table(self, below: int) -> Iterator[DataFrame]:
        """The live rows of the batches before ``below``, bucketed by ``key``."""
        name = f"jobstrata_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({self.columns}, part int) USING parquet PARTITIONED BY (part) "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.home}'"
        )
        try:
            live = [f"{p}/live=1" for p in self.parts(below) if path_exists(self.spark, f"{p}/live=1")]
            if live:
                self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (part={i}) LOCATION '{p}'" for i, p in enumerate(live)))
            yield self.spark.table(name).drop("part")
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # external: the files stay

    def _write(self, rows: DataFrame, path: str) -> None:
        name = f"jobstrata_{uuid.uuid4().hex}"
        delete_path(self.spark, path)
        try:
            rows.write.format("parquet").option("path", path).partitionBy("live").bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def write(self, batch: int, rows: DataFrame) -> str:
        """Store ``rows`` (with ``live``) as a batch; its folder.  Best laid out by ``key`` before."""
        if batch <= max(self._done("merged"), default=-1):
            raise ValueError(f"batch {batch} is merged already")
        path = f"{self.home}/batch={batch:06d}"
        self._write(rows, path)
        return path

    def compact(self, upto: int) -> None:
        """Merge the batches up to ``upto`` into one folder, so that the number of files stays small.

        The merged folder counts once it is complete; only then the parts go.
        """
        old = self.parts(upto + 1)
        if len(old) < 2:
            return
        with self.table(upto + 1) as rows:
            self._write(rows.repartition(self.buckets, "key").withColumn("live", F.lit(1)), f"{self.home}/merged={upto:06d}")
        for path in old:
            delete_path(self.spark, path)
