"""Connected components of an edge table, by alternating star contraction.

Every round replaces edges so that nodes hang on smaller ones (large star, then
small star); a path of n nodes is flat after about log n rounds.  All rounds
are joins and pre-aggregated groupings on the edge table: no component is ever
held in one task, and nothing but a count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.session import materialize, release

#: A path of n nodes takes about log2 n rounds, so this many suffice for any table.
_ROUNDS = 64


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v")))


def _is_flat(edges: DataFrame) -> bool:
    """Whether every edge ``u > v`` leads to a root: no node has two edges up, or edges both ways."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, root`` for every node of an edge but the roots themselves.

    ``root`` is the smallest node of the component.  Loops, repeated edges and
    edges with a null end count for nothing.  Nodes can be of any orderable type.
    """
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v")
    now = materialize(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(_ROUNDS):
        if _is_flat(now):
            out = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            out._scratch = now._scratch  # for release()
            return out
        last, now = now, materialize(_small_star(_large_star(now)).distinct(), "edges")
        release(last)
    raise RuntimeError(f"no components after {_ROUNDS} rounds")
