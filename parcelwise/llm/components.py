"""Connected components of an edge table, by alternating large and small stars; nothing but edges moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parcelwise.session import reliable


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours; combined before the shuffle, so a hub costs one row a task."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))


#: Rows for each task where their number is known; fewer tasks write fewer files in every shuffle that follows.
ROWS_A_TASK = 250_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """No more partitions than ``rows`` need. Narrow: nothing is shuffled, and a large table stays as it is."""
    return df.coalesce(max(1, -(-rows // ROWS_A_TASK)))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v); component is the least node reached.

    Any orderable node type. Edges from a node to itself keep it as a node. Each round is written to the shared folder. Edges with a null
    end are left out; an empty table gives an empty one.
    """
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL")
    now = reliable(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    rows = now.count()
    while True:
        now = few(now, rows)
        both = few(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), 2 * rows)
        large = few(both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), rows)
        large = few(large.union(now.where("u = v")).distinct(), rows)
        down = large.where("u >= v")
        small = few(down.join(_least(down), "u"), rows)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).distinct()
        now = reliable(few(small, 2 * rows))
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return few(now, rows).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        state, rows = tuple(found), found[0]
