"""Connected components by alternating star steps, on stored edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import shared


#: Rows of a stored partition, about.
PARTITION_ROWS = 1 << 16


def _packed(frame: DataFrame, rows: int) -> tuple[DataFrame, str]:
    """The frame as a table in as many files as so many rows need, so that a small graph isn't thousands of empty tasks."""
    context = frame.sparkSession.sparkContext
    return shared.placed(frame.coalesce(max(context.defaultParallelism, -(-rows // PARTITION_ROWS))))


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of links (a, b), the least node it is connected with.

    Every round hooks neighbours to the least node around (large star, then small star) until each node hangs on
    its component's least. Least nodes are aggregated with map-side combine and meet the edges from stored tables, so a node
    with very many edges is split by Spark's skew join. Every step reads the tables of the one before and nothing of its plan, so
    plans stay as small in the last round as in the first. Null ends are left out.
    """
    session = links.sparkSession
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    (edges, place), before = shared.placed(edges), None
    rows = 2 * edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooked, between = _star(both, rows, large=True)
        shared.erase(session, place)
        edges, place = _star(hooked, rows, large=False)
        shared.erase(session, between)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    least = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(least)


def _star(edges: DataFrame, rows: int, large: bool) -> tuple[DataFrame, str]:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    if large:  # larger neighbours hang on the least one around, the node itself included
        least, place = _packed(least.select("u", F.least("u", "m").alias("m")), rows)
        hung = edges.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its smaller neighbours hang on the least of these
        least, place = _packed(least, rows)
        hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        hung = hung.unionByName(least.select("u", F.col("m").alias("v")))
    out = _packed(hung.distinct(), rows)
    shared.erase(edges.sparkSession, place)
    return out
