"""Connected components of a graph given as a table of edges, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedside.llm.common import remove_written, written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) to (node, root): the smallest node of each node's component.

    Nodes without edges and loops don't appear. First every node ties its smaller
    neighbours to the least of them, again and again, until each node has one smaller
    neighbour; then the pointers are doubled until all point at roots. Each step is a
    table in the shared folder. A node's smaller neighbours are gathered, never all of
    its neighbours, so a hub of many nodes isn't a group.
    """
    current = written(edges.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    while True:
        n, nodes = current.select(F.count("*"), F.count_distinct("v")).first()
        if n == nodes:
            break
        least = current.withColumn("m", F.min("u").over(Window.partitionBy("v")))
        tied = least.select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("v")), F.struct(F.col("m").alias("u"), F.col("u").alias("v")))).alias("e"))
        after = written(tied.select("e.u", "e.v").where("u < v").distinct(), "edges")
        remove_written(current)
        current = after
    while True:
        up = current.select(F.col("v").alias("u"), F.col("u").alias("above"))
        joined = written(current.join(up, "u", "left").select(F.coalesce("above", "u").alias("u"), "v", F.col("above").isNotNull().alias("moved")), "edges")
        moved = joined.where("moved").limit(1).count()
        remove_written(current)
        current = joined.select("u", "v")
        if not moved:
            return current.select(F.col("v").alias("node"), F.col("u").alias("root"))
