"""Reachability over edge tables, safe against cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelens.operators import store


def reachable(edges: DataFrame, starts: DataFrame, depth: int = 20) -> DataFrame:
    """start, node, hops: every node that a start (column node) reaches by edges src -> dst, with the least number of steps.

    Breadth first: each round joins the frontier to the edges and drops what is known, so cycles end and no path is
    carried. Rounds are written beside each other into one table, so what is known is one scan, whatever their number. depth bounds
    the rounds; a frontier that is not empty then is an error."""
    spark, path = edges.sparkSession, store.scratch(edges.sparkSession, "reached")
    front = starts.select(F.col("node").alias("start"), "node").distinct()
    schema = front.withColumn("hops", F.lit(0)).schema
    edges = store.written(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "reach-edges")
    for hop in range(depth + 2):
        front.write.parquet(f"{path}/hops={hop}")
        front = spark.read.schema(front.schema).parquet(f"{path}/hops={hop}")
        seen = spark.read.schema(schema).parquet(path)
        if front.isEmpty():
            return seen
        found = front.join(edges, front["node"] == edges["src"]).select("start", F.col("dst").alias("node")).distinct()
        front = found.join(seen.select("start", "node"), ["start", "node"], "left_anti")
    raise RuntimeError(f"nodes are still found after {depth} steps")


def paths(edges: DataFrame, starts: DataFrame, stops: DataFrame | None = None, depth: int = 40) -> DataFrame:
    """start, node, hops, path (from start to node): a shortest path to every node that a start reaches along edges src -> dst; nodes in stops (column
    node) are reached, but not passed.

    Rounds go breadth first, and each finds for its nodes the predecessor from which they are reached: of several the least by
    code point. So among shortest paths the one is given whose nodes, read from the end, are least. Then it writes them with their paths, which are those of the
    predecessors, one round before, and the node. So a path is written once and shuffled once, when it is handed on; what is known is compared by start and node alone.
    depth bounds the rounds; nodes that are found after that are an error."""
    spark, path = edges.sparkSession, store.scratch(edges.sparkSession, "paths")
    edges = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    if stops is not None:
        edges = edges.join(stops.select(F.col("node").alias("src")).distinct(), "src", "left_anti")
    # joins in rounds are by key on both sides: what is small enough to be sent to all tasks would go over the driver in each
    edges = store.written(edges, "path-edges").hint("merge")
    front = starts.select(F.col("node").alias("start"), "node", F.array("node").alias("path")).distinct()
    kept = front.schema
    for hop in range(depth + 2):
        front.write.parquet(f"{path}/hops={hop}")
        front = spark.read.schema(kept).parquet(f"{path}/hops={hop}")
        seen = spark.read.schema(kept).parquet(path)
        if front.isEmpty():
            return seen.select("start", "node", F.col("hops").cast("int").alias("hops"), "path")
        found = front.select("start", "node").join(edges, F.col("node") == F.col("src")).groupBy("start", F.col("dst").alias("node")).agg(F.min("src").alias("before"))
        found = found.join(seen.select("start", "node").hint("merge"), ["start", "node"], "left_anti")
        ways = front.select("start", F.col("node").alias("before"), "path").hint("merge")
        front = found.join(ways, ["start", "before"]).select("start", "node", F.array_append("path", F.col("node")).alias("path"))
    raise RuntimeError(f"nodes are still found after {depth} steps")


def maximal_names(df: DataFrame, name: str, mark: str = ".") -> DataFrame:
    """Distinct dotted names that are no strict prefix of another one."""
    from changelens.functions.text import ancestors

    names = df.select(name).distinct()
    shorter = names.select(F.explode(F.filter(ancestors(F.col(name), mark), lambda p: p != F.col(name))).alias(name)).distinct()
    return names.join(shorter, name, "left_anti")
