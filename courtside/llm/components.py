"""Connected components of a link table, by contraction with random priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import written


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): equal roots, same component.

    Each step maps every node to the one of least priority among itself and
    its neighbours, and the links to links between those; a random priority
    a step makes the number of nodes left fall by a constant factor however
    long a chain is. Neighbourhoods are minima combined map-side, so a node
    with very many links costs one row a task; nothing is collected.
    """
    edges = written(links.select("a", "b").where("a <> b"), f"{name}-edges")
    label = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select(
        "node", F.col("node").alias("root"))
    step = 0
    while not edges.isEmpty():
        def rank(c: str):
            return F.struct(F.xxhash64(F.lit(step), F.col(c)), F.col(c).alias("to"))
        both = edges.union(edges.select("b", "a"))
        best = written(
            both.groupBy("a").agg(F.min(rank("b")).alias("n")).select(
                F.col("a").alias("node"), F.least(rank("a"), F.col("n"))["to"].alias("to")),
            f"{name}-step")
        label = written(
            label.join(best.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")), f"{name}-labels")
        a = best.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        b = best.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = written(edges.join(a, "a").join(b, "b").where("ta <> tb").select(
            F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
            f"{name}-edges")
        step += 1
    return label
