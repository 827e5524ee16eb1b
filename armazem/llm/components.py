"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star steps: each turns every node's links into links with the
least node it sees, until nothing changes. Every round is written to the shared folder, which
cuts the lineage. Nothing but one row of figures a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armazem.llm.runtime import run_folder, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component: the least node reachable.

    Links are undirected; repeated links and links of a node with itself are fine, null ends are
    left out. A hub with very many links is reduced to its minimum on the map side, and the join
    that hands the minimum back may be split by AQE.
    """
    spark = links.sparkSession
    folder = run_folder(spark, "components")
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        "u is not null and v is not null and u != v").distinct()
    edges = written(edges, f"{folder}/0")
    before, step = None, 0
    while True:
        step += 1
        edges = written(small_star(large_star(edges)), f"{folder}/{step}")
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its least neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
        "u != v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
