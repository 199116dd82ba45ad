"""Connected components of a large graph by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import materialize


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the smallest node reached.

    Alternating large-star and small-star steps: each node's larger (then
    smaller) neighbours are hung on the smallest node it knows, until the
    edges are stars and stay so, after a number of rounds that grows with
    the logarithm of the node count. A round is an aggregate (combined
    before it is shuffled) and a join on plain shuffles, which adaptive
    execution splits at a node with very many edges; its edges are written
    to the shared checkpoint folder, so nothing is recomputed and nothing
    is collected."""
    edges = materialize(
        edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        spark,
        "edges",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _star(spark, both, larger=True)
        edges = _star(spark, edges, larger=False)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _star(spark: SparkSession, edges: DataFrame, larger: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on its smallest one; edges stay (greater, smaller)."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    least = materialize(least, spark, "least")
    joined = edges.join(least, "a")
    if larger:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.filter(F.col("b") <= F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return materialize(out.filter(F.col("a") != F.col("b")).distinct(), spark, "edges")
