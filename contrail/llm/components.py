"""Connected components of a graph that no task and no driver could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contrail.session import discard, stage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: larger neighbours go to the smallest one.  Small star: the others do.

    The minimum of a node is found by a grouping that combines before the shuffle and
    joined back, so that a node with very many neighbours is split like any skewed join."""
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("u", "v")
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = near.join(least, "u")
    moved = joined.filter(F.col("v") <= F.col("u") if small else F.col("v") > F.col("u"))
    pairs = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if small:
        pairs = pairs.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return pairs.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a``, ``b``); the component
    is its smallest node.

    Large and small stars alternate until every edge points at a smallest node: a
    logarithmic number of rounds in practice, each written to the shared folder.  Loops,
    repeated edges and null ends are ignored; no edges give no rows."""
    loops_out = edges.filter("a is not null and b is not null and a <> b")
    now, path = stage(loops_out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        after, new_path = stage(_star(_star(now, small=False), small=True), "edges")
        # Done when every larger end has one smaller end that is itself never a larger end.
        heads = after.agg(F.count("*").alias("n"), F.count_distinct("a").alias("a")).first()
        chained = heads["n"] != heads["a"] or not after.join(
            after.select(F.col("a").alias("b")).distinct(), "b", "left_semi"
        ).isEmpty()
        discard(edges.sparkSession, path)
        now, path = after, new_path
        if not chained:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
