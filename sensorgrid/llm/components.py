"""Connected components of a graph given as links, however large a component is."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorgrid.llm.common import discard, saved


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its smallest node.

    Alternates two steps until the edges no longer change: every node hands the
    smallest of its neighbourhood to its larger neighbours, then to its smaller ones
    and itself. Paths shrink by half each time, a star is done at once. Each round's
    edges are written, so the plan does not grow; minima are written too, so that
    the joins are between tables and hot nodes can be split. Only the last round's
    tables stay.
    """
    a, b = F.col("a"), F.col("b")
    edges = saved(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "edges-low")
        large = saved(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "edges-large",
        )
        low = saved(large.groupBy("u").agg(F.min("v").alias("m")), "edges-low")
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, saved(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        discard(last, least, large, low)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
