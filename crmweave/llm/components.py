"""Connected components by alternating stars (Kiveris et al., 2014), as joins and minima.

Every step hangs the neighbours of a node under their smallest, once for larger neighbours and
once for smaller ones; edges become stars around the smallest node of each component in a number
of steps that grows with the logarithm of the input. Every half step is written, so lineage
stays short; minima are combined before the shuffle, and no neighbour list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.session import write_table


def _hang(edges: DataFrame) -> DataFrame:
    """``(u, v, m)``: every edge with the smallest of u and all its neighbours.

    The minima are written, so both sides of the join are plain tables: a side of known size
    may be broadcast, and where it is not, adaptive execution splits the edges of a hub.
    """
    least = write_table(edges.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m")), "minima")
    joined = edges.join(least, F.col("u") == F.col("at"))
    return joined.select("u", "v", F.least("u", "m").alias("m"))


def _step(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    large = _hang(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = _hang(write_table(large.where("u != v").distinct(), "large"))
    small = small.select("v", "m").union(small.select("u", "m")).toDF("u", "v")
    return small.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges``, two columns of one integer type.

    ``label`` is the smallest node of the component. Loops and repeated edges do no harm;
    edges with a null end are left out; without edges there are no rows.
    """
    pairs = edges.toDF("u", "v").where("u != v")
    now = write_table(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        print_of = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(print_of) == seen:
            break
        seen = tuple(print_of)
        now = write_table(_step(now), "edges")
    stars = now.toDF("node", "label")
    return stars.union(stars.select("label", "label").distinct())
