"""Connected components of a link table, in a logarithmic number of rounds.

Alternates two star operations (large-star, small-star) until every node is
linked to the smallest node of its component.  Node degrees are unbounded (the
hub of a star is linked to its whole component), so no step groups a hub's
links in one task: minima are partial aggregates, and each is materialised
before the join that hands it back, which leaves two plain shuffles that
adaptive execution can split at a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import materialize


def _minima(links: DataFrame) -> DataFrame:
    return materialize(links.groupBy("u").agg(F.min("v").alias("m")))


def _star(links: DataFrame, mins: DataFrame) -> DataFrame:
    """(v, m) for every neighbour v of u other than m, and (u, m)."""
    j = links.join(mins, "u").select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return j.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; ``root`` is the smallest
    node of its component.  ``a`` and ``b`` are columns of one ordered type."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = materialize(edges)
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = _minima(both)
        # large star: neighbours above u go to the smallest neighbour (or u itself)
        low = mins.select("u", F.least("u", "m").alias("m"))
        large = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u > v").distinct())
        # small star: u and its neighbours below go to the smallest of these
        edges = materialize(_star(large, _minima(large)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == last:
            break
        last = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)
