"""Connected components over a table of links, in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.sources.workspace import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: link a node's larger (or smaller) neighbours to its smallest neighbour.

    Only minima are gathered per node, never neighbour lists, so a hub with a third of all links
    is one combined row per map task; its join rows can be split.
    """
    both = edges.union(edges.select("dst", "src")) if larger else edges
    # larger: (src, dst) both ways; else src > dst already.
    least = both.groupBy(F.col("src").alias("at")).agg(F.min("dst").alias("m"))
    least = least.select("at", F.least("at", "m").alias("m"))
    joined = both.join(least, F.col("src") == F.col("at"))
    if larger:
        out = joined.filter(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    else:
        out = joined.select(F.col("dst").alias("src"), F.col("m").alias("dst")).union(
            least.select(F.col("at").alias("src"), F.col("m").alias("dst"))
        )
    return out.filter(F.col("src") != F.col("dst")).distinct()


def component_minima(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (src, dst): root is the smallest node of its component.

    Large-star and small-star steps alternate until the links form stars: every node then points
    at its root. Each round is a written table, so lineage does not grow.
    """
    edges = links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    edges = stored(edges.filter(F.col("src") != F.col("dst")).distinct(), "edges")
    while True:
        summed = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("src", "dst").cast("long")).alias("h")).first()  # one row
        if not summed["n"]:
            break
        after = stored(_star(stored(_star(edges, True), "large-star"), False), "small-star")
        again = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("src", "dst").cast("long")).alias("h")).first()
        edges = after
        if summed == again:
            break
    roots = edges.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(roots)
