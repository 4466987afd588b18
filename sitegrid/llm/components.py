"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrid.llm.tables import written


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) of every node with a link. links: columns a and b of one type.

    In each round every node joins the neighbour of least random rank, itself included,
    and links are renamed; rounds are about the logarithm of the number of nodes, also
    for long chains. Tables between rounds are written to the shared folder.
    """
    links = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    roots = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().select("node", F.col("node").alias("root"))
    turn = 0
    while not links.isEmpty():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("rank"), F.col(c).alias("node"))  # noqa: B023, E731
        both = links.select("a", rank("b").alias("to")).union(links.select(F.col("b").alias("a"), rank("a")))
        best = both.groupBy("a").agg(F.min("to").alias("to"))
        best = written(best.select(F.col("a").alias("old"), F.least(F.col("to"), rank("a"))["node"].alias("new")), name)
        renamed = links.join(best.withColumnsRenamed({"old": "a", "new": "x"}), "a").join(best.withColumnsRenamed({"old": "b", "new": "y"}), "b")
        links = written(renamed.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), name)
        moved = roots.join(best.withColumnsRenamed({"old": "root"}), "root", "left")
        roots = written(moved.select("node", F.coalesce("new", "root").alias("root")), name)
    return roots
