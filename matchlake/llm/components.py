"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (a, b), a > b: link the neighbours of each node to the smallest of them.

    The large step links a node's larger neighbours, the small step the node and its smaller ones.
    Minima are aggregated and written first, so that the join is between two plain tables and Spark
    can split the rows of a hub.
    """
    near = edges.select(F.col("a").alias("at"), F.col("b").alias("to"))
    if large:
        near = near.union(edges.select(F.col("b").alias("at"), F.col("a").alias("to")))
    lowest = staged(near.groupBy("at").agg(F.least(F.min("to"), F.col("at")).alias("low")), "lowest")
    joined = near.join(lowest, "at")
    if large:
        linked = joined.where(F.col("to") > F.col("at")).select(F.col("to").alias("a"), F.col("low").alias("b"))
    else:
        linked = joined.select(F.col("to").alias("a"), F.col("low").alias("b")).union(
            lowest.select(F.col("at").alias("a"), F.col("low").alias("b"))
        )
    return staged(linked.where("a > b").distinct(), "star")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that is not the smallest of its component. edges: (a, b), a > b.

    Alternating star steps; each shortens the paths, so a chain of n nodes takes about log n rounds.
    Two sums over the edges tell whether a round changed them; nothing else reaches the driver.
    """

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = staged(edges.distinct(), "edges")
    before = mark(edges)
    while before[0]:
        edges = _star(_star(edges, large=True), large=False)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
