"""Connected components of a link table, for near-duplicate groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored


def _mapped(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replaces ``column`` by its root where ``mapping`` (node, root) has one.
    Merged, as a compressed table's size says little about its rows."""
    m = mapping.select(F.col("node").alias("_node"), F.col("root").alias("_root")).hint("merge")
    return df.join(m, df[column] == m["_node"], "left").withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def components(links: DataFrame) -> DataFrame:
    """(node, root) from links (a, b): root is the smallest node of the
    component; nodes that are their own root are left out.

    Each round hangs every node with a smaller neighbour under its smallest
    one, flattens these trees by pointer jumping and contracts the links to
    their roots. Only local minima survive a round, so few rounds are needed
    even for chains. Every step reads checkpointed tables, so joins on a root
    with very many links are plain shuffles that Spark may split.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    roots = None
    while not edges.isEmpty():
        step = stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "roots")
        while True:
            jumped = stored(_mapped(step.withColumn("was", F.col("root")), "root", step), "roots")
            moved = not jumped.where("root <> was").isEmpty()
            step = jumped.drop("was")
            if not moved:
                break
        roots = step if roots is None else stored(_mapped(roots, "root", step).unionByName(step), "roots")
        ends = _mapped(_mapped(edges, "a", step), "b", step).where("a <> b")
        edges = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return links.sparkSession.createDataFrame([], links.select(F.col("a").alias("node"), F.col("b").alias("root")).schema) if roots is None else roots
