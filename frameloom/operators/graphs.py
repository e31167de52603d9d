"""Connected groups of a table of edges, whose ends may be of any type that can be ordered and grouped (numbers, text, structs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.products import delete, fresh_folder


class Steps:
    """Tables written between steps. Reading them back cuts the lineage and, unlike a checkpoint, the size that Spark expects of them, which
    would otherwise grow with every join of every round."""

    def __init__(self) -> None:
        self.paths: dict[str, str] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """The table under its name; the one that had the name before is deleted."""
        path, schema = fresh_folder(df.sparkSession, name), df.schema
        df.write.parquet(path)
        self.drop(df, name)
        self.paths[name] = path
        return df.sparkSession.read.schema(schema).parquet(path)

    def drop(self, df: DataFrame, *names: str) -> None:
        delete(df.sparkSession, [self.paths.pop(n) for n in names if n in self.paths])


def connected(edges: DataFrame) -> DataFrame:
    """node, root for every end of the edges (u, v): the root is the smallest node of the group.

    In a round every node is hooked to its smallest neighbour, if that is smaller, and follows two steps more; then the edges are
    drawn between what the nodes have become, and those within one node go. Only a node without a smaller neighbour stays, so at most half
    of a round's nodes are left once all have reached theirs. Edges with a null end are ignored; an empty table gives an empty result.
    """
    steps = Steps()
    left = steps.write("edges", edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v").distinct())
    tree = steps.write("tree", left.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node")))
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        hook = steps.write("hook", both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("p")))
        up = hook.select(F.col("u").alias("p"), F.col("p").alias("q"))
        for _ in range(2):
            hook = hook.join(up, "p").select("u", F.col("q").alias("p"))
        hook = steps.write("jump", hook)
        to = lambda c, h=hook: h.select(F.col("u").alias(c), F.col("p").alias(f"new_{c}"))
        tree = steps.write("tree", tree.join(to("root"), "root", "left").select("node", F.coalesce("new_root", "root").alias("root")))
        left = steps.write("edges", left.join(to("u"), "u").join(to("v"), "v").where("new_u <> new_v").select(F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")).distinct())
    steps.drop(tree, "edges", "hook", "jump")
    return tree
