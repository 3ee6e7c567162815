"""Connected components of an edge table, by smallest neighbours and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import file_stage


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of `edges` (a, b); the root is the smallest id of the component.

    Each round takes the smallest root among a node's neighbours, folded map-side, and then the root
    of that root, so rounds are logarithmic in practice even on long paths. The edge table is read
    as it was written; every round's result is a written table, and a join on it can be split where
    one root holds many nodes. Self-loops give single components; null ends are left out,
    and edges that come twice count once.
    """
    real = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = file_stage(real.union(real.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    roots = file_stage(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("root")), "roots"
    )
    while True:
        heard = (
            both.join(roots.withColumnRenamed("id", "b").hint("merge"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("root").alias("near"))
        )
        own = roots.join(heard.hint("merge"), "id").select("id", "root", F.least("root", "near").alias("near"))
        nearer = file_stage(own, "nearer")
        if nearer.where("near < root").isEmpty():  # both ends of every edge have one root
            return roots
        jump = nearer.select(F.col("id").alias("near"), F.col("near").alias("far"))
        roots = file_stage(
            nearer.select("id", "near")
            .join(jump.hint("merge"), "near")
            .select("id", F.least("near", "far").alias("root")),
            "roots",
        )
