"""Connected components of a link table, by hooking to the least neighbour and contracting.

One round: every node hooks to the least of itself and its neighbours; the
resulting forest is flattened by pointer jumping; links are rewritten to their
roots, and those inside one tree are dropped. At least half of the linked
nodes vanish per round. All steps are joins and combined aggregates on two
slim tables; nothing but counts comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node of its component.

    Repeated, reversed and self links are allowed; rows with a null are ignored.
    """
    spark = links.sparkSession
    edges = links.select("a", "b").where("a is not null and b is not null and a != b").distinct()
    edges = materialize(edges, "cc-edges")
    roots, first = spark.createDataFrame([], "node long, root long"), True
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(both.groupBy("a").agg(F.min("b").alias("least"))
                             .select(F.col("a").alias("node"), F.least("a", "least").alias("root")), "cc-parent")
        while True:
            # Two jumps a turn; the second moving nothing means that the forest is flat.
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
            once = parent.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            twice = once.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"),
                                                         (F.col("above") < F.col("root")).alias("moved"))
            jumped = materialize(twice, "cc-parent")
            moved = not jumped.where("moved").isEmpty()
            parent = jumped.select("node", "root")
            if not moved:
                break
        old = roots.join(parent.withColumnRenamed("root", "above").withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"))
        new = parent.join(roots.select("node"), "node", "left_anti")
        roots = parent if first else materialize(old.unionByName(new), "cc-roots")
        first = False
        at_a = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        at_b = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = materialize(edges.join(at_a, "a").join(at_b, "b").where("ra != rb")
                            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-edges")
    return roots
