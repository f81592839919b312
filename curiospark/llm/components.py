"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep, release


def components(edges: DataFrame) -> DataFrame:
    """node, comp (a kept table, with a further column; the smallest node that edges a, b connect it to) of every node of an edge.

    In each round, a node takes the smallest label among its neighbours, then its label's label, so paths of any
    length shrink to half and less. Minima are pre-aggregated; nothing comes to the driver but a count.
    """
    both = keep(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        hooked = keep(labels.join(near, "node").select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("was")), "hooked")
        jumped = hooked.join(hooked.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp", "left")
        moved = F.least("comp", "next")
        new = keep(jumped.select("node", moved.alias("comp"), (moved != F.col("was")).alias("moved")), "labels")
        release(labels, hooked)
        if not new.where("moved").limit(1).count():
            release(both)
            return new
        labels = new
