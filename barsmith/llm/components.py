"""Connected components of a distributed edge list.

Labels start as the vertex ids and fall to the smallest id of the component. A round
takes the smallest label among a vertex's neighbours, offers it to the vertex and to the
vertex its label points at (hooking), then follows pointers once (label of the label), so
a path of n vertices needs about log n rounds. Every round ends in a reliable
checkpoint; the driver sees one number per round.

High-degree vertices: sums over neighbours are partial aggregates, and the two joins have
a plain checkpointed table on either side, so adaptive execution can split a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for each vertex of ``edges`` (two columns of one comparable type)
    the smallest vertex reachable. Null ends and loops are no links."""
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
         .filter("u is not null and v is not null and u <> v"))
    e = checkpointed(e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    label = checkpointed(e.groupBy(F.col("u").alias("id"))
                         .agg(F.min("v").alias("n"))
                         .select("id", F.least("id", "n").alias("f")))
    if label.isEmpty():
        return label.select("id", F.col("f").alias("component"))
    while True:
        near = (e.join(label.select(F.col("id").alias("v"), F.col("f").alias("m")), "v")
                .groupBy(F.col("u").alias("id")).agg(F.min("m").alias("m")))
        mine = near.join(label, "id")
        offers = (mine.select(F.explode(F.array(
            F.struct(F.col("id"), F.least("f", "m").alias("f")),
            F.struct(F.col("f").alias("id"), F.least("f", "m").alias("f")))).alias("o"))
            .groupBy(F.col("o.id").alias("id")).agg(F.min("o.f").alias("f")))
        hooked = checkpointed(offers)
        jump = hooked.select(F.col("id").alias("f"), F.col("f").alias("g"))
        new = checkpointed(hooked.join(jump, "f").select("id", F.col("g").alias("f")))
        moved = (new.join(label.withColumnRenamed("f", "old"), "id")
                 .filter("f <> old").isEmpty())
        label = new
        if moved:
            return label.select("id", F.col("f").alias("component"))
