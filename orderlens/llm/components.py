"""Connected components of a link table by contraction, as DataFrame jobs.

Each round hooks every root to its smallest neighbour, follows the hooks to their
ends by joins of the hook table with itself, and contracts the links. Roots that are
not the smallest among their neighbours vanish, so the link table shrinks each round.
Only partial aggregates and joins (split by AQE when one root holds many links) are
used; no component is ever gathered in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged


def components(links: DataFrame, staged: Staged) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: long).

    component is the smallest node reachable. Self-links and repeated links are
    allowed; null ends are dropped; an empty link table gives an empty result.
    """
    contract = lambda e: (
        e.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    edges = staged.write(contract(links))
    names: DataFrame | None = None
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        hooks = staged.write(
            ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up"))
        )
        while True:
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            moved = staged.write(hooks.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
            staged.drop(hooks)
            hooks = moved
            if hooks.where("moved").isEmpty():
                break
        hooks = hooks.select("node", "up")
        if names is None:
            names = hooks.select("node", F.col("up").alias("component"))
        else:
            renamed = hooks.select(F.col("node").alias("component"), "up")
            names = names.join(renamed, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        names = staged.write(names)
        up_a = hooks.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        up_b = hooks.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        edges = staged.write(contract(edges.join(up_a, "a").join(up_b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))))
    if names is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return names
