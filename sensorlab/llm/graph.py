"""Connected components of an edge table by contraction.

Each round points every node at its smallest neighbour, jumps the pointers to their roots,
and contracts the edges to the roots.  Only edges that still join different roots go to the
next round.  Edges, pointers and labels stay in Spark; the driver sees one count a round.
Hub nodes are pre-aggregated (partial ``min``) before the shuffle, and joins on a hub are
plain sort-merge joins whose skewed side adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm.storage import written

c = F.col


def _roots(parent: DataFrame) -> DataFrame:
    """Jump (node, root) pointers until each one points at a root."""
    while True:
        up = parent.select(c("node").alias("_at"), c("root").alias("_next"))
        jumped = written(
            parent.join(up, c("root") == c("_at"), "left")
            .select("node", F.coalesce(c("_next"), c("root")).alias("root"),
                    (F.coalesce(c("_next"), c("root")) != c("root")).alias("moved")), "roots")
        parent = jumped.select("node", "root")
        if jumped.where("moved").limit(1).count() == 0:
            return parent


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node that the
    node reaches.  Nulls, loops and repeated edges are ignored; no edges give no rows."""
    live = written(edges.where(c(a) != c(b))
                   .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "edges")
    labels = None
    while live.limit(1).count():
        both = live.union(live.select(c("b").alias("a"), c("a").alias("b")))
        pointer = both.groupBy(c("a").alias("node")).agg(F.min("b").alias("least"))
        roots = _roots(written(pointer.select("node", F.least("node", "least").alias("root")), "pointers"))
        if labels is None:
            labels = roots.select("node", c("root").alias("component"))
        else:
            step = roots.select(c("node").alias("_n"), c("root").alias("_r"))
            labels = written(labels.join(step, c("component") == c("_n"), "left")
                             .select("node", F.coalesce("_r", "component").alias("component")), "labels")
        ra = roots.select(c("node").alias("a"), c("root").alias("ra"))
        rb = roots.select(c("node").alias("b"), c("root").alias("rb"))
        live = written(live.join(ra, "a").join(rb, "b").where("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                       .distinct(), "edges")
    if labels is None:
        return live.select(c("a").alias("node"), c("b").alias("component"))
    return labels
