"""Connected components of a link table, by hooking and contraction.

Every node points to its smallest neighbour (or itself), pointers are followed to their roots by doubling, and the
links between different roots are the next round's table. A node that is not smaller than all its neighbours goes in
each round, so rounds are few; the smallest node of a component is the root at the end. The smallest neighbour is a
partial aggregate, so a node with very many links costs its task one row per task; tables are written between the
steps, so that no step is computed twice and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import discard, materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link between two different nodes; root is the smallest node reachable.

    Links may be repeated, given in either direction, or loop (loops and null ends are ignored). An empty table gives
    an empty result.
    """
    links = materialise(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while True:
        both = links.union(links.select("b", "a"))
        up = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                         .select("node", F.least("node", "low").alias("root")), "hooks")
        while True:
            over = up.select(F.col("node").alias("via"), F.col("root").alias("top"))
            last, up = up, materialise(
                up.join(over, up["root"] == over["via"])
                .select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "jumps")
            discard(last)
            if up.where("moved").isEmpty():
                break
        if found is None:
            found = materialise(up.select("node", "root"), "roots")
        else:
            over = up.select(F.col("node").alias("via"), F.col("root").alias("top"))
            last, found = found, materialise(found.join(over, found["root"] == over["via"], "left")
                                             .select("node", F.coalesce("top", "root").alias("root")), "roots")
            discard(last)
        ends = up.select(F.col("node").alias("via"), F.col("root").alias("top"))
        one = links.join(ends, links["a"] == ends["via"]).select(F.col("top").alias("a"), "b")
        last, links = links, materialise(
            one.join(ends, one["b"] == ends["via"]).select("a", F.col("top").alias("b"))
            .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        discard(last, up)
        if links.isEmpty():
            return found
