"""Connected components by randomised contraction, in DataFrame operations.

Each round every vertex picks the neighbour (or itself) that is least in a
fresh pseudo-random order, and every edge is replaced by the edge between the
picks of its ends.  In expectation a constant share of the vertices disappears
per round whatever the shape of the graph (long paths and stars included), so
the number of rounds is logarithmic.  All steps are joins and partial
aggregates keyed by vertex; no neighbourhood is ever gathered in one row, and a
hub's rows are split by the adaptive skew join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import staged

MAX_ROUNDS = 200


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) edges of one hashable type -> (node, root): equal roots, same component.

    Direction, repeats, self-loops and rows with a null end don't matter; a
    vertex that has only such rows is absent.  ``root`` is an arbitrary vertex
    of the component.  An empty table gives an empty table.
    """
    ends = edges.select("src", "dst").filter("src <> dst")
    both = staged(ends.union(ends.select("dst", "src")).distinct())
    picks = []
    while not both.isEmpty():
        if len(picks) == MAX_ROUNDS:
            raise RuntimeError("contraction did not end")
        ordered = lambda c, k=len(picks): F.struct(
            F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("v"))
        pick = staged(both.groupBy("src").agg(F.min(ordered("dst")).alias("least"))
                      .select(F.col("src").alias("node"),
                              F.least("least", ordered("src"))["v"].alias("root")))
        picks.append(pick)
        a, b = (pick.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
                for c in ("src", "dst"))
        both = staged(both.join(a, "src").join(b, "dst").filter("src_root <> dst_root")
                      .select(F.col("src_root").alias("src"), F.col("dst_root").alias("dst"))
                      .distinct())
    if not picks:
        return both.select(F.col("src").alias("node"), F.col("dst").alias("root"))

    def compose(done: DataFrame, pick: DataFrame) -> DataFrame:
        nxt = pick.select(F.col("node").alias("root"), F.col("root").alias("next"))
        return done.join(nxt, "root", "left").select("node", F.coalesce("next", "root").alias("root"))

    return reduce(compose, picks)
