"""Connected components of a graph too large for one machine."""

from pyspark.sql import DataFrame, functions as F

from orderlake.llm.scratch import drop, stage

MOST_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (`a`, `b`: longs, either order, repeated or looped as may be) -> `node, component`.

    A component is named after its smallest node. Nodes without an edge to another are not in the result;
    nor are edges with a null end.

    Alternating star contraction: each node's neighbours are linked to the smallest of them, first the
    larger ones, then the smaller ones, until every edge points at its component's smallest node. The
    number of rounds grows with the logarithm of the graph. All steps are minima and joins by node.
    """
    links = stage(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .filter("a is not null and b is not null and a <> b")
        .distinct(),
        "links",
    )
    before = None
    for _ in range(MOST_ROUNDS):
        # An XOR of hashes is the same for the same set of links.
        state = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = links.union(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        lowest = both.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("m"))
        large = links.join(lowest, "lo").select("hi", F.least("lo", "m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(
            F.explode(
                F.array(
                    F.struct("hi", F.col("m").alias("lo")),
                    F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                )
            ).alias("x")
        )
        contracted = stage(small.select("x.hi", "x.lo").filter("hi <> lo").distinct(), "links")
        drop(links)
        links = contracted
    else:
        raise RuntimeError(f"no fixed point after {MOST_ROUNDS} rounds")
    component = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return component.union(component.select("component", "component").distinct())
