"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, label) for every node of the links (a, b); label is the smallest node that links lead to.

    Alternates large-star and small-star steps (each node sends its neighbours to the smallest of them) until nothing
    changes, so paths halve and hubs never gather their neighbours in one place: minima are pre-aggregated and joins on
    a hub can be split. Null nodes aren't allowed; an empty table gives an empty one.
    """
    now = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    for _ in range(most_rounds):
        both = _both(now)
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Links now lead down; each node keeps its smallest end and sends the other ends there.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        same = now.select(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if same == after.select(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first():
            break
        now = after
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
